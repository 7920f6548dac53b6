"""Operator 3: mix sources to target weights with distributed prefix sums. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import running_totals, saved, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float) -> DataFrame:
    """``source, source_size, target`` for ``sizes(source, source_size)``.

    Sources in code point order, null last, take the weights in turn. Shares of the total that would
    pass ``epochs`` times a source stop there, and the excess goes to the others by weight. That is one
    level L with target = min(cap, L x weight): sorted by cap / weight, L follows from running sums.
    """
    ranked = running_totals(
        sizes.select("source", "source_size", F.col("source").isNull().alias("__last"), F.lit(1).alias("__one")),
        ["__last", "source"],
        ["__one"],
        "source-ranks",
    )
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("__one_before") % len(weights) + 1).cast("int"))
    weighted = saved(
        ranked.select("source", "source_size", turn.alias("__weight"))
        .withColumn("__cap", F.col("source_size") * float(epochs))
        .withColumn("__ratio", F.col("__cap") / F.col("__weight")),
        "source-weights",
    )
    total, weight = weighted.agg(F.sum("source_size"), F.sum("__weight")).first()
    wanted = float(share) * float(total or 0)
    level = F.lit(wanted) - F.col("__cap_before")
    level = level / (F.lit(float(weight or 0)) - F.col("__weight_before"))
    # the first source that stays below its cap has the largest such level
    level = (
        running_totals(weighted, ["__ratio"], ["__cap", "__weight"], "source-levels")
        .select("__ratio", level.alias("level"))
        .filter("level < __ratio")
        .agg(F.max("level"))
        .first()[0]
    )
    target = F.col("__cap") if level is None else F.least("__cap", F.lit(level) * F.col("__weight"))
    return weighted.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = 17,
    whole_documents: bool = False,
) -> DataFrame:
    """All columns of ``docs`` and ``size, source_size, target, taken`` (replaced where present).

    Each source is sorted by range of hash-random keys over all tasks; its budget is cut exactly in the
    running totals of the sizes, after as many whole epochs as fit. ``taken`` counts the words the mix
    takes, repeats included. The document at the cut is taken in part, or, with ``whole_documents``,
    wholly if over half of it fits. Rows with equal id, text and source share a key and are treated
    alike, so reruns agree. A null text has size 0; null is a source of its own; without rows or words
    all targets are 0.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    keyed = docs.select(F.col("source"), _key(seed).alias("key"), word_count(F.col("text")).alias("size"))
    keys = saved(keyed.groupBy("source", "key").agg(F.sum("size").alias("size")), "mix-keys")
    sizes = keys.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes, weights, share, epochs), "mix-targets")

    totals = running_totals(keys, ["source", "key"], ["size"], "mix")
    budget = F.floor(F.col("target") + 0.5)
    plan = targets.withColumn(
        "__epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("__rest", (budget - F.col("__epochs") * F.col("source_size")).cast("long"))
    start = totals.groupBy("source").agg(F.min("size_before").alias("__start"))
    plan = saved(
        plan.alias("p")
        .join(start.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
        .select("p.*", "s.__start"),
        "mix-budgets",
    )
    before = F.col("size_before") - F.col("__start")
    cut = (
        totals.alias("t")
        .join(plan.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source")))
        .filter(before + F.col("size") > F.col("__rest"))
        .groupBy("t.source")
        .agg(F.min(F.struct("key", (F.col("__rest") - before).alias("part"), "size")).alias("__cut"))
    )
    plan = saved(
        plan.alias("p")
        .join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select(F.col("p.source").alias("__source"), "p.source_size", "p.target", "p.__epochs", "c.__cut"),
        "mix-cuts",
    )
    size, at, own = F.col("size"), F.col("__cut"), F.col("__key")
    if whole_documents:
        part = F.when(2 * at["part"] > at["size"], size).otherwise(0)
    else:
        part = F.floor(at["part"] * size / at["size"])
    last = F.when(at.isNull() | (own < at["key"]), size).when(own == at["key"], part).otherwise(0)
    return (
        docs.withColumns({"size": word_count(F.col("text")), "__key": _key(seed)})
        .join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("taken", (F.col("__epochs") * size + last).cast("long"))
        .drop("__key", "__source", "__epochs", "__cut")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs`` alone.

    A document without words has no copies to count and stays once if its source gives any.
    """
    read = {"doc_id", "text", "source"}
    held = docs.select(*(F.col(c).alias(c if c in read else f"__{i}") for i, c in enumerate(docs.columns)))
    mixed = mix(held, whole_documents=True, **options)
    size = F.col("size")
    copies = F.when(size > 0, F.col("taken") / size).otherwise((F.col("target") > 0).cast("int")).cast("int")
    columns = [F.col(h).alias(c) for h, c in zip(held.columns, docs.columns, strict=True)]
    return mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*columns)
