"""Running totals over all rows of a table, without a task that sees all of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.runtime import work_dir

_PART, _UPTO, _AMOUNT = "__part", "__upto", "__amount"


def running_total(
    df: DataFrame, amount: Column, name: str, order: list[str] | None = None
) -> tuple[DataFrame, int]:
    """``df`` with the sum of ``amount`` over the rows before each one as ``name``, and the whole sum.

    The rows are sorted by ``order`` across all tasks; without it they stay in the parts they are in.
    Every task adds up its own rows while they are written out, so a task that runs again cannot move
    them; what the parts before hold, one number a task, is joined to them. Rows of equal order follow
    each other in any sequence. A null ``amount`` is 0; amounts must not be negative.
    """
    spark = df.sparkSession
    path = work_dir(spark, "running-total")
    weighed = df.withColumn(_AMOUNT, F.coalesce(amount.cast("long"), F.lit(0).cast("long")))
    placed = (weighed.sort(*order) if order else weighed).withColumn(_PART, F.spark_partition_id())
    schema = T.StructType([*placed.schema.fields, T.StructField(_UPTO, T.LongType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            if batch.num_rows:
                upto = pc.add(pc.cumulative_sum(batch[_AMOUNT]), before)
                before = upto[-1].as_py()
                yield pa.RecordBatch.from_arrays([*batch.columns, upto], schema.fieldNames())

    placed.mapInArrow(add_up, schema).write.parquet(path)
    written = spark.read.schema(schema).parquet(path)
    parts = written.groupBy(_PART).agg(F.max(_UPTO).alias("__size"))
    # one row a task, here and in the broadcast
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _PART, "__size", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__earlier")
    )
    total = parts.agg(F.sum("__size")).first()[0] or 0
    numbered = written.join(F.broadcast(offsets.drop("__size")), _PART).select(
        *df.columns, (F.col("__earlier") + F.col(_UPTO) - F.col(_AMOUNT)).alias(name)
    )
    return numbered, total


def equal_shares(
    df: DataFrame,
    amount: Column,
    order: list[str],
    share: int,
    at_least: int = 1,
    at_most: int = 1 << 30,
    spread: tuple[int, int] = (1, 1),
) -> DataFrame:
    """``df`` in as many partitions as ``share`` goes into the whole ``amount``, all of nearly the same.

    Cuts are made in the running total, so a partition has at most the mean and one row more, however
    the amounts are spread over the values of ``order``. Partitions hold stretches of that order and are
    sorted by it. There are between ``at_least`` and ``at_most``; with ``at_most`` they grow instead.
    ``spread`` (n, least) makes up to n of a small whole, of at least that amount each.
    """
    rows, total = running_total(df, amount, "__before", order)
    few = min(spread[0], -(-total // spread[1]))
    tasks = min(at_most, max(at_least, few, -(-total // share), 1))
    size = max(1, -(-total // tasks))
    number = F.least(F.expr(f"__before div {size}"), F.lit(tasks - 1)).cast("int")
    return rows.repartitionById(tasks, number).sortWithinPartitions(*order).drop("__before")
