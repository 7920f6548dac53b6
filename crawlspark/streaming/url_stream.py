"""Streams of selected URLs: resumable intake and the cap per domain."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crawlspark.functions import urls
from crawlspark.operators.select_urls import QUOTA_ORDER
from crawlspark.schemas import SELECTED_URL

SPILL_GROUPS = 64


def stream_selected(
    spark: SparkSession,
    root: str,
    files_per_trigger: int = 1000,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The gzipped JSON-lines files below ``root`` as a stream.

    The checkpoint of the query that consumes it records which files are done, and a finished set
    of files is read to its end with ``trigger(availableNow=True)``. A trigger takes in a number
    of files, or, if given, a number of bytes such as ``"10g"``.
    """
    limit = ("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        limit = ("maxBytesPerTrigger", bytes_per_trigger)
    return (
        spark.readStream.schema(SELECTED_URL)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz")
        .option(*limit)
        .json(root)
    )


def stream_cap_per_domain(stream: DataFrame, cap: int) -> DataFrame:
    """T4: the first ``cap`` pages of every domain over the whole stream, and all homepages.

    State is one small count per domain and is never evicted, so the cap is exact. Pages of one
    trigger are ranked in the order of the batch operator, after those of earlier triggers.

    Before the shuffle every Arrow batch drops what cannot be among its first ``cap`` rows of a
    domain, so a trigger full of one domain sends ``cap`` rows a batch to one task, which holds the
    best ``cap`` and one batch at a time. Homepages among the dropped go around the count, spread
    over groups of their own.
    """
    if cap == 0:
        return stream
    columns, schema = stream.columns, stream.schema
    order = list(QUOTA_ORDER)
    keyed = stream.select(
        "*",
        urls.host_no_www(F.col("url")).alias("_host"),
        urls.is_homepage(F.col("url")).alias("_home"),
        F.lit(0).alias("_group"),
    )

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch.sort_values(order, kind="stable").groupby("_host", dropna=False).cumcount()
            beyond = rank.reindex(batch.index) >= cap
            spread = pd.Series(range(len(batch)), index=batch.index, dtype="int32") % SPILL_GROUPS
            group = batch["_group"].mask(beyond, 1 + spread)
            yield batch.assign(_group=group)[~beyond | batch["_home"]]

    def count(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if key[1] > 0:
            for batch in batches:
                yield batch[columns]
            return
        room = cap - (state.get[0] if state.exists else 0)
        best = None
        for batch in batches:
            rows = batch if best is None else pd.concat([best, batch])
            rows = rows.sort_values(order, kind="stable")
            best, beyond = rows.iloc[:room], rows.iloc[room:]
            yield beyond[beyond["_home"]][columns]
        state.update((cap - room + len(best),))
        yield best[columns]

    return (
        keyed.mapInPandas(thin, keyed.schema)
        .groupBy("_host", "_group")
        .applyInPandasWithState(count, schema, "pages long", "append", GroupStateTimeout.NoTimeout)
    )
