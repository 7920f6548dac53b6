"""Match facts held per host from its first match on."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crawlspark.operators.rollup import CARRIER

MAX_HOSTS = 50_000
BUCKETS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_PAIRS = "array<struct<app_name:string,app_type:string>>"
_HELD = f"start long, seen_time_epoch long, page_url string, process_time_epoch long, source string, name_type_list {_PAIRS}"
_ROW = f"hold_start timestamp, fqdn_no_www string, seen_time_epoch long, page_url string, process_time_epoch long, source string, name_type_list {_PAIRS}"
_OUT = f"fqdn_no_www string, {_HELD}"


class _Hold:
    """What is held of one host: the first match, and the apps so far."""

    __slots__ = ("apps", "carrier", "start")

    def __init__(self, start: int, carrier: tuple, apps: set) -> None:
        self.start, self.carrier, self.apps = start, carrier, apps

    def add(self, carrier: tuple, app: tuple) -> None:
        self.carrier = min(self.carrier, carrier)
        self.apps.add(app)

    def value(self) -> tuple:
        return (self.start, *self.carrier, [{"app_name": n, "app_type": t} for n, t in sorted(self.apps)])


def _facts(rows: pd.DataFrame) -> Iterator[tuple]:
    """``host, microseconds, carrier, app`` of rows in order of time."""
    rows = rows.sort_values("seen_us", kind="stable")
    carriers = zip(*(rows[c] for c in CARRIER), strict=True)
    apps = zip(rows["app_name"], rows["app_type"], strict=True)
    return zip(rows["fqdn_no_www"], rows["seen_us"].astype("int64"), carriers, apps, strict=True)


def _emitted(holds: list[tuple[str, _Hold]]) -> pd.DataFrame:
    columns = ["fqdn_no_www", "start", *CARRIER, "name_type_list"]
    return pd.DataFrame([(host, *hold.value()) for host, hold in holds], columns=columns)


class HostHold(StatefulProcessor):
    """State of one bucket of hosts, with one timer: for the hold that ends first.

    A timer costs a read of the whole bucket, so the one that expires ends all holds that the watermark has passed.
    """

    def __init__(self, hold_us: int, most: int) -> None:
        self.hold_us, self.most = hold_us, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getMapState("held", "host string", _HELD)

    def _load(self) -> dict[str, _Hold]:
        held = {}
        for (host,), (start, *carrier, pairs) in self.state.iterator():
            held[host] = _Hold(start, tuple(carrier), {(p["app_name"], p["app_type"]) for p in pairs})
        return held

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, done, changed = self._load(), [], set()
        # the rows of a trigger come in any order
        for host, us, carrier, app in _facts(pd.concat(list(rows))):
            now = held.get(host)
            if now is not None and us >= now.start + self.hold_us:
                done.append((host, now))
                now = None
            if now is None:
                now = held[host] = _Hold(us, carrier, set())
            now.add(carrier, app)
            changed.add(host)
        # the hosts held longest make room
        for host in sorted(held, key=lambda h: (held[h].start, h))[: max(0, len(held) - self.most)]:
            done.append((host, held.pop(host)))
            changed.discard(host)
            if self.state.containsKey((host,)):
                self.state.removeKey((host,))
        for host in changed:
            self.state.updateValue((host,), held[host].value())
        first = self._first_end(held)
        timers = list(self.handle.listTimers())
        for at in timers:
            if at != first:
                self.handle.deleteTimer(at)
        if first is not None and first not in timers:
            self.handle.registerTimer(first)
        yield _emitted(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark, held = timerValues.getCurrentWatermarkInMs(), self._load()
        done = [(host, hold) for host, hold in held.items() if _end_ms(hold.start + self.hold_us) <= mark]
        for host, _ in done:
            del held[host]
            self.state.removeKey((host,))
        first = self._first_end(held)
        if first is not None:
            self.handle.registerTimer(first)
        if done:
            yield _emitted(done)

    def _first_end(self, held: dict[str, _Hold]) -> int | None:
        return min((_end_ms(hold.start + self.hold_us) for hold in held.values()), default=None)

    def close(self) -> None:
        pass


def _end_ms(us: int) -> int:
    return -(-int(us) // 1000)


def _micros(hold: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {hold}"))


def _hold_us(df: DataFrame, hold: str) -> int:
    return df.sparkSession.range(1).select(_micros(hold)).first()[0]


def _rows(facts: DataFrame, time: str) -> DataFrame:
    return facts.withColumn("seen_us", F.unix_micros(time))


def _shaped(found: DataFrame) -> DataFrame:
    return found.select(
        F.timestamp_micros("start").alias("hold_start"), "fqdn_no_www", *CARRIER, "name_type_list"
    )


def stream_host_hold(
    facts: DataFrame,
    hold: str = "60 seconds",
    delay: str = "60 seconds",
    time: str = "seen_ts",
    max_hosts: int = MAX_HOSTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per host and hold, which begins with the host's first match and lasts for ``hold``.

    A hold is emitted when the watermark passes its end or a later match of the host comes, which begins
    the next one. At most ``max_hosts`` are held, spread over ``buckets`` by hash: a bucket that is full emits
    those held longest. A task sorts a bucket's rows of one trigger, so the source should bound its triggers.
    State is kept in RocksDB, for which the session is set. The holds that are open when finished input ends
    are those of ``open_host_holds``.
    """
    spark = facts.sparkSession
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
    timed = _rows(facts.withWatermark(time, delay), time)
    bucketed = timed.withColumn("hosts_no", F.pmod(F.xxhash64("fqdn_no_www"), F.lit(buckets)))
    found = bucketed.groupBy("hosts_no").transformWithStateInPandas(
        statefulProcessor=HostHold(_hold_us(facts, hold), max(1, max_hosts // buckets)),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return _shaped(found)


def host_holds(facts: DataFrame, hold: str = "60 seconds", time: str = "seen_ts") -> DataFrame:
    """All holds of finished facts, in batch: the same rows, without a limit of hosts.

    Rows are sorted by host and time and read in turn; a task holds one host's apps at a time.
    """
    hold_us = _hold_us(facts, hold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host = now = None
        for rows in batches:
            done = []
            for own, us, carrier, app in zip(
                rows["fqdn_no_www"],
                rows["seen_us"],
                zip(*(rows[c] for c in CARRIER), strict=True),
                zip(rows["app_name"], rows["app_type"], strict=True),
                strict=True,
            ):
                if now is None or own != host or us >= now.start + hold_us:
                    if now is not None:
                        done.append((host, now))
                    host, now = own, _Hold(int(us), carrier, set())
                now.add(carrier, app)
            yield _emitted(done)
        if now is not None:
            yield _emitted([(host, now)])

    in_turn = _rows(facts, time).repartition("fqdn_no_www").sortWithinPartitions("fqdn_no_www", "seen_us")
    return _shaped(in_turn.mapInPandas(run, _OUT))


def open_host_holds(
    facts: DataFrame, hold: str = "60 seconds", delay: str = "60 seconds", time: str = "seen_ts"
) -> DataFrame:
    """The rows that ``stream_host_hold`` holds back when its input has ended; ``facts`` are the same in batch.

    That is the last hold of every host, if it ends after the last watermark.
    """
    last = facts.agg(F.unix_millis(F.max(time) - F.expr(f"interval {delay}"))).first()[0]
    end = F.ceil((F.unix_micros("hold_start") + F.lit(_hold_us(facts, hold))) / F.lit(1000))
    held = host_holds(facts, hold, time).where(end > F.lit(last))
    newest = held.groupBy("fqdn_no_www").agg(F.max_by(F.struct("*"), "hold_start").alias("held"))
    return newest.select("held.*")
