import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from crawlspark.streaming import host_hold

SCHEMA = (
    "seen_time_epoch long, process_time_epoch long, source string, fqdn_no_www string, page_url string, "
    "app_type string, app_name string, seen_ts timestamp"
)
BASE = 1_600_000_000


def fact(at, host, app):
    ts = dt.datetime.fromtimestamp(BASE, dt.timezone.utc) + dt.timedelta(seconds=at)
    return (BASE + int(at), BASE, "s", host, f"{host}/{at}", "html", app, ts)


def by_hand(facts, hold=60):
    """Holds of facts in order of time."""
    out, now = [], {}
    for at, host, app in sorted(facts):
        if host not in now or at >= now[host][0] + hold:
            now[host] = (at, f"{host}/{at}", set())
            out.append((host, now[host]))
        now[host][2].add(app)
    return sorted((host, start, page, tuple(sorted(apps))) for host, (start, page, apps) in out)


def shown(df):
    start = f"unix_micros(hold_start) / 1e6 - {BASE} as start"
    rows = df.selectExpr("fqdn_no_www", start, "page_url", "name_type_list.app_name as apps").collect()
    return sorted((r[0], r[1], r[2], tuple(sorted(r[3]))) for r in rows)


def streamed(spark, path, triggers, **options):
    for i, facts in enumerate(triggers):
        spark.createDataFrame([fact(*f) for f in facts], SCHEMA).coalesce(1).write.parquet(f"{path}/in/{i}")
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{path}/in")
    stream = host_hold.stream_host_hold(rows, buckets=4, **options)
    run = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state")
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def test_a_hold_begins_with_the_first_match(spark, tmp_path):
    facts = [(0, "a", "x"), (59.9, "a", "y"), (60, "a", "z"), (61, "b", "x"), (119, "a", "x"), (200, "a", "q"), (320, "c", "x")]
    emitted = streamed(spark, str(tmp_path), [facts])
    assert shown(emitted) == [r for r in by_hand(facts) if r[0] != "c"]
    whole = spark.createDataFrame([fact(*f) for f in facts], SCHEMA)
    assert shown(host_hold.host_holds(whole)) == by_hand(facts)
    # 320 less the delay is where the hold of 200 ends: emitted, not open
    assert shown(host_hold.open_host_holds(whole)) == [r for r in by_hand(facts) if r[0] == "c"]


@pytest.mark.parametrize("per_trigger", [40, 150])
def test_holds_outlast_triggers(spark, tmp_path, per_trigger):
    source = random.Random(per_trigger)
    facts = sorted((source.randrange(3_000) / 2, source.choice("abcdef"), source.choice("xyz")) for _ in range(300))
    parts = [facts[i : i + per_trigger] for i in range(0, len(facts), per_trigger)]
    for part in parts:
        source.shuffle(part)
    emitted = streamed(spark, str(tmp_path), parts)
    whole = spark.createDataFrame([fact(*f) for f in facts], SCHEMA)
    assert sorted(shown(emitted) + shown(host_hold.open_host_holds(whole))) == by_hand(facts)


def test_the_hosts_held_longest_make_room(spark, tmp_path):
    facts = [(i, f"host{i}", "x") for i in range(40)]
    emitted = streamed(spark, str(tmp_path), [facts], max_hosts=8)
    found = shown(emitted)
    # two of each of the four buckets are held on, those that came last
    assert len(found) == 32 and found == [r for r in by_hand(facts) if r in found]
    assert "host0" in {r[0] for r in found} and "host39" not in {r[0] for r in found}


def test_no_facts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert host_hold.host_holds(none).count() == 0
    assert host_hold.open_host_holds(none).count() == 0


class _Handle:
    """State and timers of one bucket, which counts how often the state is read whole."""

    def __init__(self):
        self.rows, self.timers, self.reads = {}, set(), 0

    def getMapState(self, *_):
        return self

    def iterator(self):
        self.reads += 1
        return iter(list(self.rows.items()))

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def containsKey(self, key):
        return key in self.rows

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def listTimers(self):
        return iter(sorted(self.timers))


def test_a_bucket_is_read_once_a_trigger():
    hosts, hold_us = 200, 60_000_000
    handle, processor = _Handle(), host_hold.HostHold(hold_us, hosts)
    processor.init(handle)
    facts = [fact(i / 10, f"host{i}", "x") for i in range(hosts)]
    rows = pd.DataFrame(facts, columns=[f.split()[0] for f in SCHEMA.split(", ")])
    rows["seen_us"] = [BASE * 1_000_000 + i * 100_000 for i in range(hosts)]
    assert [len(out) for out in processor.handleInputRows((0,), iter([rows]), None)] == [0]
    for passed, left in ((150, 50), (199, 1), (200, 0)):
        mark = BASE * 1_000 + 60_000 + (passed - 1) * 100
        values, before, emitted = TimerValues(0, mark), handle.reads, []
        for at in sorted(t for t in handle.timers if t <= mark):
            for out in processor.handleExpiredTimer((0,), values, ExpiredTimerInfo(at)):
                emitted += list(out["fqdn_no_www"])
            handle.deleteTimer(at)
        assert handle.reads - before == 1
        assert len(handle.rows) == left and len(handle.timers) == min(left, 1)
        assert f"host{passed - 1}" in emitted
