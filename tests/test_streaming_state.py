"""Stateful keep-latest, snapshots, observed counts, catalog tables, crash and replay."""

from __future__ import annotations

import time
from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.bronze import bronze
from checks.queries import QUERIES
from courierlake.operators.dedup import keep_latest
from courierlake.session import scratch_path
from courierlake.sources import events as ev
from courierlake.sources import tables, versions
from courierlake.sources.schemas import TOPICS
from courierlake.streaming import latest, metrics, recovery, runs
from courierlake.streaming import topics as st
from courierlake.streaming import upsert

SCHEMA = T.StructType().add("id", T.IntegerType()).add("at", T.IntegerType()).add("v", T.StringType())


def paths(spark, *names):
    return [scratch_path(spark, n) for n in names]


def equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def land(spark, path, *batches):
    """One file for each batch."""
    for rows in batches:
        tables.land(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)


# --- keep-latest ---------------------------------------------------------------------


class Table:
    """A stream into a change log, and snapshots of the table it stands for."""

    def __init__(self, spark, every="15 seconds", slack="0 seconds"):
        self.spark, self.every, self.slack = spark, every, slack
        self.landed, self.log, self.ckpt, self.root = paths(spark, "landed", "log", "ckpt", "snap")

    def run(self, *batches):
        land(self.spark, self.landed, *batches)
        stream = st.landed_rows(self.spark, self.landed, SCHEMA, maxFilesPerTrigger="1")
        query = latest.start_latest(
            stream, "id", "at", self.log, self.ckpt, every=self.every, slack=self.slack
        )
        query.awaitTermination()
        return query

    def snapshot(self):
        df = latest.write_snapshot(self.spark, self.log, self.ckpt, "id", "at", self.root, SCHEMA)
        return {tuple(r) for r in df.collect()} if df.count() == df.distinct().count() else df.collect()


def test_late_and_repeated_rows_over_a_restart(spark):
    t = Table(spark)
    t.run([(1, 10, "a"), (2, 10, "a")], [(1, 5, "late"), (2, 20, "b"), (3, 1, "c")])
    assert t.snapshot() == {(1, 10, "a"), (2, 20, "b"), (3, 1, "c")}
    t.run([(2, 20, "b"), (2, 15, "late"), (1, 11, "d"), (4, None, "no time")], [(4, 99, "e"), (None, 1, "no key")])
    assert t.snapshot() == {
        (1, 11, "d"), (2, 20, "b"), (3, 1, "c"), (4, None, "no time"), (None, 1, "no key")
    }


@pytest.mark.parametrize("every", ["1 second", "1 hour"])
def test_windows_leave_the_state_when_they_close(spark, every):
    """With short windows rows reach the log, with long ones all are read from the state."""
    import time

    t = Table(spark, every)
    for k in range(3):
        t.run([(i, k, str(k)) for i in range(20)], [(100 + k, 0, "x")])
        time.sleep(1.1)
    logged = spark.read.schema(SCHEMA).parquet(t.log).count()
    still_open = latest.open_rows(spark, t.ckpt, SCHEMA).count()
    assert (logged > 0) == (every == "1 second") and still_open > 0
    if every == "1 second":
        assert still_open < 20 + 20 + 3
    assert t.snapshot() == {(i, 2, "2") for i in range(20)} | {(100 + k, 0, "x") for k in range(3)}


def test_snapshots_read_only_what_is_new(spark):
    import time

    t = Table(spark, "1 second")
    for k in range(3):
        t.run([(i, k, str(k)) for i in range(5)])
        time.sleep(1.1)
        t.snapshot()
    version = versions.current(spark, t.root)
    windows = [r[0] for r in spark.read.parquet(t.log).select(latest.WINDOW).distinct().collect()]
    assert version.number == 3 and version.info == {"window": max(windows)}
    # What earlier snapshots have covered is not read again.
    for w in windows[:-1]:
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{t.log}/{latest.WINDOW}={w}")
        assert fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    t.run([(0, 0, "late")])
    assert t.snapshot() == {(i, 2, "2") for i in range(5)}


def test_ties_as_in_the_batch_operator(spark):
    rows = [(i % 5, 7, f"v{i}") for i in range(50)]
    t = Table(spark, slack=latest.CLOCK_SLACK)
    t.run(rows[:20], rows[20:30], rows[30:])
    want = keep_latest(spark.createDataFrame(rows, SCHEMA), "id", "at").collect()
    assert t.snapshot() == {tuple(r) for r in want}


def test_a_stream_without_rows_gives_an_empty_snapshot(spark):
    t = Table(spark)
    t.run([])
    assert t.snapshot() == set()


def test_stream_equals_batch_on_a_whole_table(spark, sf):
    users = bronze(spark, sf, "users").filter("user_id IS NOT NULL")
    landed, log, ckpt, root = paths(spark, "landed", "log", "ckpt", "snap")
    tables.land(users.repartition(5), landed)
    stream = st.landed_rows(spark, landed, users.schema, maxFilesPerTrigger="2")
    latest.start_latest(stream, "user_id", "event_time", log, ckpt).awaitTermination()
    got = latest.write_snapshot(spark, log, ckpt, "user_id", "event_time", root, users.schema)
    assert equal(got, upsert.merge_latest(users, users, ["user_id"], "event_time"))


# --- versions ------------------------------------------------------------------------


def test_a_writer_that_dies_leaves_the_old_version(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    schema = T.StructType.fromDDL("id long")
    assert versions.current(spark, root) is None and versions.read_current(spark, root, schema).count() == 0
    versions.publish(spark.range(3), root)
    with monkeypatch.context() as m:
        m.setattr(versions, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("dies")))
        with pytest.raises(RuntimeError):
            versions.publish(spark.range(5), root)
    assert versions.read_current(spark, root, schema).count() == 3
    version = versions.publish(versions.read_current(spark, root, schema).union(spark.range(1)), root, {"a": 1})
    assert (version.number, versions.current(spark, root).info) == (2, {"a": 1})
    assert versions.read_current(spark, root, schema).count() == 4


def test_old_versions_expire(spark):
    root = scratch_path(spark, "versions")
    for k in range(4):
        versions.publish(spark.range(k), root)
    assert versions.expire(spark, root, keep=2) == 2
    assert versions.read_current(spark, root, T.StructType.fromDDL("id long")).count() == 3
    assert versions.expire(spark, root, keep=2) == 0


# --- observed counts -----------------------------------------------------------------


@pytest.mark.parametrize("keep", [None, "key is not null and cast(key as int) % 10 <> 3"])
def test_received_against_landed(spark, keep):
    log, path, ckpt = paths(spark, "messages", "landed", "ckpt")
    rows = [(t, None if k == 0 else str(k), "{}") for n, t in enumerate(TOPICS[:4]) for k in range(10 * n)]
    for part in range(3):
        ev.publish(spark.createDataFrame(rows[part::3], st.MESSAGE_SCHEMA), log, fmt="parquet")
    stream = st.read_topics(spark, log, fmt="parquet", maxFilesPerTrigger="2")
    query = metrics.land_audited(stream, path, ckpt, TOPICS, None if keep is None else F.expr(keep))
    batches = metrics.observed_batches(query)
    assert len(batches) > 2
    got = {r.topic: r for r in metrics.received_and_landed(spark, batches, TOPICS).collect()}
    assert list(got) == list(TOPICS)
    landed = spark.read.schema(st.MESSAGE_SCHEMA).parquet(path)
    for n, t in enumerate(TOPICS[:4]):
        # A null key and every key that ends in 3 are dropped.
        lost = 0 if keep is None or not n else 1 + n
        assert (got[t].received, got[t].landed, got[t].lost) == (10 * n, 10 * n - lost, lost)
        assert landed.where(F.col("topic") == t).count() == got[t].landed


def test_a_failed_query_raises(spark):
    log, path, ckpt = paths(spark, "messages", "landed", "ckpt")
    ev.publish(spark.createDataFrame([("users", "1", "{}")], st.MESSAGE_SCHEMA), log, fmt="parquet")
    stream = st.read_topics(spark, log, fmt="parquet")
    query = metrics.land_audited(stream, path, ckpt, TOPICS, F.raise_error(F.lit("broken")).cast("boolean"))
    with pytest.raises(Exception, match="broken"):
        metrics.observed_batches(query)


# --- catalog tables ------------------------------------------------------------------


def test_loader_creates_and_appends_to_a_catalog_table(spark):
    landed, root, ckpt = paths(spark, "landed", "zone", "ckpt")
    name = "state_bronze.things"
    try:
        for k in range(2):
            land(spark, landed, [(k, 1, "a")], [(k, 2, "b")], [])
            for _ in range(2):  # the second run finds nothing new
                st.load_table(spark, landed, SCHEMA, name, root, ckpt).awaitTermination()
            assert spark.table(name).count() == 2 * (k + 1)
        assert spark.table(name).schema.simpleString() == SCHEMA.simpleString()
        # The sink skips batches it has seen the number of, so a second checkpoint would lose rows.
        with pytest.raises(ValueError, match="another checkpoint"):
            st.load_table(spark, landed, SCHEMA, name, root, scratch_path(spark, "ckpt"))
        assert spark.sql(f"SELECT count(*) FROM {name} WHERE v = 'b'").first()[0] == 2
    finally:
        spark.sql("DROP SCHEMA IF EXISTS state_bronze CASCADE")


# --- crash, resume, replay -----------------------------------------------------------


def load(spark, landed, table, ckpt):
    query = st.load_bronze(spark, landed, SCHEMA, table, ckpt, maxFilesPerTrigger="1")
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def read(spark, table):
    return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(table).collect())


def test_a_batch_without_commit_is_run_again_and_not_written_twice(spark):
    landed, table, ckpt = paths(spark, "landed", "table", "ckpt")
    land(spark, landed, *[[(k, k, "a")] for k in range(3)])
    assert load(spark, landed, table, ckpt) == 3
    assert recovery.forget_commit(spark, ckpt) == 2
    assert recovery.last_batch(spark, ckpt) == 1 and recovery.last_batch(spark, ckpt, "offsets") == 2
    assert load(spark, landed, table, ckpt) == 0  # run again, and found in the sink's log
    assert read(spark, table) == [0, 1, 2] and recovery.last_batch(spark, ckpt) == 2


def test_files_without_an_entry_in_the_sinks_log_are_not_seen(spark):
    landed, table, ckpt = paths(spark, "landed", "table", "ckpt")
    land(spark, landed, *[[(k, k, "a")] for k in range(3)])
    load(spark, landed, table, ckpt)
    assert recovery.forget_commit(spark, ckpt, table) == 2
    assert read(spark, table) == [0, 1]
    assert load(spark, landed, table, ckpt) == 1  # read and written again
    assert read(spark, table) == [0, 1, 2]


@pytest.mark.parametrize("batch", [0, 1, 3])
def test_replay_from_a_batch(spark, batch):
    landed, table, ckpt = paths(spark, "landed", "table", "ckpt")
    land(spark, landed, *[[(k, k, "a")] for k in range(4)])
    load(spark, landed, table, ckpt)
    dropped = recovery.rewind(spark, ckpt, table, batch)
    assert len(dropped) == 3 - batch
    assert read(spark, table) == list(range(batch + 1))
    land(spark, landed, [(4, 4, "new")])
    assert load(spark, landed, table, ckpt) == 4 - batch
    assert read(spark, table) == [0, 1, 2, 3, 4]


def test_a_compacted_log_is_not_taken_apart(spark):
    landed, table, ckpt = paths(spark, "landed", "table", "ckpt")
    land(spark, landed, *[[(k, k, "a")] for k in range(11)])
    load(spark, landed, table, ckpt)
    with pytest.raises(ValueError, match="new checkpoint"):
        recovery.rewind(spark, ckpt, table, 1)
    assert read(spark, table) == list(range(11))
    assert len(recovery.rewind(spark, ckpt, table, 9)) == 1
    assert read(spark, table) == list(range(10))


# --- runs at an interval -------------------------------------------------------------


def test_a_run_at_an_interval_stops_when_idle(spark):
    landed, table, ckpt = paths(spark, "landed", "table", "ckpt")
    land(spark, landed, *[[(k, j, "a") for j in range(10)] for k in range(4)])
    rows = st.landed_rows(spark, landed, SCHEMA, maxFilesPerTrigger="1")
    writer = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", ckpt)
    batches = runs.run_until_idle(writer.trigger(processingTime="200 milliseconds").start(), idle=2)
    assert [b[:2] for b in batches] == [(k, 10) for k in range(4)]
    assert all(a[3] <= b[2] + timedelta(milliseconds=1) for a, b in zip(batches, batches[1:], strict=False))
    assert spark.read.schema(SCHEMA).parquet(table).count() == 40


class Looking:
    """A query of one batch, whose triggers then look for files all the time and find none."""

    def __init__(self, looks: int):
        self.isActive, self.recentProgress, self.polls, self.looks = True, [], 0, looks

    @property
    def status(self):
        return {"isTriggerActive": True, "isDataAvailable": self.polls == 3}

    def processAllAvailable(self):
        until = self.polls + self.looks
        while self.isActive and self.polls < until:
            time.sleep(0.001)

    def stop(self):
        self.isActive = False

    def awaitTermination(self, poll=None):
        if poll:
            self.polls += 1
            time.sleep(poll)
        if self.polls == 4:
            took = {"triggerExecution": 10}
            self.recentProgress = [SimpleNamespace(numInputRows=5, batchId=0, timestamp="2024-01-01T00:00:00.000Z", durationMs=took)]
        if self.polls > 500:
            self.stop()
            raise TimeoutError("it never counts as idle")


@pytest.mark.parametrize("looks", [5, 50])
def test_a_run_is_idle_although_triggers_always_look_for_files(looks):
    query = Looking(looks)
    batches = runs.run_until_idle(query, idle=0.1, poll=0.01)
    assert [b[:2] for b in batches] == [(0, 5)]
    assert looks < query.polls < 500  # not before a look has found nothing


def test_a_larger_backlog_takes_larger_runs(spark):
    (landed,) = paths(spark, "landed")
    spark.range(1000).repartition(100).write.parquet(landed)
    assert st.files_per_run(spark, landed, least=4) == -(-101 // st.RUNS)  # the job's marker is a file too
    assert st.files_per_run(spark, landed, least=9) == 9
    spark.range(400).write.option("maxRecordsPerFile", 1).mode("append").parquet(landed)
    assert st.files_per_run(spark, landed, least=4) == -(-501 // st.RUNS)
    assert st.files_per_run(spark, landed, least=2000) == int(st.FILES_PER_TRIGGER)


def test_interval_runs_do_not_grow_with_the_backlog(spark, tmp_path):
    events = spark.range(300).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "id AS user_id", "'a' AS event_type", "0.5D AS value", "'{}' AS props"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "FLUSH_ROWS", 2)  # some 150 files
        patch.setattr(runs, "run_until_idle", lambda *a, f=runs.run_until_idle, **b: seen.extend(f(*a, **b)) or seen)
        got = QUERIES["stream_interval_runs"](spark, str(tmp_path)).first()
    assert got.asDict() == {"rows": 300, "bounded": True, "overlaps": 0, "loaded": 300}
    assert 1 < len(seen) <= st.RUNS + 1


# --- a whole landing zone ------------------------------------------------------------


def test_one_query_loads_all_topics(spark, sf):
    landed, zone, ckpt = paths(spark, "landed", "zone", "ckpt")
    topics = ("orders", "billing", "delivery", "reviews")  # with columns of one name and different types
    for run in range(3):
        for topic in topics:
            rows = bronze(spark, sf, topic)
            part = F.pmod(F.xxhash64("event_time"), F.lit(2)) == run  # none in the last run
            tables.land(rows.where(part), f"{landed}/{topic}")
        query = st.load_zone(spark, landed, zone, ckpt, topics, maxFilesPerTrigger="2")
        query.awaitTermination()
        assert (sum(p.numInputRows for p in query.recentProgress) > 0) == (run < 2)
    for topic in topics:
        assert equal(st.read_zone(spark, zone, topic), bronze(spark, sf, topic)), topic
    text = st.read_zone(spark, zone, "orders").select("status")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<orders:struct<status:string>>" in text and "table#" in text
