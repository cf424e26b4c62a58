"""Streams equal their batch result, and a restart adds nothing."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.bronze import bronze
from courierlake.plans.silver import SILVER
from courierlake.session import scratch_path
from courierlake.sources import events as ev
from courierlake.sources import tables
from courierlake.sources.schemas import PRIMARY_KEYS, TOPICS, bronze_schema
from courierlake.streaming import topics as st
from courierlake.streaming import upsert


def equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def log(spark, sf):
    path = scratch_path(spark, "log")
    for t in TOPICS:
        ev.publish(ev.bronze_messages(bronze(spark, sf, t), t), path, fmt="parquet")
    return path


def test_all_topics_land_typed_and_complete(spark, sf, log):
    root, ckpt = scratch_path(spark, "landed"), scratch_path(spark, "ckpt")
    for _ in range(2):  # the second round starts from the checkpoints and finds nothing new
        for query in st.land_topics(spark, log, root, ckpt, fmt="parquet").values():
            query.awaitTermination()
    for t in TOPICS:
        landed = spark.read.parquet(f"{root}/{t}").drop(ev.CORRUPT)
        want = bronze(spark, sf, t)
        assert [f.name for f in landed.schema] == [f.name for f in want.schema]
        assert equal(landed, want), t


def test_new_checkpoint_replays_from_the_start(spark, sf, log):
    counts = []
    for _ in range(2):
        path = scratch_path(spark, "replay")
        messages = st.read_topics(spark, log, ("users",), fmt="parquet")
        st.land_events(messages, bronze_schema("users"), path, scratch_path(spark, "ckpt")).awaitTermination()
        counts.append(spark.read.parquet(path).count())
    assert counts[0] == counts[1] == bronze(spark, sf, "users").count()


def test_bad_messages_are_kept_as_text(spark):
    messages = spark.createDataFrame([("t", "1", '{"a": 1}'), ("t", "2", "{oops"), ("t", "3", '{"a": "x"}')], st.MESSAGE_SCHEMA)
    got = ev.from_messages(messages, T.StructType([T.StructField("a", T.IntegerType())])).collect()
    assert [(r.a, r[ev.CORRUPT]) for r in got] == [(1, None), (None, "{oops"), (None, '{"a": "x"}')]


def test_loader_takes_new_files_once_and_archives_them(spark, sf):
    landed, table, ckpt, archive = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt", "arch"))
    reviews = bronze(spark, sf, "reviews")
    seen = []
    for part in (F.col("platform") == "ios", F.col("platform") != "ios"):
        tables.land(reviews.filter(part), landed)
        query = st.load_bronze(spark, landed, reviews.schema, table, ckpt, "archive", archive)
        query.awaitTermination()
        seen.append(sum(p.numInputRows for p in query.recentProgress))
    assert sum(seen) == reviews.count()
    assert equal(spark.read.schema(reviews.schema).parquet(table), reviews)


def test_empty_files_add_nothing(spark, sf):
    landed, table, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    users = bronze(spark, sf, "users")
    tables.land(users, landed)
    tables.land(users.filter(F.lit(False)), landed)
    st.load_bronze(spark, landed, users.schema, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == users.count()


def test_upsert_equals_batch_dedup(spark, sf):
    users = bronze(spark, sf, "users").filter(F.col("user_id").isNotNull())
    first, second = users.filter("event_time < '2001-08-02'"), users.filter("event_time >= '2001-08-02'")
    merged = upsert.merge_latest(upsert.merge_latest(first, second, ["user_id"], "event_time"), second, ["user_id"], "event_time")
    log = scratch_path(spark, "changes")
    for batch_id, batch in [(0, first), (1, second), (1, second)]:  # batch 1 is replayed
        upsert.append_batch(batch, batch_id, log)
    changes = spark.read.parquet(log).drop("batch")
    snapshot = upsert.write_snapshot(changes, ["user_id"], "event_time", scratch_path(spark, "snap"))
    assert equal(merged, snapshot)
    as_of = date(2001, 9, 1)
    assert equal(SILVER["users"](snapshot, as_of), SILVER["users"](users, as_of))


def test_landed_files_respect_the_row_limit(spark, sf):
    root = scratch_path(spark, "files")
    for topic in ("orders", "users"):
        tables.land(bronze(spark, sf, topic), f"{root}/{topic}", tables.FLUSH_ROWS)
    audit = {r["table"]: r for r in tables.rows_by_table(spark, root).collect()}
    assert set(audit) == {"ORDERS", "USERS"}
    assert audit["ORDERS"].rows == bronze(spark, sf, "orders").count()
    assert all(r.largest_file <= tables.FLUSH_ROWS for r in audit.values())


def test_tables_land_at_once_and_are_told_by_file(spark):
    root = scratch_path(spark, "zone")
    meet = threading.Barrier(3, timeout=60)
    land = tables.land

    def both(df, path, rows_per_file):
        meet.wait()  # breaks if a table waits for another one
        land(df, path, rows_per_file)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "land", both)
        tables.land_all({f"t{k}": spark.range(10 * k) for k in range(1, 4)}, root, 4)
    audit = tables.rows_by_table(spark, root)
    assert {r.table: (r.rows, r.largest_file <= 4) for r in audit.collect()} == {f"T{k}": (10 * k, True) for k in range(1, 4)}
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" in plan and "substring_index" not in plan[plan.rindex("Project ") :]  # once for each file
    with pytest.raises(Exception, match="broken"):
        tables.land_all({"t1": spark.range(1).selectExpr("raise_error('broken') AS x")}, root)


def test_compaction_keeps_rows_and_drops_files(spark, sf):
    small, big = scratch_path(spark, "small"), scratch_path(spark, "big")
    reviews = bronze(spark, sf, "reviews")
    tables.land(reviews, small, 100)
    files = lambda path: spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    assert equal(tables.compact(spark, small, big), reviews)
    assert files(big) < files(small) / 4


def test_message_keys_are_primary_keys(spark, sf):
    row = ev.bronze_messages(bronze(spark, sf, "promotions"), "promotions").first()
    assert row.topic == "promotions" and f'"{PRIMARY_KEYS["promotions"]}":"{row.key}"' in row.value


def test_envelope_time_is_iso(spark):
    df = spark.createDataFrame([(1,)], "id int")
    fixed = ev.with_envelope(df, "orders", F.lit("2001-02-03 04:05:06").cast("timestamp")).first()
    assert (fixed.event_type, fixed.event_time) == ("orders_loaded", "2001-02-03T04:05:06.000000")
    assert ev.with_envelope(df, "orders").select(F.col("event_time").cast("timestamp")).first()[0]


def test_loader_deletes_what_it_has_loaded(spark, sf):
    """Files of an earlier batch are gone after a later one, and every row is in the table."""
    landed, table, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    reviews = bronze(spark, sf, "reviews")
    first, second = F.col("platform") == "ios", F.col("platform") != "ios"
    left = []
    for part in (first, second, F.lit(False)):
        tables.land(reviews.filter(part), landed)
        st.load_bronze(spark, landed, reviews.schema, table, ckpt, "delete").awaitTermination()
        left.append(spark.read.schema(reviews.schema).parquet(landed).filter(first).count())
    assert equal(spark.read.schema(reviews.schema).parquet(table), reviews)
    assert left[0] > left[-1]


def test_a_backlog_is_loaded_in_bounded_batches(spark, sf):
    landed, table, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    users = bronze(spark, sf, "users").repartition(6)
    tables.land(users, landed)
    query = st.load_bronze(spark, landed, users.schema, table, ckpt, maxFilesPerTrigger="2")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 3
    assert equal(spark.read.schema(users.schema).parquet(table), users)


def test_landed_folders_keep_their_own_columns(spark, sf):
    root = scratch_path(spark, "mixed")
    for topic in ("orders", "users", "drivers"):
        tables.land(bronze(spark, sf, topic), f"{root}/{topic}")
    for topic in ("orders", "users", "drivers"):
        rows = tables.read_landed(spark, root, topic)
        assert {r["table"] for r in rows.select("table").distinct().collect()} == {topic.upper()}
        assert equal(rows.drop("table"), bronze(spark, sf, topic))
    counts = {r["table"]: r["count"] for r in tables.route_landed(spark, root).groupBy("table").count().collect()}
    assert counts == {t.upper(): bronze(spark, sf, t).count() for t in ("orders", "users", "drivers")}


def test_scratch_data_is_cleared(spark):
    from courierlake.session import clear_scratch, materialize

    df = materialize(spark.range(3).toDF("id"), "cleared")
    assert df.count() == 3
    folder = df.inputFiles()[0].rsplit("/", 1)[0]
    assert clear_scratch(spark) >= 1
    with pytest.raises(Exception, match=r"(?i)path|exist|file"):
        spark.read.parquet(folder).count()


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    from types import SimpleNamespace

    from courierlake.session import scratch_root

    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: None),
        sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="x"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(bare)
