"""Queries over sources, sinks, streams, quality tests and audits."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.adapters import ADAPTERS, bronze_cte
from checks.bronze import bronze, pipeline, table
from checks.oracle.silver import silver_ctes
from checks.oracle.sql import with_
from courierlake.operators import quality
from courierlake.session import materialize, scratch_path
from courierlake.sources import events as ev
from courierlake.sources import tables
from courierlake.sources.schemas import PRIMARY_KEYS, TOPICS
from courierlake.streaming import latest, metrics, recovery, runs
from courierlake.streaming import topics as st

INGEST: dict[str, tuple] = {}

EVENT_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("ts", T.TimestampType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
    .add("props", T.StringType())
)
EVENT_COLUMNS = "event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props"


def op(name: str, oracle: str | None = None):
    def add(fn):
        INGEST[name] = (fn, oracle)
        return fn

    return add


def per_topic(select: str, topics=TOPICS) -> str:
    """UNION ALL of one SELECT per bronze table; ``{t}`` is the topic, ``{key}`` its key."""
    parts = [
        select.format(t=t, T=t.upper(), key=PRIMARY_KEYS[t], bronze=f"({bronze_cte(t)})") for t in topics
    ]
    return " UNION ALL ".join(parts)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])


def _topic_messages(spark: SparkSession, sf: str) -> DataFrame:
    messages = [ev.bronze_messages(bronze(spark, sf, t), t) for t in TOPICS]
    return reduce(DataFrame.unionByName, messages)


# --- batch sources -------------------------------------------------------------------


@op("src_csv_roundtrip", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "csv")
    orders.write.option("header", True).csv(path)
    return ev.read_csv(spark, path, orders.schema)


@op(
    "src_nan_to_null",
    "SELECT event_id, CASE WHEN value > 50 THEN NULL ELSE value END AS value FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    nan = F.lit(float("nan"))
    dirty = F.when(F.col("value") > 50, nan).otherwise(F.col("value")).alias("value")
    return ev.nan_to_null(_events(spark, sf).select("event_id", dirty))


@op(
    "src_event_envelope",
    "SELECT user_id, value, 'events_loaded' AS event_type, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_time FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select("user_id", "value", "ts")
    return ev.with_envelope(rows, "events", at=F.col("ts")).drop("ts")


@op(
    "src_json_encode",
    """SELECT 'events' AS topic, CAST(event_id AS VARCHAR) AS key,
       '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ||
       '","user_id":' || user_id || ',"event_type":"' || event_type || '","is_click":' ||
       CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END || ',"missing":null}' AS value
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        (F.col("event_type") == "click").alias("is_click"),
        F.lit(None).cast("string").alias("missing"),
    )
    return ev.to_messages(rows, "events")


@op(
    "src_json_types",
    """SELECT 'events' AS topic, CAST(event_id AS VARCHAR) AS key,
       '{"event_id":' || event_id || ',"ratio":' || CAST((event_id % 1000) / 8.0 AS DOUBLE) ||
       ',"pair":[' || event_id || ',' || user_id || '],"kinds":["' || event_type || '",null],"none":' ||
       CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '[]' END || ',"at":{"day":"' ||
       strftime(ts, '%Y-%m-%d') || '"}}' AS value FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Floats, arrays with and without values, and a nested struct."""
    rows = _events(spark, sf).select(
        "event_id",
        ((F.col("event_id") % 1000) / F.lit(8.0)).alias("ratio"),
        F.array("event_id", "user_id").alias("pair"),
        F.array("event_type", F.lit(None).cast("string")).alias("kinds"),
        F.when(F.col("event_id") % 2 == 1, F.array().cast("array<int>")).alias("none"),
        F.struct(F.to_date("ts").alias("day")).alias("at"),
    )
    return ev.to_messages(rows, "events")


@op(
    "src_json_decode",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
    "CAST(NULL AS VARCHAR) AS corrupt FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    messages = _events(spark, sf).select(
        F.concat(F.lit('{"event_id":'), "event_id", F.lit(","), F.substring("props", 2, 2**31 - 1)).alias(
            "value"
        )
    )
    schema = T.StructType.fromDDL("event_id long, k long")
    return ev.from_messages(messages, schema).withColumnRenamed(ev.CORRUPT, "corrupt")


@op(
    "src_route_by_path",
    " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS \"table\", {PRIMARY_KEYS[t]} AS key, CAST(event_time AS VARCHAR) "
        f"AS event_time, {len(ADAPTERS[t].columns | {'event_type': ''})} AS columns FROM ({bronze_cte(t)})"
        for t in TOPICS
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "landed")
    tables.land_all({topic: bronze(spark, sf, topic) for topic in TOPICS}, root)
    landed = {topic: tables.read_landed(spark, root, topic) for topic in TOPICS}
    parts = [
        rows.select(
            "table",
            F.col(PRIMARY_KEYS[topic]).alias("key"),
            F.col("event_time").cast("string").alias("event_time"),
            F.lit(len(rows.drop("table").columns)).cast("long").alias("columns"),
        )
        for topic, rows in landed.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@op("src_registry", per_topic("SELECT '{T}' AS table_name, count(*) AS rows, count({key}) AS keyed FROM {bronze}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    views = tables.register_bronze(spark, lambda t: bronze(spark, sf, t))
    parts = [
        spark.sql(f"SELECT '{v}' AS table_name, count(*) AS rows, count({PRIMARY_KEYS[t]}) AS keyed FROM {v}")
        for t, v in views.items()
    ]
    for view in views.values():
        spark.catalog.dropTempView(view)  # the plans above hold what they refer to
    return reduce(DataFrame.unionByName, parts)


# --- sinks ---------------------------------------------------------------------------


@op("sink_publish_messages", per_topic("SELECT '{t}' AS topic, count(*) AS messages FROM {bronze}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    ev.publish(_topic_messages(spark, sf), path, fmt="parquet")
    sent = spark.read.schema(st.MESSAGE_SCHEMA).parquet(path)
    return sent.groupBy("topic").agg(F.count("*").alias("messages"))


@op(
    "sink_max_records_per_file",
    "SELECT count(*) AS rows, TRUE AS within_limit, count(DISTINCT o_orderkey) AS keys FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    tables.land(table(spark, sf, "orders"), path, tables.FLUSH_ROWS)
    landed = spark.read.parquet(path).select("o_orderkey", F.col("_metadata.file_path").alias("file"))
    per_file = landed.groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("k"))
    return per_file.agg(
        F.sum("n").alias("rows"),
        (F.max("n") <= tables.FLUSH_ROWS).alias("within_limit"),
        F.sum("k").alias("keys"),
    )


def _from_catalog(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a catalog table, whose schema is dropped."""
    rows = materialize(spark.table(name), "table")
    spark.sql(f"DROP SCHEMA {name.split('.')[0]} CASCADE")
    return rows


@op("sink_append_bronze", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Orders reach a catalog table by two runs of the loader, the first of which creates it."""
    landed, root, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    name = f"bronze_{uuid.uuid4().hex[:12]}.orders"
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < "1998-01-01"
    for part in (orders.filter(early), orders.filter(~early | early.isNull())):
        tables.land(part, landed)
        st.load_table(spark, landed, orders.schema, name, root, ckpt).awaitTermination()
    return _from_catalog(spark, name)


@op(
    "sink_create_zone",
    "SELECT o_orderstatus, count(*) AS rows, CAST(2 AS BIGINT) AS tables FROM orders GROUP BY 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A zone and its tables are created by the first append; later ones find them."""
    root, schema = scratch_path(spark, "zone"), f"zone_{uuid.uuid4().hex[:12]}"
    orders = table(spark, sf, "orders")
    late = F.col("o_orderkey") % 2 == 1
    for part, name in ((orders.where(late), "orders"), (orders.where(~late), "orders"), (orders.limit(0), "empty")):
        tables.append_table(part, schema, name, root)
    made = spark.sql(f"SHOW TABLES IN {schema}").where("not isTemporary").count()
    rows = _from_catalog(spark, f"{schema}.orders").groupBy("o_orderstatus").agg(F.count("*").alias("rows"))
    return rows.withColumn("tables", F.lit(made).cast("long"))


@op(
    "sink_overwrite_gold",
    "SELECT o_orderkey, o_orderstatus, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) "
    "AS order_month FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    root, schema = scratch_path(spark, "gold"), f"gold_{uuid.uuid4().hex[:12]}"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("order_month")
    )
    # A full refresh leaves nothing of what the table held before.
    before = orders.withColumn("o_orderstatus", F.lit("old"))
    for rows in (before, orders.repartition("order_month")):
        name = tables.overwrite_table(rows, schema, "orders", root, ("order_month",))
    return _from_catalog(spark, name)


# --- streams -------------------------------------------------------------------------


def _land_all_topics(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All topics published, then drained by one stream. Returns messages sent and landed."""
    log, path, ckpt = (scratch_path(spark, n) for n in ("messages", "landed", "ckpt"))
    ev.publish(_topic_messages(spark, sf), log, fmt="parquet")
    st.land_raw(st.read_topics(spark, log, fmt="parquet"), path, ckpt).awaitTermination()
    read = spark.read.schema(st.MESSAGE_SCHEMA)
    return read.parquet(log), read.parquet(path)


@op(
    "stream_ingest_topics",
    per_topic("SELECT '{t}' AS topic, count(*) AS messages, count(DISTINCT {key}) AS keys FROM {bronze}"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    _, landed = _land_all_topics(spark, sf)
    return landed.groupBy("topic").agg(
        F.count("*").alias("messages"), F.countDistinct("key").alias("keys")
    )


@op("stream_land_parquet", f"SELECT {EVENT_COLUMNS} FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    log, landed, ckpt = (scratch_path(spark, n) for n in ("messages", "landed", "ckpt"))
    ev.publish(ev.to_messages(_events(spark, sf), "events"), log, fmt="parquet")
    messages = st.read_topics(spark, log, ("events",), fmt="parquet")
    for _ in range(2):  # the second start finds everything already landed
        st.land_events(messages, EVENT_SCHEMA, landed, ckpt).awaitTermination()
    return spark.read.schema(EVENT_SCHEMA).parquet(landed)


def _in_two_loads(spark: SparkSession, sf: str, clean_source: str = "off") -> DataFrame:
    """Events loaded to bronze by two runs of the loader, each after new files landed."""
    landed, bronze_path, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    events = _events(spark, sf)
    early = F.col("ts") < "2024-01-16"
    for part in (events.filter(early), events.filter(~early | early.isNull())):
        tables.land(part, landed)
        st.load_bronze(
            spark, landed, EVENT_SCHEMA, bronze_path, ckpt, clean_source, maxFilesPerTrigger="2"
        ).awaitTermination()
    return spark.read.schema(EVENT_SCHEMA).parquet(bronze_path)


@op("stream_incremental_bronze", f"SELECT {EVENT_COLUMNS} FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _in_two_loads(spark, sf)


@op("stream_skip_empty", f"SELECT {EVENT_COLUMNS} FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Files without rows, alone in a micro-batch and among others, add nothing."""
    landed, bronze_path, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    events = _events(spark, sf)
    none = events.where(F.lit(False))
    for parts in ([none], [events.where("event_id % 2 = 0"), none], [none, events.where("event_id % 2 = 1")]):
        for part in parts:
            tables.land(part, landed)
        st.load_bronze(
            spark, landed, EVENT_SCHEMA, bronze_path, ckpt, maxFilesPerTrigger="1"
        ).awaitTermination()
    return spark.read.schema(EVENT_SCHEMA).parquet(bronze_path)


@op("stream_load_and_delete", f"SELECT {EVENT_COLUMNS} FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _in_two_loads(spark, sf, "delete")


def _filled(topic: str) -> list[str]:
    return list(ADAPTERS[topic].columns)


@op(
    "stream_load_zone",
    " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS \"table\", {PRIMARY_KEYS[t]} AS key, CAST(event_time AS VARCHAR) AS event_time, "
        + " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in _filled(t))
        + f" AS filled FROM ({bronze_cte(t)})"
        for t in TOPICS
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Ten topics, with empty files among them, loaded by two runs of one query."""
    landed, zone, ckpt = (scratch_path(spark, n) for n in ("landed", "zone", "ckpt"))
    for half in range(2):
        for topic in TOPICS:
            rows = bronze(spark, sf, topic)
            part = F.pmod(F.xxhash64(PRIMARY_KEYS[topic], "event_time"), F.lit(2)) == half
            tables.land(rows.where(part), f"{landed}/{topic}")
            tables.land(rows.where(F.lit(False)), f"{landed}/{topic}")
        st.load_zone(spark, landed, zone, ckpt).awaitTermination()
    parts = [
        st.read_zone(spark, zone, topic).select(
            F.lit(topic.upper()).alias("table"),
            F.col(PRIMARY_KEYS[topic]).alias("key"),
            F.col("event_time").cast("string").alias("event_time"),
            sum((F.col(c).isNotNull().cast("long") for c in _filled(topic)), F.lit(0)).alias("filled"),
        )
        for topic in TOPICS
    ]
    return reduce(DataFrame.unionByName, parts)


@op(
    "stream_interval_runs",
    "SELECT count(*) AS rows, TRUE AS bounded, CAST(0 AS BIGINT) AS overlaps, count(*) AS loaded FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A loader at an interval takes a bounded number of rows at a time, one run after the other."""
    landed, bronze_path, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    tables.land(_events(spark, sf), landed, tables.FLUSH_ROWS)
    files = st.files_per_run(spark, landed, least=4)
    rows = st.landed_rows(spark, landed, EVENT_SCHEMA, maxFilesPerTrigger=str(files))
    writer = rows.writeStream.format("parquet").option("path", bronze_path).option("checkpointLocation", ckpt)
    query = writer.trigger(processingTime="100 milliseconds").start()
    batches = runs.batches_frame(spark, runs.run_until_idle(query, idle=2))
    loaded = spark.read.schema(EVENT_SCHEMA).parquet(bronze_path).count()
    # A run may begin in the millisecond in which the one before ends.
    before = F.lag("ended").over(Window.orderBy("batch"))
    overlap = F.unix_millis(before) - F.unix_millis("started") > 1
    return batches.select("rows", overlap.alias("overlap")).agg(
        F.sum("rows").alias("rows"),
        (F.max("rows") <= files * tables.FLUSH_ROWS).alias("bounded"),
        F.count_if("overlap").alias("overlaps"),
        F.lit(loaded).cast("long").alias("loaded"),
    )


LATEST_KEYS = ["user_id", "event_type"]


@op(
    "stream_dedup_upsert",
    f"SELECT {EVENT_COLUMNS} FROM events QUALIFY row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One stateful stream: two micro-batches and a snapshot, then a restart with late and repeated rows."""
    landed, log, ckpt, root = (scratch_path(spark, n) for n in ("landed", "log", "ckpt", "snapshots"))
    events = _events(spark, sf)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    runs = [
        [events.filter(third == 0), events.filter(third == 1)],
        # In any part there are rows older than what has come before; some come a second time.
        [events.filter((third == 2) | (F.col("event_id") % 5 == 0))],
    ]
    for parts in runs:
        for part in parts:
            tables.land(part.coalesce(1), landed)
        stream = st.landed_rows(spark, landed, EVENT_SCHEMA, maxFilesPerTrigger="1")
        latest.start_latest(
            stream, LATEST_KEYS, "event_id", log, ckpt, every="1 second", slack="0 seconds"
        ).awaitTermination()
        table_now = latest.write_snapshot(spark, log, ckpt, LATEST_KEYS, "event_id", root, EVENT_SCHEMA)
    return table_now


@op("stream_crash_resume", f"SELECT {EVENT_COLUMNS} FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A loader dies between write and commit, resumes, and later replays from its second batch."""
    landed, bronze_path, ckpt = (scratch_path(spark, n) for n in ("landed", "bronze", "ckpt"))
    events = _events(spark, sf)
    parts = [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k) for k in range(4)]

    def load(*new: DataFrame) -> None:
        for part in new:
            tables.land(part.coalesce(1), landed)
        st.load_bronze(
            spark, landed, EVENT_SCHEMA, bronze_path, ckpt, maxFilesPerTrigger="1"
        ).awaitTermination()

    load(*parts[:3])
    recovery.forget_commit(spark, ckpt)
    load()  # the batch is run again and found in the sink's log
    load(parts[3])
    recovery.rewind(spark, ckpt, bronze_path, 1)
    load()  # all that followed the second batch is read and written again
    return spark.read.schema(EVENT_SCHEMA).parquet(bronze_path)


# --- quality -------------------------------------------------------------------------

NOT_NULL = {
    "orders": ["order_id", "customer_id", "restaurant_id"],
    "payments": ["payment_id", "order_id", "amount_usd"],
    "delivery": ["delivery_id", "order_id", "driver_id"],
    "billing": ["invoice_id", "restaurant_id"],
    "customers": ["customer_id", "user_id", "age_years"],
    "users": ["user_id", "email"],
    "restaurants": ["restaurant_id", "restaurant_name"],
    "drivers": ["driver_id"],
    "promotions": ["promo_id", "promo_code"],
    "reviews": ["review_id", "order_id", "rating_overall"],
}

ACCEPTED = {
    "billing": ("status", ["Paid", "Pending", "Partial", "Paid - Date Unknown", "Overdue"]),
    "customers": ("loyalty_tier", ["Bronze", "Silver", "Gold", "Platinum", "Diamond"]),
    "delivery": ("status", ["Delivered", "Failed", "In Transit", "Returned", "Partial"]),
    "drivers": ("vehicle_type", ["Car", "Van", "Motorcycle", "Scooter", "Bicycle"]),
    "payments": ("status", ["Success", "Failed", "Refunded", "Pending"]),
    "restaurants": ("plan_tier", ["Starter", "Growth", "Pro", "Enterprise"]),
}

LINKS = {
    ("orders", "customers"): "customer_id",
    ("orders", "restaurants"): "restaurant_id",
    ("orders", "drivers"): "driver_id",
    ("payments", "orders"): "order_id",
    ("delivery", "orders"): "order_id",
    ("billing", "restaurants"): "restaurant_id",
    ("customers", "users"): "user_id",
    ("reviews", "orders"): "order_id",
}


@op(
    "dq_unique",
    with_(
        silver_ctes(*TOPICS)
        | {
            "x": per_topic(
                "SELECT '{t}' AS table_name, '{key}' AS column_name, count(*) AS failing_values, "
                "CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows FROM (SELECT count(*) AS n "
                "FROM s_{t} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
            )
            + " UNION ALL SELECT 'lineitem', 'l_orderkey', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) "
            "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"
        },
        "SELECT * FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    tested = {t: (p.silver(t), PRIMARY_KEYS[t]) for t in TOPICS}
    # A raw table, whose order key does repeat, next to the silver tables, whose keys must not.
    return quality.unique(tested | {"lineitem": (table(spark, sf, "lineitem"), "l_orderkey")})


@op(
    "dq_not_null",
    with_(
        silver_ctes(*NOT_NULL)
        | {
            "x": " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS failing_rows "
                f"FROM s_{t}"
                for t, cs in NOT_NULL.items()
                for c in cs
            )
        },
        "SELECT * FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    return quality.not_null({t: (p.silver(t), cs) for t, cs in NOT_NULL.items()})


@op(
    "dq_accepted_values",
    with_(
        silver_ctes(*ACCEPTED)
        | {
            "x": " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS failing_rows "
                f"FROM s_{t} WHERE {c} NOT IN ({', '.join(repr(v) for v in vs)}) GROUP BY {c}"
                for t, (c, vs) in ACCEPTED.items()
            )
        },
        "SELECT * FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    return quality.accepted_values({t: (p.silver(t), c, vs) for t, (c, vs) in ACCEPTED.items()})


@op(
    "dq_relationships",
    with_(
        silver_ctes(*dict.fromkeys(t for pair in LINKS for t in pair))
        | {
            "x": " UNION ALL ".join(
                f"SELECT '{c}' AS child_table, '{p}' AS parent_table, '{k}' AS column_name, "
                f"count(DISTINCT {k}) AS orphan_keys, count(*) AS orphan_rows FROM s_{c} "
                f"WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM s_{p} WHERE {k} IS NOT NULL)"
                for (c, p), k in LINKS.items()
            )
        },
        "SELECT * FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    return quality.relationships(
        {(c, q): (p.silver(c), p.silver(q), k) for (c, q), k in LINKS.items()}
    )


# --- audits --------------------------------------------------------------------------


def _audited(spark: SparkSession, messages: DataFrame, keep: Column | None = None) -> DataFrame:
    """Received against landed, as the stream that lands the messages has observed it."""
    log, path, ckpt = (scratch_path(spark, n) for n in ("messages", "landed", "ckpt"))
    ev.publish(messages, log, fmt="parquet")
    # Five files at a time leave most cores without any; a run has one for each at least.
    files = st.files_per_run(spark, log, max(5, spark.sparkContext.defaultParallelism))
    stream = st.read_topics(spark, log, fmt="parquet", maxFilesPerTrigger=str(files))
    query = metrics.land_audited(stream, path, ckpt, TOPICS, keep)
    return metrics.received_and_landed(spark, metrics.observed_batches(query), TOPICS)


@op(
    "audit_rowcount",
    per_topic(
        "SELECT '{T}' AS \"table\", count(*) AS rows, TRUE AS within_limit FROM {bronze}"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "landed")
    tables.land_all({topic: bronze(spark, sf, topic) for topic in TOPICS}, root, tables.FLUSH_ROWS)
    counted = tables.rows_by_table(spark, root)
    return counted.select(
        "table", "rows", (F.col("largest_file") <= tables.FLUSH_ROWS).alias("within_limit")
    )


@op(
    "audit_reconcile",
    with_(
        silver_ctes(*TOPICS)
        | {
            "x": per_topic(
                "SELECT '{t}' AS table_name, (SELECT count(*) FROM b_{t}) AS bronze_rows, "
                "(SELECT count(*) FROM b_{t} WHERE {key} IS NULL) AS keyless_rows, "
                "(SELECT count(DISTINCT trim({key})) FROM b_{t}) AS bronze_keys, "
                "(SELECT count(*) FROM s_{t}) AS silver_rows"
            ),
            "y": "SELECT *, bronze_keys - silver_rows AS lost_rows FROM x",
        },
        "SELECT * FROM y",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    return quality.reconcile({t: (p.bronze(t), p.silver(t), PRIMARY_KEYS[t]) for t in TOPICS})


@op(
    "audit_received_landed",
    per_topic(
        "SELECT '{t}' AS topic, count(*) AS received, count(*) AS landed, CAST(0 AS BIGINT) AS lost FROM {bronze}"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _audited(spark, _topic_messages(spark, sf))


@op(
    "audit_lossy_stream",
    per_topic(
        "SELECT '{t}' AS topic, count(*) AS received, count(*) - lost AS landed, lost FROM (SELECT "
        "*, count(*) FILTER (right({key}, 1) = '7') OVER () AS lost FROM {bronze}) GROUP BY lost"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that break off are not landed, and the stream counts them as lost."""
    broken = F.coalesce(F.col("key").endswith("7"), F.lit(False))
    half = F.col("value").substr(F.lit(1), F.length("value") - 1)
    messages = _topic_messages(spark, sf).withColumn("value", F.when(broken, half).otherwise(F.col("value")))
    return _audited(spark, messages, keep=F.try_parse_json("value").isNotNull())
