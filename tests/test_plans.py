"""The physical plans have the shape that a large cluster needs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks.bronze import AS_OF
from checks.queries import QUERIES
from courierlake.operators.dedup import keep_latest
from courierlake.plans.pipeline import Pipeline
from courierlake.plans.silver import SILVER
from courierlake.session import scratch_path
from courierlake.sources.schemas import PRIMARY_KEYS
from checks.bronze import bronze, pipeline


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf):
    """Bronze as files, as in production."""
    root = scratch_path(spark, "bronze")
    for topic in SILVER:
        bronze(spark, sf, topic).write.parquet(f"{root}/{topic}")
    return Pipeline(lambda t: spark.read.parquet(f"{root}/{t}"), AS_OF)


@pytest.mark.parametrize("topic", sorted(SILVER))
def test_silver_cuts_groups_before_the_shuffle(stored, topic):
    text = plan(stored.silver(topic))
    limit = re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", text)
    assert limit
    # A plan prints its last step first: the shuffle comes after the partial limit.
    assert "Exchange hashpartitioning" in text[: limit.start()]


@pytest.mark.parametrize("topic,shuffles", [("orders", 1), ("users", 1), ("reviews", 1), ("billing", 1), ("payments", 2), ("delivery", 2)])
def test_silver_shuffles_no_more_than_its_keys(stored, topic, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", plan(stored.silver(topic)))) == shuffles


def test_key_filter_reaches_the_scan(stored):
    for topic in SILVER:
        assert f"IsNotNull({PRIMARY_KEYS[topic]})" in plan(stored.silver(topic)), topic


def test_facts_read_only_their_columns(spark, stored, sf):
    root = scratch_path(spark, "gold")
    stored.fct_orders.write.parquet(root)
    stored_fact = spark.read.parquet(root)
    text = plan(stored_fact.groupBy("order_status").agg(F.sum("total_paid_amount")))
    assert re.search(r"ReadSchema: struct<order_status:string,total_paid_amount:decimal\(18,2\)>", text)


def test_pre_aggregation_before_shuffles(stored):
    from courierlake.plans import gold, marts

    for df in (marts.payments_summary(stored.fct_payments), gold.paid_billing_summary(stored.silver("billing"))):
        text = plan(df)
        assert "partial_" in text



@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("silver_", "gold_", "kpi_", "join_", "dq_"))])
def test_no_cross_join_and_no_python_in_plans(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in text, banned


def test_dedup_of_a_projection_prunes_columns(spark, stored):
    wide = stored.bronze("orders")
    text = plan(keep_latest(wide.select("order_id", "event_time", "status"), "order_id", "event_time"))
    assert re.search(r"ReadSchema: struct<order_id:string,status:string,event_time:string>", text)


def test_stored_silver_is_read_by_column(spark, sf):
    stored = Pipeline(lambda t: bronze(spark, sf, t), AS_OF, store_silver=True)
    text = plan(stored.fct_orders.groupBy("order_status").count())
    assert re.search(r"ReadSchema: struct<status:string>", text)
    assert "Window" not in text


@pytest.fixture
def stages(monkeypatch):
    """The plans of what is written as Parquet meanwhile."""
    seen, write = [], DataFrameWriter.parquet

    def spy(writer, *args, **options):
        seen.append(plan(writer._df))
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return seen


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n.startswith(("mart_", "window_", "eda_", "agg_", "sort_", "stream_", "sink_"))]
)
def test_no_stage_has_a_cross_join_or_python(spark, sf, name, stages):
    """The query's plan, and those of all results that are stored on the way to it."""
    for text in [plan(QUERIES[name](spark, sf)), *stages]:
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert banned not in text, banned
    if name.startswith(("mart_", "window_lag", "eda_pareto")):
        assert stages


def test_lag_stores_one_layout_and_broadcasts_nothing_of_the_rows(spark, monkeypatch):
    from courierlake.operators import sequences

    stored = []
    keep = sequences.materialize
    monkeypatch.setattr(sequences, "materialize", lambda df, name: stored.append(name) or keep(df, name))
    df = spark.range(1000).selectExpr("id % 3 as g", "id as k", "id * 2 as v")
    text = plan(sequences.lag_rows(df, ["g"], [F.col("k").asc()], {"p": ("v", 7)}, slice_rows=50))
    assert stored == ["slices"]
    # The rows are read once; the other scan counts them by slice.
    assert text.count("FileScan") == 2 and text.count("ReadSchema: struct<_place:bigint>") == 1
    assert not re.search(r"broadcast.*\bv#", text.split("FileScan")[0])


def test_billing_is_cleaned_once_for_the_subscription_mart(spark, sf):
    from courierlake.plans.pipeline import shared_nodes

    assert shared_nodes("mart_subscription") == {"silver_billing"}
    assert shared_nodes("mart_revenue") == set()
    assert shared_nodes("mart_revenue", "revenue_growth_by_day") == {"star_orders"}
    text = plan(pipeline(spark, sf).mart_subscription)
    assert "silver_billing" in text and "Window" not in text


def test_the_star_is_built_once_for_both_marts(spark, sf):
    p = pipeline(spark, sf).share("mart_revenue", "revenue_growth_by_day")
    assert "star_orders" in plan(p.revenue_growth_by_day)
    alone = pipeline(spark, sf)
    want, got = (x.revenue_growth_by_day.select("order_date", "gross_revenue_usd") for x in (alone, p))
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0
