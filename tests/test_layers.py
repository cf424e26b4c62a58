"""Properties of the layers as a whole."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.bronze import AS_OF, bronze, pipeline
from courierlake.operators import quality
from courierlake.plans import kpis, marts
from courierlake.plans.pipeline import Pipeline
from courierlake.plans.silver import SILVER
from courierlake.plans.publish import publish_gold, publish_marts, register_silver
from courierlake.session import scratch_path


@pytest.fixture(scope="module")
def p(spark, sf):
    return pipeline(spark, sf)


@pytest.fixture(scope="module")
def published(spark, p):
    root = scratch_path(spark, "warehouse")
    gold = publish_gold(p, root)
    return gold, publish_marts(spark, gold, root)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_mart_totals_equal_fact_totals(p):
    delivered = p.fct_orders.filter("order_status = 'Delivered'")
    mart = p.mart_revenue
    assert total(mart, "gross_revenue_usd") == total(delivered, "total_paid_amount")
    assert total(mart, "total_bookings_count") == p.fct_orders.count()
    assert total(mart, "gross_bookings_usd") == total(p.fct_orders, "total_paid_amount")


def test_subscription_mart_totals_equal_fact_totals(p):
    assert total(p.mart_subscription, "gross_billed_usd") == total(p.fct_billing, "invoice_total_usd")
    assert total(p.mart_subscription, "total_invoices_count") == p.fct_billing.count()


def test_mart_grain_is_unique(p):
    grain = p.mart_revenue.groupBy(*marts.REVENUE_GRAIN).count().filter("count > 1")
    assert grain.count() == 0


def test_published_tables_hold_the_models(spark, p, published):
    gold, stored_marts = published
    assert len(gold) == 10
    for model, name in gold.items():
        assert spark.table(name).count() == getattr(p, model).count(), model
    mart = spark.table(stored_marts["mart_revenue_summary"])
    assert mart.count() == p.mart_revenue.count()
    assert mart.exceptAll(p.mart_revenue.select(*mart.columns)).count() == 0
    scan = mart.filter("order_month = DATE '1998-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in scan


def test_silver_views_answer_sql(spark, p):
    register_silver(p)
    got = spark.sql("SELECT count(*) AS n FROM silver_orders o LEFT ANTI JOIN silver_customers c USING (customer_id)")
    assert got.first().n == 0


def test_growth_by_calendar_differs_from_growth_by_rows(p):
    """A day's revenue is compared with the same weekday one week before."""
    rows = p.revenue_growth_by_day.filter("gross_revenue_usd_prior_week IS NOT NULL").count()
    daily = marts.daily_revenue(p.star_orders, [*marts.GROWTH_GROUP, "order_date"])
    earlier = daily.select(*marts.GROWTH_GROUP, F.date_add("order_date", 7).alias("order_date"))
    assert rows == daily.select(*earlier.columns).filter("order_date IS NOT NULL").intersect(earlier).count()


def test_pareto_ends_at_all_revenue(p):
    per_customer = kpis.customer_revenue(p.silver("orders"), p.stored_customers)
    ranked = kpis.pareto(per_customer)
    assert ranked.agg(F.max("running_revenue_usd")).first()[0] >= total(per_customer, "revenue_usd")
    assert float(ranked.orderBy(F.col("revenue_usd").desc()).tail(1)[0].cumulative_share_pct) == 100.0


def test_hot_restaurant_and_customer(spark, sf):
    """A third of all orders on one customer and one restaurant: the mart keeps every order."""

    def hot(topic):
        df = bronze(spark, sf, topic)
        if topic != "orders":
            return df
        heavy = F.crc32("order_id") % 3 == 0
        return df.withColumns(
            {
                "customer_id": F.when(heavy, "C1").otherwise(F.col("customer_id")),
                "restaurant_id": F.when(heavy, "R1").otherwise(F.col("restaurant_id")),
            }
        )

    pipe = Pipeline(hot, AS_OF)
    assert total(pipe.mart_revenue, "total_bookings_count") == pipe.fct_orders.count()


@pytest.mark.parametrize("topic,key", [("delivery", "order_id"), ("drivers", "vehicle_plate")])
def test_hot_groups_change_no_flag(spark, sf, topic, key):
    """A third of the rows on one order or plate: flags are those of windows over the group."""
    df = bronze(spark, sf, topic)
    heavy = F.crc32(df.columns[0]) % 3 == 0
    df = df.withColumn(key, F.when(heavy, "same").otherwise(F.col(key))).filter(F.col(df.columns[0]).isNotNull())
    counted = df.withColumn("n", F.count(df.columns[0]).over(Window.partitionBy(key)))
    want = {r[df.columns[0]]: r.n > 1 for r in counted.collect()}
    flag = {"delivery": "is_redelivery", "drivers": "dq_duplicate_plate"}[topic]
    got = {r[df.columns[0]]: r[flag] for r in SILVER[topic](df, AS_OF).collect()}
    assert got == {k.strip(): v for k, v in want.items()}


def test_quality_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 4), (None, 5)], "k string, v int")
    parents = spark.createDataFrame([("a",)], "k string")
    u = quality.unique({"t": (df, "k")}).first()
    assert (u.failing_values, u.failing_rows) == (1, 2)
    n = {r.column_name: r.failing_rows for r in quality.not_null({"t": (df, ["k", "v"])}).collect()}
    assert n == {"k": 2, "v": 1}
    a = quality.accepted_values({"t": (df, "k", ["a"])}).collect()
    assert [(r.value, r.failing_rows) for r in a] == [("b", 1)]
    r = quality.relationships({("t", "p"): (df, parents, "k")}).first()
    assert (r.orphan_keys, r.orphan_rows) == (1, 1)
    c = quality.reconcile({"t": (df, parents, "k")}).first()
    assert (c.bronze_rows, c.keyless_rows, c.bronze_keys, c.silver_rows, c.lost_rows) == (5, 2, 2, 1, 1)
