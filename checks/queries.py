"""Registered queries: name to (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.generic import GENERIC
from checks.ingest import INGEST
from checks.bronze import pipeline, portable
from checks.oracle import kpis as kpi_sql
from checks.oracle import marts as mart_sql
from checks.oracle.gold import COLUMNS as GOLD_COLUMNS
from checks.oracle.gold import gold_oracle
from checks.oracle.silver import COLUMNS, silver_ctes
from checks.oracle.sql import final, with_
from courierlake.plans import gold, kpis, marts
from courierlake.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf: portable(query(tune(spark), sf))
    if oracle:
        ORACLES[name] = oracle


def _silver() -> None:
    for t, columns in COLUMNS.items():

        def query(spark: SparkSession, sf: str, t: str = t) -> DataFrame:
            df = pipeline(spark, sf).silver(t)
            return df if t == "users" else df.drop("_loaded_at")

        register(f"silver_{t}", query, with_(silver_ctes(t), final(columns, f"s_{t}")))


def _without_keys(df: DataFrame) -> DataFrame:
    """Hashed keys differ between engines; everything else is compared."""
    return df.drop(*[c for c in df.columns if c.endswith("_sk")])


def _gold() -> None:
    for model in GOLD_COLUMNS:

        def query(spark: SparkSession, sf: str, model: str = model) -> DataFrame:
            return _without_keys(getattr(pipeline(spark, sf), model))

        register(f"gold_{model}", query, gold_oracle(model))


def _marts() -> None:
    growth = ["gross_revenue_usd_prior_week", "revenue_wow_growth_pct", "volume_wow_growth_pct",
              "net_income_usd_prior_month", "income_mom_growth_pct"]
    register("mart_revenue", lambda s, d: pipeline(s, d).mart_revenue, mart_sql.mart_revenue)
    register(
        "mart_revenue_daily",
        lambda s, d: marts.daily_revenue(pipeline(s, d).star_orders),
        mart_sql.mart_revenue_daily,
    )
    register(
        "window_lag_growth",
        lambda s, d: pipeline(s, d).mart_revenue.select(*marts.REVENUE_GRAIN, *growth),
        mart_sql.window_lag_growth,
    )
    register(
        "window_range_growth",
        lambda s, d: pipeline(s, d).revenue_growth_by_day,
        mart_sql.window_range_growth,
    )
    register(
        "agg_payments_summary",
        lambda s, d: _without_keys(marts.payments_summary(pipeline(s, d).fct_payments)),
        mart_sql.agg_payments_summary,
    )
    register(
        "mart_subscription",
        lambda s, d: pipeline(s, d).mart_subscription,
        mart_sql.mart_subscription,
    )


def _kpis() -> None:
    spark_side: dict[str, Query] = {
        "kpi_revenue": lambda s, d: kpis.revenue(
            (p := pipeline(s, d)).fct_orders, p.fct_billing
        ),
        "kpi_mrr": lambda s, d: kpis.mrr(pipeline(s, d).fct_billing),
        "kpi_churn_rate": lambda s, d: kpis.churn_rate(pipeline(s, d).fct_billing),
        "kpi_delivery_aov": lambda s, d: kpis.delivery_aov(pipeline(s, d).fct_orders),
        "kpi_monthly_growth": lambda s, d: kpis.monthly_growth(pipeline(s, d).fct_orders),
        "kpi_cancel_refund_series": lambda s, d: kpis.cancel_refund_series(
            pipeline(s, d).fct_orders
        ),
        "eda_payment_mix": lambda s, d: kpis.payment_mix(
            gold.fct_orders((p := pipeline(s, d)).silver("orders"), with_id=True),
            gold.fct_payments(p.silver("payments"), with_id=True),
            key="order_id",
        ),
        "eda_pareto": lambda s, d: kpis.pareto(
            kpis.customer_revenue((p := pipeline(s, d)).silver("orders"), p.stored_customers)
        ),
        "eda_segment_share": lambda s, d: kpis.segment_share(
            kpis.customer_revenue((p := pipeline(s, d)).silver("orders"), p.stored_customers)
        ),
        "kpi_status_geo": lambda s, d: kpis.status_geo(pipeline(s, d).star_orders),
        "kpi_rev_per_subscriber": lambda s, d: kpis.revenue_per_subscriber(
            pipeline(s, d).fct_billing
        ),
        "eda_cohort": lambda s, d: kpis.cohorts(
            (p := pipeline(s, d).share("fct_billing", "dim_restaurants")).fct_billing, p.stored_restaurants
        ),
        "eda_decompose": lambda s, d: kpis.decompose(pipeline(s, d).fct_orders),
    }
    for name, query in spark_side.items():
        register(name, query, kpi_sql.KPIS[name])


def _generic() -> None:
    for name, (query, oracle) in (GENERIC | INGEST).items():
        register(name, query, oracle)


_generic()
_silver()
_gold()
_marts()
_kpis()
