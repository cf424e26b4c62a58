"""Build all layers of a run: silver as views, gold and marts as fully refreshed tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from courierlake.plans import marts
from courierlake.plans.pipeline import Pipeline
from courierlake.plans.silver import SILVER
from courierlake.sources.tables import overwrite_table

GOLD = (
    "fct_orders",
    "fct_payments",
    "fct_delivery",
    "fct_reviews",
    "fct_billing",
    "dim_customers",
    "dim_restaurants",
    "dim_drivers",
    "dim_promotions",
    "dim_users",
)


def register_silver(pipeline: Pipeline, prefix: str = "silver_") -> list[str]:
    for topic in SILVER:
        pipeline.silver(topic).createOrReplaceTempView(f"{prefix}{topic}")
    return [f"{prefix}{topic}" for topic in SILVER]


def publish_gold(pipeline: Pipeline, root: str, schema: str = "gold") -> dict[str, str]:
    """Write the star schema. Returns the table name of each model."""
    pipeline.share(*GOLD)
    return {
        model: overwrite_table(getattr(pipeline, model), schema, model, root) for model in GOLD
    }


def publish_marts(
    spark: SparkSession, gold: dict[str, str], root: str, schema: str = "revenue"
) -> dict[str, str]:
    """Write the marts from the stored star schema, one folder per month.

    Readers of a range of months skip the others; the order of the mart is theirs to ask
    for, as a sort across a stored table would be lost on reading anyway.
    """
    star = marts.star_orders(
        *[spark.table(gold[m]) for m in ("fct_orders", "fct_payments", "dim_customers", "dim_restaurants")]
    )
    subscription = marts.mart_subscription(
        spark.table(gold["fct_billing"]), spark.table(gold["dim_restaurants"])
    )
    # Gathers a month's rows so that not every task writes every month; a month too large
    # for one task is split again.
    revenue = marts.mart_revenue(star).hint("rebalance", "order_month")
    subscription = subscription.hint("rebalance", "invoice_month")
    return {
        "mart_revenue_summary": overwrite_table(
            revenue, schema, "mart_revenue_summary", root, ("order_month",)
        ),
        "mart_subscription_summary": overwrite_table(
            subscription, schema, "mart_subscription_summary", root, ("invoice_month",)
        ),
    }
