"""Silver promotions: terms, usage and cost repaired, one row per promotion."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_title,
    clean_upper,
    date_diff_boundary,
    decimal_ratio,
    least_or_null,
    money,
    number_label,
    safe_ratio,
    try_date,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import day, loaded_at


def clean_promotions(bronze: DataFrame, as_of: date) -> DataFrame:
    # Unqualified names below are source columns, before any cast or repair.
    unit = F.trim("discount_unit")
    amount = number_label("discount_value")
    cap, minimum = F.col("max_discount_usd"), F.col("min_order_usd")
    used, limit = F.col("times_used"), F.col("usage_limit")
    counted = least_or_null(used, limit)
    starts, ends = try_date("start_date"), try_date("end_date")
    live = day(as_of).between(starts, ends)
    cost = F.abs("revenue_impact_usd")

    typed = with_row_hash(bronze).filter(F.col("promo_id").isNotNull()).select(
        F.trim("promo_id").alias("promo_id"),
        F.trim("campaign_id").alias("campaign_id"),
        F.trim("created_by").alias("created_by"),
        F.trim("restaurant_id").alias("restaurant_id"),
        F.coalesce("restaurant_id", F.lit("Platform-Wide")).alias("restaurant_scope"),
        clean_upper("promo_code").alias("promo_code"),
        *[
            clean_title(c).alias(c)
            for c in ("promo_name", "promo_type", "target_segment", "applies_to", "channel")
        ],
        F.col("is_stackable").cast("boolean").alias("is_stackable_flag"),
        F.col("discount_value").cast("decimal(10,2)").alias("discount_value"),
        unit.alias("discount_unit_raw"),
        F.when(unit == "Percent", "Percentage")
        .when(unit == "Fixed USD", "Fixed")
        .otherwise(unit)
        .alias("discount_unit_clean"),
        F.when(unit == "Percent", F.concat(amount, F.lit("%")))
        .when(unit == "Fixed USD", F.concat(F.lit("$"), amount))
        .alias("discount_label"),
        minimum.cast("decimal(10,2)").alias("min_order_usd"),
        F.when(cap < minimum, minimum).otherwise(cap).alias("max_discount_usd"),
        starts.alias("start_date"),
        ends.alias("end_date"),
        date_diff_boundary("day", starts, ends).alias("duration_days"),
        F.coalesce(live, F.lit(False)).alias("is_currently_live"),
        F.coalesce(limit, F.lit(0)).alias("usage_limit"),
        counted.alias("times_used"),
        used.alias("times_used_original"),
        safe_ratio(
            least_or_null(used, F.coalesce(limit, F.lit(0))).cast("decimal(18,1)") * 100, limit
        ).alias("usage_rate_pct"),
        F.when(counted >= limit, "Exhausted")
        .when(counted >= limit * 0.8, "Nearly Exhausted")
        .when(counted >= limit * 0.5, "Mid Usage")
        .otherwise("Low Usage")
        .alias("usage_bucket"),
        money("revenue_impact_usd").alias("revenue_impact_usd"),
        cost.alias("revenue_cost_usd"),
        decimal_ratio(cost, counted).alias("avg_cost_per_use_usd"),
        (used > limit).alias("dq_over_usage_limit"),
        (cap < minimum).alias("dq_max_discount_lt_min_order"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
        loaded_at(as_of),
    )
    return keep_latest(typed, "promo_id", "_extracted_at")
