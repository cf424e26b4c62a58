"""Silver restaurants: profile, buckets, opening hours, one row per restaurant."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_lower,
    clean_title,
    clean_upper,
    date_diff_boundary,
    money,
    to_int,
    try_date,
    try_hour,
    try_time,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import day, loaded_at, rating_bucket
from courierlake.plans.values import PAST_MIDNIGHT


def clean_restaurants(bronze: DataFrame, as_of: date) -> DataFrame:
    # Unqualified names below are source columns: buckets see the values before any cast.
    pct, orders = F.col("commission_pct"), F.col("total_orders")
    inactive, featured = ~F.col("is_active"), F.col("is_featured")
    opens, closes = try_hour("open_time"), try_hour("close_time")
    # Only these two spellings count as closing after midnight; 02:00 gives negative hours.
    past_midnight = F.col("close_time").isin(*PAST_MIDNIGHT)

    typed = with_row_hash(bronze).filter(F.col("restaurant_id").isNotNull()).select(
        F.trim("restaurant_id").alias("restaurant_id"),
        clean_title("name").alias("restaurant_name"),
        clean_title("cuisine_type").alias("cuisine_type"),
        F.trim("address").alias("address"),
        clean_title("city").alias("city"),
        clean_upper("state").alias("state"),
        F.lpad(F.col("zip_code").cast("string"), 5, "0").alias("zip_code"),
        F.trim("phone").alias("phone"),
        clean_lower("email").alias("email"),
        clean_lower("website").alias("website"),
        clean_title("plan_tier").alias("plan_tier"),
        money("monthly_fee_usd").alias("monthly_fee_usd"),
        pct.cast("decimal(5,2)").alias("commission_pct"),
        F.when(pct >= 25, "High (25%+)")
        .when(pct >= 18, "Medium (18-25%)")
        .otherwise("Low (<18%)")
        .alias("commission_bucket"),
        try_date("signup_date").alias("signup_date"),
        date_diff_boundary("month", try_date("signup_date"), day(as_of)).alias(
            "months_on_platform"
        ),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("is_featured").cast("boolean").alias("is_featured"),
        F.when(inactive, "Inactive")
        .when(featured, "Featured")
        .otherwise("Active")
        .alias("restaurant_status"),
        F.col("avg_rating").cast("decimal(3,1)").alias("avg_rating"),
        F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        to_int("avg_prep_time_min").alias("avg_prep_time_min"),
        rating_bucket(F.col("avg_rating")).alias("rating_bucket"),
        F.when(orders >= 15000, "High Volume")
        .when(orders >= 8000, "Medium Volume")
        .otherwise("Low Volume")
        .alias("volume_bucket"),
        F.round(orders * (pct / 100.0), 2).alias("estimated_commissions_earned"),
        try_time("open_time").alias("open_time"),
        try_time("close_time").alias("close_time"),
        (F.when(past_midnight, closes + 24).otherwise(closes) - opens).alias(
            "operating_hours_per_day"
        ),
        "delivery_radius_km",
        F.col("min_order_usd").cast("decimal(10,2)").alias("min_order_usd"),
        *[
            F.col(c).cast("boolean").alias(c)
            for c in ("accepts_cash", "halal_certified", "vegan_options")
        ],
        (inactive & featured).alias("dq_inactive_but_featured"),
        ((orders > 10000) & (F.col("total_reviews") < 10)).alias("dq_low_reviews_high_orders"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
        loaded_at(as_of),
    )
    return keep_latest(typed, "restaurant_id", "_extracted_at")
