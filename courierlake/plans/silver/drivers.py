"""Silver drivers: profile, performance buckets, duplicate flags, one row per driver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_lower,
    clean_title,
    clean_upper,
    date_diff_boundary,
    decimal_ratio,
    money,
    try_date,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.operators.skew import attach_group_stats
from courierlake.plans.silver.common import day, loaded_at, rating_bucket
from courierlake.plans.values import WORKING



def _flag_duplicates(bronze: DataFrame) -> DataFrame:
    """Drivers sharing a licence or plate, re-extracted copies included; NULL is one value."""
    counted = attach_group_stats(
        bronze,
        {
            "same_license": ("license_number", F.count("driver_id")),
            "same_plate": ("vehicle_plate", F.count("driver_id")),
        },
    )
    return counted


def clean_drivers(bronze: DataFrame, as_of: date) -> DataFrame:
    # Unqualified names below are source columns: buckets see the values before any cast.
    vehicle, rating, on_time = F.col("vehicle_type"), F.col("avg_rating"), F.col("on_time_rate_pct")
    active = F.col("is_active").try_cast("boolean")
    status = clean_title("status")
    months = date_diff_boundary("month", try_date("hire_date"), day(as_of))

    known = with_row_hash(bronze).filter(F.col("driver_id").isNotNull())
    known = known.transform(_flag_duplicates)
    typed = known.select(
        F.trim("driver_id").alias("driver_id"),
        clean_title("first_name").alias("first_name"),
        clean_title("last_name").alias("last_name"),
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        clean_lower("email").alias("email"),
        F.trim("phone").alias("phone"),
        clean_title("city").alias("city"),
        clean_upper("state").alias("state"),
        clean_title("zone").alias("zone"),
        clean_title("vehicle_type").alias("vehicle_type"),
        clean_upper("vehicle_plate").alias("vehicle_plate"),
        clean_upper("license_number").alias("license_number"),
        F.when(vehicle.isin("Van", "Car"), "High Capacity")
        .when(vehicle.isin("Motorcycle", "Scooter"), "Medium Capacity")
        .when(vehicle == "Bicycle", "Low Capacity")
        .otherwise("Unknown")
        .alias("vehicle_capacity"),
        try_date("hire_date").alias("hire_date"),
        months.alias("months_on_platform"),
        F.when(months >= 36, "Veteran")
        .when(months >= 12, "Experienced")
        .otherwise("New")
        .alias("tenure_bucket"),
        active.alias("is_active"),
        status.alias("status_raw"),
        F.when(~F.col("is_active") & status.isin(*WORKING), "Inactive")
        .otherwise(status)
        .alias("status_clean"),
        clean_title("background_check").alias("background_check"),
        F.coalesce("total_deliveries", F.lit(0)).alias("total_deliveries"),
        rating.cast("decimal(3,1)").alias("avg_rating"),
        on_time.cast("decimal(5,2)").alias("on_time_rate_pct"),
        F.col("acceptance_rate_pct").cast("decimal(5,2)").alias("acceptance_rate_pct"),
        rating_bucket(rating).alias("rating_bucket"),
        F.when((rating >= 4.0) & (on_time >= 80), "Top Performer")
        .when((rating >= 3.5) & (on_time >= 65), "Good Performer")
        .when((rating < 3.0) | (on_time < 50), "At Risk")
        .otherwise("Average Performer")
        .alias("performance_tier"),
        *[
            money(c).alias(c)
            for c in ("hourly_rate_usd", "total_earnings_usd", "total_tips_usd")
        ],
        decimal_ratio(F.col("total_earnings_usd"), F.col("total_deliveries")).alias(
            "avg_earning_per_delivery_usd"
        ),
        "max_distance_km",
        ((F.col("background_check") == "Failed") & F.col("is_active")).alias(
            "dq_active_failed_background"
        ),
        (F.col("same_license") > 1).alias("dq_duplicate_license"),
        (F.col("same_plate") > 1).alias("dq_duplicate_plate"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
        loaded_at(as_of),
    )
    return keep_latest(typed, "driver_id", "_extracted_at")
