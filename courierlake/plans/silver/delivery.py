"""Silver delivery: durations, flags and buckets rebuilt, one row per delivery."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import clean_title, date_diff_boundary, money, to_int
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.operators.skew import attach_group_stats
from courierlake.plans.silver.common import loaded_at
from courierlake.plans.values import HIGH_WEATHER, IN_PROGRESS, NOT_COMPLETED, SEVERE_WEATHER

MAX_SPEED_KMH = 120


def _typed(bronze: DataFrame) -> DataFrame:
    return with_row_hash(bronze).filter(F.col("delivery_id").isNotNull()).select(
        F.trim("delivery_id").alias("delivery_id"),
        F.trim("order_id").alias("order_id"),
        F.trim("driver_id").alias("driver_id"),
        F.trim("restaurant_id").alias("restaurant_id"),
        F.trim("customer_id").alias("customer_id"),
        F.col("pickup_time").try_cast("timestamp").alias("pickup_time"),
        F.col("dropoff_time").try_cast("timestamp").alias("dropoff_time"),
        to_int("estimated_time_min").alias("estimated_time_min"),
        to_int("actual_time_min").alias("reported_min"),
        *[
            F.col(c).cast("double").alias(c)
            for c in ("distance_km", "pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
        ],
        clean_title("status").alias("status"),
        clean_title("weather_condition").alias("weather_condition"),
        clean_title("traffic_level").alias("traffic_level"),
        to_int("delivery_attempt").alias("delivery_attempt"),
        F.trim("proof_of_delivery").alias("raw_proof"),
        F.col("driver_rating").cast("decimal(3,1)").alias("raw_rating"),
        money(F.coalesce("tip_usd", F.lit(0))).alias("raw_tip"),
        F.trim("late_reason").alias("raw_late_reason"),
        F.trim("notes").alias("notes"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
    )


def _timing(df: DataFrame) -> DataFrame:
    # The two recorded moments outrank the reported duration.
    measured = date_diff_boundary("minute", "pickup_time", "dropoff_time")
    df = df.withColumn(
        "actual_time_min",
        F.when(F.col("dropoff_time") > F.col("pickup_time"), measured).otherwise(
            F.col("reported_min")
        ),
    )
    actual, estimated = F.col("actual_time_min"), F.col("estimated_time_min")
    # An integer divided by 60.0 has six decimals in the source dialect.
    hours = F.round(actual.cast("decimal(12,0)") / F.lit(60), 6).cast("double")
    speed = F.round(F.try_divide(F.col("distance_km"), hours), 2)
    return df.withColumns(
        {
            "is_on_time": actual <= estimated,
            "is_late": actual > estimated,
            "delay_min": actual - estimated,
            "speed": speed,
        }
    ).withColumn("avg_speed_kmh", F.when(F.col("speed") > MAX_SPEED_KMH, F.lit(None)).otherwise(F.col("speed")))


def _repair(df: DataFrame) -> DataFrame:
    status, on_time = F.col("status"), F.col("is_on_time")
    weather, traffic = F.col("weather_condition"), F.col("traffic_level")
    not_completed = status.isin(*NOT_COMPLETED)
    late_reason, proof = F.col("raw_late_reason"), F.col("raw_proof")
    df = df.withColumns(
        {
            "late_reason": F.when(on_time, F.lit(None))
            .when(~on_time & late_reason.isNull(), F.lit("Unknown"))
            .otherwise(late_reason),
            "driver_rating": F.when(not_completed, F.lit(None)).otherwise(F.col("raw_rating")),
            "tip_usd": money(F.when(not_completed, 0).otherwise(F.col("raw_tip"))),
            "proof_of_delivery": F.when(
                (status == "Delivered") & proof.isNull(), F.lit("Not Captured")
            )
            .when(status != "Delivered", F.lit(None))
            .otherwise(proof),
            "condition_severity": F.when(
                weather.isin(*SEVERE_WEATHER) | (traffic == "Severe"), "Severe"
            )
            .when(weather.isin(*HIGH_WEATHER) | (traffic == "High"), "High")
            .when((weather == "Cloudy") | (traffic == "Moderate"), "Moderate")
            .otherwise("Normal"),
        }
    )
    rating, tip = F.col("driver_rating"), F.col("tip_usd")
    return df.withColumns(
        {
            # Half steps between 2 and 4, other than 3, have no bucket either.
            "driver_rating_bucket": F.when(rating >= 4, "Good")
            .when(rating == 3, "Neutral")
            .when(rating <= 2, "Bad")
            .otherwise("No Rating"),
            "tip_bucket": F.when(tip == 0, "No Tip")
            .when(tip <= 5, "Low")
            .when(tip <= 10, "Medium")
            .otherwise("High"),
        }
    )


def _attempts(df: DataFrame) -> DataFrame:
    """Per-order attempt columns. Re-extracted copies count, as they come before dedup."""
    counted = attach_group_stats(
        df,
        {
            "deliveries_for_order": ("order_id", F.count("delivery_id")),
            "total_attempts_for_order": ("order_id", F.max("delivery_attempt")),
        },
    )
    return counted.withColumns(
        {
            "is_redelivery": F.col("deliveries_for_order") > 1,
            "is_first_attempt": F.col("delivery_attempt") == 1,
        }
    )


def clean_delivery(bronze: DataFrame, as_of: date) -> DataFrame:
    repaired = bronze.transform(_typed).transform(_timing).transform(_repair)
    latest = keep_latest(repaired.transform(_attempts), "delivery_id", "_extracted_at")
    status = F.col("status")
    return latest.select(
        "delivery_id",
        "order_id",
        "driver_id",
        "restaurant_id",
        "customer_id",
        "pickup_time",
        "dropoff_time",
        F.date_trunc("month", "pickup_time").alias("delivery_month"),
        F.dayname("pickup_time").alias("delivery_day_of_week"),
        F.hour("pickup_time").alias("pickup_hour"),
        "estimated_time_min",
        "actual_time_min",
        "delay_min",
        "is_on_time",
        "is_late",
        "late_reason",
        "distance_km",
        "avg_speed_kmh",
        "status",
        (status == "Delivered").alias("is_delivered"),
        status.isin(*NOT_COMPLETED).alias("is_failed"),
        status.isin(*IN_PROGRESS).alias("is_in_progress"),
        "pickup_lat",
        "pickup_lng",
        "dropoff_lat",
        "dropoff_lng",
        "weather_condition",
        "traffic_level",
        "condition_severity",
        "delivery_attempt",
        "is_first_attempt",
        "is_redelivery",
        "total_attempts_for_order",
        "proof_of_delivery",
        "notes",
        "driver_rating",
        "driver_rating_bucket",
        "tip_usd",
        "tip_bucket",
        "_extracted_at",
        loaded_at(as_of),
    )
