"""Silver orders: typed, repaired, one row per order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_title,
    clean_upper,
    money,
    timestamp_from_parts,
    to_int,
    try_date,
    try_time,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import loaded_at
from courierlake.plans.values import RATEABLE, REFUNDABLE



def _typed(bronze: DataFrame) -> DataFrame:
    return with_row_hash(bronze).filter(F.col("order_id").isNotNull()).select(
        F.trim("order_id").alias("order_id"),
        F.trim("customer_id").alias("customer_id"),
        F.trim("restaurant_id").alias("restaurant_id"),
        F.trim("driver_id").alias("raw_driver_id"),
        try_date("order_date").alias("order_date"),
        try_time("order_time").alias("order_time"),
        clean_title("status").alias("status"),
        clean_title("channel").alias("channel"),
        clean_title("order_type").alias("order_type"),
        money(F.abs("subtotal_usd")).alias("subtotal_usd"),
        money(F.abs("tax_usd")).alias("tax_usd"),
        money(F.abs("delivery_fee_usd")).alias("raw_delivery_fee"),
        money(F.abs("discount_usd")).alias("discount_usd"),
        money(F.abs(F.coalesce("tip_usd", F.lit(0)))).alias("tip_usd"),
        money(F.abs(F.coalesce("refund_amount_usd", F.lit(0)))).alias("raw_refund"),
        to_int("items_count").alias("items_count"),
        clean_upper("promo_code").alias("raw_promo"),
        to_int("estimated_delivery_min").alias("estimated_delivery_min"),
        to_int("actual_delivery_min").alias("raw_actual_min"),
        to_int("prep_time_min").alias("prep_time_min"),
        F.col("customer_rating").cast("decimal(3,1)").alias("raw_rating"),
        F.trim("notes").alias("notes"),
        F.col("is_reorder").cast("boolean").alias("is_reorder"),
        F.trim("cancellation_reason").alias("raw_reason"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
    )


def _repair(df: DataFrame) -> DataFrame:
    # A customer collects a pickup order: no courier, no fee.
    pickup = F.col("order_type") == "Pickup"
    df = df.withColumns(
        {
            "driver_id": F.when(pickup, F.lit(None)).otherwise(F.col("raw_driver_id")),
            "delivery_fee_usd": money(F.when(pickup, 0).otherwise(F.col("raw_delivery_fee"))),
        }
    )

    # The tip goes to the driver and is no part of the total; the raw total is not trusted.
    df = df.withColumn(
        "total_usd",
        money(
            F.col("subtotal_usd")
            + F.col("tax_usd")
            + F.col("delivery_fee_usd")
            - F.col("discount_usd")
        ),
    )

    promo, discount = F.col("raw_promo"), F.col("discount_usd")
    status, reason = F.col("status"), F.col("raw_reason")
    refund, total = F.col("raw_refund"), F.col("total_usd")
    impossible_time = F.col("raw_actual_min") < F.col("prep_time_min")
    return df.withColumns(
        {
            "promo_code": F.when(promo.isNotNull() & (discount == 0), F.lit(None))
            .when(promo.isNull() & (discount > 0), F.lit("UNKNOWN"))
            .otherwise(promo),
            "refund_amount_usd": F.when(status.isin(*REFUNDABLE) & (refund == 0), total)
            .when(refund > total, total)
            .otherwise(refund),
            "actual_delivery_min": F.when(impossible_time, F.lit(None)).otherwise(
                F.col("raw_actual_min")
            ),
            "customer_rating": F.when(~status.isin(*RATEABLE), F.lit(None)).otherwise(
                F.col("raw_rating")
            ),
            "cancellation_reason": F.when(
                (status == "Cancelled") & reason.isNull(), F.lit("Unknown")
            )
            .when(status != "Cancelled", F.lit(None))
            .otherwise(reason),
        }
    )


def clean_orders(bronze: DataFrame, as_of: date) -> DataFrame:
    latest = keep_latest(bronze.transform(_typed).transform(_repair), "order_id", "_extracted_at")
    return latest.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        "driver_id",
        "order_date",
        "order_time",
        timestamp_from_parts("order_date", "order_time").alias("order_at"),
        "status",
        "channel",
        "order_type",
        "is_reorder",
        "promo_code",
        "cancellation_reason",
        "notes",
        "subtotal_usd",
        "tax_usd",
        "delivery_fee_usd",
        "discount_usd",
        "total_usd",
        "tip_usd",
        "refund_amount_usd",
        "items_count",
        "prep_time_min",
        "estimated_delivery_min",
        "actual_delivery_min",
        "customer_rating",
        "_extracted_at",
        loaded_at(as_of),
    )
