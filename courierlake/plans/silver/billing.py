"""Silver billing: dates untangled, totals and status recomputed, one row per invoice."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_title,
    clean_upper,
    date_diff_boundary,
    greatest_or_null,
    money,
    try_date,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import day, loaded_at
from courierlake.plans.values import OPEN_INVOICE, SETTLED, UNPAID_INVOICE

FEES = ("base_fee_usd", "overage_fee_usd", "addon_fee_usd", "discount_usd", "tax_usd")


def _typed(bronze: DataFrame) -> DataFrame:
    titles = ("billing_period", "plan_tier", "payment_method", "payment_gateway")
    return with_row_hash(bronze).filter(F.col("invoice_id").isNotNull()).select(
        F.trim("invoice_id").alias("invoice_id"),
        F.trim("restaurant_id").alias("restaurant_id"),
        try_date("invoice_date").alias("raw_invoice_date"),
        try_date("due_date").alias("raw_due_date"),
        try_date("payment_date").alias("raw_payment_date"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in (*FEES, "usage_orders")],
        F.col("total_usd").alias("stated_total"),
        *[clean_title(c).alias(c) for c in titles],
        clean_title("status").alias("raw_status"),
        clean_upper("currency").alias("currency"),
        F.trim("transaction_ref").alias("transaction_ref"),
        F.coalesce(F.nullif(F.trim("notes"), F.lit("")), F.lit("None")).alias("notes"),
        F.trim("created_by").alias("created_by"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
    )


def _repair(df: DataFrame, as_of: date) -> DataFrame:
    first, second = F.col("raw_invoice_date"), F.col("raw_due_date")
    swapped = second < first
    total = (
        F.col("base_fee_usd")
        + F.col("overage_fee_usd")
        + F.col("addon_fee_usd")
        - F.col("discount_usd")
        + F.col("tax_usd")
    )
    df = df.withColumns(
        {
            "invoice_date": F.when(swapped, second).otherwise(first),
            "due_date": F.when(swapped, first).otherwise(second),
            "total_usd": money(greatest_or_null(F.round(total, 2), F.lit(0))),
        }
    )

    paid_on, issued = F.col("raw_payment_date"), F.col("invoice_date")
    status = F.col("raw_status")
    past_due = F.col("due_date") < day(as_of)
    df = df.withColumns(
        {
            "payment_date": F.when(paid_on < issued, F.lit(None))
            .when(paid_on.isNull() & (status == "Paid"), issued)
            .otherwise(paid_on),
            # Waived and disputed invoices stay so even with a payment date.
            "status": F.when(
                (paid_on >= issued) & status.isin(*UNPAID_INVOICE), "Paid"
            )
            .when((status == "Paid") & paid_on.isNull(), "Paid - Date Unknown")
            .when(status.isin(*OPEN_INVOICE) & past_due, "Overdue")
            .otherwise(status),
        }
    )
    unsettled = ~F.col("status").isin(*SETTLED)
    return df.withColumn("is_overdue", F.coalesce(unsettled & past_due, F.lit(False)))


def clean_billing(bronze: DataFrame, as_of: date) -> DataFrame:
    repaired = bronze.transform(_typed).transform(_repair, as_of)
    latest = keep_latest(repaired, "invoice_id", "_extracted_at")
    return latest.select(
        "invoice_id",
        "restaurant_id",
        "invoice_date",
        "due_date",
        "payment_date",
        date_diff_boundary("day", "invoice_date", "due_date").alias("days_to_due"),
        date_diff_boundary("day", "invoice_date", "payment_date").alias("days_to_payment"),
        "is_overdue",
        "billing_period",
        "plan_tier",
        "status",
        "payment_method",
        "payment_gateway",
        "currency",
        "base_fee_usd",
        "usage_orders",
        "overage_fee_usd",
        "addon_fee_usd",
        "discount_usd",
        "tax_usd",
        "total_usd",
        F.round("stated_total", 2).alias("total_usd_original"),
        F.round(F.col("stated_total") - F.col("total_usd"), 2).alias("total_usd_variance"),
        "transaction_ref",
        "notes",
        "created_by",
        loaded_at(as_of),
    )
