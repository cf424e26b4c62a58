"""Silver payments: typed, reconciled, one row per transaction and per payment."""

from __future__ import annotations

from datetime import date
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_title,
    clean_upper,
    greatest_or_null,
    least_or_null,
    money,
    timestamp_from_parts,
    try_date,
    try_time,
)
from courierlake.operators.dedup import ROW_HASH, first_per_key, keep_latest, with_row_hash
from courierlake.plans.silver.common import loaded_at
from courierlake.plans.values import UNCOLLECTED, WALLETS



def _typed(bronze: DataFrame) -> DataFrame:
    return with_row_hash(bronze).filter(F.col("payment_id").isNotNull()).select(
        F.trim("payment_id").alias("payment_id"),
        F.trim("order_id").alias("order_id"),
        F.trim("customer_id").alias("customer_id"),
        clean_title("payment_method").alias("payment_method"),
        clean_title("card_type").alias("raw_card_type"),
        "card_last4",
        clean_upper("currency").alias("currency"),
        try_date("payment_date").alias("payment_date"),
        try_time("payment_time").alias("payment_time"),
        clean_title("status").alias("status"),
        F.trim("transaction_id").alias("transaction_id"),
        clean_title("gateway").alias("payment_gateway"),
        money(F.abs("amount_usd")).alias("amount_usd"),
        money(F.abs(F.coalesce("gateway_fee_usd", F.lit(0)))).alias("raw_fee"),
        F.col("is_refunded").cast("boolean").alias("raw_is_refunded"),
        money(F.coalesce("refund_amount_usd", F.lit(0))).alias("raw_refund"),
        try_date("refund_date").alias("raw_refund_date"),
        F.coalesce("fraud_score", F.lit(0)).cast("double").alias("fraud_score"),
        clean_upper("ip_country").alias("ip_country"),
        F.trim("billing_zip").alias("billing_zip_code"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
    )


def _repair(df: DataFrame) -> DataFrame:
    # Money that was never collected cannot be refunded.
    uncollected = F.col("status").isin(*UNCOLLECTED)
    df = df.withColumns(
        {
            "claimed": F.when(uncollected, F.lit(False)).otherwise(F.col("raw_is_refunded")),
            "refund": money(F.when(uncollected, 0).otherwise(F.col("raw_refund"))),
            "refund_day": F.when(~F.coalesce(uncollected, F.lit(False)), F.col("raw_refund_date")),
        }
    )

    amount, refund = F.col("amount_usd"), F.col("refund")
    full_refund = F.col("claimed") & (refund == 0)
    fee = least_or_null("raw_fee", "amount_usd")
    score = F.col("fraud_score")
    return df.withColumns(
        {
            "refund_date": F.when(F.col("refund_day") < F.col("payment_date"), F.lit(None)).otherwise(
                F.col("refund_day")
            ),
            "refund_amount_usd": F.when(refund > amount, amount)
            .when(full_refund, amount)
            .otherwise(refund),
            "is_refunded": F.when((refund > 0) | full_refund, F.lit(True)).otherwise(F.lit(False)),
            "fee_amount_usd": fee,
            "net_amount_usd": greatest_or_null(money(amount - fee), money(F.lit(0))),
            "card_type": F.when(F.col("payment_method").isin(*WALLETS), F.lit(None)).otherwise(
                F.col("raw_card_type")
            ),
            "fraud_risk_level": F.when(score >= 0.8, "High")
            .when(score >= 0.5, "Medium")
            .otherwise("Low"),
            "is_flagged": F.coalesce(score >= 0.8, F.lit(False)),
        }
    )


def one_per_transaction(df: DataFrame, null_txn: Literal["collapse", "keep"] = "collapse") -> DataFrame:
    """Original of each double-booked transaction: earliest payment, then earliest extract.

    Payments without a transaction id count as one transaction ("collapse") unless told
    to "keep" them all.
    """
    order = [
        F.col("payment_date").asc_nulls_last(),
        F.col("_extracted_at").asc_nulls_last(),
        F.col("payment_id").asc_nulls_last(),
    ]
    if null_txn == "collapse":
        return first_per_key(df, ["transaction_id"], order, keep_hash=True)
    known = F.col("transaction_id").isNotNull()
    originals = first_per_key(df.filter(known), ["transaction_id"], order, keep_hash=True)
    return originals.unionByName(df.filter(~known))


def clean_payments(
    bronze: DataFrame, as_of: date, null_txn: Literal["collapse", "keep"] = "collapse"
) -> DataFrame:
    repaired = bronze.transform(_typed).transform(_repair)
    # Transactions first: a re-extracted payment therefore keeps its oldest copy.
    latest = keep_latest(one_per_transaction(repaired, null_txn), "payment_id", "_extracted_at")
    return latest.select(
        "payment_id",
        "order_id",
        "customer_id",
        "payment_date",
        "payment_time",
        timestamp_from_parts("payment_date", "payment_time").alias("payment_at_ts"),
        "refund_date",
        "transaction_id",
        "payment_method",
        "card_type",
        "card_last4",
        "currency",
        "payment_gateway",
        "status",
        "amount_usd",
        "fee_amount_usd",
        "net_amount_usd",
        "refund_amount_usd",
        "is_refunded",
        "fraud_score",
        "fraud_risk_level",
        "is_flagged",
        "billing_zip_code",
        "ip_country",
        "_extracted_at",
        loaded_at(as_of),
    )
