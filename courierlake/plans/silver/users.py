"""Silver users: strictly typed, one row per user. Bad data fails the run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash


def clean_users(bronze: DataFrame, as_of: date) -> DataFrame:
    typed = with_row_hash(bronze).filter(F.col("user_id").isNotNull()).select(
        "user_id",
        "first_name",
        "last_name",
        F.lower("email").alias("email"),
        "phone",
        "city",
        "state",
        "zip_code",
        F.upper("country").alias("country"),
        F.col("registration_date").cast("date").alias("registered_date"),
        F.col("last_login").cast("timestamp").alias("last_login_at"),
        "account_status",
        F.col("role").alias("user_role"),
        F.col("email_verified").cast("boolean").alias("is_email_verified"),
        "preferred_lang",
        "referral_code",
        "referred_by",
        F.col("notification_opt").cast("boolean").alias("has_notification_opt_in"),
        "loyalty_tier",
        F.col("total_spent_usd").cast("decimal(18,2)").alias("total_spent_usd"),
        F.col("event_time").cast("timestamp").alias("_loaded_at"),
        ROW_HASH,
    )
    return keep_latest(typed, "user_id", "_loaded_at")
