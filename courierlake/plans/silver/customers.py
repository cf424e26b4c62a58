"""Silver customers: profile, repaired averages, quality flags, one row per customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import (
    clean_lower,
    clean_title,
    clean_upper,
    date_diff_boundary,
    safe_ratio,
    try_boolean,
    try_date,
    try_double,
    try_money,
)
from courierlake.operators.dedup import ROW_HASH, keep_latest, with_row_hash
from courierlake.plans.silver.common import day, loaded_at


def _typed(bronze: DataFrame, as_of: date) -> DataFrame:
    gender = F.lower("gender")
    unset = F.lit("NaN")
    return with_row_hash(bronze).filter(F.col("customer_id").isNotNull()).select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("user_id").alias("user_id"),
        clean_title("first_name").alias("first_name"),
        clean_title("last_name").alias("last_name"),
        # From the source columns as they came, neither trimmed nor title-cased.
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        clean_lower("email").alias("email"),
        F.regexp_replace("phone", "[^0-9]", "").alias("phone_digits"),
        try_date("date_of_birth").alias("date_of_birth"),
        date_diff_boundary("year", try_date("date_of_birth"), day(as_of)).alias("age_years"),
        F.when(gender.isin("male", "m"), "Male")
        .when(gender.isin("female", "f"), "Female")
        .otherwise("Other")
        .alias("gender"),
        clean_title("city").alias("city"),
        clean_upper("state").alias("state"),
        F.lpad(F.col("zip_code").cast("string"), 5, "0").alias("zip_code"),
        try_date("registration_date").alias("registered_at"),
        try_date("last_order_date").alias("last_order_at"),
        clean_title("account_status").alias("account_status"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        try_money(F.coalesce("total_spent_usd", F.lit(0))).alias("total_spent_usd"),
        try_money(F.coalesce("avg_order_value_usd", F.lit(0))).alias("stated_average"),
        F.coalesce("loyalty_points", F.lit(0)).alias("loyalty_points"),
        clean_title("loyalty_tier").alias("loyalty_tier"),
        clean_title("preferred_payment").alias("preferred_payment_method"),
        clean_title("preferred_cuisine").alias("preferred_cuisine_type"),
        F.coalesce(F.nullif(F.trim("dietary_preference"), unset), F.lit("None Specified")).alias(
            "dietary_preference"
        ),
        try_boolean("is_premium").alias("is_premium"),
        try_boolean("marketing_opt_in").alias("has_marketing_opt_in"),
        try_double(F.nullif(F.trim("churn_risk"), unset)).alias("churn_risk"),
        F.coalesce("referral_count", F.lit(0)).alias("referral_count"),
        F.col("event_time").cast("timestamp").alias("_extracted_at"),
        ROW_HASH,
    )


def _check(df: DataFrame, as_of: date) -> DataFrame:
    orders, spent = F.col("total_orders"), F.col("total_spent_usd")
    average = safe_ratio(spent, orders)
    a_month_ago = F.date_sub(day(as_of), 30)
    df = df.withColumns(
        {
            "true_average": F.when(orders > 0, average).otherwise(0),
            "dq_avg_val_mismatch": (orders > 0) & (F.abs(F.col("stated_average") - average) > 0.01),
            "dq_low_spend_anomaly": (orders > 0)
            & (spent < 1)
            & (F.col("registered_at") < a_month_ago),
            "dq_loyalty_mismatch": (F.col("loyalty_points") == 0) & (spent > 100),
        }
    )
    corrected = F.when(F.col("dq_avg_val_mismatch"), F.col("true_average")).otherwise(
        F.col("stated_average")
    )
    return df.withColumn("avg_order_value_usd", corrected.cast("decimal(18,2)"))


def clean_customers(bronze: DataFrame, as_of: date) -> DataFrame:
    checked = bronze.transform(_typed, as_of).transform(_check, as_of)
    return keep_latest(checked, "customer_id", "_extracted_at").select(
        "customer_id",
        "user_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "phone_digits",
        "date_of_birth",
        "age_years",
        "gender",
        "city",
        "state",
        "zip_code",
        "registered_at",
        "last_order_at",
        "account_status",
        "total_orders",
        "total_spent_usd",
        "avg_order_value_usd",
        "loyalty_points",
        "loyalty_tier",
        "preferred_payment_method",
        "preferred_cuisine_type",
        "dietary_preference",
        "is_premium",
        "churn_risk",
        "has_marketing_opt_in",
        "referral_count",
        "dq_avg_val_mismatch",
        "dq_low_spend_anomaly",
        "dq_loyalty_mismatch",
        "_extracted_at",
        loaded_at(as_of),
    )
