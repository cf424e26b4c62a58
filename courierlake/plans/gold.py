"""Gold layer: five facts and five dimensions over silver, keyed by hashed ids.

Facts and most dimensions are projections. ``{new: old}`` maps state the renames; columns
that keep their name are listed as they are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions import date_diff_boundary, surrogate_key
from courierlake.operators.skew import lookup_join
from courierlake.plans.silver.common import day


def _keys(*ids: str) -> list[Column]:
    """``order_id`` becomes ``order_sk``, and so on."""
    return [surrogate_key(i).alias(i.removesuffix("_id") + "_sk") for i in ids]


def _renamed(**new_from_old: str) -> list[Column]:
    return [F.col(old).alias(new) for new, old in new_from_old.items()]


def fct_orders(orders: DataFrame, with_id: bool = False) -> DataFrame:
    """``with_id`` also keeps the natural order id, for joins that must not meet hash collisions."""
    return orders.select(
        *["order_id"] * with_id,
        *_keys("order_id", "customer_id", "restaurant_id", "driver_id"),
        "order_at",
        "order_date",
        "order_time",
        *_renamed(order_status="status", order_channel="channel"),
        "order_type",
        *_renamed(is_reorder_flag="is_reorder"),
        "items_count",
        *_renamed(
            subtotal_amount="subtotal_usd",
            tax_amount="tax_usd",
            delivery_fee_amount="delivery_fee_usd",
            discount_amount="discount_usd",
            tip_amount="tip_usd",
            total_paid_amount="total_usd",
            refund_amount="refund_amount_usd",
        ),
        "promo_code",
        "customer_rating",
        "notes",
        "cancellation_reason",
    )


def fct_payments(payments: DataFrame, with_id: bool = False) -> DataFrame:
    status = F.col("status")
    return payments.select(
        *["order_id"] * with_id,
        *_keys("payment_id", "order_id", "customer_id"),
        "transaction_id",
        "payment_date",
        "payment_time",
        "payment_at_ts",
        "payment_method",
        "payment_gateway",
        "currency",
        "amount_usd",
        *_renamed(gateway_fee_usd="fee_amount_usd"),
        "net_amount_usd",
        *_renamed(refund_amount="refund_amount_usd", payment_status="status"),
        "is_refunded",
        "fraud_score",
        "fraud_risk_level",
        "ip_country",
        "billing_zip_code",
        (status == "Success").alias("is_fully_paid"),
        (status == "Failed").alias("is_failed_transaction"),
        (F.col("fraud_risk_level") == "High").alias("is_high_risk_transaction"),
    )


def fct_delivery(delivery: DataFrame) -> DataFrame:
    delivered = F.col("status") == "Delivered"
    return delivery.select(
        *_keys("delivery_id", "order_id", "driver_id", "restaurant_id", "customer_id"),
        "pickup_time",
        "dropoff_time",
        "delivery_month",
        "delivery_day_of_week",
        "pickup_hour",
        "pickup_lat",
        "pickup_lng",
        "dropoff_lat",
        "dropoff_lng",
        *_renamed(
            duration_minutes="actual_time_min",
            estimated_minutes="estimated_time_min",
            actual_minutes="actual_time_min",
            delay_minutes="delay_min",
        ),
        "is_late",
        "distance_km",
        "avg_speed_kmh",
        "weather_condition",
        "traffic_level",
        "condition_severity",
        *_renamed(delivery_status="status"),
        "driver_rating",
        "driver_rating_bucket",
        *_renamed(tip_amount="tip_usd"),
        "tip_bucket",
        "late_reason",
        F.coalesce("notes", F.lit("None")).alias("driver_notes"),
        *_renamed(attempt_number="delivery_attempt"),
        "is_first_attempt",
        "is_redelivery",
        "total_attempts_for_order",
        "proof_of_delivery",
        delivered.alias("is_completed"),
        (delivered & ~F.col("is_late")).alias("is_perfect_trip"),
        (F.col("delay_min") > 15).alias("contains_severe_delay"),
    )


def fct_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        *_keys("review_id", "order_id", "customer_id", "restaurant_id", "driver_id"),
        "review_date",
        "rating_overall",
        "rating_food",
        "rating_delivery",
        "rating_driver",
        "rating_packaging",
        "rating_value",
        "review_content",
        "sentiment",
        "is_verified_purchase",
        "helpful_votes_count",
        "report_count",
        "has_images",
        "source_platform",
        "has_restaurant_responded",
        "restaurant_response_text",
        "is_featured_review",
        "is_positive_review",
        "is_negative_review",
        *_renamed(is_potential_anomaly="is_conflicting_sentiment"),
    )


def fct_billing(billing: DataFrame) -> DataFrame:
    return billing.select(
        surrogate_key("invoice_id").alias("billing_sk"),
        *_keys("restaurant_id"),
        "transaction_ref",
        "invoice_date",
        "due_date",
        "payment_date",
        "days_to_due",
        "days_to_payment",
        *_renamed(billing_status="status"),
        "billing_period",
        "plan_tier",
        "is_overdue",
        *_renamed(invoice_total_usd="total_usd"),
        "base_fee_usd",
        "usage_orders",
        "overage_fee_usd",
        "addon_fee_usd",
        "discount_usd",
        "tax_usd",
        *_renamed(
            raw_source_total_usd="total_usd_original",
            calculation_variance_usd="total_usd_variance",
        ),
        "payment_method",
        "payment_gateway",
        "currency",
        "notes",
        "created_by",
    )


def dim_customers(customers: DataFrame, users: DataFrame, as_of: date) -> DataFrame:
    account = users.select(
        "user_id", "last_login_at", "is_email_verified", "user_role", "has_notification_opt_in"
    )
    since_order = date_diff_boundary("day", "last_order_at", day(as_of))
    spent, tier = F.col("total_spent_usd"), F.col("loyalty_tier")
    return lookup_join(customers, account, "user_id").select(
        *_keys("customer_id", "user_id"),
        "full_name",
        "email",
        *_renamed(phone="phone_digits"),
        "date_of_birth",
        "age_years",
        "gender",
        "city",
        "state",
        "zip_code",
        "account_status",
        "is_email_verified",
        "user_role",
        "has_notification_opt_in",
        "is_premium",
        "has_marketing_opt_in",
        "registered_at",
        "last_order_at",
        "last_login_at",
        since_order.alias("days_since_last_order"),
        "total_orders",
        *_renamed(lifetime_value_usd="total_spent_usd", aov_usd="avg_order_value_usd"),
        "loyalty_points",
        "loyalty_tier",
        *_renamed(churn_risk_score="churn_risk"),
        "referral_count",
        "preferred_payment_method",
        "preferred_cuisine_type",
        "dietary_preference",
        F.when(since_order <= 30, "Active")
        .when(since_order <= 90, "At Risk")
        .when(since_order > 90, "Churned")
        .otherwise("Unknown")
        .alias("customer_lifecycle"),
        F.when(spent >= 500, "High Value")
        .when(spent >= 150, "Medium Value")
        .otherwise("Low Value")
        .alias("value_segment"),
        F.when(tier.isin("Diamond", "Platinum"), "Top Tier")
        .when(tier.isin("Gold", "Silver"), "Mid Tier")
        .otherwise("Base Tier")
        .alias("loyalty_segment"),
    )


def paid_billing_summary(billing: DataFrame) -> DataFrame:
    """Lifetime paid fees per restaurant. Invoices paid on an unknown date do not count."""
    return (
        billing.filter(F.col("status") == "Paid")
        .groupBy("restaurant_id")
        .agg(
            F.sum("total_usd").alias("lifetime_fees_paid_usd"),
            F.sum("base_fee_usd").alias("total_base_fees_usd"),
            F.sum("overage_fee_usd").alias("total_overage_fees_usd"),
            F.max("invoice_date").alias("last_billing_date"),
            F.count("invoice_id").alias("total_invoices_paid"),
        )
    )


def dim_restaurants(restaurants: DataFrame, billing: DataFrame) -> DataFrame:
    # Both sides hold one row per restaurant, so this join cannot be skewed.
    joined = restaurants.join(paid_billing_summary(billing), "restaurant_id", "left")
    fees = F.coalesce("lifetime_fees_paid_usd", F.lit(0))
    prep = F.col("avg_prep_time_min")
    return joined.select(
        *_keys("restaurant_id"),
        "restaurant_id",
        "restaurant_name",
        "cuisine_type",
        "address",
        "city",
        "state",
        "zip_code",
        "phone",
        "email",
        "website",
        "plan_tier",
        "monthly_fee_usd",
        "commission_pct",
        "commission_bucket",
        fees.alias("lifetime_fees_paid_usd"),
        F.coalesce("total_base_fees_usd", F.lit(0)).alias("total_base_fees_usd"),
        F.coalesce("total_overage_fees_usd", F.lit(0)).alias("total_overage_fees_usd"),
        *_renamed(
            lifetime_orders_count="total_orders",
            lifetime_reviews_count="total_reviews",
        ),
        "avg_rating",
        "rating_bucket",
        "volume_bucket",
        "avg_prep_time_min",
        "open_time",
        "close_time",
        "operating_hours_per_day",
        "delivery_radius_km",
        "min_order_usd",
        "signup_date",
        "months_on_platform",
        "restaurant_status",
        "is_active",
        "is_featured",
        "last_billing_date",
        "accepts_cash",
        "halal_certified",
        "vegan_options",
        F.when(fees >= 10000, "Key Account")
        .when(fees >= 2000, "Growing Partner")
        .otherwise("Standard Partner")
        .alias("partner_segment"),
        F.when(prep <= 15, "Fast Prep")
        .when(prep <= 30, "Average Prep")
        .otherwise("Slow Prep")
        .alias("efficiency_segment"),
    )


def dim_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.select(
        *_keys("driver_id"),
        "full_name",
        "email",
        "phone",
        "city",
        "state",
        "zone",
        "vehicle_type",
        "vehicle_plate",
        "license_number",
        "vehicle_capacity",
        "hire_date",
        "months_on_platform",
        "tenure_bucket",
        "is_active",
        *_renamed(activity_status="status_clean"),
        "background_check",
        *_renamed(is_high_risk_driver="dq_active_failed_background"),
        "total_deliveries",
        "avg_rating",
        "on_time_rate_pct",
        "acceptance_rate_pct",
        "rating_bucket",
        "performance_tier",
        "hourly_rate_usd",
        "total_earnings_usd",
        "total_tips_usd",
        "avg_earning_per_delivery_usd",
        "max_distance_km",
    )


def dim_promotions(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        surrogate_key("promo_id").alias("promo_sk"),
        *_keys("restaurant_id"),
        "campaign_id",
        "restaurant_scope",
        *_renamed(campaign_manager="created_by"),
        "promo_code",
        "promo_name",
        "promo_type",
        "target_segment",
        "applies_to",
        *_renamed(marketing_channel="channel"),
        "is_stackable_flag",
        "discount_value",
        *_renamed(discount_type="discount_unit_clean"),
        "discount_label",
        "min_order_usd",
        "max_discount_usd",
        "start_date",
        "end_date",
        "duration_days",
        "is_currently_live",
        "usage_limit",
        *_renamed(redemption_count="times_used"),
        "usage_rate_pct",
        "usage_bucket",
        *_renamed(total_campaign_cost_usd="revenue_cost_usd"),
        "avg_cost_per_use_usd",
        "dq_over_usage_limit",
        "dq_max_discount_lt_min_order",
    )


def dim_users(users: DataFrame) -> DataFrame:
    return users.select(
        *_keys("user_id"),
        "user_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        "city",
        "state",
        "zip_code",
        "country",
        *_renamed(registered_at="registered_date"),
        "last_login_at",
        "account_status",
        *_renamed(platform_role="user_role"),
        "is_email_verified",
        *_renamed(
            preferred_language="preferred_lang",
            is_opted_in_notifications="has_notification_opt_in",
        ),
        "referral_code",
        "referred_by",
        "loyalty_tier",
        *_renamed(lifetime_spend_total_usd="total_spent_usd"),
        "_loaded_at",
    )
