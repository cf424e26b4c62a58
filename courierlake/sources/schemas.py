"""Explicit schemas of the ten bronze tables.

Bronze is never inferred: a file whose column is all null, or holds integers in
one batch and decimals in the next, still lands with the declared type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Columns that ingestion adds to every source row.
ENVELOPE_DDL = "event_type string, event_time string"

_SOURCE_DDL = {
    "orders": """
        order_id string, customer_id string, restaurant_id string, driver_id string,
        order_date string, order_time string, status string, channel string, order_type string,
        subtotal_usd double, tax_usd double, delivery_fee_usd double, discount_usd double,
        tip_usd double, total_usd double, refund_amount_usd double, items_count int,
        promo_code string, estimated_delivery_min int, actual_delivery_min int, prep_time_min int,
        customer_rating double, notes string, is_reorder boolean, cancellation_reason string
    """,
    "payments": """
        payment_id string, order_id string, customer_id string, payment_method string,
        card_type string, card_last4 string, currency string, payment_date string,
        payment_time string, status string, transaction_id string, gateway string,
        amount_usd double, gateway_fee_usd double, is_refunded boolean, refund_amount_usd double,
        refund_date string, fraud_score double, is_flagged boolean, ip_country string,
        billing_zip string
    """,
    "delivery": """
        delivery_id string, order_id string, driver_id string, restaurant_id string,
        customer_id string, pickup_time string, dropoff_time string, estimated_time_min int,
        actual_time_min int, distance_km double, pickup_lat double, pickup_lng double,
        dropoff_lat double, dropoff_lng double, status string, weather_condition string,
        traffic_level string, delivery_attempt int, proof_of_delivery string, driver_rating double,
        tip_usd double, is_on_time boolean, late_reason string, notes string
    """,
    "billing": """
        invoice_id string, restaurant_id string, invoice_date string, due_date string,
        payment_date string, base_fee_usd decimal(18,2), usage_orders int,
        overage_fee_usd decimal(18,2), addon_fee_usd decimal(18,2), discount_usd decimal(18,2),
        tax_usd decimal(18,2), total_usd decimal(18,2), billing_period string, plan_tier string,
        status string, payment_method string, payment_gateway string, currency string,
        transaction_ref string, notes string, created_by string
    """,
    "customers": """
        customer_id string, user_id string, first_name string, last_name string, email string,
        phone string, date_of_birth string, gender string, city string, state string,
        zip_code string, registration_date string, last_order_date string, account_status string,
        total_orders int, total_spent_usd double, avg_order_value_usd double, loyalty_points int,
        loyalty_tier string, preferred_payment string, preferred_cuisine string,
        dietary_preference string, is_premium string, marketing_opt_in string, churn_risk string,
        referral_count int
    """,
    "users": """
        user_id string, first_name string, last_name string, email string, phone string,
        city string, state string, zip_code string, country string, registration_date string,
        last_login string, account_status string, role string, email_verified string,
        preferred_lang string, referral_code string, referred_by string, notification_opt string,
        loyalty_tier string, total_spent_usd double
    """,
    "restaurants": """
        restaurant_id string, name string, cuisine_type string, address string, city string,
        state string, zip_code string, phone string, email string, website string,
        plan_tier string, monthly_fee_usd double, commission_pct double, signup_date string,
        is_active boolean, is_featured boolean, avg_rating double, total_reviews int,
        total_orders int, avg_prep_time_min double, open_time string, close_time string,
        delivery_radius_km double, min_order_usd double, accepts_cash boolean,
        halal_certified boolean, vegan_options boolean
    """,
    "drivers": """
        driver_id string, first_name string, last_name string, email string, phone string,
        city string, state string, zone string, vehicle_type string, vehicle_plate string,
        license_number string, hire_date string, is_active boolean, status string,
        background_check string, total_deliveries int, avg_rating double, on_time_rate_pct double,
        acceptance_rate_pct double, hourly_rate_usd double, total_earnings_usd double,
        total_tips_usd double, max_distance_km double
    """,
    "promotions": """
        promo_id string, campaign_id string, created_by string, restaurant_id string,
        promo_code string, promo_name string, promo_type string, target_segment string,
        applies_to string, channel string, is_stackable boolean, discount_value double,
        discount_unit string, min_order_usd double, max_discount_usd double, start_date string,
        end_date string, usage_limit int, times_used int, revenue_impact_usd double
    """,
    "reviews": """
        review_id string, order_id string, customer_id string, restaurant_id string,
        driver_id string, overall_rating string, food_rating string, delivery_rating string,
        driver_rating string, packaging_rating string, value_rating string, review_text string,
        review_date string, sentiment string, is_verified string, helpful_votes int,
        report_count int, restaurant_response string, is_featured string, platform string,
        images_attached string
    """,
}

TOPICS = tuple(_SOURCE_DDL)

# First column of a row, used as message key and as the table's primary key.
PRIMARY_KEYS = {
    "orders": "order_id",
    "payments": "payment_id",
    "delivery": "delivery_id",
    "billing": "invoice_id",
    "customers": "customer_id",
    "users": "user_id",
    "restaurants": "restaurant_id",
    "drivers": "driver_id",
    "promotions": "promo_id",
    "reviews": "review_id",
}


def source_schema(topic: str) -> T.StructType:
    """Schema of a source row, before the event envelope is added."""
    return T.StructType.fromDDL(_SOURCE_DDL[topic].strip())


def bronze_schema(topic: str) -> T.StructType:
    """Schema of a landed event: the source row plus its envelope."""
    return T.StructType.fromDDL(f"{_SOURCE_DDL[topic].strip()}, {ENVELOPE_DDL}")
