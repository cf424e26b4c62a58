"""DuckDB equivalents of the gold tables, without their hashed keys.

The ``g_*`` queries keep the natural ids, so that marts can join on them.
"""

from __future__ import annotations

from checks.oracle.silver import silver_ctes
from checks.oracle.sql import AS_OF, final, with_

GOLD_SQL = {
    "fct_orders": """
        SELECT *, status AS order_status, channel AS order_channel, is_reorder AS is_reorder_flag,
               subtotal_usd AS subtotal_amount, tax_usd AS tax_amount,
               delivery_fee_usd AS delivery_fee_amount, discount_usd AS discount_amount,
               tip_usd AS tip_amount, total_usd AS total_paid_amount,
               refund_amount_usd AS refund_amount
        FROM s_orders""",
    "fct_payments": """
        SELECT *, fee_amount_usd AS gateway_fee_usd, refund_amount_usd AS refund_amount,
               status AS payment_status, status = 'Success' AS is_fully_paid,
               status = 'Failed' AS is_failed_transaction,
               fraud_risk_level = 'High' AS is_high_risk_transaction
        FROM s_payments""",
    "fct_delivery": """
        SELECT *, actual_time_min AS duration_minutes, actual_time_min AS actual_minutes,
               estimated_time_min AS estimated_minutes, delay_min AS delay_minutes,
               status AS delivery_status, tip_usd AS tip_amount,
               coalesce(notes, 'None') AS driver_notes, delivery_attempt AS attempt_number,
               is_delivered AS is_completed, is_delivered AND NOT is_late AS is_perfect_trip,
               delay_min > 15 AS contains_severe_delay
        FROM s_delivery""",
    "fct_reviews": "SELECT *, is_conflicting_sentiment AS is_potential_anomaly FROM s_reviews",
    "fct_billing": """
        SELECT *, status AS billing_status, total_usd AS invoice_total_usd,
               total_usd_original AS raw_source_total_usd,
               total_usd_variance AS calculation_variance_usd
        FROM s_billing""",
    "dim_customers": f"""
        SELECT c.* REPLACE (c.customer_id AS customer_id), c.phone_digits AS phone,
               u.is_email_verified, u.user_role, u.has_notification_opt_in, u.last_login_at,
               date_diff('day', c.last_order_at, {AS_OF}) AS days_since_last_order,
               c.total_spent_usd AS lifetime_value_usd, c.avg_order_value_usd AS aov_usd,
               c.churn_risk AS churn_risk_score,
               CASE WHEN c.last_order_at IS NULL THEN 'Unknown'
                    WHEN c.last_order_at >= {AS_OF} - INTERVAL 30 DAY THEN 'Active'
                    WHEN c.last_order_at >= {AS_OF} - INTERVAL 90 DAY THEN 'At Risk'
                    ELSE 'Churned' END AS customer_lifecycle,
               CASE WHEN c.total_spent_usd >= 500 THEN 'High Value'
                    WHEN c.total_spent_usd >= 150 THEN 'Medium Value'
                    ELSE 'Low Value' END AS value_segment,
               CASE c.loyalty_tier WHEN 'Diamond' THEN 'Top Tier' WHEN 'Platinum' THEN 'Top Tier'
                    WHEN 'Gold' THEN 'Mid Tier' WHEN 'Silver' THEN 'Mid Tier'
                    ELSE 'Base Tier' END AS loyalty_segment
        FROM s_customers c LEFT JOIN s_users u USING (user_id)""",
    "dim_restaurants": """
        SELECT r.*, r.total_orders AS lifetime_orders_count, r.total_reviews AS lifetime_reviews_count,
               coalesce(p.f, 0) AS lifetime_fees_paid_usd, coalesce(p.b, 0) AS total_base_fees_usd,
               coalesce(p.o, 0) AS total_overage_fees_usd, p.d AS last_billing_date,
               CASE WHEN p.f >= 10000 THEN 'Key Account' WHEN p.f >= 2000 THEN 'Growing Partner'
                    ELSE 'Standard Partner' END AS partner_segment,
               CASE WHEN r.avg_prep_time_min <= 15 THEN 'Fast Prep'
                    WHEN r.avg_prep_time_min <= 30 THEN 'Average Prep'
                    ELSE 'Slow Prep' END AS efficiency_segment
        FROM s_restaurants r LEFT JOIN (
            SELECT restaurant_id, sum(total_usd) f, sum(base_fee_usd) b, sum(overage_fee_usd) o,
                   max(invoice_date) d
            FROM s_billing WHERE status = 'Paid' GROUP BY ALL) p USING (restaurant_id)""",
    "dim_drivers": "SELECT *, status_clean AS activity_status, "
    "dq_active_failed_background AS is_high_risk_driver FROM s_drivers",
    "dim_promotions": """
        SELECT *, created_by AS campaign_manager, channel AS marketing_channel,
               discount_unit_clean AS discount_type, times_used AS redemption_count,
               revenue_cost_usd AS total_campaign_cost_usd
        FROM s_promotions""",
    "dim_users": """
        SELECT *, registered_date AS registered_at, user_role AS platform_role,
               preferred_lang AS preferred_language,
               has_notification_opt_in AS is_opted_in_notifications,
               total_spent_usd AS lifetime_spend_total_usd
        FROM s_users""",
}

NEEDS = {
    "fct_orders": ("orders",),
    "fct_payments": ("payments",),
    "fct_delivery": ("delivery",),
    "fct_reviews": ("reviews",),
    "fct_billing": ("billing",),
    "dim_customers": ("customers", "users"),
    "dim_restaurants": ("restaurants", "billing"),
    "dim_drivers": ("drivers",),
    "dim_promotions": ("promotions",),
    "dim_users": ("users",),
}

COLUMNS = {
    "fct_orders": """order_at:s order_date:s order_time order_status order_channel order_type
        is_reorder_flag items_count:i subtotal_amount:f tax_amount:f delivery_fee_amount:f
        discount_amount:f tip_amount:f total_paid_amount:f refund_amount:f promo_code
        customer_rating:f notes cancellation_reason""",
    "fct_payments": """transaction_id payment_date:s payment_time payment_at_ts:s payment_method
        payment_gateway currency amount_usd:f gateway_fee_usd:f net_amount_usd:f refund_amount:f
        payment_status is_refunded fraud_score:f fraud_risk_level ip_country billing_zip_code
        is_fully_paid is_failed_transaction is_high_risk_transaction""",
    "fct_delivery": """pickup_time:s dropoff_time:s delivery_month:s delivery_day_of_week
        pickup_hour:i pickup_lat:f pickup_lng:f dropoff_lat:f dropoff_lng:f duration_minutes:i
        estimated_minutes:i actual_minutes:i delay_minutes:i is_late distance_km:f avg_speed_kmh:f
        weather_condition traffic_level condition_severity delivery_status driver_rating:f
        driver_rating_bucket tip_amount:f tip_bucket late_reason driver_notes attempt_number:i
        is_first_attempt is_redelivery total_attempts_for_order:i proof_of_delivery is_completed
        is_perfect_trip contains_severe_delay""",
    "fct_reviews": """review_date:s rating_overall:f rating_food:f rating_delivery:f rating_driver:f
        rating_packaging:f rating_value:f review_content sentiment is_verified_purchase
        helpful_votes_count:i report_count:i has_images source_platform has_restaurant_responded
        restaurant_response_text is_featured_review is_positive_review is_negative_review
        is_potential_anomaly""",
    "fct_billing": """transaction_ref invoice_date:s due_date:s payment_date:s days_to_due:i
        days_to_payment:i billing_status billing_period plan_tier is_overdue invoice_total_usd:f
        base_fee_usd:f usage_orders:i overage_fee_usd:f addon_fee_usd:f discount_usd:f tax_usd:f
        raw_source_total_usd:f calculation_variance_usd:f payment_method payment_gateway currency
        notes created_by""",
    "dim_customers": """full_name email phone date_of_birth:s age_years:i gender city state zip_code
        account_status is_email_verified user_role has_notification_opt_in is_premium
        has_marketing_opt_in registered_at:s last_order_at:s last_login_at:s
        days_since_last_order:i total_orders:i lifetime_value_usd:f aov_usd:f loyalty_points:i
        loyalty_tier churn_risk_score:f referral_count:i preferred_payment_method
        preferred_cuisine_type dietary_preference customer_lifecycle value_segment
        loyalty_segment""",
    "dim_restaurants": """restaurant_id restaurant_name cuisine_type address city state zip_code
        phone email website plan_tier monthly_fee_usd:f commission_pct:f commission_bucket
        lifetime_fees_paid_usd:f total_base_fees_usd:f total_overage_fees_usd:f
        lifetime_orders_count:i lifetime_reviews_count:i avg_rating:f rating_bucket volume_bucket
        avg_prep_time_min:i open_time close_time operating_hours_per_day:i delivery_radius_km:f
        min_order_usd:f signup_date:s months_on_platform:i restaurant_status is_active is_featured
        last_billing_date:s accepts_cash halal_certified vegan_options partner_segment
        efficiency_segment""",
    "dim_drivers": """full_name email phone city state zone vehicle_type vehicle_plate
        license_number vehicle_capacity hire_date:s months_on_platform:i tenure_bucket is_active
        activity_status background_check is_high_risk_driver total_deliveries:i avg_rating:f
        on_time_rate_pct:f acceptance_rate_pct:f rating_bucket performance_tier hourly_rate_usd:f
        total_earnings_usd:f total_tips_usd:f avg_earning_per_delivery_usd:f max_distance_km:f""",
    "dim_promotions": """campaign_id restaurant_scope campaign_manager promo_code promo_name
        promo_type target_segment applies_to marketing_channel is_stackable_flag discount_value:f
        discount_type discount_label min_order_usd:f max_discount_usd:f start_date:s end_date:s
        duration_days:i is_currently_live usage_limit:i redemption_count:i usage_rate_pct:f
        usage_bucket total_campaign_cost_usd:f avg_cost_per_use_usd:f dq_over_usage_limit
        dq_max_discount_lt_min_order""",
    "dim_users": """user_id first_name last_name email phone city state zip_code country
        registered_at:s last_login_at:s account_status platform_role is_email_verified
        preferred_language is_opted_in_notifications referral_code referred_by loyalty_tier
        lifetime_spend_total_usd:f _loaded_at:s""",
}


def gold_ctes(*models: str) -> dict[str, str]:
    tables = dict.fromkeys(t for m in models for t in NEEDS[m])
    return silver_ctes(*tables) | {f"g_{m}": GOLD_SQL[m] for m in models}


def gold_oracle(model: str) -> str:
    return with_(gold_ctes(model), final(COLUMNS[model], f"g_{model}"))
