"""Dirty bronze tables derived from the given test tables.

The expressions are those of FIXTURES.md section 2. They use only syntax that Spark SQL
and DuckDB share, so the Spark queries and their SQL oracles read the same rows. ``k`` is
the source key; ``d`` is 0 for an original row and 1 for a re-extracted copy.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Adapter:
    source: str
    key: str
    columns: dict[str, str]


ADAPTERS: dict[str, Adapter] = {
    "orders": Adapter(
        source="orders",
        key="o_orderkey",
        columns={
            "order_id": "CASE WHEN k % 997 = 5 THEN NULL ELSE ' O' || CAST(k AS STRING) || ' ' END",
            "customer_id": "'C' || CAST(o_custkey AS STRING)",
            "restaurant_id": "'R' || CAST(k % 120 AS STRING)",
            "driver_id": "CASE WHEN k % 9 = 0 THEN NULL ELSE 'D' || CAST(k % 200 AS STRING) END",
            "order_date": "CASE WHEN k % 211 = 7 THEN 'bad' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
            "order_time": "LPAD(CAST(k % 24 AS STRING), 2, '0') || ':' || LPAD(CAST(k % 60 AS STRING), 2, '0') || ':00'",
            "status": "CASE WHEN d = 1 THEN 'delivered' WHEN k % 11 = 0 THEN 'cancelled' WHEN k % 11 = 1 THEN 'failed' WHEN k % 11 = 2 THEN 'refunded' WHEN k % 11 = 3 THEN 'pending' WHEN k % 11 = 4 THEN 'out for delivery' WHEN k % 11 = 5 THEN NULL WHEN k % 11 = 6 THEN 'rejected' ELSE ' DELIVERED' END",
            "channel": "CASE WHEN k % 3 = 0 THEN 'app' WHEN k % 3 = 1 THEN 'WEB' ELSE 'phone ' END",
            "order_type": "CASE WHEN k % 4 = 0 THEN 'pickup' ELSE 'delivery' END",
            "subtotal_usd": "CASE WHEN k % 503 = 1 THEN NULL WHEN k % 13 = 0 THEN -o_totalprice ELSE o_totalprice END",
            "tax_usd": "CAST(k % 900 AS DOUBLE) / 100",
            "delivery_fee_usd": "CAST(k % 700 AS DOUBLE) / 100",
            "discount_usd": "CAST(CASE WHEN k % 3 = 0 THEN 0 WHEN k % 401 = 1 THEN 99999999 ELSE k % 500 END AS DOUBLE) / 100",
            "tip_usd": "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 1500 AS DOUBLE) / 100 END",
            "total_usd": "o_totalprice",
            "refund_amount_usd": "CASE WHEN k % 6 = 0 THEN o_totalprice * 2 WHEN k % 6 = 1 THEN CAST(k % 1000 AS DOUBLE) / 100 WHEN k % 6 = 2 THEN NULL ELSE CAST(0 AS DOUBLE) END",
            "items_count": "CAST(1 + k % 8 AS INT)",
            "promo_code": "CASE WHEN k % 4 = 1 THEN ' save' || CAST(k % 20 AS STRING) END",
            "estimated_delivery_min": "CAST(20 + k % 40 AS INT)",
            "actual_delivery_min": "CAST(10 + k % 17 AS INT)",
            "prep_time_min": "CAST(5 + k % 30 AS INT)",
            "customer_rating": "CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(2 + k % 8 AS DOUBLE) / 2 END",
            "notes": "CASE WHEN k % 8 = 0 THEN ' ring bell ' END",
            "is_reorder": "(k % 2 = 0)",
            "cancellation_reason": "CASE WHEN k % 2 = 0 THEN NULL ELSE 'changed mind' END",
            "event_time": "CASE WHEN k % 101 = 3 AND d = 0 THEN NULL ELSE '2001-08-0' || CAST(1 + d AS STRING) || 'T10:00:00' END",
        },
    ),
    "payments": Adapter(
        source="orders",
        key="o_orderkey",
        columns={
            "payment_id": "'P' || CAST(k AS STRING)",
            "order_id": "'O' || CAST(k - k % 3 AS STRING)",
            "customer_id": "'C' || CAST(o_custkey AS STRING)",
            "payment_method": "CASE WHEN k % 6 = 0 THEN 'credit card' WHEN k % 6 = 1 THEN 'debit card' WHEN k % 6 = 2 THEN 'paypal' WHEN k % 6 = 3 THEN 'apple pay' WHEN k % 6 = 4 THEN 'google pay' ELSE 'gift card' END",
            "card_type": "CASE WHEN k % 2 = 0 THEN 'visa' ELSE 'mastercard' END",
            "card_last4": "LPAD(CAST(k % 10000 AS STRING), 4, '0')",
            "currency": "' usd'",
            "payment_date": "CASE WHEN k % 97 = 1 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
            "payment_time": "LPAD(CAST(k % 24 AS STRING), 2, '0') || ':30:00'",
            "status": "CASE WHEN k % 5 = 0 THEN 'failed' WHEN k % 5 = 1 THEN 'pending' WHEN k % 5 = 2 THEN 'refunded' ELSE 'success' END",
            "transaction_id": "CASE WHEN k % 1009 = 4 THEN NULL WHEN k % 50 = 7 THEN 'T' || CAST(k - 1 AS STRING) ELSE 'T' || CAST(k AS STRING) END",
            "gateway": "CASE WHEN k % 2 = 0 THEN 'stripe' ELSE 'adyen' END",
            "amount_usd": "CASE WHEN k % 17 = 0 THEN -o_totalprice WHEN k % 1013 = 2 THEN NULL ELSE o_totalprice END",
            "gateway_fee_usd": "CASE WHEN k % 19 = 0 THEN o_totalprice * 3 WHEN k % 19 = 1 THEN NULL ELSE CAST(k % 300 AS DOUBLE) / 100 END",
            "is_refunded": "(k % 4 = 0)",
            "refund_amount_usd": "CASE WHEN k % 8 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 8 = 2 THEN o_totalprice * 2 WHEN k % 8 = 3 THEN CAST(k % 100 AS DOUBLE) ELSE NULL END",
            "refund_date": "CASE WHEN k % 8 = 2 THEN '1994-01-01' WHEN k % 8 < 4 THEN '2001-08-15' END",
            "fraud_score": "CASE WHEN k % 23 = 0 THEN NULL ELSE CAST(k % 11 AS DOUBLE) / 10 END",
            "is_flagged": "(k % 3 = 0)",
            "ip_country": "CASE WHEN k % 2 = 0 THEN 'us' ELSE ' ca ' END",
            "billing_zip": "CAST(10000 + k % 80000 AS STRING)",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T11:00:00'",
        },
    ),
    "delivery": Adapter(
        source="orders",
        key="o_orderkey",
        columns={
            "delivery_id": "'DL' || CAST(k AS STRING)",
            "order_id": "'O' || CAST(CASE WHEN k % 6 = 1 THEN k - 1 ELSE k END AS STRING)",
            "driver_id": "'D' || CAST(k % 200 AS STRING)",
            "restaurant_id": "'R' || CAST(k % 120 AS STRING)",
            "customer_id": "'C' || CAST(o_custkey AS STRING)",
            "pickup_time": "CASE WHEN k % 31 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:' || LPAD(CAST(k % 30 AS STRING), 2, '0') || ':50' END",
            "dropoff_time": "CASE WHEN k % 37 = 0 THEN 'n/a' WHEN k % 41 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 09:00:00' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:' || LPAD(CAST(30 + k % 29 AS STRING), 2, '0') || ':10' END",
            "estimated_time_min": "CAST(15 + k % 20 AS INT)",
            "actual_time_min": "CASE WHEN k % 43 = 0 THEN NULL ELSE CAST(k % 50 AS INT) END",
            "distance_km": "CAST(k % 800 AS DOUBLE) / 8",
            "pickup_lat": "CAST(30 + k % 10 AS DOUBLE)",
            "pickup_lng": "CAST(-100 + k % 10 AS DOUBLE)",
            "dropoff_lat": "CAST(30 + k % 11 AS DOUBLE)",
            "dropoff_lng": "CAST(-100 + k % 11 AS DOUBLE)",
            "status": "CASE WHEN k % 9 = 0 THEN 'failed' WHEN k % 9 = 1 THEN 'returned' WHEN k % 9 = 2 THEN 'in transit' WHEN k % 9 = 3 THEN 'partial' ELSE 'DELIVERED' END",
            "weather_condition": "CASE WHEN k % 7 = 0 THEN 'stormy' WHEN k % 7 = 1 THEN 'rainy' WHEN k % 7 = 2 THEN 'cloudy' WHEN k % 7 = 3 THEN NULL ELSE 'sunny' END",
            "traffic_level": "CASE WHEN k % 5 = 0 THEN 'severe' WHEN k % 5 = 1 THEN 'high' WHEN k % 5 = 2 THEN 'moderate' ELSE 'low' END",
            "delivery_attempt": "CAST(CASE WHEN k % 6 = 1 THEN 2 ELSE 1 END AS INT)",
            "proof_of_delivery": "CASE WHEN k % 4 = 0 THEN NULL ELSE 'photo' END",
            "driver_rating": "CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(2 + k % 9 AS DOUBLE) / 2 END",
            "tip_usd": "CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 1500 AS DOUBLE) / 100 END",
            "is_on_time": "(k % 2 = 0)",
            "late_reason": "CASE WHEN k % 3 = 0 THEN NULL ELSE 'traffic' END",
            "notes": "CASE WHEN k % 8 = 0 THEN 'gate code' END",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T12:00:00'",
        },
    ),
    "billing": Adapter(
        source="orders",
        key="o_orderkey",
        columns={
            "invoice_id": "'I' || CAST(k AS STRING)",
            "restaurant_id": "'R' || CAST(k % 120 AS STRING)",
            "invoice_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
            "due_date": "CASE WHEN k % 14 = 0 THEN '1994-06-01' WHEN k % 14 = 1 THEN '2002-01-01' ELSE '2001-08-20' END",
            "payment_date": "CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN '1993-01-01' WHEN k % 6 = 2 THEN 'bad' ELSE '2001-08-25' END",
            "base_fee_usd": "CAST(29 + 70 * (k % 4) AS DECIMAL(18,2))",
            "usage_orders": "CAST(k % 400 AS INT)",
            "overage_fee_usd": "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 50 AS DECIMAL(18,2)) END",
            "addon_fee_usd": "CAST(k % 20 AS DECIMAL(18,2))",
            "discount_usd": "CAST(CASE WHEN k % 29 = 0 THEN 5000 ELSE k % 10 END AS DECIMAL(18,2))",
            "tax_usd": "CAST(k % 9 AS DECIMAL(18,2))",
            "total_usd": "CAST(k % 600 AS DECIMAL(18,2))",
            "billing_period": "CASE WHEN k % 3 = 0 THEN 'yearly' ELSE 'monthly ' END",
            "plan_tier": "CASE WHEN k % 4 = 0 THEN 'starter' WHEN k % 4 = 1 THEN 'growth' WHEN k % 4 = 2 THEN 'pro' ELSE 'ENTERPRISE' END",
            "status": "CASE WHEN k % 7 = 0 THEN 'pending' WHEN k % 7 = 1 THEN 'partial' WHEN k % 7 = 2 THEN 'overdue' WHEN k % 7 = 3 THEN 'waived' WHEN k % 7 = 4 THEN 'disputed' ELSE 'paid' END",
            "payment_method": "CASE WHEN k % 2 = 0 THEN 'ach' ELSE 'credit card' END",
            "payment_gateway": "'stripe'",
            "currency": "'usd '",
            "transaction_ref": "' X' || CAST(k AS STRING)",
            "notes": "CASE WHEN k % 3 = 0 THEN '  ' WHEN k % 3 = 1 THEN NULL ELSE 'late fee' END",
            "created_by": "' system '",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T13:00:00'",
        },
    ),
    "customers": Adapter(
        source="customer",
        key="c_custkey",
        columns={
            "customer_id": "'C' || CAST(k AS STRING)",
            "user_id": "'U' || CAST(k AS STRING)",
            "first_name": "' ann' || CAST(k % 50 AS STRING)",
            "last_name": "CASE WHEN k % 61 = 0 THEN NULL ELSE 'LEE' END",
            "email": "' User' || CAST(k AS STRING) || '@Example.com'",
            "phone": "'(555) ' || LPAD(CAST(k % 1000 AS STRING), 3, '0') || '-0100'",
            "date_of_birth": "CASE WHEN k % 53 = 0 THEN 'unknown' ELSE CAST(1950 + k % 50 AS STRING) || '-12-15' END",
            "gender": "CASE WHEN k % 5 = 0 THEN 'M' WHEN k % 5 = 1 THEN 'female' WHEN k % 5 = 2 THEN 'F' WHEN k % 5 = 3 THEN 'male' ELSE NULL END",
            "city": "'austin'",
            "state": "' tx'",
            "zip_code": "CAST(501 + k % 90000 AS STRING)",
            "registration_date": "CASE WHEN k % 2 = 0 THEN '2000-05-05' ELSE '2001-08-20' END",
            "last_order_date": "CASE WHEN k % 4 = 0 THEN '2001-08-25' WHEN k % 4 = 1 THEN '2001-07-01' WHEN k % 4 = 2 THEN '2000-01-01' ELSE NULL END",
            "account_status": "CASE WHEN k % 9 = 0 THEN 'suspended' ELSE 'ACTIVE' END",
            "total_orders": "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k % 12 AS INT) END",
            "total_spent_usd": "CASE WHEN k % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END",
            "avg_order_value_usd": "CAST(k % 200 AS DOUBLE)",
            "loyalty_points": "CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k % 900 END AS INT)",
            "loyalty_tier": "CASE WHEN k % 6 = 0 THEN 'diamond' WHEN k % 6 = 1 THEN 'platinum' WHEN k % 6 = 2 THEN 'gold' WHEN k % 6 = 3 THEN 'silver' ELSE 'bronze' END",
            "preferred_payment": "'credit card'",
            "preferred_cuisine": "'thai'",
            "dietary_preference": "CASE WHEN k % 3 = 0 THEN 'NaN' WHEN k % 3 = 1 THEN NULL ELSE 'vegan' END",
            "is_premium": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'False' END",
            "marketing_opt_in": "CASE WHEN k % 3 = 0 THEN 'on' WHEN k % 3 = 1 THEN '1' ELSE 'maybe' END",
            "churn_risk": "CASE WHEN k % 4 = 0 THEN 'NaN' WHEN k % 4 = 1 THEN 'High' ELSE '0.25' END",
            "referral_count": "CASE WHEN k % 2 = 0 THEN NULL ELSE CAST(k % 5 AS INT) END",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T14:00:00'",
        },
    ),
    "users": Adapter(
        source="customer",
        key="c_custkey",
        columns={
            "user_id": "CASE WHEN k % 17 = 0 THEN NULL ELSE 'U' || CAST(k AS STRING) END",
            "first_name": "'ann'",
            "last_name": "'lee'",
            "email": "'User' || CAST(k AS STRING) || '@Example.com'",
            "phone": "'555-0100'",
            "city": "'austin'",
            "state": "'TX'",
            "zip_code": "'78701'",
            "country": "'us'",
            "registration_date": "'2000-05-05'",
            "last_login": "'2001-08-1' || CAST(k % 10 AS STRING) || ' 08:00:00'",
            "account_status": "'active'",
            "role": "CASE WHEN k % 20 = 0 THEN 'admin' ELSE 'user' END",
            "email_verified": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
            "preferred_lang": "'en'",
            "referral_code": "'REF' || CAST(k AS STRING)",
            "referred_by": "CASE WHEN k % 3 = 0 THEN 'U1' END",
            "notification_opt": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
            "loyalty_tier": "'Gold'",
            "total_spent_usd": "c_acctbal",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T15:00:00'",
        },
    ),
    "restaurants": Adapter(
        source="supplier",
        key="s_suppkey",
        columns={
            "restaurant_id": "'R' || CAST(k AS STRING)",
            "name": "' thai/palace ' || CAST(k AS STRING)",
            "cuisine_type": "CASE WHEN k % 3 = 0 THEN 'thai' WHEN k % 3 = 1 THEN 'MEXICAN' ELSE 'italian' END",
            "address": "' 1 Main St '",
            "city": "CASE WHEN k % 2 = 0 THEN 'austin' ELSE 'dallas' END",
            "state": "'tx'",
            "zip_code": "CAST(501 + k AS STRING)",
            "phone": "' 555-0101'",
            "email": "'INFO@Example.com'",
            "website": "'HTTP://Example.com'",
            "plan_tier": "CASE WHEN k % 4 = 0 THEN 'starter' WHEN k % 4 = 1 THEN 'growth' WHEN k % 4 = 2 THEN 'pro' ELSE 'enterprise' END",
            "monthly_fee_usd": "CAST(29 + 70 * (k % 4) AS DOUBLE)",
            "commission_pct": "CASE WHEN k % 10 = 9 THEN NULL ELSE CAST(12 + k % 18 AS DOUBLE) END",
            "signup_date": "CASE WHEN k % 3 = 0 THEN '1998-03-31' ELSE '2001-02-28' END",
            "is_active": "(k % 5 <> 0)",
            "is_featured": "(k % 4 = 0)",
            "avg_rating": "CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(4 + k % 7 AS DOUBLE) / 2 END",
            "total_reviews": "CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 40 AS INT) END",
            "total_orders": "CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(2500 * (k % 8) AS INT) END",
            "avg_prep_time_min": "CAST(20 + k % 50 AS DOUBLE) / 2",
            "open_time": "CASE WHEN k % 9 = 0 THEN 'bad' ELSE '09:00' END",
            "close_time": "CASE WHEN k % 4 = 0 THEN '00:00' WHEN k % 4 = 1 THEN '01:00' WHEN k % 4 = 2 THEN '02:00' ELSE '22:00' END",
            "delivery_radius_km": "CAST(k % 15 AS DOUBLE)",
            "min_order_usd": "CAST(10 + k % 10 AS DOUBLE)",
            "accepts_cash": "(k % 2 = 0)",
            "halal_certified": "(k % 3 = 0)",
            "vegan_options": "(k % 5 = 0)",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T16:00:00'",
        },
    ),
    "drivers": Adapter(
        source="part",
        key="p_partkey",
        columns={
            "driver_id": "' D' || CAST(k AS STRING)",
            "first_name": "'bo'",
            "last_name": "CASE WHEN k % 61 = 0 THEN NULL ELSE 'diaz' END",
            "email": "'Driver' || CAST(k AS STRING) || '@Example.com'",
            "phone": "' 555-0102 '",
            "city": "'austin'",
            "state": "'tx'",
            "zone": "CASE WHEN k % 2 = 0 THEN 'north-east' ELSE 'SOUTH' END",
            "vehicle_type": "CASE WHEN k % 6 = 0 THEN 'Van' WHEN k % 6 = 1 THEN 'Car' WHEN k % 6 = 2 THEN 'Scooter' WHEN k % 6 = 3 THEN 'Bicycle' WHEN k % 6 = 4 THEN 'motorcycle' ELSE NULL END",
            "vehicle_plate": "CASE WHEN k % 25 = 0 THEN NULL ELSE 'pl' || CAST(k % 900 AS STRING) END",
            "license_number": "'lic' || CAST(CASE WHEN k % 40 = 1 THEN k - 1 ELSE k END AS STRING)",
            "hire_date": "CASE WHEN k % 3 = 0 THEN '1997-01-31' WHEN k % 3 = 1 THEN '2000-09-30' ELSE '2001-06-30' END",
            "is_active": "(k % 4 <> 0)",
            "status": "CASE WHEN k % 3 = 0 THEN 'available' WHEN k % 3 = 1 THEN 'on delivery' ELSE 'offline' END",
            "background_check": "CASE WHEN k % 7 = 0 THEN 'Failed' ELSE 'passed' END",
            "total_deliveries": "CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 10 * 100 AS INT) END",
            "avg_rating": "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(4 + k % 7 AS DOUBLE) / 2 END",
            "on_time_rate_pct": "CAST(40 + k % 60 AS DOUBLE)",
            "acceptance_rate_pct": "CAST(50 + k % 50 AS DOUBLE)",
            "hourly_rate_usd": "CAST(15 + k % 10 AS DOUBLE)",
            "total_earnings_usd": "p_retailprice",
            "total_tips_usd": "CAST(k % 300 AS DOUBLE)",
            "max_distance_km": "CAST(p_size AS DOUBLE)",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T17:00:00'",
        },
    ),
    "promotions": Adapter(
        source="part",
        key="p_partkey",
        columns={
            "promo_id": "'PR' || CAST(k AS STRING)",
            "campaign_id": "'CA' || CAST(k % 30 AS STRING)",
            "created_by": "' mkt '",
            "restaurant_id": "CASE WHEN k % 4 = 0 THEN NULL ELSE 'R' || CAST(k % 120 AS STRING) END",
            "promo_code": "' save' || CAST(k % 20 AS STRING)",
            "promo_name": "'summer deal'",
            "promo_type": "'discount'",
            "target_segment": "'new users'",
            "applies_to": "'first order'",
            "channel": "'email'",
            "is_stackable": "(k % 2 = 0)",
            "discount_value": "CAST(5 + k % 20 AS DOUBLE) / 2",
            "discount_unit": "CASE WHEN k % 3 = 0 THEN 'Percent' WHEN k % 3 = 1 THEN 'Fixed USD ' ELSE 'BOGO' END",
            "min_order_usd": "CAST(10 + k % 15 AS DOUBLE)",
            "max_discount_usd": "CASE WHEN k % 12 = 0 THEN NULL ELSE CAST(k % 40 AS DOUBLE) END",
            "start_date": "CASE WHEN k % 5 = 0 THEN '2001-08-01' ELSE '2000-01-01' END",
            "end_date": "CASE WHEN k % 5 = 0 THEN '2001-10-01' WHEN k % 5 = 1 THEN 'open' ELSE '2000-12-31' END",
            "usage_limit": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 0 ELSE CAST(100 AS INT) END",
            "times_used": "CAST(k % 150 AS INT)",
            "revenue_impact_usd": "-p_retailprice",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T18:00:00'",
        },
    ),
    "reviews": Adapter(
        source="orders",
        key="o_orderkey",
        columns={
            "review_id": "'RV' || CAST(k AS STRING)",
            "order_id": "'O' || CAST(k AS STRING)",
            "customer_id": "'C' || CAST(o_custkey AS STRING)",
            "restaurant_id": "'R' || CAST(k % 120 AS STRING)",
            "driver_id": "CASE WHEN k % 9 = 0 THEN NULL ELSE 'D' || CAST(k % 200 AS STRING) END",
            "overall_rating": "CASE WHEN k % 13 = 0 THEN 'n/a' ELSE CAST(1 + k % 5 AS STRING) END",
            "food_rating": "CAST(1 + k % 5 AS STRING)",
            "delivery_rating": "CAST(1 + k % 4 AS STRING)",
            "driver_rating": "CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(1 + k % 3 AS STRING) END",
            "packaging_rating": "CAST(1 + k % 5 AS STRING)",
            "value_rating": "CAST(1 + k % 2 AS STRING)",
            "review_text": "' good food '",
            "review_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
            "sentiment": "CASE WHEN k % 3 = 0 THEN 'negative' WHEN k % 3 = 1 THEN 'POSITIVE' ELSE 'neutral' END",
            "is_verified": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
            "helpful_votes": "CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 30 AS INT) END",
            "report_count": "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 3 AS INT) END",
            "restaurant_response": "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '  ' ELSE ' thanks ' END",
            "is_featured": "CASE WHEN k % 7 = 0 THEN 'true' ELSE 'false' END",
            "platform": "CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END",
            "images_attached": "CASE WHEN k % 6 = 0 THEN 'true' ELSE 'false' END",
            "event_time": "'2001-08-0' || CAST(1 + d AS STRING) || 'T19:00:00'",
        },
    ),
}


def bronze_cte(table: str) -> str:
    """The bronze table as a SQL subquery over the source table (DuckDB side)."""
    a = ADAPTERS[table]
    cols = ", ".join(f"{expr} AS {name}" for name, expr in a.columns.items())
    return (
        f"SELECT {cols} FROM ("
        f"SELECT *, {a.key} AS k, 0 AS d FROM {a.source} UNION ALL "
        f"SELECT *, {a.key} AS k, 1 AS d FROM {a.source} WHERE {a.key} % 10 = 3)"
    )
