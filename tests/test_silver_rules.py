"""Repair rules one by one, each with its ordinary, its edge and its NULL case."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from courierlake.plans.silver import SILVER
from courierlake.plans.silver.payments import clean_payments
from courierlake.sources.schemas import PRIMARY_KEYS

AS_OF = date(2001, 9, 1)
T1, T2 = "2001-08-01T10:00:00", "2001-08-02T10:00:00"


@pytest.fixture
def clean(rows):
    """``clean(topic, {...}, ...)``: silver rows by key; key and event_time default."""

    def run(topic, *given):
        key = PRIMARY_KEYS[topic]
        full = [{key: f"x{i}", "event_time": T1} | g for i, g in enumerate(given)]
        return {r[key]: r for r in SILVER[topic](rows(topic, *full), AS_OF).collect()}

    return run


def column(result, name):
    return [result[k][name] for k in sorted(result)]


# --- orders --------------------------------------------------------------------------

MONEY = {"subtotal_usd": 10.0, "tax_usd": 1.0, "delivery_fee_usd": 2.0, "discount_usd": 0.0}


def test_orders_drop_keyless_rows_and_trim(clean):
    r = clean("orders", {"order_id": None}, {"order_id": " a ", "status": " out for delivery", "promo_code": " s1 ", "discount_usd": 1.0})
    assert list(r) == ["a"]
    assert (r["a"].status, r["a"].promo_code) == ("Out For Delivery", "S1")


def test_orders_pickup_has_no_driver_and_no_fee(clean):
    base = MONEY | {"driver_id": "d"}
    r = clean("orders", base | {"order_type": "pickup"}, base | {"order_type": "delivery"}, base)
    assert column(r, "driver_id") == [None, "d", "d"]
    assert column(r, "delivery_fee_usd") == [0, 2, 2]
    assert column(r, "total_usd") == [11, 13, 13]


def test_orders_amounts_lose_their_sign_and_null_parts_void_the_total(clean):
    r = clean("orders", MONEY | {"subtotal_usd": -10.0}, MONEY | {"tax_usd": None}, MONEY | {"discount_usd": 50.0})
    assert column(r, "total_usd") == [13, None, -37]
    assert column(r, "tip_usd") == [0, 0, 0]


def test_orders_promo_rules(clean):
    r = clean(
        "orders",
        {"promo_code": "a", "discount_usd": 0.0},
        {"promo_code": None, "discount_usd": 2.0},
        {"promo_code": "a", "discount_usd": 2.0},
        {"promo_code": "a", "discount_usd": None},
        {"promo_code": None, "discount_usd": 0.0},
    )
    assert column(r, "promo_code") == [None, "UNKNOWN", "A", "A", None]


def test_orders_refund_rules(clean):
    base = MONEY
    r = clean(
        "orders",
        base | {"status": "cancelled", "refund_amount_usd": None},
        base | {"status": "delivered", "refund_amount_usd": 0.0},
        base | {"status": "delivered", "refund_amount_usd": 99.0},
        base | {"status": "refunded", "refund_amount_usd": -5.0},
        {"status": "failed", "refund_amount_usd": 7.0},
        base | {"status": None, "refund_amount_usd": 0.0},
    )
    assert column(r, "refund_amount_usd") == [13, 0, 13, 5, 7, 0]


def test_orders_times_ratings_and_reasons(clean):
    r = clean(
        "orders",
        {"status": "cancelled", "customer_rating": 4.0, "cancellation_reason": None, "prep_time_min": 9, "actual_delivery_min": 8},
        {"status": "delivered", "customer_rating": 4.0, "cancellation_reason": "x", "prep_time_min": 8, "actual_delivery_min": 8},
        {"status": None, "customer_rating": 4.0, "cancellation_reason": "x", "prep_time_min": None, "actual_delivery_min": 8},
        {"status": "out for delivery", "customer_rating": 3.5},
        {"status": "cancelled", "cancellation_reason": "late"},
    )
    assert column(r, "actual_delivery_min") == [None, 8, 8, None, None]
    assert column(r, "customer_rating") == [None, 4, 4, D("3.5"), None]
    assert column(r, "cancellation_reason") == ["Unknown", None, "x", None, "late"]


def test_orders_keep_latest_with_null_time_first(clean):
    r = clean(
        "orders",
        {"order_id": "a", "status": "old"},
        {"order_id": " a", "status": "new", "event_time": T2},
        {"order_id": "b", "status": "dated", "event_time": T2},
        {"order_id": "b", "status": "undated", "event_time": None},
    )
    assert {k: v.status for k, v in r.items()} == {"a": "New", "b": "Undated"}


def test_orders_order_at(clean):
    r = clean(
        "orders",
        {"order_date": "2001-02-03", "order_time": "04:05:06"},
        {"order_date": "bad", "order_time": "04:05:06"},
        {"order_date": "2001-02-03", "order_time": None},
    )
    assert column(r, "order_at") == [datetime(2001, 2, 3, 4, 5, 6), None, None]


# --- payments ------------------------------------------------------------------------


def pay(n, **kw):
    return {"transaction_id": f"t{n}", "amount_usd": 100.0, "status": "success", "is_refunded": False} | kw


def test_payments_uncollected_money_is_not_refunded(clean):
    refund = {"is_refunded": True, "refund_amount_usd": 5.0, "refund_date": "2001-05-05"}
    r = clean("payments", pay(0, status="failed") | refund, pay(1, status="pending") | refund, pay(2) | refund, pay(3, status=None) | refund)
    assert column(r, "is_refunded") == [False, False, True, True]
    assert column(r, "refund_amount_usd") == [0, 0, 5, 5]
    assert column(r, "refund_date") == [None, None, date(2001, 5, 5), date(2001, 5, 5)]


def test_payments_refund_amount_and_flag(clean):
    r = clean(
        "payments",
        pay(0, refund_amount_usd=500.0),
        pay(1, is_refunded=True, refund_amount_usd=0.0),
        pay(2, is_refunded=False, refund_amount_usd=3.0),
        pay(3, refund_amount_usd=-3.0),
        pay(4, is_refunded=None, refund_amount_usd=None),
        pay(5, amount_usd=None, refund_amount_usd=4.0),
    )
    assert column(r, "refund_amount_usd") == [100, 100, 3, -3, 0, 4]
    assert column(r, "is_refunded") == [True, True, True, False, False, True]


def test_payments_refund_before_payment_has_no_date(clean):
    r = clean(
        "payments",
        pay(0, payment_date="2001-05-05", refund_date="2001-05-04"),
        pay(1, payment_date="2001-05-05", refund_date="2001-05-05"),
        pay(2, payment_date=None, refund_date="2001-05-04"),
    )
    assert column(r, "refund_date") == [None, date(2001, 5, 5), date(2001, 5, 4)]


def test_payments_fee_and_net(clean):
    r = clean(
        "payments",
        pay(0, gateway_fee_usd=3.0),
        pay(1, gateway_fee_usd=300.0),
        pay(2, gateway_fee_usd=None),
        pay(3, gateway_fee_usd=3.0, amount_usd=None),
        pay(4, gateway_fee_usd=3.0, amount_usd=-100.0),
    )
    assert column(r, "fee_amount_usd") == [3, 100, 0, None, 3]
    assert column(r, "net_amount_usd") == [97, 0, 100, None, 97]


def test_payments_wallets_and_fraud(clean):
    r = clean(
        "payments",
        pay(0, payment_method="apple pay", card_type="visa", fraud_score=0.8),
        pay(1, payment_method="credit card", card_type="visa", fraud_score=0.5),
        pay(2, payment_method=None, card_type="visa", fraud_score=None),
    )
    assert column(r, "card_type") == [None, "Visa", "Visa"]
    assert column(r, "fraud_risk_level") == ["High", "Medium", "Low"]
    assert column(r, "is_flagged") == [True, False, False]


def test_payments_one_per_transaction_then_one_per_payment(rows):
    given = [
        {"payment_id": "a", "transaction_id": "t", "payment_date": "2001-01-02", "event_time": T1},
        {"payment_id": "b", "transaction_id": "t", "payment_date": "2001-01-01", "event_time": T2},
        {"payment_id": "c", "transaction_id": "u", "payment_date": None, "event_time": T1, "gateway": "old"},
        {"payment_id": "c", "transaction_id": "u", "payment_date": None, "event_time": T2, "gateway": "new"},
        {"payment_id": "d", "transaction_id": None, "event_time": T1},
        {"payment_id": "e", "transaction_id": None, "event_time": T1},
    ]
    df = rows("payments", *given)
    r = {x.payment_id: x for x in clean_payments(df, AS_OF).collect()}
    assert sorted(r) == ["b", "c", "d"]
    assert r["c"].payment_gateway == "Old"  # a re-extracted payment keeps its oldest copy
    kept = {x.payment_id for x in clean_payments(df, AS_OF, null_txn="keep").collect()}
    assert kept == {"b", "c", "d", "e"}


# --- delivery ------------------------------------------------------------------------


def test_delivery_duration_and_flags(clean):
    r = clean(
        "delivery",
        {"pickup_time": "2001-01-01 10:00:50", "dropoff_time": "2001-01-01 10:01:10", "actual_time_min": 9, "estimated_time_min": 1, "distance_km": 1.0},
        {"pickup_time": "2001-01-01 10:00:00", "dropoff_time": "2001-01-01 09:00:00", "actual_time_min": 9, "estimated_time_min": 5, "distance_km": 100.0},
        {"pickup_time": None, "dropoff_time": "n/a", "actual_time_min": 0, "estimated_time_min": 5, "distance_km": 1.0},
        {"actual_time_min": None, "estimated_time_min": 5, "late_reason": "rain"},
    )
    assert column(r, "actual_time_min") == [1, 9, 0, None]
    assert column(r, "is_on_time") == [True, False, True, None]
    assert column(r, "is_late") == [False, True, False, None]
    assert column(r, "delay_min") == [0, 4, -5, None]
    assert column(r, "late_reason") == [None, "Unknown", None, "rain"]
    assert column(r, "avg_speed_kmh") == [60.0, None, None, None]


def test_delivery_speed_uses_hours_of_six_decimals(clean):
    r = clean("delivery", {"actual_time_min": 1, "estimated_time_min": 1, "distance_km": 1.9999})
    assert r["x0"].avg_speed_kmh == round(1.9999 / 0.016667, 2)


def test_delivery_status_rules(clean):
    r = clean(
        "delivery",
        {"status": "failed", "driver_rating": 4.0, "tip_usd": 3.0, "proof_of_delivery": "photo"},
        {"status": "delivered", "driver_rating": 2.5, "tip_usd": 5.5, "proof_of_delivery": None},
        {"status": "in transit", "driver_rating": 3.0, "tip_usd": None},
        {"status": None, "driver_rating": 2.0, "tip_usd": 11.0, "proof_of_delivery": "photo"},
    )
    assert column(r, "driver_rating") == [None, D("2.5"), 3, 2]
    assert column(r, "driver_rating_bucket") == ["No Rating", "No Rating", "Neutral", "Bad"]
    assert column(r, "tip_usd") == [0, D("5.5"), 0, 11]
    assert column(r, "tip_bucket") == ["No Tip", "Medium", "No Tip", "High"]
    assert column(r, "proof_of_delivery") == [None, "Not Captured", None, "photo"]
    assert column(r, "is_failed") == [True, False, False, None]
    assert column(r, "is_in_progress") == [False, False, True, None]


def test_delivery_severity(clean):
    r = clean(
        "delivery",
        {"weather_condition": "snowy"},
        {"weather_condition": "sunny", "traffic_level": "severe"},
        {"weather_condition": "windy", "traffic_level": "low"},
        {"weather_condition": None, "traffic_level": "moderate"},
        {"weather_condition": "sunny", "traffic_level": None},
    )
    assert column(r, "condition_severity") == ["Severe", "Severe", "High", "Moderate", "Normal"]


def test_delivery_attempts_count_before_dedup(clean):
    r = clean(
        "delivery",
        {"delivery_id": "a", "order_id": "1", "delivery_attempt": 1},
        {"delivery_id": "a", "order_id": "1", "delivery_attempt": 1, "event_time": T2},
        {"delivery_id": "b", "order_id": "2", "delivery_attempt": 1},
        {"delivery_id": "c", "order_id": None, "delivery_attempt": 3},
        {"delivery_id": "d", "order_id": None, "delivery_attempt": 2},
    )
    assert column(r, "is_redelivery") == [True, False, True, True]
    assert column(r, "total_attempts_for_order") == [1, 1, 3, 3]
    assert column(r, "is_first_attempt") == [True, True, False, False]


# --- billing -------------------------------------------------------------------------


def test_billing_dates_and_total(clean):
    r = clean(
        "billing",
        {"invoice_date": "2001-05-10", "due_date": "2001-05-01", "base_fee_usd": D(10), "discount_usd": D(50)},
        {"invoice_date": "2001-05-10", "due_date": None, "base_fee_usd": D(10), "tax_usd": D(2), "total_usd": D(20)},
    )
    assert column(r, "invoice_date") == [date(2001, 5, 1), date(2001, 5, 10)]
    assert column(r, "due_date") == [date(2001, 5, 10), None]
    assert column(r, "days_to_due") == [9, None]
    assert column(r, "total_usd") == [0, 12]
    assert column(r, "total_usd_variance") == [None, 8]
    assert column(r, "notes") == ["None", "None"]


@pytest.mark.parametrize(
    "status,paid,due,want_status,want_paid,overdue",
    [
        ("pending", "2001-05-11", "2001-06-01", "Paid", date(2001, 5, 11), False),
        ("paid", None, "2001-06-01", "Paid - Date Unknown", date(2001, 5, 10), False),
        ("paid", "2001-05-01", "2001-06-01", "Paid", None, False),
        ("partial", None, "2001-06-01", "Overdue", None, True),
        ("partial", "1999-01-01", "2001-06-01", "Overdue", None, True),
        ("pending", None, "2001-09-01", "Pending", None, False),
        ("overdue", None, "2002-06-01", "Overdue", None, False),
        ("waived", "2001-05-11", "2001-06-01", "Waived", date(2001, 5, 11), False),
        ("disputed", None, "2001-06-01", "Disputed", None, False),
        ("other", None, "2001-06-01", "Other", None, True),
        (None, None, "2001-06-01", None, None, False),
        ("pending", None, None, "Pending", None, False),
    ],
)
def test_billing_status(clean, status, paid, due, want_status, want_paid, overdue):
    given = {"invoice_date": "2001-05-10", "status": status, "payment_date": paid, "due_date": due}
    r = clean("billing", given)["x0"]
    assert (r.status, r.payment_date, r.is_overdue) == (want_status, want_paid, overdue)


# --- customers -----------------------------------------------------------------------


def test_customers_profile(clean):
    r = clean(
        "customers",
        {"first_name": " ann", "last_name": "LEE", "phone": "(555) 1-2", "zip_code": "501", "gender": "M", "date_of_birth": "2000-12-31", "dietary_preference": "NaN", "churn_risk": "High", "marketing_opt_in": "on"},
        {"first_name": "bo", "last_name": None, "zip_code": "1234567", "gender": None, "date_of_birth": "bad", "churn_risk": " 0.25 ", "is_premium": "False"},
    )
    a, b = r["x0"], r["x1"]
    assert (a.first_name, a.full_name, a.phone_digits, a.zip_code) == ("Ann", " ann LEE", "55512", "00501")
    assert (a.gender, a.age_years, a.dietary_preference, a.churn_risk) == ("Male", 1, "None Specified", None)
    assert (b.full_name, b.zip_code, b.gender, b.age_years) == (None, "12345", "Other", None)
    assert (b.churn_risk, b.is_premium, a.has_marketing_opt_in) == (0.25, False, True)


def test_customers_average_and_flags(clean):
    r = clean(
        "customers",
        {"total_orders": 4, "total_spent_usd": 10.0, "avg_order_value_usd": 2.5, "loyalty_points": 5},
        {"total_orders": 4, "total_spent_usd": 10.0, "avg_order_value_usd": 3.0, "loyalty_points": 5},
        {"total_orders": None, "total_spent_usd": 200.0, "avg_order_value_usd": 3.0, "loyalty_points": None},
        {"total_orders": 1, "total_spent_usd": 0.5, "avg_order_value_usd": 0.5, "registration_date": "2001-08-01", "loyalty_points": 1},
        {"total_orders": 1, "total_spent_usd": 0.5, "avg_order_value_usd": 0.5, "registration_date": "2001-08-02", "loyalty_points": 1},
    )
    assert column(r, "avg_order_value_usd") == [D("2.5"), D("2.5"), 3, D("0.5"), D("0.5")]
    assert column(r, "dq_avg_val_mismatch") == [False, True, False, False, False]
    assert column(r, "dq_low_spend_anomaly") == [False, False, False, True, False]
    assert column(r, "dq_loyalty_mismatch") == [False, False, True, False, False]


# --- users, restaurants, drivers -----------------------------------------------------


def test_users_fail_on_bad_data(clean):
    assert clean("users", {"email": "A@B.c", "country": "us", "registration_date": "2001-01-01"})["x0"].email == "a@b.c"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean("users", {"registration_date": "bad"})


def test_restaurants_buckets_and_hours(clean):
    r = clean(
        "restaurants",
        {"commission_pct": 25.0, "total_orders": 15000, "avg_rating": 4.5, "open_time": "09:00", "close_time": "00:00", "is_active": False, "is_featured": True, "total_reviews": 5, "avg_prep_time_min": 12.5},
        {"commission_pct": 18.0, "total_orders": 8000, "avg_rating": 3.5, "open_time": "09:00", "close_time": "02:00", "is_active": True, "is_featured": True},
        {"commission_pct": None, "total_orders": None, "avg_rating": None, "open_time": "bad", "close_time": "22:00", "signup_date": "2001-08-31"},
    )
    assert column(r, "commission_bucket") == ["High (25%+)", "Medium (18-25%)", "Low (<18%)"]
    assert column(r, "volume_bucket") == ["High Volume", "Medium Volume", "Low Volume"]
    assert column(r, "rating_bucket") == ["Excellent", "Average", "Poor"]
    assert column(r, "operating_hours_per_day") == [15, -7, None]
    assert column(r, "restaurant_status") == ["Inactive", "Featured", "Active"]
    assert column(r, "dq_inactive_but_featured") == [True, False, None]
    assert column(r, "dq_low_reviews_high_orders") == [True, False, None]
    assert column(r, "estimated_commissions_earned") == [3750.0, 1440.0, None]
    assert column(r, "months_on_platform") == [None, None, 1]
    assert r["x0"].avg_prep_time_min == 13


def test_drivers_buckets_see_source_values(clean):
    r = clean(
        "drivers",
        {"vehicle_type": "Van", "hire_date": "1998-09-30", "is_active": False, "status": "available", "avg_rating": 4.0, "on_time_rate_pct": 80.0, "total_earnings_usd": 10.0, "total_deliveries": 4},
        {"vehicle_type": "motorcycle", "hire_date": "2000-09-30", "is_active": True, "status": "available", "background_check": "Failed", "avg_rating": 2.9, "total_deliveries": 0},
        {"vehicle_type": None, "hire_date": "bad", "is_active": False, "status": "offline", "avg_rating": None, "on_time_rate_pct": None, "total_deliveries": None},
    )
    assert column(r, "vehicle_capacity") == ["High Capacity", "Unknown", "Unknown"]
    assert column(r, "vehicle_type") == ["Van", "Motorcycle", None]
    assert column(r, "tenure_bucket") == ["Veteran", "Experienced", "New"]
    assert column(r, "status_clean") == ["Inactive", "Available", "Offline"]
    assert column(r, "performance_tier") == ["Top Performer", "At Risk", "Average Performer"]
    assert column(r, "rating_bucket") == ["Good", "Poor", "Poor"]
    assert column(r, "avg_earning_per_delivery_usd") == [2.5, None, None]
    assert column(r, "dq_active_failed_background") == [False, True, False]


def test_drivers_duplicates_include_copies_and_null(clean):
    r = clean(
        "drivers",
        {"driver_id": "a", "license_number": "L1", "vehicle_plate": None},
        {"driver_id": "b", "license_number": "L1", "vehicle_plate": None},
        {"driver_id": "c", "license_number": "L2", "vehicle_plate": "P"},
        {"driver_id": "d", "license_number": "l2", "vehicle_plate": "Q"},
        {"driver_id": "d", "license_number": "l2", "vehicle_plate": "Q", "event_time": T2},
    )
    assert column(r, "dq_duplicate_license") == [True, True, False, True]
    assert column(r, "dq_duplicate_plate") == [True, True, False, True]


# --- promotions, reviews -------------------------------------------------------------


def test_promotions_terms(clean):
    r = clean(
        "promotions",
        {"discount_unit": "Percent", "discount_value": 10.0, "min_order_usd": 20.0, "max_discount_usd": 5.0, "restaurant_id": None},
        {"discount_unit": "Fixed USD ", "discount_value": 2.5, "min_order_usd": 20.0, "max_discount_usd": 30.0, "restaurant_id": " R1"},
        {"discount_unit": "BOGO", "discount_value": 1.0, "min_order_usd": 20.0, "max_discount_usd": None},
    )
    assert column(r, "discount_unit_clean") == ["Percentage", "Fixed", "BOGO"]
    assert column(r, "discount_label") == ["10%", "$2.5", None]
    assert column(r, "max_discount_usd") == [20.0, 30.0, None]
    assert column(r, "restaurant_scope") == ["Platform-Wide", " R1", "Platform-Wide"]
    assert column(r, "dq_max_discount_lt_min_order") == [True, False, None]


def test_promotions_usage(clean):
    r = clean(
        "promotions",
        {"times_used": 150, "usage_limit": 100, "revenue_impact_usd": -50.0},
        {"times_used": 80, "usage_limit": 100, "revenue_impact_usd": -50.0},
        {"times_used": 50, "usage_limit": 100},
        {"times_used": 10, "usage_limit": None, "revenue_impact_usd": -50.0},
        {"times_used": 10, "usage_limit": 0, "revenue_impact_usd": -50.0},
    )
    assert column(r, "times_used") == [100, 80, 50, None, 0]
    assert column(r, "times_used_original") == [150, 80, 50, 10, 10]
    assert column(r, "usage_rate_pct") == [100, 80, 50, None, None]
    assert column(r, "usage_bucket") == ["Exhausted", "Nearly Exhausted", "Mid Usage", "Low Usage", "Exhausted"]
    assert column(r, "usage_limit") == [100, 100, 100, 0, 0]
    assert column(r, "avg_cost_per_use_usd") == [0.5, 0.63, None, None, None]
    assert column(r, "dq_over_usage_limit") == [True, False, False, None, True]


@pytest.mark.parametrize(
    "start,end,live,days",
    [("2001-08-01", "2001-09-01", True, 31), ("2001-09-02", "2001-10-01", False, 29), ("2001-08-01", "open", False, None)],
)
def test_promotions_live(clean, start, end, live, days):
    r = clean("promotions", {"start_date": start, "end_date": end})["x0"]
    assert (r.is_currently_live, r.duration_days) == (live, days)


def test_reviews(clean):
    r = clean(
        "reviews",
        {"overall_rating": "5", "sentiment": "negative", "restaurant_response": " thanks ", "is_verified": "true"},
        {"overall_rating": "2", "sentiment": "negative", "restaurant_response": "  ", "helpful_votes": 3},
        {"overall_rating": "n/a", "sentiment": "positive", "restaurant_response": None},
    )
    assert column(r, "rating_overall") == [5, 2, None]
    assert column(r, "restaurant_response_text") == ["thanks", "", "No Response"]
    assert column(r, "has_restaurant_responded") == [True, False, False]
    assert column(r, "is_positive_review") == [True, False, None]
    assert column(r, "is_negative_review") == [False, True, None]
    assert column(r, "is_conflicting_sentiment") == [True, False, False]
    assert column(r, "helpful_votes_count") == [0, 3, 0]


# --- all tables ----------------------------------------------------------------------


@pytest.mark.parametrize("topic", sorted(set(SILVER) - {"delivery", "drivers"}))
def test_copies_change_nothing(spark, sf, topic):
    """Doubling the input gives the same table (flags that count copies are elsewhere)."""
    from checks.bronze import bronze

    df = bronze(spark, sf, topic)
    once, twice = SILVER[topic](df, AS_OF), SILVER[topic](df.unionByName(df), AS_OF)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    key = PRIMARY_KEYS[topic]
    assert once.groupBy(F.col(key)).count().filter("count > 1").count() == 0
