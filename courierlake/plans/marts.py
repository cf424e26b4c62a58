"""Revenue and subscription marts over the gold star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions import count_if_true, percent, safe_ratio, sum_if
from courierlake.operators.sequences import lag_days, lag_rows
from courierlake.operators.skew import lookup_join
from courierlake.plans.values import CANCELLED, COLLECTED

REVENUE_GRAIN = [
    "order_date",
    "order_week",
    "order_month",
    "customer_value_segment",
    "customer_lifecycle",
    "customer_city",
    "customer_state",
    "restaurant_name",
    "cuisine_type",
    "merchant_tier",
    "restaurant_city",
    "latest_payment_method",
]
GROWTH_GROUP = ["customer_value_segment", "cuisine_type", "merchant_tier"]

SUBSCRIPTION_GRAIN = [
    "invoice_date",
    "invoice_week",
    "invoice_month",
    "restaurant_name",
    "cuisine_type",
    "restaurant_city",
    "plan_tier",
    "billing_period",
]


def payments_summary(fct_payments: DataFrame, key: str = "order_sk") -> DataFrame:
    """One row per order ``key``: did any payment succeed, and how was the latest one made.

    The latest payment is an aggregate over (date, transaction) instead of a ranking, so
    the payments of an order are combined before the shuffle. A payment without a date
    comes last; equal dates go to the smallest transaction id, then to NULL.
    """
    return fct_payments.groupBy(key).agg(
        F.max(F.when(F.col("payment_status") == "Success", 1).otherwise(0)).alias(
            "has_success_payment"
        ),
        F.min_by(
            F.struct("payment_method", "payment_gateway"),
            F.struct(
                F.col("payment_date").isNull(),
                -F.unix_date("payment_date"),
                F.col("transaction_id").isNull(),
                F.col("transaction_id"),
            ),
        ).alias("latest"),
        F.sum("refund_amount").alias("total_gateway_refund_usd"),
    ).select(
        key,
        "has_success_payment",
        F.col("latest.payment_method").alias("latest_payment_method"),
        F.col("latest.payment_gateway").alias("latest_payment_gateway"),
        "total_gateway_refund_usd",
    )


def star_orders(
    fct_orders: DataFrame,
    fct_payments: DataFrame,
    dim_customers: DataFrame,
    dim_restaurants: DataFrame,
    key: str = "order_sk",
) -> DataFrame:
    """Orders with the payment, customer and restaurant attributes the mart groups by.

    ``key`` joins payments to orders. With facts that keep the natural id it should be "order_id":
    two of very many orders may share a 63-bit hash, and orders are already dealt out by their id.
    """
    customers = dim_customers.select(
        "customer_sk",
        F.col("value_segment").alias("customer_value_segment"),
        "customer_lifecycle",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )
    restaurants = dim_restaurants.select(
        "restaurant_sk",
        "restaurant_name",
        "cuisine_type",
        F.col("plan_tier").alias("merchant_tier"),
        F.col("city").alias("restaurant_city"),
        "commission_pct",
    )
    orders = fct_orders.select(
        *dict.fromkeys([key, "order_sk"]),
        "customer_sk",
        "restaurant_sk",
        "order_date",
        "order_status",
        "subtotal_amount",
        "delivery_fee_amount",
        "discount_amount",
        "tip_amount",
        "total_paid_amount",
        "refund_amount",
    )
    # Both sides of the payment join hold one row per order.
    joined = orders.join(payments_summary(fct_payments, key), key, "left")
    joined = lookup_join(joined, customers, "customer_sk")
    joined = lookup_join(joined, restaurants, "restaurant_sk")
    status = F.col("order_status")
    return joined.select(
        "*",
        F.trunc("order_date", "week").alias("order_week"),
        F.trunc("order_date", "month").alias("order_month"),
        (F.col("subtotal_amount") * F.coalesce("commission_pct", F.lit(0)) / 100).alias(
            "commission"
        ),
        (status == "Delivered").alias("is_realized"),
        status.isin(*CANCELLED).alias("is_cancelled"),
        (status == "Failed").alias("is_failed"),
        (F.col("has_success_payment") == 1).alias("is_fully_paid"),
    )


def daily_revenue(star: DataFrame, grain: list[str] | None = None) -> DataFrame:
    """All order measures at a grain; the mart's own twelve columns by default.

    Rates come from the summed columns, so every sum is computed once.
    """
    realized = F.col("is_realized")
    booked, refund, fee = F.col("total_paid_amount"), F.col("refund_amount"), F.col("delivery_fee_amount")
    commission = F.col("commission")
    sums = star.groupBy(*(REVENUE_GRAIN if grain is None else grain)).agg(
        F.count("order_sk").alias("total_bookings_count"),
        count_if_true(realized).alias("successful_orders_count"),
        count_if_true(F.col("is_cancelled")).alias("cancelled_orders_count"),
        count_if_true(F.col("is_failed")).alias("failed_orders_count"),
        count_if_true(F.col("is_fully_paid")).alias("paid_orders_count"),
        F.sum(booked).alias("gross_bookings_usd"),
        sum_if(realized, booked).alias("gross_revenue_usd"),
        sum_if(realized, booked - refund).alias("net_revenue_usd"),
        sum_if(realized, refund).alias("total_refunds_usd"),
        sum_if(realized, commission).alias("platform_commission_usd"),
        sum_if(realized, fee).alias("platform_delivery_fees_usd"),
        sum_if(realized, commission + fee - refund).alias("net_income_usd"),
        F.sum("discount_amount").alias("total_marketing_discounts_usd"),
        sum_if(realized, "tip_amount").alias("total_tips_pass_through_usd"),
        sum_if(realized, "subtotal_amount").alias("realized_subtotal"),
    )
    delivered, total = F.col("successful_orders_count"), F.col("total_bookings_count")
    revenue = F.col("gross_revenue_usd")
    return sums.select(
        "*",
        safe_ratio(revenue, delivered).alias("avg_order_value_usd"),
        safe_ratio(F.col("realized_subtotal"), delivered).alias("avg_subtotal_usd"),
        percent(delivered, total).alias("order_success_rate_pct"),
        percent(F.col("cancelled_orders_count"), total).alias("cancellation_rate_pct"),
        percent(F.col("failed_orders_count"), total).alias("failure_rate_pct"),
        percent(F.col("total_refunds_usd"), revenue).alias("refund_rate_pct"),
        percent(F.col("paid_orders_count"), total).alias("payment_match_rate_pct"),
        percent(F.col("platform_commission_usd"), F.col("realized_subtotal")).alias(
            "effective_commission_rate_pct"
        ),
    ).drop("paid_orders_count", "realized_subtotal")


def growth(now: str, before: str) -> Column:
    return percent(F.col(now) - F.col(before), F.col(before))


def _with_growth(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        growth("gross_revenue_usd", "gross_revenue_usd_prior_week").alias("revenue_wow_growth_pct"),
        growth("total_bookings_count", "bookings_prior_week").alias("volume_wow_growth_pct"),
        growth("net_income_usd", "net_income_usd_prior_month").alias("income_mom_growth_pct"),
    ).drop("bookings_prior_week")


GROWTH_LAGS = {
    "gross_revenue_usd_prior_week": ("gross_revenue_usd", 7),
    "bookings_prior_week": ("total_bookings_count", 7),
    "net_income_usd_prior_month": ("net_income_usd", 30),
}


def mart_revenue(star: DataFrame) -> DataFrame:
    """Daily revenue per customer group and restaurant, with growth over 7 and 30 rows back.

    "Back" counts rows of the (segment, cuisine, tier) group in date order; rows of one
    day are put in the order of the remaining grain columns.
    """
    daily = daily_revenue(star)
    rest = [c for c in REVENUE_GRAIN if c not in (*GROWTH_GROUP, "order_date")]
    order = [F.col(c).asc_nulls_last() for c in ["order_date", *rest]]
    return _with_growth(lag_rows(daily, GROWTH_GROUP, order, GROWTH_LAGS))


def revenue_growth_by_day(star: DataFrame) -> DataFrame:
    """Growth against the same group exactly 7 and 30 days earlier."""
    daily = daily_revenue(star, [*GROWTH_GROUP, "order_date"]).select(
        *GROWTH_GROUP, "order_date", "total_bookings_count", "gross_revenue_usd", "net_income_usd"
    )
    return _with_growth(lag_days(daily, GROWTH_GROUP, "order_date", GROWTH_LAGS))


def star_billing(fct_billing: DataFrame, dim_restaurants: DataFrame) -> DataFrame:
    """Invoices summed per restaurant, day, plan and period, with restaurant attributes.

    Summing before the join leaves a restaurant at most a calendar of rows per plan.
    """
    status = F.col("billing_status")
    revenue_status = (
        F.when(status.isin(*COLLECTED), "Collected")
        .when(F.col("is_overdue"), "Overdue")
        .otherwise("Pending")
    )
    sums = ("invoice_total_usd", "base_fee_usd", "overage_fee_usd", "addon_fee_usd", "discount_usd")
    per_restaurant = (
        fct_billing.withColumn("revenue_status", revenue_status)
        .groupBy("restaurant_sk", "invoice_date", "plan_tier", "billing_period", "revenue_status")
        .agg(F.count("*").alias("invoices"), *[F.sum(c).alias(c) for c in sums])
    )
    restaurants = dim_restaurants.select(
        "restaurant_sk", "restaurant_name", "cuisine_type", F.col("city").alias("restaurant_city")
    )
    return lookup_join(per_restaurant, restaurants, "restaurant_sk").select(
        "*",
        F.trunc("invoice_date", "week").alias("invoice_week"),
        F.trunc("invoice_date", "month").alias("invoice_month"),
        (F.col("overage_fee_usd") + F.col("addon_fee_usd")).alias("usage_fee_usd"),
    )


def mart_subscription(fct_billing: DataFrame, dim_restaurants: DataFrame) -> DataFrame:
    """Daily invoices per restaurant and plan: billed, collected and overdue."""
    collected = F.col("revenue_status") == "Collected"
    overdue = F.col("revenue_status") == "Overdue"
    return (
        star_billing(fct_billing, dim_restaurants)
        .groupBy(*SUBSCRIPTION_GRAIN)
        .agg(
            F.sum("invoices").alias("total_invoices_count"),
            sum_if(collected, "invoices").alias("collected_invoices_count"),
            sum_if(overdue, "invoices").alias("overdue_invoices_count"),
            F.sum("invoice_total_usd").alias("gross_billed_usd"),
            F.sum("base_fee_usd").alias("billed_base_fees_usd"),
            F.sum("usage_fee_usd").alias("billed_usage_fees_usd"),
            F.sum("discount_usd").alias("total_discounts_given_usd"),
            sum_if(collected, "invoice_total_usd").alias("recognized_recurring_revenue_usd"),
            sum_if(collected, "base_fee_usd").alias("collected_base_fees_usd"),
            sum_if(collected, "usage_fee_usd").alias("collected_usage_fees_usd"),
            sum_if(overdue, "invoice_total_usd").alias("overdue_uncollected_revenue_usd"),
        )
    )


def sorted_mart(mart: DataFrame, day: str, amount: str, grain: list[str]) -> DataFrame:
    """Newest day first, then largest amount, then the grain, which makes the order total.

    For reading; tables are written unsorted.
    """
    rest = [F.col(c).asc_nulls_last() for c in grain if c != day]
    return mart.orderBy(F.col(day).desc_nulls_first(), F.col(amount).desc_nulls_first(), *rest)
