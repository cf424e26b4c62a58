"""Documented KPIs and analyses over the gold layer.

Each reduces the facts to calendar, tier or customer grain first; windows only run over
those reduced rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from courierlake.functions import (
    count_if_true,
    date_diff_boundary,
    percent,
    safe_ratio,
    sum_if,
    surrogate_key,
)
from courierlake.operators.sequences import running_sum
from courierlake.operators.skew import lookup_join
from courierlake.plans.marts import growth, payments_summary
from courierlake.plans.values import CANCELLED, COLLECTED



def _delivered() -> Column:
    return F.col("order_status") == "Delivered"


def _collected(fct_billing: DataFrame) -> DataFrame:
    return fct_billing.filter(F.col("billing_status").isin(*COLLECTED))


def _share(part: str) -> Column:
    """Percent of the column's total; for results of a few rows per category only."""
    return percent(F.col(part), F.sum(part).over(Window.partitionBy()))


def revenue(fct_orders: DataFrame, fct_billing: DataFrame) -> DataFrame:
    """Total, gross and net revenue, and gross by its prose definition (all orders)."""
    total, refund = F.col("total_paid_amount"), F.col("refund_amount")
    zero = F.lit(0).cast("decimal(28,2)")
    orders = fct_orders.agg(
        sum_if(_delivered(), total).alias("gross_revenue_usd"),
        sum_if(_delivered(), total - refund).alias("net_revenue_usd"),
        F.sum(total - refund - F.col("discount_amount")).alias("bookings_less_refunds_usd"),
    ).withColumn("subscription_revenue_usd", zero)
    invoices = _collected(fct_billing).agg(
        zero.alias("gross_revenue_usd"),
        zero.alias("net_revenue_usd"),
        zero.alias("bookings_less_refunds_usd"),
        F.sum("invoice_total_usd").alias("subscription_revenue_usd"),
    )
    both = orders.unionByName(invoices)
    summed = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    total_revenue = F.col("gross_revenue_usd") + F.col("subscription_revenue_usd")
    return summed.select("*", total_revenue.alias("total_revenue_usd"))


def mrr(fct_billing: DataFrame) -> DataFrame:
    """Collected base fees per month and plan tier."""
    month = F.trunc("invoice_date", "month")
    return (
        _collected(fct_billing)
        .groupBy(month.alias("invoice_month"), "plan_tier")
        .agg(F.sum("base_fee_usd").alias("mrr_usd"), F.count("*").alias("invoices"))
        .withColumn("invoice_quarter", F.trunc("invoice_month", "quarter"))
    )


def _active_months(fct_billing: DataFrame, *by: str) -> DataFrame:
    """Months in which a restaurant had a collected invoice; one row each."""
    return (
        _collected(fct_billing)
        .filter(F.col("invoice_date").isNotNull())
        .select("restaurant_sk", *by, F.trunc("invoice_date", "month").alias("month"))
        .distinct()
    )


def churn_rate(fct_billing: DataFrame) -> DataFrame:
    """Restaurants of a tier that are active in a month and not in the next one."""
    each = Window.partitionBy("restaurant_sk", "plan_tier").orderBy("month")
    following = F.lead("month").over(each)
    stays = F.coalesce(following == F.add_months("month", 1), F.lit(False))
    per_month = (
        _active_months(fct_billing, "plan_tier")
        .withColumn("stays", stays)
        .groupBy("month", "plan_tier")
        .agg(
            F.count("*").alias("active_restaurants"),
            count_if_true(~F.col("stays")).alias("lost_restaurants"),
        )
    )
    # One row per month and tier from here on.
    last = F.max("month").over(Window.partitionBy())
    rate = percent(F.col("lost_restaurants"), F.col("active_restaurants"))
    return (
        per_month.withColumn("last", last)
        .filter(F.col("month") < F.col("last"))
        .select("month", "plan_tier", "active_restaurants", "lost_restaurants", rate.alias("churn_rate_pct"))
    )


def delivery_aov(fct_orders: DataFrame) -> DataFrame:
    """Delivered share of orders and revenue per delivered order."""
    counted = fct_orders.agg(
        F.count("*").alias("total_orders"),
        count_if_true(_delivered()).alias("delivered_orders"),
        sum_if(_delivered(), "total_paid_amount").alias("gross_revenue_usd"),
    )
    return counted.select(
        "*",
        percent(F.col("delivered_orders"), F.col("total_orders")).alias("delivery_rate_pct"),
        safe_ratio(F.col("gross_revenue_usd"), F.col("delivered_orders")).alias("aov_usd"),
    )


def _monthly(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.filter(F.col("order_date").isNotNull())
        .groupBy(F.trunc("order_date", "month").alias("order_month"))
        .agg(
            F.count("*").alias("total_bookings_count"),
            sum_if(_delivered(), "total_paid_amount").alias("gross_revenue_usd"),
            count_if_true(F.col("order_status").isin(*CANCELLED)).alias(
                "cancelled_orders_count"
            ),
            sum_if(F.col("refund_amount") > 0, F.lit(1)).alias("refunded_orders_count"),
            F.sum("refund_amount").alias("refund_amount_usd"),
        )
    )


def monthly_growth(fct_orders: DataFrame) -> DataFrame:
    """Monthly revenue and bookings against the month before."""
    calendar = Window.orderBy("order_month")  # one row per month
    monthly = _monthly(fct_orders).select(
        "order_month",
        "gross_revenue_usd",
        "total_bookings_count",
        F.lag("gross_revenue_usd").over(calendar).alias("prior_revenue_usd"),
        F.lag("total_bookings_count").over(calendar).alias("prior_bookings"),
    )
    return monthly.select(
        "*",
        growth("gross_revenue_usd", "prior_revenue_usd").alias("revenue_mom_pct"),
        growth("total_bookings_count", "prior_bookings").alias("bookings_mom_pct"),
    )


def cancel_refund_series(fct_orders: DataFrame) -> DataFrame:
    """Cancellations and refunds per month."""
    rate = percent(F.col("cancelled_orders_count"), F.col("total_bookings_count"))
    return _monthly(fct_orders).select(
        "order_month",
        "total_bookings_count",
        "cancelled_orders_count",
        "refunded_orders_count",
        "refund_amount_usd",
        rate.alias("cancellation_rate_pct"),
    )


def payment_mix(fct_orders: DataFrame, fct_payments: DataFrame, key: str = "order_sk") -> DataFrame:
    """Revenue share and order value per payment method. ``key`` joins payments to orders."""
    methods = payments_summary(fct_payments, key).select(key, "latest_payment_method")
    by_method = (
        fct_orders.join(methods, key, "left")
        .groupBy("latest_payment_method")
        .agg(
            F.count("*").alias("orders"),
            count_if_true(_delivered()).alias("delivered_orders"),
            sum_if(_delivered(), "total_paid_amount").alias("gross_revenue_usd"),
        )
    )
    return by_method.select(
        "*",
        _share("gross_revenue_usd").alias("revenue_share_pct"),
        safe_ratio(F.col("gross_revenue_usd"), F.col("delivered_orders")).alias("aov_usd"),
    )


def customer_revenue(orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Revenue per customer with delivered orders, and the customer's value segment."""
    per_customer = (
        orders.filter((F.col("status") == "Delivered") & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("total_usd").alias("revenue_usd"))
        .withColumn("customer_sk", surrogate_key("customer_id"))
    )
    segments = dim_customers.select("customer_sk", "value_segment")
    return lookup_join(per_customer, segments, "customer_sk").drop("customer_sk")


def pareto(per_customer: DataFrame) -> DataFrame:
    """Customers by falling revenue with their cumulative share of the total."""
    known = per_customer.filter(F.col("revenue_usd").isNotNull())
    order = [F.col("revenue_usd").desc(), F.col("customer_id").asc()]
    ranked = running_sum(known, "revenue_usd", order, "running_revenue_usd", total="_total_usd")
    share = percent(F.col("running_revenue_usd"), F.col("_total_usd")).alias("cumulative_share_pct")
    return ranked.select(*per_customer.columns, "running_revenue_usd", share)


def segment_share(per_customer: DataFrame) -> DataFrame:
    """Customers and revenue share per value segment."""
    by_segment = per_customer.groupBy("value_segment").agg(
        F.count("*").alias("customers"), F.sum("revenue_usd").alias("revenue_usd")
    )
    return by_segment.select("*", _share("revenue_usd").alias("revenue_share_pct"))


def status_geo(star: DataFrame) -> DataFrame:
    """Orders by status, customer state and restaurant city."""
    return star.groupBy("order_status", "customer_state", "restaurant_city").agg(
        F.count("*").alias("orders"),
        F.sum("total_paid_amount").alias("gross_bookings_usd"),
        sum_if(F.col("is_realized"), "total_paid_amount").alias("gross_revenue_usd"),
        F.sum("refund_amount").alias("refund_amount_usd"),
    )


def revenue_per_subscriber(fct_billing: DataFrame) -> DataFrame:
    """Collected revenue per paying restaurant, by plan tier."""
    # Per restaurant first: a distinct count would shuffle every invoice's key.
    per_restaurant = (
        _collected(fct_billing)
        .groupBy("plan_tier", "restaurant_sk")
        .agg(F.sum("invoice_total_usd").alias("revenue"), F.count("*").alias("n"))
    )
    by_tier = per_restaurant.groupBy("plan_tier").agg(
        F.count("*").alias("subscribers"),
        F.sum("n").alias("invoices"),
        F.sum("revenue").alias("revenue_usd"),
    )
    return by_tier.select(
        "*",
        safe_ratio(F.col("revenue_usd"), F.col("subscribers")).alias("revenue_per_subscriber_usd"),
        _share("revenue_usd").alias("revenue_share_pct"),
    )


def cohorts(fct_billing: DataFrame, dim_restaurants: DataFrame) -> DataFrame:
    """Share of a signup-quarter and tier cohort with a collected invoice at each age."""
    members = dim_restaurants.filter(F.col("signup_date").isNotNull()).select(
        "restaurant_sk",
        "plan_tier",
        "signup_date",
        F.trunc("signup_date", "quarter").alias("cohort_quarter"),
    )
    sizes = members.groupBy("cohort_quarter", "plan_tier").agg(F.count("*").alias("cohort_size"))
    age = date_diff_boundary("month", "signup_date", "month").alias("age_months")
    # Distinct months first, so a restaurant brings at most a calendar of rows.
    active = (
        _active_months(fct_billing)
        .join(members, "restaurant_sk")
        .select("cohort_quarter", "plan_tier", age)
        .filter(F.col("age_months") >= 0)
        .groupBy("cohort_quarter", "plan_tier", "age_months")
        .agg(F.count("*").alias("active_restaurants"))
    )
    return active.join(sizes, ["cohort_quarter", "plan_tier"]).withColumn(
        "survival_pct", percent(F.col("active_restaurants"), F.col("cohort_size"))
    )


def decompose(fct_orders: DataFrame) -> DataFrame:
    """Monthly revenue as trend (12-month centred mean), cycle (month of year) and noise."""
    calendar = Window.orderBy("order_month")  # one row per month
    # Decimal means: an exact half cent must not depend on the order of a sum.
    value = F.col("gross_revenue_usd").cast("decimal(24,8)")
    series = _monthly(fct_orders).select("order_month", value.alias("revenue_usd"))
    series = series.withColumn("trend", F.avg("revenue_usd").over(calendar.rowsBetween(-6, 5)))
    same_month = Window.partitionBy(F.month("order_month"))
    series = series.withColumn("cycle", F.avg(F.col("revenue_usd") - F.col("trend")).over(same_month))
    noise = F.col("revenue_usd") - F.col("trend") - F.col("cycle")
    return series.select(
        "order_month",
        F.round("revenue_usd", 2).alias("revenue_usd"),
        F.round("trend", 2).alias("trend_usd"),
        F.round("cycle", 2).alias("cyclical_usd"),
        F.round(noise, 2).alias("noise_usd"),
    )
