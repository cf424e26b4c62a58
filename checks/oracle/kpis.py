"""DuckDB equivalents of the KPI queries."""

from __future__ import annotations

from checks.oracle.gold import gold_ctes
from checks.oracle.marts import STAR
from checks.oracle.sql import final, pct, r2, ratio, with_

ORDERS = gold_ctes("fct_orders") | {
    "o": "SELECT *, coalesce(order_status = 'Delivered', FALSE) AS hit FROM g_fct_orders"
}
BILLS = gold_ctes("fct_billing") | {
    "paid": "SELECT *, CAST(date_trunc('month', invoice_date) AS DATE) AS month "
    "FROM g_fct_billing WHERE billing_status LIKE 'Paid%'"
}
MONTHLY = ORDERS | {
    "m": """
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month,
               count(*) AS total_bookings_count,
               sum(CASE WHEN hit THEN total_paid_amount ELSE 0 END) AS gross_revenue_usd,
               count(*) FILTER (order_status IN ('Cancelled', 'Rejected')) AS cancelled_orders_count,
               count(*) FILTER (refund_amount > 0) AS refunded_orders_count,
               sum(refund_amount) AS refund_amount_usd
        FROM o WHERE order_date IS NOT NULL GROUP BY 1"""
}

PER_CUSTOMER = gold_ctes("fct_orders", "dim_customers") | {
    "pc": """
        SELECT o.customer_id, any_value(c.value_segment) AS value_segment,
               sum(o.total_paid_amount) AS revenue_usd
        FROM g_fct_orders o LEFT JOIN g_dim_customers c USING (customer_id)
        WHERE o.order_status = 'Delivered' AND o.customer_id IS NOT NULL GROUP BY 1"""
}

KPIS = {
    "kpi_revenue": with_(
        ORDERS
        | BILLS
        | {
            "a": """
                SELECT sum(total_paid_amount) FILTER (hit) AS gross_revenue_usd,
                       sum(total_paid_amount - refund_amount) FILTER (hit) AS net_revenue_usd,
                       sum(total_paid_amount - refund_amount - discount_amount)
                           AS bookings_less_refunds_usd,
                       (SELECT sum(invoice_total_usd) FROM paid) AS subscription_revenue_usd
                FROM o""",
            "r": "SELECT *, gross_revenue_usd + subscription_revenue_usd AS total_revenue_usd FROM a",
        },
        final(
            "gross_revenue_usd:f net_revenue_usd:f bookings_less_refunds_usd:f "
            "subscription_revenue_usd:f total_revenue_usd:f",
            "r",
        ),
    ),
    "kpi_mrr": with_(
        BILLS
        | {
            "r": """
                SELECT month AS invoice_month, plan_tier, sum(base_fee_usd) AS mrr_usd,
                       count(*) AS invoices,
                       CAST(date_trunc('quarter', month) AS DATE) AS invoice_quarter
                FROM paid GROUP BY month, plan_tier"""
        },
        final("invoice_month:s plan_tier mrr_usd:f invoices:i invoice_quarter:s", "r"),
    ),
    "kpi_churn_rate": with_(
        BILLS
        | {
            "act": "SELECT DISTINCT restaurant_id, plan_tier, month FROM paid WHERE month IS NOT NULL",
            "j": """
                SELECT a.month, a.plan_tier, count(*) AS active_restaurants,
                       count(*) FILTER (b.month IS NULL) AS lost_restaurants
                FROM act a LEFT JOIN act b ON b.restaurant_id = a.restaurant_id
                     AND b.plan_tier = a.plan_tier AND b.month = a.month + INTERVAL 1 MONTH
                WHERE a.month < (SELECT max(month) FROM act) GROUP BY 1, 2""",
            "r": f"SELECT *, {pct('lost_restaurants', 'active_restaurants')} AS churn_rate_pct FROM j",
        },
        final("month:s plan_tier active_restaurants:i lost_restaurants:i churn_rate_pct:f", "r"),
    ),
    "kpi_delivery_aov": with_(
        ORDERS
        | {
            "a": "SELECT count(*) AS total_orders, count(*) FILTER (hit) AS delivered_orders, "
            "sum(total_paid_amount) FILTER (hit) AS gross_revenue_usd FROM o",
            "r": f"SELECT *, {pct('delivered_orders', 'total_orders')} AS delivery_rate_pct, "
            f"{ratio('gross_revenue_usd', 'delivered_orders')} AS aov_usd FROM a",
        },
        final("total_orders:i delivered_orders:i gross_revenue_usd:f delivery_rate_pct:f aov_usd:f", "r"),
    ),
    "kpi_monthly_growth": with_(
        MONTHLY
        | {
            "l": "SELECT *, lag(gross_revenue_usd) OVER (ORDER BY order_month) AS prior_revenue_usd, "
            "lag(total_bookings_count) OVER (ORDER BY order_month) AS prior_bookings FROM m",
            "r": f"""SELECT *,
                {pct("(gross_revenue_usd - prior_revenue_usd)", "prior_revenue_usd")} AS revenue_mom_pct,
                {pct("(total_bookings_count - prior_bookings)", "prior_bookings")} AS bookings_mom_pct
                FROM l""",
        },
        final(
            "order_month:s gross_revenue_usd:f total_bookings_count:i prior_revenue_usd:f "
            "prior_bookings:i revenue_mom_pct:f bookings_mom_pct:f",
            "r",
        ),
    ),
    "kpi_cancel_refund_series": with_(
        MONTHLY
        | {
            "r": f"SELECT *, {pct('cancelled_orders_count', 'total_bookings_count')} "
            "AS cancellation_rate_pct FROM m"
        },
        final(
            "order_month:s total_bookings_count:i cancelled_orders_count:i refunded_orders_count:i "
            "refund_amount_usd:f cancellation_rate_pct:f",
            "r",
        ),
    ),
    "eda_payment_mix": with_(
        STAR
        | {
            "a": """
                SELECT latest_payment_method, count(*) AS orders,
                       count(*) FILTER (hit) AS delivered_orders,
                       sum(CASE WHEN hit THEN total_paid_amount ELSE 0 END) AS gross_revenue_usd
                FROM star GROUP BY 1""",
            "r": f"""SELECT *,
                {pct("gross_revenue_usd", "(SELECT sum(gross_revenue_usd) FROM a)")} AS revenue_share_pct,
                {ratio("gross_revenue_usd", "delivered_orders")} AS aov_usd FROM a""",
        },
        final(
            "latest_payment_method orders:i delivered_orders:i gross_revenue_usd:f "
            "revenue_share_pct:f aov_usd:f",
            "r",
        ),
    ),
    "eda_pareto": with_(
        PER_CUSTOMER
        | {
            "a": """
                SELECT *, sum(revenue_usd) OVER (ORDER BY revenue_usd DESC, customer_id
                              ROWS UNBOUNDED PRECEDING) AS running_revenue_usd,
                       sum(revenue_usd) OVER () AS whole
                FROM pc WHERE revenue_usd IS NOT NULL""",
            "r": f"SELECT *, {pct('running_revenue_usd', 'whole')} AS cumulative_share_pct FROM a",
        },
        final(
            "customer_id value_segment revenue_usd:f running_revenue_usd:f cumulative_share_pct:f", "r"
        ),
    ),
    "eda_segment_share": with_(
        PER_CUSTOMER
        | {
            "a": "SELECT value_segment, count(*) AS customers, sum(revenue_usd) AS revenue_usd "
            "FROM pc GROUP BY 1",
            "r": f"SELECT *, {pct('revenue_usd', '(SELECT sum(revenue_usd) FROM a)')} "
            "AS revenue_share_pct FROM a",
        },
        final("value_segment customers:i revenue_usd:f revenue_share_pct:f", "r"),
    ),
    "kpi_status_geo": with_(
        STAR
        | {
            "r": """
                SELECT order_status, customer_state, restaurant_city, count(*) AS orders,
                       sum(total_paid_amount) AS gross_bookings_usd,
                       sum(CASE WHEN hit THEN total_paid_amount ELSE 0 END) AS gross_revenue_usd,
                       sum(refund_amount) AS refund_amount_usd
                FROM star GROUP BY ALL"""
        },
        final(
            "order_status customer_state restaurant_city orders:i gross_bookings_usd:f "
            "gross_revenue_usd:f refund_amount_usd:f",
            "r",
        ),
    ),
    "kpi_rev_per_subscriber": with_(
        BILLS
        | {
            "a": "SELECT plan_tier, count(DISTINCT restaurant_id) AS subscribers, "
            "count(*) AS invoices, sum(invoice_total_usd) AS revenue_usd FROM paid GROUP BY 1",
            "r": f"SELECT *, {ratio('revenue_usd', 'subscribers')} AS revenue_per_subscriber_usd, "
            f"{pct('revenue_usd', '(SELECT sum(revenue_usd) FROM a)')} AS revenue_share_pct FROM a",
        },
        final(
            "plan_tier subscribers:i invoices:i revenue_usd:f revenue_per_subscriber_usd:f "
            "revenue_share_pct:f",
            "r",
        ),
    ),
    "eda_cohort": with_(
        BILLS
        | gold_ctes("dim_restaurants")
        | {
            "mem": "SELECT restaurant_id, plan_tier, signup_date, "
            "CAST(date_trunc('quarter', signup_date) AS DATE) AS cohort_quarter "
            "FROM g_dim_restaurants WHERE signup_date IS NOT NULL",
            "a": """
                SELECT e.cohort_quarter, e.plan_tier,
                       date_diff('month', e.signup_date, p.month) AS age_months,
                       count(DISTINCT p.restaurant_id) AS active_restaurants
                FROM paid p JOIN mem e USING (restaurant_id)
                WHERE p.month IS NOT NULL AND date_diff('month', e.signup_date, p.month) >= 0
                GROUP BY 1, 2, 3""",
            "r": f"""
                SELECT a.*, s.cohort_size, {pct("a.active_restaurants", "s.cohort_size")} AS survival_pct
                FROM a JOIN (SELECT cohort_quarter, plan_tier, count(*) AS cohort_size
                             FROM mem GROUP BY 1, 2) s USING (cohort_quarter, plan_tier)""",
        },
        final(
            "cohort_quarter:s plan_tier age_months:i active_restaurants:i cohort_size:i survival_pct:f",
            "r",
        ),
    ),
    "eda_decompose": with_(
        MONTHLY
        | {
            "t": """
                SELECT order_month, CAST(gross_revenue_usd AS DOUBLE) AS v,
                       avg(CAST(gross_revenue_usd AS DOUBLE)) OVER (ORDER BY order_month
                           ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) AS trend
                FROM m""",
            "c": "SELECT *, avg(v - trend) OVER (PARTITION BY month(order_month)) AS cyc FROM t",
            "r": f"SELECT order_month, {r2('v')} AS revenue_usd, {r2('trend')} AS trend_usd, "
            f"{r2('cyc')} AS cyclical_usd, {r2('v - trend - cyc')} AS noise_usd FROM c",
        },
        final("order_month:s revenue_usd:f trend_usd:f cyclical_usd:f noise_usd:f", "r"),
    ),
}
