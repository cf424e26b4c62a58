"""Single-operator queries: projections, predicates, functions, joins, aggregates, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import bronze_cte
from checks.bronze import AS_OF, bronze, pipeline, table
from checks.oracle.gold import gold_ctes
from checks.oracle.marts import STAR, SUBSCRIPTION, SUBSCRIPTION_COLUMNS, mart_revenue
from checks.oracle.silver import silver_ctes
from checks.oracle.sql import AS_OF as AS_OF_SQL
from checks.oracle.sql import boolean, dt, final, least, pct, r2, ratio, title, tm, with_
from courierlake import functions as fx
from courierlake.operators.dedup import first_per_key, keep_latest
from courierlake.operators.skew import attach_group_stats, lookup_join
from courierlake.plans import gold, marts
from courierlake.plans.silver.common import day
from courierlake.plans.silver.delivery import clean_delivery
from courierlake.plans.silver.orders import _repair, _typed
from courierlake.plans.silver.payments import one_per_transaction
from courierlake.plans.silver.promotions import clean_promotions

GENERIC: dict[str, tuple] = {}


def op(name: str, oracle: str | None = None):
    def add(fn):
        GENERIC[name] = (fn, oracle)
        return fn

    return add


def b(t: str) -> str:
    return f"({bronze_cte(t)}) AS b_{t}"


# --- projections and predicates ------------------------------------------------------


@op("filter_pk_not_null", f"SELECT order_id, status, event_time FROM {b('orders')} WHERE order_id IS NOT NULL")
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = bronze(spark, sf, "orders")
    return orders.filter(F.col("order_id").isNotNull()).select("order_id", "status", "event_time")


@op(
    "proj_staged_chain",
    with_(
        silver_ctes("orders")
        | {
            "x": """SELECT order_key AS order_id,
                subtotal + tax + CASE WHEN type_text = 'Pickup' THEN 0 ELSE raw_delivery_fee END - discount AS total_usd,
                CASE WHEN discount = 0 THEN NULL WHEN raw_promo_code IS NULL AND discount > 0 THEN 'UNKNOWN'
                     ELSE raw_promo_code END AS promo_code, loaded_at AS _extracted_at FROM o1"""
        },
        final("order_id total_usd:f promo_code _extracted_at:s", "x"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    staged = bronze(spark, sf, "orders").transform(_typed).transform(_repair)
    return staged.select("order_id", "total_usd", "promo_code", "_extracted_at")


@op(
    "proj_rename_prune",
    "SELECT o_orderkey AS order_key, o_orderstatus AS order_status, "
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_paid_amount FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("order_status"),
        fx.money("o_totalprice").alias("total_paid_amount"),
    )


@op(
    "proj_lateral_alias",
    with_(
        silver_ctes("promotions"),
        final("promo_id discount_unit_raw discount_unit_clean discount_label", "s_promotions"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    promotions = clean_promotions(bronze(spark, sf, "promotions"), AS_OF)
    return promotions.select("promo_id", "discount_unit_raw", "discount_unit_clean", "discount_label")


@op(
    "filter_then_agg",
    with_(
        silver_ctes("billing")
        | {
            "x": """SELECT restaurant_id, sum(total_usd) AS lifetime_fees_paid_usd,
                sum(base_fee_usd) AS total_base_fees_usd, sum(overage_fee_usd) AS total_overage_fees_usd,
                max(invoice_date) AS last_billing_date, count(invoice_id) AS total_invoices_paid
                FROM s_billing WHERE status = 'Paid' GROUP BY 1"""
        },
        final(
            "restaurant_id lifetime_fees_paid_usd:f total_base_fees_usd:f total_overage_fees_usd:f "
            "last_billing_date:s total_invoices_paid:i",
            "x",
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return gold.paid_billing_summary(pipeline(spark, sf).silver("billing"))


@op(
    "pred_in",
    f"SELECT delivery_id, status, weather_condition FROM {b('delivery')} "
    "WHERE weather_condition IN ('stormy', 'rainy') OR traffic_level IN ('severe')",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    severe = F.col("weather_condition").isin("stormy", "rainy") | F.col("traffic_level").isin("severe")
    delivery = bronze(spark, sf, "delivery").filter(severe)
    return delivery.select("delivery_id", "status", "weather_condition")


@op(
    "pred_not_in_null",
    f"SELECT order_id, event_time, CASE WHEN status IS NULL OR lower(trim(status)) IN "
    f"('delivered', 'out for delivery', 'refunded') THEN customer_rating END AS kept_rating FROM {b('orders')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = ~F.lower(F.trim("status")).isin("delivered", "out for delivery", "refunded")
    kept = F.when(out, F.lit(None)).otherwise(F.col("customer_rating")).alias("kept_rating")
    return bronze(spark, sf, "orders").select("order_id", "event_time", kept)


@op(
    "pred_between_date",
    f"SELECT promo_id, event_time, start_date, end_date FROM {b('promotions')} "
    f"WHERE {AS_OF_SQL} >= {dt('start_date')} AND {AS_OF_SQL} <= {dt('end_date')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    live = day(AS_OF).between(fx.try_date("start_date"), fx.try_date("end_date"))
    return bronze(spark, sf, "promotions").filter(live).select(
        "promo_id", "event_time", "start_date", "end_date"
    )


@op(
    "pred_null_logic",
    f"SELECT delivery_id, event_time, proof_of_delivery, driver_rating FROM {b('delivery')} "
    "WHERE (proof_of_delivery IS NULL AND driver_rating IS NOT NULL) OR actual_time_min > 45",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    wanted = (F.col("proof_of_delivery").isNull() & F.col("driver_rating").isNotNull()) | (
        F.col("actual_time_min") > 45
    )
    return bronze(spark, sf, "delivery").filter(wanted).select(
        "delivery_id", "event_time", "proof_of_delivery", "driver_rating"
    )


@op(
    "pred_interval",
    f"SELECT customer_id, event_time, registration_date FROM {b('customers')} "
    f"WHERE {dt('registration_date')} < {AS_OF_SQL} - INTERVAL 30 DAY",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    old = fx.try_date("registration_date") < F.date_sub(day(AS_OF), 30)
    return bronze(spark, sf, "customers").filter(old).select(
        "customer_id", "event_time", "registration_date"
    )


@op(
    "proj_bool_flags",
    f"""SELECT review_id, event_time, sentiment = 'POSITIVE' AS is_loud,
        TRY_CAST(overall_rating AS DECIMAL(3,1)) >= 4 AS is_positive_review,
        sentiment = 'negative' AND TRY_CAST(overall_rating AS DECIMAL(3,1)) >= 4 AS is_conflicting
        FROM {b('reviews')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    high = F.col("overall_rating").try_cast("decimal(3,1)") >= 4
    return bronze(spark, sf, "reviews").select(
        "review_id",
        "event_time",
        (F.col("sentiment") == "POSITIVE").alias("is_loud"),
        high.alias("is_positive_review"),
        ((F.col("sentiment") == "negative") & high).alias("is_conflicting"),
    )


# --- scalar functions ----------------------------------------------------------------


@op(
    "fn_string",
    f"""SELECT customer_id, event_time, trim(state) AS trimmed, upper(trim(first_name)) AS up,
        lower(trim(email)) AS low, first_name || ' ' || last_name AS full_name,
        lpad(zip_code, 5, '0') AS zip FROM {b('customers')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "customers").select(
        "customer_id",
        "event_time",
        F.trim("state").alias("trimmed"),
        fx.clean_upper("first_name").alias("up"),
        fx.clean_lower("email").alias("low"),
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.lpad("zip_code", 5, "0").alias("zip"),
    )


@op(
    "fn_initcap",
    f"SELECT p_partkey, {title('p_name')} AS name, {title('p_type')} AS kind, "
    f"{title('p_brand')} AS brand FROM part",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        fx.title_case("p_name").alias("name"),
        fx.title_case("p_type").alias("kind"),
        fx.title_case("p_brand").alias("brand"),
    )


@op(
    "fn_regexp_digits",
    f"SELECT customer_id, event_time, regexp_replace(phone, '[^0-9]', '', 'g') AS digits FROM {b('customers')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    digits = F.regexp_replace("phone", "[^0-9]", "").alias("digits")
    return bronze(spark, sf, "customers").select("customer_id", "event_time", digits)


@op(
    "fn_null",
    f"""SELECT customer_id, event_time, nullif(dietary_preference, 'NaN') AS diet,
        coalesce(nullif(dietary_preference, 'NaN'), 'None Specified') AS diet_or_none,
        CAST(coalesce(total_orders, 0) AS BIGINT) AS orders_or_zero FROM {b('customers')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    diet = F.nullif("dietary_preference", F.lit("NaN"))
    return bronze(spark, sf, "customers").select(
        "customer_id",
        "event_time",
        diet.alias("diet"),
        F.coalesce(diet, F.lit("None Specified")).alias("diet_or_none"),
        F.coalesce("total_orders", F.lit(0)).alias("orders_or_zero"),
    )


@op(
    "fn_case_bucket",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'High' WHEN o_totalprice >= 50000
       THEN 'Medium' ELSE 'Low' END AS bucket FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    bucket = F.when(price >= 200000, "High").when(price >= 50000, "Medium").otherwise("Low")
    return table(spark, sf, "orders").select("o_orderkey", bucket.alias("bucket"))


@op(
    "fn_cast",
    f"""SELECT customer_id, event_time, CAST({dt('date_of_birth')} AS VARCHAR) AS dob,
        TRY_CAST(churn_risk AS DOUBLE) AS risk_or_nan, {boolean('is_premium')} AS premium,
        {boolean('marketing_opt_in')} AS opted, CAST(CAST(total_spent_usd AS DECIMAL(18,2)) AS DOUBLE) AS spent
        FROM (SELECT * REPLACE (nullif(churn_risk, 'NaN') AS churn_risk) FROM {b('customers')})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "customers").select(
        "customer_id",
        "event_time",
        fx.try_date("date_of_birth").alias("dob"),
        fx.try_double(F.nullif("churn_risk", F.lit("NaN"))).alias("risk_or_nan"),
        fx.try_boolean("is_premium").alias("premium"),
        fx.try_boolean("marketing_opt_in").alias("opted"),
        fx.money("total_spent_usd").alias("spent"),
    )


@op(
    "fn_math",
    f"""SELECT restaurant_id, event_time, CAST(round(avg_prep_time_min) AS BIGINT) AS prep,
        {r2("monthly_fee_usd / nullif(total_orders, 0)")} AS fee_per_order,
        {r2("total_orders * (commission_pct / 100)")} AS commission,
        abs(monthly_fee_usd - 100) AS off_100 FROM {b('restaurants')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "restaurants").select(
        "restaurant_id",
        "event_time",
        fx.to_int("avg_prep_time_min").cast("bigint").alias("prep"),
        fx.decimal_ratio(F.col("monthly_fee_usd"), F.col("total_orders")).alias("fee_per_order"),
        F.round(F.col("total_orders") * (F.col("commission_pct") / 100), 2).alias("commission"),
        F.abs(F.col("monthly_fee_usd") - 100).alias("off_100"),
    )


@op(
    "fn_least_greatest_null",
    f"""SELECT promo_id, event_time, CAST({least("times_used", "usage_limit")} AS BIGINT) AS used,
        CASE WHEN max_discount_usd IS NOT NULL THEN greatest(max_discount_usd, min_order_usd) END AS cap
        FROM {b('promotions')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "promotions").select(
        "promo_id",
        "event_time",
        fx.least_or_null("times_used", "usage_limit").alias("used"),
        fx.greatest_or_null("max_discount_usd", "min_order_usd").alias("cap"),
    )


@op(
    "fn_datediff_boundary",
    f"""SELECT delivery_id, event_time,
        date_diff('minute', TRY_CAST(pickup_time AS TIMESTAMP), TRY_CAST(dropoff_time AS TIMESTAMP)) AS minutes,
        date_diff('day', TRY_CAST(pickup_time AS TIMESTAMP)::DATE, {AS_OF_SQL}) AS days,
        date_diff('month', TRY_CAST(pickup_time AS TIMESTAMP)::DATE, {AS_OF_SQL}) AS months,
        date_diff('year', TRY_CAST(pickup_time AS TIMESTAMP)::DATE, {AS_OF_SQL}) AS years
        FROM {b('delivery')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    picked, dropped = (F.col(c).try_cast("timestamp") for c in ("pickup_time", "dropoff_time"))
    return bronze(spark, sf, "delivery").select(
        "delivery_id",
        "event_time",
        fx.date_diff_boundary("minute", picked, dropped).alias("minutes"),
        *[fx.date_diff_boundary(p, picked, day(AS_OF)).alias(f"{p}s") for p in ("day", "month", "year")],
    )


@op(
    "fn_date",
    """SELECT o_orderkey, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
       left(dayname(o_orderdate), 3) AS weekday, hour(o_orderdate) AS hour FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.trunc("o_orderdate", "week").alias("week"),
        F.trunc("o_orderdate", "month").alias("month"),
        F.dayname("o_orderdate").alias("weekday"),
        F.hour("o_orderdate").alias("hour"),
    )


@op(
    "fn_ts_from_parts",
    f"""SELECT payment_id, event_time, CAST(TRY_CAST(CAST({dt('payment_date')} AS VARCHAR) || ' ' ||
        {tm('payment_time')} AS TIMESTAMP) AS VARCHAR) AS paid_at FROM {b('payments')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "payments").select(
        "payment_id",
        "event_time",
        fx.timestamp_from_parts(fx.try_date("payment_date"), fx.try_time("payment_time")).alias("paid_at"),
    )


@op(
    "sk_hash",
    f"SELECT count(*) AS ids, count(*) AS keys, FALSE AS has_negative, FALSE AS has_null FROM "
    f"(SELECT DISTINCT driver_id FROM {b('orders')})",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Hash values differ between engines; what counts is one key per id, NULL included."""
    ids = bronze(spark, sf, "orders").select("driver_id").distinct()
    key = F.col("key")
    return ids.withColumn("key", fx.surrogate_key("driver_id")).agg(
        F.count("*").alias("ids"),
        F.countDistinct("key").alias("keys"),
        F.bool_or(key < 0).alias("has_negative"),
        F.bool_or(key.isNull()).alias("has_null"),
    )


# --- deduplication and windows -------------------------------------------------------

_LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


def _line_ties() -> list:
    return [F.col(c.strip()).asc() for c in _LINE_ORDER.split(",")]


def _line_sql(direction: str) -> str:
    return (
        "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM (SELECT * FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY l_shipdate {direction}, {_LINE_ORDER}) = 1)"
    )


@op("dedup_latest", _line_sql("DESC NULLS FIRST"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("l_shipdate").desc_nulls_first(), *_line_ties()]
    return first_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@op("dedup_earliest", _line_sql("ASC NULLS LAST"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("l_shipdate").asc_nulls_last(), *_line_ties()]
    return first_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@op(
    "dedup_chained",
    f"""SELECT payment_id, transaction_id, payment_date, event_time FROM (
        SELECT * FROM {b('payments')} QUALIFY row_number() OVER (PARTITION BY transaction_id
            ORDER BY {dt('payment_date')} NULLS LAST, event_time NULLS LAST, payment_id NULLS LAST) = 1)
        QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY event_time DESC NULLS FIRST) = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    payments = bronze(spark, sf, "payments").select(
        "payment_id",
        "transaction_id",
        fx.try_date("payment_date").alias("payment_date"),
        F.col("event_time").alias("_extracted_at"),
    )
    latest = keep_latest(one_per_transaction(payments), "payment_id", "_extracted_at")
    return latest.withColumnRenamed("_extracted_at", "event_time")


@op(
    "window_dup_flag",
    f"""SELECT driver_id, event_time, count(driver_id) OVER (PARTITION BY license_number) > 1 AS dup_license,
        count(driver_id) OVER (PARTITION BY vehicle_plate) > 1 AS dup_plate FROM {b('drivers')}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    counted = attach_group_stats(
        bronze(spark, sf, "drivers").select("driver_id", "event_time", "license_number", "vehicle_plate"),
        {
            "same_license": ("license_number", F.count("driver_id")),
            "same_plate": ("vehicle_plate", F.count("driver_id")),
        },
    )
    return counted.select(
        "driver_id",
        "event_time",
        (F.col("same_license") > 1).alias("dup_license"),
        (F.col("same_plate") > 1).alias("dup_plate"),
    )


@op(
    "window_redelivery",
    with_(
        silver_ctes("delivery"),
        final("delivery_id is_redelivery total_attempts_for_order:i is_first_attempt", "s_delivery"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    delivery = clean_delivery(bronze(spark, sf, "delivery"), AS_OF)
    return delivery.select(
        "delivery_id", "is_redelivery", "total_attempts_for_order", "is_first_attempt"
    )


# --- joins ---------------------------------------------------------------------------


@op(
    "join_left_natural",
    with_(
        silver_ctes("customers", "users")
        | {
            "x": "SELECT c.customer_id, c.user_id, u.user_role, u.is_email_verified "
            "FROM s_customers c LEFT JOIN s_users u ON c.user_id = u.user_id"
        },
        final("customer_id user_id user_role is_email_verified", "x"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    users = p.silver("users").select("user_id", "user_role", "is_email_verified")
    return lookup_join(p.silver("customers").select("customer_id", "user_id"), users, "user_id")


@op(
    "join_left_preagg",
    with_(
        gold_ctes("dim_restaurants"),
        final(
            "restaurant_id lifetime_fees_paid_usd:f total_base_fees_usd:f total_overage_fees_usd:f "
            "last_billing_date:s partner_segment",
            "g_dim_restaurants",
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline(spark, sf).dim_restaurants.select(
        "restaurant_id",
        "lifetime_fees_paid_usd",
        "total_base_fees_usd",
        "total_overage_fees_usd",
        "last_billing_date",
        "partner_segment",
    )


@op(
    "join_left_surrogate",
    with_(
        STAR | {"x": "SELECT o.*, p.ok, p.last.m AS m FROM g_fct_orders o LEFT JOIN pay p USING (order_id)"},
        "SELECT CAST(order_at AS VARCHAR) AS order_at, order_status, "
        "CAST(total_paid_amount AS DOUBLE) AS total_paid_amount, "
        "CAST(ok AS BIGINT) AS has_success_payment, m AS latest_payment_method FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf)
    joined = p.fct_orders.join(marts.payments_summary(p.fct_payments), "order_sk", "left")
    return joined.select(
        "order_at", "order_status", "total_paid_amount", "has_success_payment", "latest_payment_method"
    )


@op(
    "join_star_multi",
    with_(
        STAR,
        final(
            "order_date:s order_week:s order_month:s customer_value_segment customer_lifecycle "
            "customer_city customer_state restaurant_name cuisine_type merchant_tier restaurant_city "
            "latest_payment_method order_status total_paid_amount:f commission:f",
            "star",
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline(spark, sf).star_orders.select(
        *marts.REVENUE_GRAIN, "order_status", "total_paid_amount", "commission"
    )


# --- aggregates, order, ad-hoc -------------------------------------------------------


@op(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(l_shipdate) AS n_shipped,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(max(l_shipdate) AS VARCHAR) AS last_ship FROM lineitem GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.count("l_shipdate").alias("n_shipped"),
        F.sum(fx.money("l_extendedprice")).alias("total"),
        F.max("l_shipdate").alias("last_ship"),
    )


@op(
    "agg_ordinal",
    """SELECT l_linestatus, l_returnflag, count(*) AS n, max(l_quantity) AS largest
       FROM lineitem GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT l_linestatus, l_returnflag, count(*) AS n, max(l_quantity) AS largest "
        "FROM {lineitem} GROUP BY 1, 2",
        lineitem=table(spark, sf, "lineitem"),
    )


@op(
    "agg_conditional",
    """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned,
       CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0) AS DOUBLE)
           AS returned_value FROM lineitem GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        fx.count_if_true(returned).alias("returned"),
        fx.sum_if(returned, fx.money("l_extendedprice")).alias("returned_value"),
    )


@op(
    "agg_safe_ratio",
    f"""SELECT l_suppkey, {pct("count(*) FILTER (l_returnflag = 'R')", "count(*)")} AS return_pct,
        {ratio("sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R')",
               "count(*) FILTER (l_returnflag = 'R')")} AS avg_returned FROM lineitem GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"),
        fx.count_if_true(returned).alias("n_returned"),
        fx.sum_if(returned, fx.money("l_extendedprice")).alias("value"),
    )
    return sums.select(
        "l_suppkey",
        fx.percent(F.col("n_returned"), F.col("n")).alias("return_pct"),
        fx.safe_ratio(F.col("value"), F.col("n_returned")).alias("avg_returned"),
    )


@op(
    "sort_mart",
    with_(
        SUBSCRIPTION
        | {
            "x": "SELECT *, row_number() OVER (ORDER BY invoice_date DESC NULLS FIRST, "
            "recognized_recurring_revenue_usd DESC NULLS FIRST, invoice_week NULLS LAST, "
            "invoice_month NULLS LAST, restaurant_name NULLS LAST, cuisine_type NULLS LAST, "
            "restaurant_city NULLS LAST, plan_tier NULLS LAST, billing_period NULLS LAST) AS _ FROM subs"
        },
        final(SUBSCRIPTION_COLUMNS, "x") + " ORDER BY _",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sorted_mart(
        pipeline(spark, sf).mart_subscription,
        "invoice_date",
        "recognized_recurring_revenue_usd",
        marts.SUBSCRIPTION_GRAIN,
    )


@op(
    "sort_mart_revenue",
    f"SELECT * FROM ({mart_revenue}) ORDER BY order_date DESC NULLS FIRST, "
    f"gross_revenue_usd DESC NULLS FIRST, {', '.join(f'{c} NULLS LAST' for c in marts.REVENUE_GRAIN[1:])}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sorted_mart(
        pipeline(spark, sf).mart_revenue, "order_date", "gross_revenue_usd", marts.REVENUE_GRAIN
    )


@op(
    "adhoc_distinct_limit",
    f"SELECT DISTINCT churn_risk FROM {b('customers')} ORDER BY churn_risk NULLS FIRST LIMIT 10",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        "SELECT DISTINCT churn_risk FROM {customers} ORDER BY churn_risk LIMIT 10",
        customers=bronze(spark, sf, "customers"),
    )
