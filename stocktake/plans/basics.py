"""Single operators: projections, filters, join forms, aggregates, sorts, scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.functions import scalar as S
from stocktake.operators.membership import not_in
from stocktake.operators.ordered import null_safe_join, number_rows
from stocktake.plans.registry import query, scaled
from stocktake.plans.sales import AS_OF, mean_of, per_customer, total
from stocktake.sources.tables import MONEY, TOTAL

# --- projections and filters ------------------------------------------------


@query(
    "f1_f2_projection_and_computed_column",
    """SELECT order_id, line_no, quantity * price AS list_value, quantity * price - line_total AS markdown
       FROM items JOIN products USING (product_id)""",
    money="list_value markdown",
)
def projection_and_computed_column(shop) -> DataFrame:
    lines = shop.items.join(shop.products.select("product_id", "price"), "product_id")
    listed = (F.col("quantity") * F.col("price")).cast(MONEY)
    return lines.select(
        "order_id", "line_no", listed.alias("list_value"),
        (listed - F.col("line_total")).alias("markdown"),
    )


@query(
    "f3_inequality_drops_null",
    """SELECT order_id, nullif(status, 'O') AS status FROM all_orders
       WHERE nullif(status, 'O') <> 'P'""",
)
def inequality_drops_null(shop) -> DataFrame:
    """A NULL status is neither equal nor unequal."""
    rows = shop.orders.select("order_id", F.nullif("status", F.lit("O")).alias("status"))
    return rows.where(F.col("status") != "P")


@query(
    "f4_conjunctive_equality",
    """SELECT order_id, amount FROM all_orders WHERE status = 'F' AND payment = '1-URGENT'""",
    money="amount",
)
def conjunctive_equality(shop) -> DataFrame:
    wanted = (F.col("status") == "F") & (F.col("payment") == "1-URGENT")
    return shop.orders.where(wanted).select("order_id", "amount")


@query(
    "f5_inclusive_range",
    """SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
    retail=False,
)
def inclusive_range(shop) -> DataFrame:
    """BETWEEN on timestamps: the upper bound is midnight, so the last day drops out."""
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20"))
    return shop.events.where(F.col("ts").between(low, high)).select("event_id")


@query(
    "f6_half_open_year",
    "SELECT order_id, amount FROM all_orders WHERE year(order_date) = 1998",
    money="amount",
)
def half_open_year(shop) -> DataFrame:
    """A year as a half-open range: both bounds reach the parquet scan."""
    return shop.orders.where(S.in_year(F.col("ordered_at"), 1998)).select("order_id", "amount")


@query(
    "f7_extract_year",
    "SELECT order_id, amount FROM all_orders WHERE year(order_date) = 1999",
    money="amount",
)
def extract_year(shop) -> DataFrame:
    """The same filter on the extracted year; it cannot be pushed, prefer the range."""
    return shop.orders.where(F.year("ordered_at") == 1999).select("order_id", "amount")


@query(
    "f8_null_tests",
    """SELECT (o.order_id IS NULL) AS never_ordered, count(*) AS n FROM customers c
       LEFT JOIN all_orders o ON c.customer_id = o.customer_id GROUP BY 1""",
)
def null_tests(shop) -> DataFrame:
    joined = shop.people.join(per_customer(shop.orders), "customer_id", "left")
    rows = F.coalesce("orders", F.lit(1))  # an unmatched customer is one row
    return joined.groupBy(F.col("orders").isNull().alias("never_ordered")).agg(F.sum(rows).alias("n"))


@query(
    "f8_customers_without_urgent_order",
    """SELECT (o.order_id IS NULL) AS never_urgent, count(*) AS n FROM customers c
       LEFT JOIN all_orders o ON c.customer_id = o.customer_id AND payment = '1-URGENT' GROUP BY 1""",
)
def null_tests_urgent(shop) -> DataFrame:
    urgent = per_customer(shop.orders.where(F.col("payment") == "1-URGENT"))
    joined = shop.people.join(urgent, "customer_id", "left")
    rows = F.coalesce("orders", F.lit(1))
    return joined.groupBy(F.col("orders").isNull().alias("never_urgent")).agg(F.sum(rows).alias("n"))


@query(
    "f9_case_classes",
    """SELECT CASE WHEN amount >= 400000 THEN 'large' WHEN amount >= 100000 THEN 'medium'
                   ELSE 'small' END AS class, count(*) AS n, sum(amount) AS total
       FROM all_orders GROUP BY 1""",
    money="total",
)
def case_classes(shop) -> DataFrame:
    amount = F.col("amount")
    label = F.when(amount >= 400_000, "large").when(amount >= 100_000, "medium").otherwise("small")
    return shop.orders.groupBy(label.alias("class")).agg(
        F.count(F.lit(1)).alias("n"), total("amount").alias("total")
    )


@query(
    "f10_relative_date",
    """SELECT customer_id, signup_date FROM (
         SELECT customer_id, min(order_date) AS signup_date FROM all_orders GROUP BY 1)
       WHERE signup_date > DATE '2001-08-02' - INTERVAL 72 MONTH""",
    dates="signup_date",
)
def relative_date(shop) -> DataFrame:
    """Signed up in the last 72 months, counted back from an explicit date."""
    return shop.signups.where(F.col("signup_date") > F.add_months(F.lit(AS_OF), -72))


@query("f18_pass_through", "SELECT * FROM part", retail=False)
def pass_through(shop) -> DataFrame:
    return shop.table("part").select("*")


# --- join forms -------------------------------------------------------------


@query(
    "j4_left_join_filtered_right",
    """SELECT c.customer_id, count(o.order_id) AS orders, coalesce(sum(o.amount), 0) AS spent
       FROM customers c LEFT JOIN all_orders o
         ON c.customer_id = o.customer_id AND o.payment = '1-URGENT' GROUP BY 1""",
    money="spent",
)
def left_join_filtered_right(shop) -> DataFrame:
    """A condition on the right side inside ON: filter first, keep every left row."""
    urgent = per_customer(shop.orders.where(F.col("payment") == "1-URGENT"))
    return shop.people.join(urgent, "customer_id", "left").select(
        "customer_id",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("spent", F.lit(0).cast(TOTAL)).alias("spent"),
    )


def _without_order(shop, condition: str) -> DataFrame:
    """Correlated NOT EXISTS in SQL; Catalyst turns it into an anti join."""
    frames = {"c": shop.people, "o": shop.orders}
    return shop.spark.sql(
        f"""SELECT customer_id, customer_name FROM {{c}} AS c WHERE NOT EXISTS (
             SELECT 1 FROM (SELECT DISTINCT customer_id FROM {{o}} WHERE {condition}) AS o
             WHERE o.customer_id = c.customer_id)""",
        **frames,
    )


@query(
    "j7_not_exists",
    """SELECT customer_id, customer_name FROM customers c WHERE NOT EXISTS (
         SELECT 1 FROM all_orders o WHERE o.customer_id = c.customer_id)""",
)
def not_exists(shop) -> DataFrame:
    return _without_order(shop, "TRUE")


@query(
    "j7_not_exists_urgent",
    """SELECT customer_id, customer_name FROM customers c WHERE NOT EXISTS (
         SELECT 1 FROM all_orders o WHERE o.customer_id = c.customer_id AND o.payment = '1-URGENT')""",
)
def not_exists_urgent(shop) -> DataFrame:
    return _without_order(shop, "payment = '1-URGENT'")


def _compared(shop, clean: DataFrame, holed: DataFrame) -> DataFrame:
    """NOT IN against a clean set, and against one that holds a NULL."""
    counts = [
        not_in(shop.people, "customer_id", right, "customer_id").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("variant"), "n")
        for name, right in (("no null", clean), ("with null", holed))
    ]
    return counts[0].unionByName(counts[1])


@query(
    "j8_null_aware_not_in",
    """SELECT 'no null' AS variant, count(*) AS n FROM customers WHERE customer_id NOT IN (
         SELECT customer_id FROM all_orders WHERE customer_id IS NOT NULL)
       UNION ALL SELECT 'with null', count(*) FROM customers WHERE customer_id NOT IN (
         SELECT customer_id FROM all_orders UNION ALL SELECT NULL)""",
)
def null_aware_not_in(shop) -> DataFrame:
    """All orders' customers, and the same with an order whose customer is not known."""
    unknown = shop.spark.range(1).select(F.lit(None).cast("long").alias("customer_id"))
    clean = shop.orders.select("customer_id").where("customer_id IS NOT NULL")
    return _compared(shop, clean, shop.orders.select("customer_id").unionByName(unknown))


@query(
    "j8_null_aware_not_in_urgent",
    """SELECT 'no null' AS variant, count(*) AS n FROM customers WHERE customer_id NOT IN (
         SELECT customer_id FROM all_orders WHERE payment = '1-URGENT')
       UNION ALL SELECT 'with null', count(*) FROM customers WHERE customer_id NOT IN (
         SELECT CASE WHEN payment = '1-URGENT' THEN customer_id END FROM all_orders)""",
)
def null_aware_not_in_urgent(shop) -> DataFrame:
    urgent = F.col("payment") == "1-URGENT"
    holed = shop.orders.select(F.when(urgent, F.col("customer_id")).alias("customer_id"))
    return _compared(shop, shop.orders.where(urgent), holed)


@query(
    "j20_right_join",
    """SELECT p.product_id, p.category, b.lines FROM
       (SELECT product_id, count(*) AS lines FROM items GROUP BY 1) b
       RIGHT JOIN products p ON b.product_id = p.product_id""",
)
def right_join(shop) -> DataFrame:
    sold = shop.items.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    return sold.join(shop.products, "product_id", "right").select("product_id", "category", "lines")


@query(
    "j13_join_to_prepared_stats",
    """SELECT product_id, product_name, coalesce(n, 0) AS lines, worth FROM products
       LEFT JOIN (SELECT product_id, count(*) AS n, sum(line_total) AS worth FROM items
                  GROUP BY 1) USING (product_id)""",
    money="worth",
)
def join_to_prepared_stats(shop) -> DataFrame:
    stats = shop.items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), total("line_total").alias("worth")
    )
    return shop.products.join(stats, "product_id", "left").select(
        "product_id", "product_name", F.coalesce("n", F.lit(0)).alias("lines"), "worth"
    )


# --- aggregates -------------------------------------------------------------


@query(
    "a1_a7_aggregate_functions",
    f"""SELECT return_flag, line_status, count(*) AS all_rows,
               count(CASE WHEN quantity > 25 THEN quantity END) AS large_rows,
               sum(line_total) AS revenue, {scaled('sum(line_cents)', 'count(*)', 0)} / 100 AS mean,
               min(ship_date) AS first_day, max(ship_date) AS last_day,
               coalesce(sum(CASE WHEN quantity > 99 THEN line_total END), 0) AS none_sum
        FROM items GROUP BY return_flag, line_status""",
    money="revenue none_sum", dates="first_day last_day",
)
def aggregate_functions(shop) -> DataFrame:
    """Count with and without NULLs, sum, rounded average, min, max, null-safe total."""
    quantity = F.col("quantity")
    return shop.items.groupBy("return_flag", "line_status").agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count(F.when(quantity > 25, quantity)).alias("large_rows"),
        total("line_total").alias("revenue"),
        mean_of(F.sum("line_total"), F.count(F.lit(1))).alias("mean"),
        F.min("ship_date").alias("first_day"),
        F.max("ship_date").alias("last_day"),
        F.coalesce(F.sum(F.when(quantity > 99, F.col("line_total"))).cast(TOTAL), F.lit(0))
        .cast(TOTAL).alias("none_sum"),
    )


@query(
    "a3_several_distinct_counts",
    """SELECT return_flag, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products
       FROM items GROUP BY return_flag""",
)
def several_distinct_counts(shop) -> DataFrame:
    """Two exact distinct counts: each is spread over (group, value) before it is
    counted, so a large group is not counted in one task."""

    def distinct(column: str, name: str) -> DataFrame:
        return shop.items.groupBy("return_flag").agg(F.countDistinct(column).alias(name))

    orders, products = distinct("order_id", "orders"), distinct("product_id", "products")
    return null_safe_join(orders, products, ["return_flag"], "inner")


@query(
    "a8_conditional_counts",
    """SELECT c.segment, count(CASE WHEN status = 'F' THEN 1 END) AS finished,
              count(CASE WHEN status = 'O' THEN 1 END) AS open,
              count(CASE WHEN status = 'P' AND amount > 400000 THEN 1 END) AS large_pending
       FROM all_orders JOIN customers c USING (customer_id) GROUP BY c.segment""",
)
def conditional_counts(shop) -> DataFrame:
    status = F.col("status")
    counts = {
        "finished": status == "F",
        "open": status == "O",
        "large_pending": (status == "P") & (F.col("amount") > 400_000),
    }
    per_buyer = shop.orders.groupBy("customer_id").agg(
        *[F.count_if(c).alias(n) for n, c in counts.items()]
    )
    return (
        per_buyer.join(shop.people.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(*[F.sum(n).alias(n) for n in counts])
    )


@query(
    "a10_group_by_month_and_status",
    """SELECT strftime(order_date, '%Y-%m') AS month, status, count(*) AS n, sum(amount) AS total
       FROM all_orders GROUP BY 1, 2""",
    money="total",
)
def group_by_month_and_status(shop) -> DataFrame:
    return shop.orders.groupBy(S.month_label(F.col("order_date")).alias("month"), "status").agg(
        F.count(F.lit(1)).alias("n"), total("amount").alias("total")
    )


@query(
    "a11_a12_where_group_having",
    """SELECT product_id, count(*) AS n, sum(line_total) AS revenue FROM items
       WHERE return_flag <> 'R' GROUP BY product_id HAVING count(*) > 20 AND sum(line_total) > 1000000""",
    money="revenue",
)
def where_group_having(shop) -> DataFrame:
    return (
        shop.items.where(F.col("return_flag") != "R")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"), total("line_total").alias("revenue"))
        .where((F.col("n") > 20) & (F.col("revenue") > 1_000_000))
    )


@query(
    "a13_average_of_sums",
    f"""SELECT category, {scaled('sum(cents)', 'count(cents)', 0)} / 100 AS avg_revenue, count(*) AS products
        FROM (SELECT category, p.product_id, sum(line_cents) AS cents FROM products p
              LEFT JOIN items i ON p.product_id = i.product_id
              GROUP BY 1, 2) GROUP BY category""",
)
def average_of_sums(shop) -> DataFrame:
    """Average over products of their sums; products without a sale have no sum."""
    sums = shop.items.groupBy("product_id").agg(
        total("line_total").alias("revenue")
    )
    rows = shop.products.select("product_id", "category").join(sums, "product_id", "left")
    return rows.groupBy("category").agg(
        mean_of(F.sum("revenue"), F.count("revenue")).alias("avg_revenue"),
        F.count(F.lit(1)).alias("products"),
    )


# --- sorts ------------------------------------------------------------------


@query(
    "k1_k2_sort_with_nulls_last",
    """SELECT customer_id, segment, spent, row_number() OVER () AS place FROM (
         SELECT c.customer_id, segment, sum(amount) AS spent FROM customers c
         LEFT JOIN all_orders o ON c.customer_id = o.customer_id GROUP BY 1, 2
         ORDER BY segment, spent DESC NULLS LAST, c.customer_id)""",
    money="spent",
)
def sort_with_nulls_last(shop) -> DataFrame:
    """Several sort keys, NULLs last; the place in the order is part of the result."""
    spent = per_customer(shop.orders)
    rows = shop.people.join(spent, "customer_id", "left").select("customer_id", "segment", "spent")
    return number_rows(rows, ["segment", "-spent", "customer_id"], "place")


@query(
    "k3_top_k",
    """SELECT order_id, amount FROM all_orders ORDER BY amount DESC, order_id LIMIT 25""",
    money="amount",
)
def top_k(shop) -> DataFrame:
    return (
        shop.orders.select("order_id", "amount").orderBy(F.desc("amount"), "order_id").limit(25)
    )


# --- scalar functions -------------------------------------------------------


@query(
    "x_string_functions",
    """SELECT customer_id, customer_name || ' ' || segment AS label,
              customer_name || ' ' || CASE WHEN segment <> 'BUILDING' THEN segment END AS broken_label,
              lower(trim('  ' || segment || ' ')) AS folded,
              replace(segment, 'U', '''') AS quoted,
              customer_id || '_item_' || (customer_id % 7 + 1) AS item_id FROM customers""",
)
def string_functions(shop) -> DataFrame:
    """Concatenation (NULL propagates), trimming, replacing, id formats."""
    segment = F.col("segment")
    padded = F.concat(F.lit("  "), segment, F.lit(" "))
    number = (F.col("customer_id") % 7 + 1).cast("string")
    return shop.people.select(
        "customer_id",
        S.full_name(F.col("customer_name"), segment).alias("label"),
        S.full_name(F.col("customer_name"), F.when(segment != "BUILDING", segment)).alias("broken_label"),
        F.lower(F.trim(padded)).alias("folded"),
        F.replace(segment, F.lit("U"), F.lit("'")).alias("quoted"),
        F.concat(F.col("customer_id").cast("string"), F.lit("_item_"), number).alias("item_id"),
    )


@query(
    "x_date_functions",
    """SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month,
              strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS label,
              rpad(dayname(ts), 9, ' ') AS weekday,
              CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-29') AS INTEGER) AS days_left,
              strftime(CAST(ts AS DATE) - INTERVAL 6 MONTH, '%Y-%m-%d') AS half_year_before,
              CAST(date_diff('month', DATE '2024-03-01', date_trunc('month', ts)) AS INTEGER) AS months,
              CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
              CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, isodow(ts) >= 6 AS weekend
       FROM events""",
    retail=False,
)
def date_functions(shop) -> DataFrame:
    day = F.col("ts").cast("date")
    march = F.lit(dt.date(2024, 3, 1))
    return shop.events.select(
        "event_id",
        S.month_of(F.col("ts")).alias("month"),
        day.alias("day"),
        S.month_label(F.col("ts")).alias("label"),
        S.padded_day_name(day).alias("weekday"),
        F.datediff(F.lit(dt.date(2024, 2, 29)), day).alias("days_left"),
        F.add_months(day, -6).alias("half_year_before"),
        S.months_between_months(S.month_of(F.col("ts")), march).alias("months"),
        F.year("ts").alias("year"),
        F.quarter("ts").alias("quarter"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"),
        (F.weekday(day) >= 5).alias("weekend"),
    )


@query(
    "x_number_functions",
    f"""SELECT order_id, line_no, product_id,
               CAST({scaled('line_cents', 'quantity', 0)} AS DOUBLE) / 100 AS unit_price,
               CAST({scaled('line_cents * 10', 'nullif(discount_pct, 0)', 1)} AS DOUBLE) AS per_point,
               coalesce(nullif(discount_pct, 0), -1)::BIGINT AS discount_or_none,
               CASE WHEN regexp_full_match(CAST(line_total AS VARCHAR), '[0-9]+\\.00')
                    THEN CAST(line_total AS BIGINT) END AS whole
        FROM items""",
)
def number_functions(shop) -> DataFrame:
    """Rounding half away from zero, NULLIF guards, COALESCE, casts that may fail."""
    points = (F.col("discount") * 100).cast("decimal(10,0)")
    money = F.col("line_total")
    guarded = F.nullif(F.abs(points), F.lit(0).cast("decimal(10,0)"))
    text = F.regexp_replace(money.cast("string"), r"\.00$", "")
    return shop.items.select(
        "order_id", "line_no", "product_id",
        F.round(money / F.col("quantity"), 2).alias("unit_price"),
        F.round(money * 1000 / guarded, 1).alias("per_point"),
        F.coalesce(guarded, F.lit(-1)).cast("long").alias("discount_or_none"),
        S.parse_as(text, "int").alias("whole"),
    )
