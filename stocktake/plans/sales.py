"""Sales reports: joins, aggregates, views and CTE-style analyses.

Functions take a ``shop`` with DataFrames ``customers``, ``orders``, ``sales`` (orders
that count), ``items``, ``products`` and ``signups``. Facts are aggregated to the
join key before they meet a dimension, so a customer or product that owns a large
share of the rows is reduced on the map side and fewer rows are shuffled.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktake.functions import scalar as S
from stocktake.operators.ordered import dense_rank_by
from stocktake.plans.registry import half_up, query, scaled
from stocktake.session import broadcast_if_few
from stocktake.sources.tables import TOTAL

AS_OF = dt.date(2001, 8, 2)


def total(c: str) -> Column:
    return F.sum(c).cast(TOTAL)


def mean_of(sum_: Column, n: Column) -> Column:
    """Average to cents from a sum and a count, half away from zero."""
    return F.round(sum_.cast(TOTAL) / F.nullif(n.cast("decimal(15,0)"), F.lit(0)), 2)


def unit_price() -> Column:
    """What a line was sold at a piece, in cents."""
    return mean_of(F.col("line_total"), F.col("quantity"))


def per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), total("amount").alias("spent")
    )


# --- joins ------------------------------------------------------------------


@query(
    "b1_order_list",
    """SELECT order_id, order_date, status, amount, customer_name, nation, region
       FROM all_orders JOIN customers USING (customer_id)""",
    money="amount", dates="order_date",
)
def order_list(shop) -> DataFrame:
    """Every order with its customer, by date."""
    return (
        shop.orders.join(shop.customers, "customer_id")
        .select("order_id", "order_date", "status", "amount", "customer_name", "nation", "region")
        .orderBy("order_date", "order_id")
    )


@query(
    "b2_revenue_by_region",
    f"""SELECT region, count(*) AS total_orders, sum(amount) AS total_revenue,
               {scaled('sum(cents)', 'count(*)', 0)} / 100 AS avg_order_value
        FROM sales JOIN customers USING (customer_id) GROUP BY region""",
    money="total_revenue",
)
def revenue_by_region(shop) -> DataFrame:
    """Orders, revenue and average order value per region."""
    return (
        per_customer(shop.sales)
        .join(shop.customers.select("customer_id", "region"), "customer_id")
        .groupBy("region")
        .agg(F.sum("orders").alias("total_orders"), total("spent").alias("total_revenue"))
        .withColumn("avg_order_value", mean_of(F.col("total_revenue"), F.col("total_orders")))
        .orderBy(F.desc("total_revenue"))
    )


@query(
    "b3_customer_lifetime_value",
    """SELECT c.customer_id, customer_name, region, count(o.order_id) AS total_orders,
              coalesce(sum(o.amount), 0) AS lifetime_value
       FROM customers c LEFT JOIN all_orders o ON c.customer_id = o.customer_id
       GROUP BY ALL""",
    money="lifetime_value",
)
def customer_lifetime_value(shop) -> DataFrame:
    """All customers, with zero for those that never ordered."""
    return (
        shop.customers.join(per_customer(shop.orders), "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "region",
            F.coalesce("orders", F.lit(0)).alias("total_orders"),
            F.coalesce("spent", F.lit(0).cast(TOTAL)).alias("lifetime_value"),
        )
        .orderBy(F.desc("lifetime_value"))
    )


# The right side of an anti join is not split when it is skewed, so its keys are made
# distinct first: repeated keys fall away on the map side.


def never_ordered(customers: DataFrame, orders: DataFrame) -> DataFrame:
    buyers = orders.select("customer_id").distinct()
    return customers.join(buyers, "customer_id", "left_anti")


def never_sold(products: DataFrame, items: DataFrame) -> DataFrame:
    sold = items.select("product_id").distinct()
    return products.join(sold, "product_id", "left_anti")


@query(
    "b4_customers_without_urgent_order",
    """SELECT c.customer_id, customer_name, region FROM customers c
       LEFT JOIN all_orders o ON c.customer_id = o.customer_id AND payment = '1-URGENT'
       WHERE o.order_id IS NULL""",
)
def customers_without_urgent_order(shop) -> DataFrame:
    """Anti join, written directly as one."""
    urgent = shop.orders.where(F.col("payment") == "1-URGENT")
    return never_ordered(shop.customers, urgent).select("customer_id", "customer_name", "region")


@query(
    "b5_products_without_bulk_line",
    """SELECT p.product_id, product_name, price, category FROM products p
       LEFT JOIN items i ON p.product_id = i.product_id AND quantity >= 50
       WHERE i.order_id IS NULL""",
    money="price",
)
def products_without_bulk_line(shop) -> DataFrame:
    """Anti join next to the product's lookup columns."""
    bulk = shop.items.where(F.col("quantity") >= 50)
    return never_sold(shop.products, bulk).select(
        "product_id", "product_name", "price", "category"
    )


def order_details(shop) -> DataFrame:
    """Order line view over the five tables; facts first, dimensions after."""
    return (
        shop.items.join(shop.orders, "order_id")
        .join(shop.customers, "customer_id")
        .join(shop.products.select("product_id", "product_name", "category"), "product_id")
    )


@query(
    "b7_order_line_receipts",
    f"""SELECT order_id, order_date, status, customer_name, region, category, product_name, line_no,
               quantity, {scaled('line_cents', 'quantity', 0)} / 100 AS unit_price, line_total,
               amount AS order_total
        FROM items JOIN all_orders USING (order_id) JOIN customers USING (customer_id)
        JOIN products USING (product_id) ORDER BY order_id, line_no""",
    money="line_total order_total", dates="order_date",
)
def order_line_receipts(shop) -> DataFrame:
    """One row per order line with customer and product, in the order of the lines."""
    return order_details(shop).select(
        "order_id", "order_date", "status", "customer_name", "region", "category",
        "product_name", "line_no", "quantity", unit_price().alias("unit_price"), "line_total",
        F.col("amount").alias("order_total"),
    ).orderBy("order_id", "line_no")


@query(
    "b8_top_customers_by_spend",
    f"""SELECT c.customer_id, customer_name, region, count(DISTINCT o.order_id) AS total_orders,
               sum(line_total) AS total_spent,
               {scaled('sum(cents)', 'count(cents)', 0)} / 100 AS avg_order_value,
               (SELECT {scaled('sum(x.cents)', 'count(*)', 0)} / 100 FROM all_orders x
                WHERE x.customer_id = c.customer_id) AS avg_per_order
        FROM customers c LEFT JOIN all_orders o ON c.customer_id = o.customer_id
        LEFT JOIN items i ON o.order_id = i.order_id
        GROUP BY c.customer_id, customer_name, region""",
    money="total_spent",
)
def top_customers_by_spend(shop) -> DataFrame:
    """Spend from order lines. ``avg_order_value`` weighs each order by its number of
    lines, as the fan-out of the plain join does; ``avg_per_order`` does not. Lines are
    folded into their order first, so no distinct count over fanned-out rows is needed."""
    lines = shop.items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), total("line_total").alias("line_sum")
    )
    weight = F.coalesce("lines", F.lit(1))
    spend = (
        shop.orders.join(lines, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            total("line_sum").alias("total_spent"),
            F.sum(F.col("amount") * weight).cast(TOTAL).alias("weighted"),
            F.sum(weight).alias("weight"),
            total("amount").alias("plain"),
        )
    )
    return (
        shop.customers.join(spend, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "region",
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            "total_spent",
            mean_of(F.col("weighted"), F.col("weight")).alias("avg_order_value"),
            mean_of(F.col("plain"), F.col("total_orders")).alias("avg_per_order"),
        )
        .orderBy(F.desc_nulls_last("total_spent"))
    )


def region_top_customers(shop, top: int = 3) -> DataFrame:
    spend = per_customer(shop.sales).join(shop.customers, "customer_id")
    best = Window.partitionBy("region").orderBy(F.desc("spent"))
    return spend.withColumn("rank_in_region", F.dense_rank().over(best)).where(
        F.col("rank_in_region") <= top
    )


@query(
    "b25_top_customers_per_region",
    """SELECT * FROM (
         SELECT region, customer_name, sum(amount) AS total_spent,
                dense_rank() OVER (PARTITION BY region ORDER BY sum(amount) DESC) AS rank_in_region
         FROM sales JOIN customers USING (customer_id)
         GROUP BY region, customer_id, customer_name) WHERE rank_in_region <= 3""",
    money="total_spent", ints="rank_in_region",
)
def top_customers_per_region(shop) -> DataFrame:
    """Three best-spending customers of each region; the rank limit is applied before
    the shuffle."""
    return (
        region_top_customers(shop)
        .select("region", "customer_name", F.col("spent").alias("total_spent"), "rank_in_region")
        .orderBy("region", "rank_in_region")
    )


def repeat_customers(shop, min_average: int) -> DataFrame:
    return (
        per_customer(shop.sales)
        .where((F.col("orders") > 1) & (F.col("spent") / F.col("orders") > min_average))
        .join(shop.customers, "customer_id")
        .select(
            "customer_name",
            F.col("orders").alias("order_count"),
            mean_of(F.col("spent"), F.col("orders")).alias("avg_order_value"),
            F.col("spent").alias("total_spent"),
        )
        .orderBy(F.desc("avg_order_value"))
    )


@query(
    "b26_repeat_customers_high_average",
    f"""SELECT customer_name, count(*) AS order_count,
               {scaled('sum(cents)', 'count(*)', 0)} / 100 AS avg_order_value,
               sum(amount) AS total_spent
        FROM sales JOIN customers USING (customer_id) GROUP BY customer_id, customer_name
        HAVING count(*) > 1 AND sum(cents) > 30000000 * count(*)""",
    money="total_spent",
)
def repeat_customers_high_average(shop) -> DataFrame:
    """HAVING on two aggregates, applied before the customer join."""
    return repeat_customers(shop, 300_000)


@query(
    "b28_popular_payment_per_region",
    """SELECT region, payment, n AS orders FROM (
         SELECT region, payment, count(*) AS n,
                rank() OVER (PARTITION BY region ORDER BY count(*) DESC) AS r
         FROM all_orders JOIN customers USING (customer_id) GROUP BY region, payment)
       WHERE r = 1""",
)
def popular_payment_per_region(shop) -> DataFrame:
    """Most used payment method per region; ties are kept."""
    used = shop.orders.groupBy("customer_id", "payment").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        used.join(shop.customers.select("customer_id", "region"), "customer_id")
        .groupBy("region", "payment")
        .agg(F.sum("n").alias("orders"))
    )
    best = Window.partitionBy("region").orderBy(F.desc("orders"))
    return counts.withColumn("r", F.rank().over(best)).where("r = 1").drop("r")


@query(
    "b29_orders_of_region_in_range",
    """SELECT order_id, amount, order_date, region
       FROM all_orders JOIN customers USING (customer_id)
       WHERE region = 'ASIA' AND order_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'""",
    money="amount", dates="order_date",
)
def orders_of_region_in_range(shop) -> DataFrame:
    """Region equality and an inclusive timestamp range, both pushed to the scan."""
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1998-03-31"))
    return (
        shop.orders.where(F.col("ordered_at").between(low, high))
        .join(shop.customers.where(F.col("region") == "ASIA"), "customer_id")
        .select("order_id", "amount", "order_date", "region")
    )


@query(
    "b33_table_row_counts",
    """SELECT 'categories' AS table_name, count(DISTINCT category) AS row_count FROM products
       UNION ALL SELECT 'products', count(*) FROM products
       UNION ALL SELECT 'customers', count(*) FROM customers
       UNION ALL SELECT 'orders', count(*) FROM all_orders
       UNION ALL SELECT 'order_items', count(*) FROM items""",
)
def table_row_counts(shop) -> DataFrame:
    """UNION ALL of one count per table."""
    tables = {
        "categories": shop.products.select("category").distinct(),
        "products": shop.products,
        "customers": shop.customers,
        "orders": shop.orders,
        "order_items": shop.items,
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


# --- CTE analyses -----------------------------------------------------------


def established_high_value(
    shop, as_of: dt.date, min_value: int, months: int = 6
) -> DataFrame:
    """Customers signed up for at least ``months`` whose lifetime value is above
    ``min_value``, densely ranked over the whole set."""
    value = shop.sales.groupBy("customer_id").agg(
        total("amount").alias("lifetime_value"),
        F.count("order_id").alias("total_orders"),
        F.max("order_date").alias("last_order_date"),
    )
    chosen = (
        value.where(F.col("lifetime_value") > min_value)
        .join(shop.signups, "customer_id")
        .where(F.col("signup_date") <= F.add_months(F.lit(as_of), -months))
        .join(shop.customers, "customer_id")
    )
    return dense_rank_by(chosen, "lifetime_value", "value_rank").select(
        "value_rank", "customer_name", "region", "segment", "lifetime_value", "total_orders",
        "last_order_date",
        F.datediff(F.lit(as_of), "last_order_date").alias("days_since_last_order"),
    )


@query(
    "b17_established_high_value_customers",
    """SELECT dense_rank() OVER (ORDER BY lifetime_value DESC) AS value_rank, customer_name, region,
              segment, lifetime_value, total_orders, last_order_date,
              CAST(DATE '2001-08-02' - last_order_date AS INTEGER) AS days_since_last_order
       FROM (SELECT c.customer_id, customer_name, region, segment,
                    coalesce(sum(s.amount), 0) AS lifetime_value, count(s.order_id) AS total_orders,
                    max(s.order_date) AS last_order_date,
                    (SELECT min(order_date) FROM all_orders a
                     WHERE a.customer_id = c.customer_id) AS signup_date
             FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
             GROUP BY c.customer_id, customer_name, region, segment)
       WHERE signup_date <= DATE '2001-02-02' AND lifetime_value > 1500000""",
    money="lifetime_value", dates="last_order_date",
)
def established_high_value_customers(shop) -> DataFrame:
    return established_high_value(shop, AS_OF, 1_500_000)


@query(
    "b18_product_vs_category_average",
    f"""SELECT category, product_id, product_name, coalesce(revenue, 0) AS revenue,
               avg_cents / 100.0 AS avg_revenue_in_category,
               (cents - avg_cents) / 100.0 AS vs_category_avg,
               {scaled('(cents - avg_cents) * 100', 'avg_cents', 1)} AS pct_vs_avg,
               CASE WHEN cents > avg_cents THEN 'Above Average'
                    WHEN cents = avg_cents THEN 'At Average' ELSE 'Below Average' END AS performance
        FROM (SELECT p.product_id, product_name, category, sum(line_total) AS revenue,
                     sum(line_cents) AS cents
              FROM products p
              LEFT JOIN items i ON p.product_id = i.product_id
              GROUP BY ALL)
        JOIN (SELECT category, {half_up('sum(cents)', 'count(cents)')} AS avg_cents
              FROM (SELECT category, product_id, sum(line_cents) AS cents FROM products
                    LEFT JOIN items USING (product_id)
                    GROUP BY ALL)
              GROUP BY category) USING (category)""",
    money="revenue avg_revenue_in_category vs_category_avg",
)
def product_vs_category_average_query(shop) -> DataFrame:
    return product_vs_category_average(shop.products, shop.items)


def product_vs_category_average(products: DataFrame, items: DataFrame) -> DataFrame:
    """Each product against the average product of its category. Products without a
    sale have no revenue: they do not enter the average and read 'Below Average'."""
    sold = items.groupBy("product_id").agg(total("line_total").alias("revenue"))
    revenue = products.select("product_id", "product_name", "category").join(
        sold, "product_id", "left"
    )
    average = revenue.groupBy("category").agg(
        mean_of(F.sum("revenue"), F.count("revenue")).alias("avg_revenue_in_category")
    )
    average = broadcast_if_few(average, products.select("category").distinct())
    gap = F.col("revenue") - F.col("avg_revenue_in_category")
    return revenue.join(average, "category").select(
        "category",
        "product_id",
        "product_name",
        F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("revenue"),
        "avg_revenue_in_category",
        gap.alias("vs_category_avg"),
        S.percent_change(F.col("revenue"), F.col("avg_revenue_in_category"), 1).alias("pct_vs_avg"),
        F.when(gap > 0, "Above Average")
        .when(gap == 0, "At Average")
        .otherwise("Below Average")
        .alias("performance"),
    )


def cohort_conversion(signups: DataFrame, orders: DataFrame) -> DataFrame:
    """Per signup month: how many ordered, and how many did so within 0..3 months
    (cumulative; an order before the signup month counts for 1..3 but not for 0)."""
    first = orders.groupBy("customer_id").agg(S.month_of(F.min("order_date")).alias("first_month"))
    behaviour = signups.select(
        "customer_id", S.month_of(F.col("signup_date")).alias("cohort_month")
    ).join(first, "customer_id", "left")
    gap = S.months_between_months(F.col("first_month"), F.col("cohort_month"))
    size, ordered, same = F.col("cohort_size"), F.col("customers_who_ordered"), F.col("ordered_month_0")
    return (
        behaviour.groupBy("cohort_month")
        .agg(
            F.count("customer_id").alias("cohort_size"),
            F.count("first_month").alias("customers_who_ordered"),
            F.count_if(gap == 0).alias("ordered_month_0"),
            *[F.count_if(gap <= m).alias(f"ordered_month_{m}") for m in (1, 2, 3)],
        )
        .withColumn("cohort", S.month_label(F.col("cohort_month")))
        .withColumn("overall_conversion_pct", S.share_percent(ordered, size, 1))
        .withColumn("same_month_pct", S.share_percent(same, size, 1))
        .drop("cohort_month")
        .orderBy("cohort")
    )


@query(
    "b19_signup_cohort_conversion",
    f"""SELECT strftime(cohort_month, '%Y-%m') AS cohort, count(*) AS cohort_size,
               count(first_month) AS customers_who_ordered,
               count(CASE WHEN gap = 0 THEN 1 END) AS ordered_month_0,
               count(CASE WHEN gap <= 1 THEN 1 END) AS ordered_month_1,
               count(CASE WHEN gap <= 2 THEN 1 END) AS ordered_month_2,
               count(CASE WHEN gap <= 3 THEN 1 END) AS ordered_month_3,
               {scaled('count(first_month) * 100', 'count(*)', 1)} AS overall_conversion_pct,
               {scaled('count(CASE WHEN gap = 0 THEN 1 END) * 100', 'count(*)', 1)} AS same_month_pct
        FROM (SELECT cohort_month, first_month, date_diff('month', cohort_month, first_month) AS gap
              FROM (SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month
                    FROM all_orders GROUP BY customer_id)
              LEFT JOIN (SELECT customer_id,
                                CAST(date_trunc('month', min(order_date)) AS DATE) AS first_month
                         FROM all_orders GROUP BY customer_id)
              USING (customer_id))
        GROUP BY cohort_month""",
)
def signup_cohort_conversion(shop) -> DataFrame:
    """Months from signup to the first order."""
    return cohort_conversion(shop.signups, shop.orders)


def date_spine(bounds: DataFrame, name: str = "date") -> DataFrame:
    """Every day of one-row ``bounds(first, last)``, both ends included."""
    return bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias(name)
    )


def span_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def daily_revenue(sales: DataFrame, bounds: DataFrame) -> DataFrame:
    """Revenue per day; days without sales stay with zero."""
    days = sales.groupBy("order_date").agg(
        total("amount").alias("revenue"), F.count("order_id").alias("n")
    )
    return (
        date_spine(bounds)
        .join(days.withColumnRenamed("order_date", "date"), "date", "left")
        .select(
            "date",
            S.padded_day_name(F.col("date")).alias("day_of_week"),
            F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("daily_revenue"),
            F.coalesce("n", F.lit(0)).alias("orders_count"),
        )
        .orderBy("date")
    )


@query(
    "b20_daily_revenue_over_spine",
    """SELECT date, rpad(dayname(date), 9, ' ') AS day_of_week,
              coalesce(sum(amount), 0) AS daily_revenue, count(order_id) AS orders_count
       FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))
                         AS DATE) AS date FROM all_orders)
       LEFT JOIN sales ON order_date = date GROUP BY date""",
    money="daily_revenue", dates="date",
)
def daily_revenue_over_spine(shop) -> DataFrame:
    return daily_revenue(shop.sales, span_of(shop.orders, "order_date"))


def customer_summary(
    customers: DataFrame, sales: DataFrame, as_of: dt.date, signups: DataFrame | None = None
) -> DataFrame:
    """Customer-360 view, with the signup date if ``signups`` is given. A customer with
    cancelled orders only reads 'Never Ordered'."""
    since = []
    if signups is not None:
        customers, since = customers.join(signups, "customer_id", "left"), ["signup_date"]
    stats = sales.groupBy("customer_id").agg(
        F.count("order_id").alias("n"),
        total("amount").alias("spent"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    idle = F.datediff(F.lit(as_of), "last_order_date")
    return customers.join(stats, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "region",
        "segment",
        *since,
        F.coalesce("n", F.lit(0)).alias("total_orders"),
        F.coalesce("spent", F.lit(0).cast(TOTAL)).alias("lifetime_value"),
        "first_order_date",
        "last_order_date",
        mean_of(F.col("spent"), F.col("n")).alias("avg_order_value"),
        idle.alias("days_since_last_order"),
        F.when(F.col("n").isNull(), "Never Ordered")
        .when(idle <= 30, "Active")
        .when(idle <= 90, "At Risk")
        .otherwise("Churned")
        .alias("customer_status"),
    )


SUMMARY_SQL = f"""
SELECT c.customer_id, customer_name, region, segment, count(s.order_id) AS total_orders,
       coalesce(sum(amount), 0) AS lifetime_value, min(order_date) AS first_order_date,
       max(order_date) AS last_order_date,
       {scaled('sum(cents)', 'count(s.order_id)', 0)} / 100 AS avg_order_value,
       CAST(DATE '2001-08-02' - max(order_date) AS INTEGER) AS days_since_last_order,
       CASE WHEN count(s.order_id) = 0 THEN 'Never Ordered'
            WHEN DATE '2001-08-02' - max(order_date) <= 30 THEN 'Active'
            WHEN DATE '2001-08-02' - max(order_date) <= 90 THEN 'At Risk'
            ELSE 'Churned' END AS customer_status
FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
GROUP BY c.customer_id, customer_name, region, segment"""


@query(
    "b21_customer_summary",
    f"""SELECT s.*, signup_date FROM ({SUMMARY_SQL}) s LEFT JOIN (
          SELECT customer_id, min(order_date) AS signup_date FROM all_orders GROUP BY 1)
        USING (customer_id)""",
    money="lifetime_value", dates="first_order_date last_order_date signup_date",
)
def customer_summary_view(shop) -> DataFrame:
    return customer_summary(shop.customers, shop.sales, AS_OF, shop.signups)


@query(
    "b22_churned_customers",
    f"""SELECT customer_id, customer_name, lifetime_value, days_since_last_order
        FROM ({SUMMARY_SQL}) WHERE customer_status = 'Churned'""",
    money="lifetime_value",
)
def churned_customers(shop) -> DataFrame:
    summary = customer_summary(shop.customers, shop.sales, AS_OF)
    return summary.where(F.col("customer_status") == "Churned").select(
        "customer_id", "customer_name", "lifetime_value", "days_since_last_order"
    )


@query(
    "b22_top_lifetime_value",
    f"""SELECT customer_id, customer_name, lifetime_value FROM ({SUMMARY_SQL})
        ORDER BY lifetime_value DESC, customer_id LIMIT 5""",
    money="lifetime_value",
)
def top_lifetime_value(shop) -> DataFrame:
    """Top five: sort and limit fuse into a per-partition top-k."""
    return (
        customer_summary(shop.customers, shop.sales, AS_OF)
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(5)
        .select("customer_id", "customer_name", "lifetime_value")
    )


@query(
    "b23_product_performance",
    f"""SELECT p.product_id, product_name, price AS current_price, category,
               coalesce(sum(quantity), 0) AS total_units_sold,
               coalesce(sum(line_total), 0) AS total_revenue,
               count(DISTINCT order_id) AS times_ordered,
               {scaled('sum(line_cents)', 'count(line_cents)', 0)} / 100 AS avg_line_value,
               {scaled(f"sum({half_up('line_cents', 'quantity')})", 'count(line_cents)', 0)} / 100
                 AS avg_selling_price
        FROM products p LEFT JOIN items i ON p.product_id = i.product_id
        GROUP BY p.product_id, product_name, price, category""".replace(
        "coalesce(sum(quantity), 0)", "CAST(coalesce(sum(quantity), 0) AS BIGINT)"
    ),
    money="current_price total_revenue",
)
def product_performance(shop) -> DataFrame:
    """All products with units, revenue and distinct orders."""
    stats = shop.items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        total("line_total").alias("revenue"),
        F.countDistinct("order_id").alias("times"),
        F.count(F.lit(1)).alias("n_lines"),
        total(unit_price()).alias("unit_prices"),
    )
    return (
        shop.products.join(stats, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            F.col("price").alias("current_price"),
            "category",
            F.coalesce("units", F.lit(0)).alias("total_units_sold"),
            F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("total_revenue"),
            F.coalesce("times", F.lit(0)).alias("times_ordered"),
            mean_of(F.col("revenue"), F.col("n_lines")).alias("avg_line_value"),
            mean_of(F.col("unit_prices"), F.col("n_lines")).alias("avg_selling_price"),
        )
    )


def monthly_partials(shop, sales: DataFrame) -> DataFrame:
    """Per month, region, category and customer: orders (``rows``), units and revenue. An order
    belongs to one customer and month, so these add up over any split of the orders."""
    lines = shop.items.select("order_id", "product_id", "quantity", "line_total")
    orders = sales.select("order_id", "customer_id", S.month_of(F.col("order_date")).alias("month"))
    per_order = (
        lines.join(shop.products.select("product_id", "category"), "product_id")
        .join(orders, "order_id")
        .groupBy("order_id", "customer_id", "month", "category")
        .agg(F.sum("quantity").alias("units"), total("line_total").alias("revenue"))
    )
    per_buyer = per_order.groupBy("customer_id", "month", "category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("units").alias("units"),
        total("revenue").alias("revenue"),
    )
    return per_buyer.join(shop.customers.select("customer_id", "region"), "customer_id")


def monthly_sales(shop, sales: DataFrame) -> DataFrame:
    """Orders, customers, units and revenue per month, region and category.

    The two distinct counts come from grouping in steps (order, then customer, then
    the report keys), which keeps the rows from being expanded once per count.
    """
    return (
        monthly_partials(shop, sales)
        .groupBy("month", "region", "category")
        .agg(
            F.sum("rows").alias("order_count"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("units").alias("units_sold"),
            total("revenue").alias("revenue"),
        )
    )


MONTHLY_SQL = """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, region, category,
       count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(quantity) AS BIGINT) AS units_sold, sum(line_total) AS revenue
FROM sales JOIN customers USING (customer_id) JOIN items USING (order_id)
JOIN products USING (product_id) GROUP BY ALL"""


@query("b24_monthly_sales", MONTHLY_SQL, money="revenue", dates="month")
def monthly_sales_report(shop) -> DataFrame:
    return monthly_sales(shop, shop.sales)
