"""Window reports: ranks, running totals, moving averages, previous-row lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.functions import scalar as S
from stocktake.operators.ordered import (
    keep_one,
    ntile_of,
    number_rows,
    ordered_groups,
    sliced_groups,
)
from stocktake.plans.registry import query, scaled
from stocktake.plans.sales import per_customer, total
from stocktake.sources.tables import TOTAL


def customer_spend(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Every customer with the sum of the orders that count (NULL without any)."""
    return customers.join(per_customer(sales), "customer_id", "left").select(
        "customer_id", "customer_name", "region", "spent"
    )


@query(
    "b9_spending_rank",
    """SELECT customer_name, region, coalesce(sum(amount), 0) AS total_spent,
              row_number() OVER (ORDER BY sum(amount) DESC NULLS LAST, c.customer_id) AS spending_rank
       FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
       GROUP BY c.customer_id, customer_name, region""",
    money="total_spent",
)
def spending_rank(shop) -> DataFrame:
    """Global row number over an aggregate, without a single-partition window."""
    spend = customer_spend(shop.customers, shop.sales)
    return number_rows(spend, ["-spent", "customer_id"], "spending_rank").select(
        "customer_name",
        "region",
        F.coalesce("spent", F.lit(0).cast(TOTAL)).alias("total_spent"),
        "spending_rank",
    )


@query(
    "b10_first_order_per_customer",
    """SELECT order_id, customer_id, order_date, amount FROM (
         SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS rn
         FROM all_orders) WHERE rn = 1""",
    money="amount", dates="order_date",
)
def first_order_per_customer(shop) -> DataFrame:
    orders = shop.orders.select("order_id", "customer_id", "order_date", "amount")
    return keep_one(orders, ["customer_id"], [F.col("order_date"), F.col("order_id")])


@query(
    "w2_latest_record_per_customer",
    """SELECT order_id, customer_id, order_date, amount FROM (
         SELECT *, row_number() OVER (PARTITION BY customer_id
                                      ORDER BY order_date DESC, order_id DESC) AS rn
         FROM all_orders) WHERE rn = 1""",
    money="amount", dates="order_date",
)
def latest_record_per_customer(shop) -> DataFrame:
    orders = shop.orders.select("order_id", "customer_id", "order_date", "amount")
    return keep_one(orders, ["customer_id"], [F.desc("order_date"), F.desc("order_id")])


@query(
    "b11_top_products_per_category",
    """SELECT * FROM (
         SELECT p.product_id, product_name, category, sum(line_total) AS total_revenue,
                dense_rank() OVER (PARTITION BY category ORDER BY sum(line_total) DESC) AS rank_in_category
         FROM items i JOIN products p ON i.product_id = p.product_id
         GROUP BY p.product_id, product_name, category) WHERE rank_in_category <= 3""",
    money="total_revenue", ints="rank_in_category",
)
def top_products_per_category(shop) -> DataFrame:
    revenue = shop.items.groupBy("product_id").agg(total("line_total").alias("total_revenue"))
    best = Window.partitionBy("category").orderBy(F.desc("total_revenue"))
    return (
        revenue.join(shop.products.select("product_id", "product_name", "category"), "product_id")
        .withColumn("rank_in_category", F.dense_rank().over(best))
        .where(F.col("rank_in_category") <= 3)
        .orderBy("category", "rank_in_category")
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(S.month_of(F.col("order_date")).alias("month")).agg(
        total("amount").alias("revenue")
    )


@query(
    "b12_month_over_month_revenue",
    f"""SELECT strftime(month, '%Y-%m') AS month, revenue AS current_revenue,
               prev / 100.0 AS previous_month_revenue, (cents - prev) / 100.0 AS revenue_change,
               {scaled('(cents - prev) * 100', 'prev', 2)} AS pct_change
        FROM (SELECT *, lag(cents) OVER (ORDER BY month) AS prev
              FROM (SELECT date_trunc('month', order_date) AS month, sum(amount) AS revenue,
                           sum(cents) AS cents FROM sales GROUP BY 1))""",
    money="current_revenue previous_month_revenue revenue_change",
)
def month_over_month_revenue(shop) -> DataFrame:
    """LAG over the months: one row per month, so the global window is small."""
    before = F.lag("revenue").over(Window.orderBy("month"))
    revenue, prev = F.col("revenue"), F.col("previous_month_revenue")
    return (
        monthly_revenue(shop.sales)
        .withColumn("previous_month_revenue", before)
        .select(
            S.month_label(F.col("month")).alias("month"),
            revenue.alias("current_revenue"),
            prev,
            (revenue - prev).alias("revenue_change"),
            S.percent_change(revenue, prev, 2).alias("pct_change"),
        )
        .orderBy("month")
    )


@query(
    "b13_daily_cumulative_revenue",
    """SELECT order_date AS sale_date, sum(amount) AS daily_revenue,
              sum(sum(amount)) OVER (ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS cumulative_revenue
       FROM sales GROUP BY order_date""",
    money="daily_revenue cumulative_revenue", dates="sale_date",
)
def daily_cumulative_revenue(shop) -> DataFrame:
    """Running total with a ROWS frame over one row per calendar day."""
    days = shop.sales.groupBy(F.col("order_date").alias("sale_date")).agg(
        total("amount").alias("daily_revenue")
    )
    so_far = Window.orderBy("sale_date").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn(
        "cumulative_revenue", F.sum("daily_revenue").over(so_far).cast(TOTAL)
    ).orderBy("sale_date")


ORDER_OF_CUSTOMER = ["order_date", "order_id"]


@query(
    "b14_three_order_moving_average",
    f"""SELECT customer_name, order_id, order_date, amount,
               {scaled('s', 'n', 0)} / 100 AS moving_avg_3_orders
        FROM (SELECT *, sum(cents) OVER w AS s, count(*) OVER w AS n FROM all_orders
              WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id
                           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
        JOIN customers USING (customer_id)""",
    money="amount", dates="order_date",
)
def three_order_moving_average(shop) -> DataFrame:
    return moving_average(shop.orders, 3).join(shop.customers, "customer_id").select(
        "customer_name", "order_id", "order_date", "amount", "moving_avg_3_orders"
    )


def moving_average(orders: DataFrame, n: int, hot_rows: int | None = None) -> DataFrame:
    """Average over this and the ``n - 1`` orders before it, per customer."""
    slim = orders.select("order_id", "customer_id", "order_date", "amount")
    groups = ordered_groups(slim, ["customer_id"], ORDER_OF_CUSTOMER, hot_rows)
    name = f"moving_avg_{n}_orders"
    return groups.framed(
        lambda w: {name: F.round(F.avg("amount").over(w.rowsBetween(1 - n, 0)), 2)},
        preceding=n - 1,
    ).rows()


def spending_tiers(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Quartiles of spend with tier names; quartile from the global row number."""
    spend = customer_spend(customers, sales).withColumn(
        "total_spent", F.coalesce("spent", F.lit(0).cast(TOTAL))
    )
    numbered = number_rows(spend, ["-total_spent", "customer_id"], "place", "everyone")
    quartile = F.col("spending_quartile")
    return numbered.withColumn(
        "spending_quartile", ntile_of(F.col("place"), F.col("everyone"), 4)
    ).select(
        "customer_id",
        "customer_name",
        "region",
        "total_spent",
        quartile,
        F.when(quartile == 1, "Platinum")
        .when(quartile == 2, "Gold")
        .when(quartile == 3, "Silver")
        .otherwise("Bronze")
        .alias("customer_tier"),
    )


@query(
    "b15_spending_quartile_tiers",
    """SELECT customer_id, customer_name, region, total_spent, spending_quartile,
              CASE spending_quartile WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver'
                                     ELSE 'Bronze' END AS customer_tier
       FROM (SELECT *, CAST(ntile(4) OVER (ORDER BY total_spent DESC, customer_id) AS INTEGER)
                       AS spending_quartile
             FROM (SELECT c.customer_id, customer_name, region, coalesce(sum(amount), 0) AS total_spent
                   FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id GROUP BY ALL))""",
    money="total_spent",
)
def spending_quartile_tiers(shop) -> DataFrame:
    return spending_tiers(shop.customers, shop.sales)


@query(
    "w14_deciles_and_percentiles",
    """SELECT customer_id, CAST(ntile(10) OVER w AS INTEGER) AS decile,
              CAST(ntile(100) OVER w AS INTEGER) AS percentile
       FROM (SELECT customer_id, sum(amount) AS spent FROM sales GROUP BY customer_id)
       WINDOW w AS (ORDER BY spent DESC, customer_id)""",
)
def deciles_and_percentiles(shop) -> DataFrame:
    spend = per_customer(shop.sales)
    numbered = number_rows(spend, ["-spent", "customer_id"], "place", "everyone")
    place, everyone = F.col("place"), F.col("everyone")
    return numbered.select(
        "customer_id",
        ntile_of(place, everyone, 10).alias("decile"),
        ntile_of(place, everyone, 100).alias("percentile"),
    )


def region_month_dashboard(shop) -> DataFrame:
    """Running total (default RANGE frame), previous month, growth and best-month rank
    per region over one row per region and month."""
    month = S.month_of(F.col("order_date")).alias("month")
    per_buyer = shop.sales.groupBy("customer_id", month).agg(
        F.count("order_id").alias("n"), total("amount").alias("spent")
    )
    stats = (
        per_buyer.join(shop.customers.select("customer_id", "region"), "customer_id")
        .groupBy("month", "region")
        .agg(F.sum("n").alias("orders_count"), total("spent").alias("revenue"))
    )
    by_month = Window.partitionBy("region").orderBy("month")
    best = Window.partitionBy("region").orderBy(F.desc("revenue"))
    return (
        stats.withColumn("cumulative_revenue", F.sum("revenue").over(by_month).cast(TOTAL))
        .withColumn("prev_month_revenue", F.lag("revenue").over(by_month))
        .withColumn("best_month_rank", F.rank().over(best))
        .withColumn(
            "mom_growth_pct", S.percent_change(F.col("revenue"), F.col("prev_month_revenue"), 1)
        )
        .withColumn("month", S.month_label(F.col("month")))
        .orderBy("region", "month")
    )


@query(
    "b16_region_month_dashboard",
    f"""SELECT strftime(month, '%Y-%m') AS month, region, orders_count, revenue,
               sum(revenue) OVER w AS cumulative_revenue, prev / 100.0 AS prev_month_revenue,
               {scaled('(cents - prev) * 100', 'prev', 1)} AS mom_growth_pct, best_month_rank
        FROM (SELECT *, lag(cents) OVER (PARTITION BY region ORDER BY month) AS prev,
                     rank() OVER (PARTITION BY region ORDER BY revenue DESC) AS best_month_rank
              FROM (SELECT date_trunc('month', order_date) AS month, region, count(*) AS orders_count,
                           sum(amount) AS revenue, sum(cents) AS cents
                    FROM sales JOIN customers USING (customer_id) GROUP BY 1, 2))
        WINDOW w AS (PARTITION BY region ORDER BY month)""",
    money="revenue cumulative_revenue prev_month_revenue", ints="best_month_rank",
)
def region_month_dashboard_report(shop) -> DataFrame:
    return region_month_dashboard(shop)


@query(
    "b27_leading_category_per_month",
    """SELECT * FROM (
         SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category,
                sum(line_total) AS revenue,
                rank() OVER (PARTITION BY date_trunc('month', order_date)
                             ORDER BY sum(line_total) DESC) AS rank_this_month
         FROM items JOIN sales USING (order_id) JOIN products USING (product_id)
         GROUP BY date_trunc('month', order_date), category) WHERE rank_this_month = 1""",
    money="revenue", dates="month", ints="rank_this_month",
)
def leading_category_per_month(shop) -> DataFrame:
    """Best category of every month; ties are kept."""
    per_product = (
        shop.items.select("order_id", "product_id", "line_total")
        .join(shop.sales.select("order_id", "order_date"), "order_id")
        .groupBy(S.month_of(F.col("order_date")).alias("month"), "product_id")
        .agg(total("line_total").alias("revenue"))
    )
    revenue = (
        per_product.join(shop.products.select("product_id", "category"), "product_id")
        .groupBy("month", "category")
        .agg(total("revenue").alias("revenue"))
    )
    best = Window.partitionBy("month").orderBy(F.desc("revenue"))
    return revenue.withColumn("rank_this_month", F.rank().over(best)).where("rank_this_month = 1")


# --- previous order ---------------------------------------------------------


def previous_order_pairs(orders: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Each order with every order of the customer's previous order date. First orders
    have none; ties on the previous date give several rows.

    The previous date is looked up among the distinct (customer, date) pairs, then the
    orders of that date are joined by equality; no pairs beyond the result are built.
    """
    days = orders.select("customer_id", "order_date").distinct()
    groups = ordered_groups(days, ["customer_id"], ["order_date"], hot_rows)
    steps = (
        groups.framed(lambda w: {"previous_date": F.lag("order_date").over(w)}, preceding=1)
        .rows()
        .where(F.col("previous_date").isNotNull())
    )
    now = orders.select("order_id", "customer_id", "order_date", F.col("amount").alias("current_amount"))
    then = orders.select(
        "customer_id",
        F.col("order_date").alias("previous_date"),
        F.col("order_id").alias("previous_order_id"),
        F.col("amount").alias("previous_amount"),
    )
    return (
        now.join(steps, ["customer_id", "order_date"])
        .join(then, ["customer_id", "previous_date"])
        .withColumn("days_since_last_order", F.datediff("order_date", "previous_date"))
    )


@query(
    "b6_order_vs_previous_order",
    """SELECT o1.order_id, o1.customer_id, o1.order_date, o2.order_date AS previous_date,
              o2.order_id AS previous_order_id, o1.amount AS current_amount,
              o2.amount AS previous_amount,
              CAST(o1.order_date - o2.order_date AS INTEGER) AS days_since_last_order
       FROM all_orders o1 JOIN all_orders o2
         ON o1.customer_id = o2.customer_id AND o2.order_date < o1.order_date
       WHERE NOT EXISTS (SELECT 1 FROM all_orders o3 WHERE o3.customer_id = o1.customer_id
                         AND o3.order_date > o2.order_date AND o3.order_date < o1.order_date)""",
    money="current_amount previous_amount", dates="order_date previous_date",
)
def order_vs_previous_order(shop) -> DataFrame:
    """The self-join form."""
    return previous_order_pairs(shop.orders)


def order_gaps(orders: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """LAG of date and amount per customer, with the gap in days."""
    slim = orders.select("order_id", "customer_id", "order_date", "amount")
    return (
        ordered_groups(slim, ["customer_id"], ORDER_OF_CUSTOMER, hot_rows)
        .framed(
            lambda w: {
                "prev_order_date": F.lag("order_date").over(w),
                "prev_order_amount": F.lag("amount").over(w),
            },
            preceding=1,
        )
        .rows()
        .withColumn("days_between_orders", F.datediff("order_date", "prev_order_date"))
    )


@query(
    "b6_order_gaps_by_lag",
    """SELECT order_id, customer_id, customer_name, order_date, amount,
              lag(order_date) OVER w AS prev_order_date, lag(amount) OVER w AS prev_order_amount,
              CAST(order_date - lag(order_date) OVER w AS INTEGER) AS days_between_orders
       FROM all_orders JOIN customers USING (customer_id)
       WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)""",
    money="amount prev_order_amount", dates="order_date prev_order_date",
)
def order_gaps_by_lag(shop) -> DataFrame:
    names = shop.customers.select("customer_id", "customer_name")
    return order_gaps(shop.orders).join(names, "customer_id")


@query(
    "w13_neighbour_offsets",
    """SELECT order_id, lag(amount, 2) OVER w AS two_orders_ago, lead(amount, 1) OVER w AS next_amount,
              lead(order_date, 2) OVER w AS two_orders_ahead
       FROM all_orders WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)""",
    money="two_orders_ago next_amount", dates="two_orders_ahead",
)
def neighbour_offsets(shop) -> DataFrame:
    """LAG and LEAD with general offsets in one pass."""
    slim = shop.orders.select("order_id", "customer_id", "order_date", "amount")
    return (
        ordered_groups(slim, ["customer_id"], ORDER_OF_CUSTOMER)
        .framed(
            lambda w: {
                "two_orders_ago": F.lag("amount", 2).over(w),
                "next_amount": F.lead("amount", 1).over(w),
                "two_orders_ahead": F.lead("order_date", 2).over(w),
            },
            preceding=2,
            following=2,
        )
        .rows()
        .select("order_id", "two_orders_ago", "next_amount", "two_orders_ahead")
    )


@query(
    "w5_rank_with_gaps",
    """SELECT region, nation, orders, rank() OVER (PARTITION BY region ORDER BY orders DESC) AS place
       FROM (SELECT region, nation, count(*) AS orders
             FROM all_orders JOIN customers USING (customer_id) GROUP BY 1, 2)""",
    ints="place",
)
def rank_with_gaps(shop) -> DataFrame:
    """RANK of the nations of a region by number of orders."""
    counts = (
        per_customer(shop.orders)
        .join(shop.customers, "customer_id")
        .groupBy("region", "nation")
        .agg(F.sum("orders").alias("orders"))
    )
    return counts.withColumn(
        "place", F.rank().over(Window.partitionBy("region").orderBy(F.desc("orders")))
    )


@query(
    "w7_rows_and_range_frames",
    """SELECT payment, month, n, sum(n) OVER (PARTITION BY payment ORDER BY month, status
                                             ROWS UNBOUNDED PRECEDING)::BIGINT AS by_rows,
              sum(n) OVER (PARTITION BY payment ORDER BY month)::BIGINT AS by_range, status
       FROM (SELECT payment, status, strftime(order_date, '%Y-%m') AS month, count(*) AS n
             FROM all_orders GROUP BY 1, 2, 3)""",
)
def rows_and_range_frames(shop) -> DataFrame:
    """The two running-total frames side by side: RANGE takes in the whole tie."""
    counts = shop.orders.groupBy(
        "payment", "status", S.month_label(F.col("order_date")).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("payment")
    rows = group.orderBy("month", "status").rowsBetween(Window.unboundedPreceding, 0)
    peers = group.orderBy("month").rangeBetween(Window.unboundedPreceding, 0)
    return counts.select(
        "payment", "month", "status", "n",
        F.sum("n").over(rows).alias("by_rows"),
        F.sum("n").over(peers).alias("by_range"),
    )


@query(
    "g1_running_total_over_all_orders",
    """SELECT order_id, sum(amount) OVER w AS revenue_so_far, row_number() OVER w AS order_no
       FROM sales WINDOW w AS (ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)""",
    money="revenue_so_far",
)
def running_total_over_all_orders(shop) -> DataFrame:
    """Running total and number over every order, with no key to partition by."""
    slim = shop.sales.select("order_id", "order_date", "amount")
    return (
        sliced_groups(slim, [], ORDER_OF_CUSTOMER)
        .running({"revenue_so_far": F.col("amount"), "order_no": F.lit(1)})
        .rows()
        .select("order_id", "revenue_so_far", "order_no")
    )


@query(
    "w7_running_spend_per_customer",
    """SELECT order_id, sum(amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id
                                          ROWS UNBOUNDED PRECEDING) AS spent_so_far
       FROM all_orders""",
    money="spent_so_far",
)
def running_spend_per_customer(shop) -> DataFrame:
    return running_spend(shop.orders).select("order_id", "spent_so_far")


def running_spend(orders: DataFrame, hot_rows: int | None = None) -> DataFrame:
    slim = orders.select("order_id", "customer_id", "order_date", "amount")
    groups = ordered_groups(slim, ["customer_id"], ORDER_OF_CUSTOMER, hot_rows)
    return groups.running({"spent_so_far": F.col("amount")}).rows()


