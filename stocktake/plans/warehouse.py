"""Star-schema queries. The change feed is the orders table: a customer's payment
priority is the tracked attribute, the order date the change date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.operators import warehouse as W
from stocktake.operators.ordered import null_safe_join
from stocktake.plans.registry import half_up, query
from stocktake.plans.sales import date_spine, span_of, total
from stocktake.session import broadcast_if_few, stage
from stocktake.sources.tables import MONEY

CUTOVER = dt.date(2000, 1, 1)

# Versions in SQL: last change per customer and day, changed rows, next start.
VERSIONS_CTE = """
feed AS (SELECT customer_id, order_date, payment FROM (
           SELECT *, row_number() OVER (PARTITION BY customer_id, order_date
                                        ORDER BY order_id DESC) AS rn FROM all_orders) WHERE rn = 1),
versions AS (
  SELECT row_number() OVER (ORDER BY order_date, customer_id) AS customer_sk, customer_id, payment,
         order_date AS effective_date,
         coalesce(lead(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
                  DATE '9999-12-31') AS end_date,
         lead(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) IS NULL AS is_current
  FROM (SELECT *, lag(payment) OVER (PARTITION BY customer_id ORDER BY order_date) AS before
        FROM feed) WHERE before IS NULL OR before <> payment)"""
DATES_CTE = """
dates AS (SELECT CAST(d AS DATE) AS full_date FROM (
  SELECT unnest(generate_series((SELECT min(order_date) FROM all_orders),
                                (SELECT max(ship_date) FROM items), INTERVAL 1 DAY)) AS d))"""


def history(orders: DataFrame) -> DataFrame:
    feed = orders.select("customer_id", "payment", "order_date", "order_id")
    return W.scd2_history(feed, "customer_id", ["payment"], "order_date", "order_id")


def keyed_history(orders: DataFrame) -> DataFrame:
    return W.with_surrogate_keys(history(orders), ["effective_date", "customer_id"], "customer_sk")


@query(
    "h1_date_dimension",
    f"""WITH {DATES_CTE.strip()}
        SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
               CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
               CAST(day(full_date) AS INTEGER) AS day_of_month,
               CAST(isodow(full_date) AS INTEGER) AS day_of_week,
               dayname(full_date) AS day_name, isodow(full_date) >= 6 AS is_weekend,
               'Q' || quarter(full_date) AS fiscal_quarter FROM dates""",
    dates="full_date",
)
def calendar_report(shop) -> DataFrame:
    return calendar(shop)


def calendar(shop) -> DataFrame:
    """Date dimension from the first order to the last shipment."""
    first = shop.orders.agg(F.min("order_date").alias("day"))
    last = shop.items.agg(F.max("ship_date").alias("day"))
    return W.date_dimension(date_spine(span_of(first.union(last), "day")))


@query(
    "h4_scd2_history_from_change_log",
    f"WITH {VERSIONS_CTE.strip()} SELECT * EXCLUDE (customer_sk) FROM versions",
    dates="effective_date end_date",
)
def scd2_history_from_change_log(shop) -> DataFrame:
    return history(shop.orders)


@query(
    "h6_surrogate_keys",
    f"WITH {VERSIONS_CTE.strip()} SELECT customer_sk, customer_id, effective_date FROM versions",
    dates="effective_date",
)
def surrogate_keys(shop) -> DataFrame:
    return keyed_history(shop.orders).select("customer_sk", "customer_id", "effective_date")


def _cutover(shop) -> tuple[DataFrame, DataFrame]:
    """The dimension as of the cutover date, and the changes from that date on."""
    feed = shop.orders.select("customer_id", "payment", "order_date", "order_id")
    before = feed.where(F.col("order_date") < F.lit(CUTOVER))
    return keyed_history(before), feed.where(F.col("order_date") >= F.lit(CUTOVER))


@query(
    "h2_scd2_incremental_merge",
    f"WITH {VERSIONS_CTE.strip()} SELECT * FROM versions",
    dates="effective_date end_date",
)
def scd2_incremental_merge(shop) -> DataFrame:
    """History up to the cutover, then everything later as one batch of changes."""
    dim, changes = _cutover(shop)
    return W.scd2_merge(
        dim, changes, "customer_id", ["payment"], "order_date", "order_id", "customer_sk"
    )


@query(
    "h2_scd2_two_tracked_columns",
    """WITH feed AS (SELECT customer_id, order_date, payment, status FROM (
         SELECT *, row_number() OVER (PARTITION BY customer_id, order_date ORDER BY order_id DESC) AS rn
         FROM all_orders) WHERE rn = 1)
       SELECT customer_id, payment, status, order_date AS effective_date,
              coalesce(lead(order_date) OVER w, DATE '9999-12-31') AS end_date,
              lead(order_date) OVER w IS NULL AS is_current
       FROM (SELECT *, lag(payment) OVER v AS payment_before, lag(status) OVER v AS status_before
             FROM feed WINDOW v AS (PARTITION BY customer_id ORDER BY order_date))
       WHERE payment_before IS NULL OR payment_before <> payment OR status_before <> status
       WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)""",
    dates="effective_date end_date",
)
def scd2_two_tracked_columns(shop) -> DataFrame:
    """A change of either column opens a version; history up to the cutover, then a batch."""
    feed = shop.orders.select("customer_id", "payment", "status", "order_date", "order_id")
    late, keys, tracked = F.col("order_date") >= F.lit(CUTOVER), ["effective_date", "customer_id"], ["payment", "status"]
    before = W.scd2_history(feed.where(~late), "customer_id", tracked, "order_date", "order_id")
    dim = W.with_surrogate_keys(before, keys, "customer_sk")
    merged = W.scd2_merge(dim, feed.where(late), "customer_id", tracked, "order_date", "order_id", "customer_sk")
    return merged.drop("customer_sk")


@query(
    "h5_change_status",
    f"""WITH {VERSIONS_CTE.strip()}
        SELECT customer_id, order_date, CASE WHEN before IS NULL THEN 'INSERTED_NEW'
               WHEN before <> payment THEN 'UPDATED_SCD2' ELSE 'NO_CHANGE' END AS status
        FROM (SELECT *, lag(payment) OVER (PARTITION BY customer_id ORDER BY order_date) AS before
              FROM feed) WHERE order_date >= DATE '2000-01-01'""",
    dates="order_date",
)
def change_status(shop) -> DataFrame:
    dim, changes = _cutover(shop)
    return W.scd2_statuses(dim, changes, "customer_id", ["payment"], "order_date", "order_id")


@query(
    "h3_point_in_time_key_lookup",
    f"""WITH {VERSIONS_CTE.strip()}
        SELECT order_id, o.customer_id, customer_sk, v.payment AS payment_then
        FROM all_orders o LEFT JOIN versions v ON o.customer_id = v.customer_id
         AND o.order_date - 30 >= effective_date AND o.order_date - 30 < end_date""",
)
def point_in_time_key_lookup(shop) -> DataFrame:
    """The customer version in force thirty days before each order, if any."""
    asked = shop.orders.select(
        "order_id", "customer_id", F.date_sub("order_date", 30).alias("as_of")
    )
    versions = keyed_history(shop.orders).withColumnRenamed("payment", "payment_then")
    found = W.point_in_time(asked, versions, "customer_id", "as_of", ["customer_sk", "payment_then"])
    return found.drop("as_of")


@query(
    "j18_sales_with_state_at_shipment",
    f"""WITH {VERSIONS_CTE.strip()}
        SELECT i.order_id, i.line_no, i.product_id, ship_date, v.payment AS payment_at_shipment
        FROM items i JOIN all_orders o USING (order_id) JOIN versions v
          ON o.customer_id = v.customer_id AND ship_date >= effective_date AND ship_date < end_date
        WHERE ship_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""",
    dates="ship_date",
)
def sales_with_state_at_shipment(shop) -> DataFrame:
    """Inner point-in-time join of one month of shipments."""
    march = (F.lit(dt.date(1998, 3, 1)), F.lit(dt.date(1998, 3, 31)))
    lines = (
        shop.items.where(F.col("ship_date").between(*march))
        .join(shop.orders.select("order_id", "customer_id"), "order_id")
        .select("order_id", "line_no", "product_id", "ship_date", "customer_id")
    )
    versions = history(shop.orders).withColumnRenamed("payment", "payment_at_shipment")
    return (
        W.point_in_time(
            stage(lines, "lines"), versions, "customer_id", "ship_date", ["payment_at_shipment"]
        )
        .where(F.col("payment_at_shipment").isNotNull())
        .drop("customer_id")
    )


# --- facts ------------------------------------------------------------------


def load_sales_facts(shop, customers: DataFrame, shipped: Column | None = None) -> DataFrame:
    """Line facts with date, customer and product keys, gross, discount and net.

    The order id stays on the fact as a degenerate dimension. Product keys are the
    natural numbers the source already uses. ``shipped`` narrows the lines at the scan. The
    joined lines are staged, so that looking for busy customers does not join them again.
    """
    items = shop.items if shipped is None else shop.items.where(shipped)
    owned = items.join(shop.orders.select("order_id", "customer_id"), "order_id")
    lines = (
        owned.join(shop.products.select("product_id", F.col("price").alias("unit_price")), "product_id")
        .select("order_id", "line_no", "customer_id", "product_id", "quantity", "unit_price",
                "discount", "ship_date")
    )
    keyed = W.point_in_time(
        stage(lines, "lines"), customers, "customer_id", "ship_date", ["customer_sk"]
    )
    gross = (F.col("quantity") * F.col("unit_price")).cast(MONEY)
    off = F.round(gross * F.col("discount"), 2).cast(MONEY)
    return keyed.select(
        "order_id",
        "line_no",
        W.date_key(F.col("ship_date")).alias("date_key"),
        "customer_sk",
        F.col("product_id").alias("product_sk"),
        "quantity",
        "unit_price",
        gross.alias("gross_amount"),
        off.alias("discount_amount"),
        (gross - off).cast(MONEY).alias("net_revenue"),
    )


DISCOUNT_CENTS = half_up("quantity * CAST(price * 100 AS HUGEINT) * discount_pct", "100")
FACTS_CTE = f"""
facts AS (
  SELECT i.order_id, i.line_no, CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS date_key,
         customer_sk, i.product_id AS product_sk, quantity, price AS unit_price,
         quantity * price AS gross_amount, {DISCOUNT_CENTS} / 100.0 AS discount_amount,
         (quantity * CAST(price * 100 AS HUGEINT) - {DISCOUNT_CENTS}) / 100.0 AS net_revenue,
         (quantity * CAST(price * 100 AS HUGEINT) - {DISCOUNT_CENTS}) AS net_cents
  FROM items i JOIN all_orders o USING (order_id) JOIN products p ON p.product_id = i.product_id
  LEFT JOIN versions v ON v.customer_id = o.customer_id
   AND ship_date >= effective_date AND ship_date < end_date)"""
WAREHOUSE_CTE = f"WITH {VERSIONS_CTE.strip()}, {FACTS_CTE.strip()}, {DATES_CTE.strip()}"


@query(
    "h7_sales_fact_load",
    f"{WAREHOUSE_CTE} SELECT * EXCLUDE (net_cents) FROM facts",
    money="unit_price gross_amount discount_amount net_revenue",
)
def sales_fact_load(shop) -> DataFrame:
    return load_sales_facts(shop, keyed_history(shop.orders))


def _star(shop, shipped: Column | None = None) -> tuple[DataFrame, DataFrame]:
    customers = keyed_history(shop.orders)
    return customers, load_sales_facts(shop, customers, shipped)


def _net_per_order(facts: DataFrame, *by: str) -> DataFrame:
    """Facts folded to one row per customer version and order, and by what is named."""
    return facts.groupBy("customer_sk", "order_id", *by).agg(total("net_revenue").alias("net"))


def _shipped_in(year: int) -> Column:
    """The year as a range of ship dates, which the scan of the lines can skip by."""
    return F.col("ship_date").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))


@query(
    "h8_historical_attribution",
    f"""{WAREHOUSE_CTE} SELECT payment, count(DISTINCT order_id) AS order_count,
               CAST(sum(net_cents) AS DOUBLE) / 100 AS total_revenue
        FROM facts JOIN versions USING (customer_sk) GROUP BY payment""",
)
def historical_attribution(shop) -> DataFrame:
    """Revenue by the attribute value in force when the sale took place."""
    customers, facts = _star(shop)
    return (
        _net_per_order(facts)
        .join(customers.select("customer_sk", "payment"), "customer_sk")
        .groupBy("payment")
        .agg(F.countDistinct("order_id").alias("order_count"), total("net").alias("total_revenue"))
    )


@query(
    "h9_historical_report_for_year",
    f"""{WAREHOUSE_CTE} SELECT payment, count(DISTINCT order_id) AS total_orders,
               CAST(sum(net_cents) AS DOUBLE) / 100 AS historical_net_revenue
        FROM facts JOIN versions USING (customer_sk)
        WHERE date_key BETWEEN 19980101 AND 19981231 GROUP BY payment""",
)
def historical_report_for_year(shop) -> DataFrame:
    """Fact, customer version and date dimension with a year filter."""
    customers, facts = _star(shop, _shipped_in(1998))
    days = calendar(shop).where("year = 1998").select("date_key")
    return (
        _net_per_order(facts, "date_key")
        .join(F.broadcast(days), "date_key")  # at most 366 rows
        .join(customers.select("customer_sk", "payment"), "customer_sk")
        .groupBy("payment")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            total("net").alias("historical_net_revenue"),
        )
    )


@query(
    "h9_current_state_report",
    f"""{WAREHOUSE_CTE} SELECT c.payment AS current_payment, count(DISTINCT order_id) AS total_orders,
               CAST(sum(net_cents) AS DOUBLE) / 100 AS net_revenue
        FROM facts JOIN versions h USING (customer_sk)
        JOIN versions c ON c.customer_id = h.customer_id AND c.is_current
        WHERE date_key BETWEEN 19980101 AND 19981231 GROUP BY c.payment""",
)
def current_state_report(shop) -> DataFrame:
    """Revenue by the attribute value the customer has now: the two dimension roles are
    joined to each other first, so the facts are joined once."""
    customers, facts = _star(shop, _shipped_in(1998))
    now = customers.where("is_current").select(
        "customer_id", F.col("payment").alias("current_payment")
    )
    roles = customers.select("customer_sk", "customer_id").join(now, "customer_id")
    days = calendar(shop).where("year = 1998").select("date_key")
    return (
        _net_per_order(facts, "date_key")
        .join(F.broadcast(days), "date_key")  # at most 366 rows
        .join(roles, "customer_sk")
        .groupBy("current_payment")
        .agg(F.countDistinct("order_id").alias("total_orders"), total("net").alias("net_revenue"))
    )


# --- other dimension and fact types -----------------------------------------


def _first_and_last(shop) -> tuple[DataFrame, DataFrame]:
    """Each customer's payment in the first order, and in the last order of those who
    ordered since 2001: a dimension and an incoming batch."""
    o = shop.orders
    place = F.struct("order_date", "order_id")
    dim = o.groupBy("customer_id").agg(F.min_by("payment", place).alias("payment"))
    recent = o.where(F.col("order_date") >= F.lit(dt.date(2001, 1, 1)))
    return dim, recent.groupBy("customer_id").agg(F.max_by("payment", place).alias("payment"))


FIRST_LAST_CTE = """
WITH dim AS (SELECT customer_id, arg_min(payment, (order_date, order_id)) AS payment
             FROM all_orders GROUP BY customer_id),
incoming AS (SELECT customer_id, arg_max(payment, (order_date, order_id)) AS payment
             FROM all_orders WHERE order_date >= DATE '2001-01-01' GROUP BY customer_id)"""


@query(
    "h10_scd0_retain",
    f"""{FIRST_LAST_CTE} SELECT customer_id, coalesce(d.payment, i.payment) AS payment
        FROM dim d FULL JOIN incoming i USING (customer_id)""",
)
def scd0_retain(shop) -> DataFrame:
    return W.scd0_merge(*_first_and_last(shop), "customer_id")


@query(
    "h10_scd1_overwrite",
    f"""{FIRST_LAST_CTE} SELECT customer_id, coalesce(i.payment, d.payment) AS payment
        FROM dim d FULL JOIN incoming i USING (customer_id)""",
)
def scd1_overwrite(shop) -> DataFrame:
    return W.scd1_merge(*_first_and_last(shop), "customer_id")


@query(
    "h10_scd3_previous_value",
    f"""{FIRST_LAST_CTE} SELECT customer_id, coalesce(i.payment, d.payment) AS payment,
               CASE WHEN i.payment <> d.payment THEN d.payment END AS previous_payment
        FROM dim d FULL JOIN incoming i USING (customer_id)""",
)
def scd3_previous_value(shop) -> DataFrame:
    return W.scd3_merge(*_first_and_last(shop), "customer_id", "payment")


@query(
    "h11_periodic_snapshot",
    f"""WITH {VERSIONS_CTE.strip()},
        span AS (SELECT CAST(date_trunc('month', min(order_date)) AS DATE) AS low,
                        CAST(date_trunc('month', max(order_date)) AS DATE) AS high FROM all_orders),
        month_ends AS (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 MONTH))
                       + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end FROM span)
        SELECT month_end, payment, count(*) AS customers FROM month_ends
        JOIN versions ON effective_date <= month_end AND month_end < end_date GROUP BY ALL""",
    dates="month_end",
)
def periodic_snapshot(shop) -> DataFrame:
    """Customers per payment preference at every month end up to the last order's month."""
    last = shop.orders.agg(F.last_day(F.max("order_date"))).first()[0]  # one row
    snapshot = W.month_end_snapshot(history(shop.orders), F.lit(last).cast("date"))
    return snapshot.groupBy("month_end", "payment").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "h12_accumulating_snapshot",
    """SELECT o.order_id, order_date AS placed, min(ship_date) AS first_shipped,
              max(ship_date) AS last_shipped,
              min(CASE WHEN return_flag = 'R' THEN ship_date END) AS first_returned,
              CAST(max(ship_date) - order_date AS INTEGER) AS days_to_complete
       FROM all_orders o LEFT JOIN items i ON i.order_id = o.order_id GROUP BY o.order_id, order_date""",
    dates="placed first_shipped last_shipped first_returned",
)
def accumulating_snapshot(shop) -> DataFrame:
    """One row per order with its milestone dates."""
    shipped = shop.items.groupBy("order_id").agg(
        F.min("ship_date").alias("first_shipped"),
        F.max("ship_date").alias("last_shipped"),
        F.min(F.when(F.col("return_flag") == "R", F.col("ship_date"))).alias("first_returned"),
    )
    return (
        shop.orders.select("order_id", F.col("order_date").alias("placed"))
        .join(shipped, "order_id", "left")
        .withColumn("days_to_complete", F.datediff("last_shipped", "placed"))
    )


@query(
    "h13_junk_dimension",
    """SELECT junk_key, return_flag, line_status, discounted, count(*) AS lines
       FROM (SELECT return_flag AS f, line_status AS s, discount_pct > 0 AS d FROM items) JOIN (
         SELECT *, row_number() OVER (ORDER BY return_flag, line_status, discounted) AS junk_key
         FROM (SELECT DISTINCT return_flag, line_status, discount_pct > 0 AS discounted FROM items))
       ON f IS NOT DISTINCT FROM return_flag AND s IS NOT DISTINCT FROM line_status
          AND d IS NOT DISTINCT FROM discounted GROUP BY ALL""",
)
def junk_dimension_counts(shop) -> DataFrame:
    """Flag combinations with a key, joined back to the lines that carry them."""
    flags = ["return_flag", "line_status", "discounted"]
    lines = shop.items.withColumn("discounted", F.col("discount") > 0)
    junk = W.junk_dimension(lines, flags, "junk_key")
    keyed = null_safe_join(lines, broadcast_if_few(junk), flags, "inner")
    return keyed.groupBy("junk_key", *flags).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "j23_role_playing_dates",
    """SELECT CAST(year(order_date) AS INTEGER) AS order_year,
              CAST(quarter(order_date) AS INTEGER) AS order_quarter,
              CAST(year(ship_date) AS INTEGER) AS ship_year,
              CAST(quarter(ship_date) AS INTEGER) AS ship_quarter, sum(line_total) AS revenue
       FROM items JOIN all_orders USING (order_id) GROUP BY 1, 2, 3, 4""",
    money="revenue",
)
def role_playing_dates(shop) -> DataFrame:
    """The date dimension joined as order date and as ship date."""
    days = calendar(shop)

    def role(name: str) -> DataFrame:
        part = days.select(
            F.col("full_date").alias(f"{name}_date"),
            F.col("year").alias(f"{name}_year"),
            F.col("quarter").alias(f"{name}_quarter"),
        )
        return broadcast_if_few(part, days)

    per_pair = (
        shop.items.join(shop.orders.select("order_id", "order_date"), "order_id")
        .groupBy("order_date", "ship_date")
        .agg(total("line_total").alias("revenue"))
    )
    return (
        per_pair.join(role("order"), "order_date")
        .join(role("ship"), "ship_date")
        .groupBy("order_year", "order_quarter", "ship_year", "ship_quarter")
        .agg(total("revenue").alias("revenue"))
    )


@query(
    "j24_snowflake_chain",
    """SELECT r_name AS region, n_name AS nation, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    money="revenue",
)
def snowflake_chain(shop) -> DataFrame:
    """Fact to supplier to nation to region, after folding the fact to the supplier."""
    per_supplier = shop.items.groupBy("supplier_id").agg(total("line_total").alias("revenue"))
    supplier, nation, region = (shop.table(t) for t in ("supplier", "nation", "region"))
    return (
        per_supplier.join(supplier, F.col("supplier_id") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
        .agg(total("revenue").alias("revenue"))
    )
