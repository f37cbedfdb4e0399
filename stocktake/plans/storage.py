"""Queries through files: CSV and JSON in and out, views, stored summaries, layouts.

Each writes to a new folder below the session's shared scratch folder and reads back.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators import documents as D
from stocktake.operators import quality as Q
from stocktake.plans import documents, quality
from stocktake.plans.registry import query
from stocktake.plans.sales import MONTHLY_SQL, monthly_partials, monthly_sales, order_details, total
from stocktake.session import scratch_path, stage
from stocktake.sources import files
from stocktake.sources.tables import STORE_DEFAULTS, apply_table, schema_of
from stocktake.sources.versions import Summary, append_batch, read_appended


@query(
    "s1_csv_read_numbered",
    f"""WITH {quality.RAW_CTE.strip()}
        SELECT row_number() OVER (ORDER BY row_no) AS place, row_no::VARCHAR AS row_no, order_id,
               trim(customer_id) AS customer_id, units, amount, ordered, note,
               NULL::VARCHAR AS _corrupt_record FROM raw""",
)
def csv_read_numbered(shop) -> DataFrame:
    """All-text, trimmed CSV rows with their place in the files."""
    path = scratch_path(shop.spark, "csv")
    files.export_csv(quality.raw_orders(shop).orderBy("row_no"), path)
    return files.read_csv_numbered(shop.spark, path, name="place")


_REMARK = "note || chr(10) || 'said \"' || units || '\", twice' || chr(13) || chr(10) || chr(10) || order_id"


@query(
    "s1_csv_line_ends_in_fields",
    f"""WITH {quality.RAW_CTE.strip()}
        SELECT row_number() OVER (ORDER BY row_no) AS place, row_no::VARCHAR AS row_no,
               {_REMARK} AS remark, trim(customer_id) AS customer_id,
               NULL::VARCHAR AS _corrupt_record FROM raw""",
)
def csv_line_ends_in_fields(shop) -> DataFrame:
    """Rows whose remarks hold quotes, commas and line ends, read by a task for each block."""
    path = scratch_path(shop.spark, "csv")
    raw = quality.raw_orders(shop).select("row_no", F.expr(_REMARK).alias("remark"), "customer_id")
    files.export_csv(raw.orderBy("row_no"), path)
    return files.read_csv_numbered(shop.spark, path, name="place", multiline=True)


@query(
    "s6_export_cleaned_csv",
    f"""WITH {quality.RAW_CTE.strip()} SELECT order_id, customer_id,
               CASE WHEN regexp_full_match(units, '[0-9]+') THEN CAST(CAST(units AS BIGINT) AS VARCHAR)
                    ELSE '' END AS units, ordered FROM complete""",
)
def export_cleaned_csv(shop) -> DataFrame:
    """Cleaned rows written as CSV, NULL as empty, and read again as text."""
    path = scratch_path(shop.spark, "csv")
    complete, _ = Q.split_required(
        Q.drop_exact_duplicates(quality.raw_orders(shop), "row_no"), quality.REQUIRED
    )
    typed = Q.cast_with_rejects(complete, files.parse_schema(quality.RAW_SCHEMA))
    files.export_csv(typed.select("order_id", "customer_id", "units", "ordered"), path)
    return files.read_csv(shop.spark, path).drop(files.CORRUPT)


@query(
    "s4_typed_load_with_defaults",
    """SELECT CAST(order_id AS BIGINT) AS id, CAST(customer_id AS BIGINT) AS customer_id,
              strftime(order_date, '%Y-%m-%d %H:%M:%S.%f') AS order_date,
              coalesce(nullif(status, 'P'), 'pending') AS status, amount AS total_amount,
              payment AS payment_method FROM all_orders""",
    money="total_amount",
)
def typed_load_with_defaults(shop) -> DataFrame:
    """Raw rows onto a typed table; a missing status takes the column default."""
    raw = shop.orders.select(
        F.col("order_id").alias("id"), "customer_id", F.col("ordered_at").alias("order_date"),
        F.nullif("status", F.lit("P")).alias("status"), F.col("amount").alias("total_amount"),
        F.col("payment").alias("payment_method"),
    )
    return apply_table(raw, schema_of("orders"), STORE_DEFAULTS["orders"])


@query(
    "s13_landing_to_warehouse",
    f"""WITH {documents.DOCS_CTE.strip()}
        SELECT event_type, coalesce(tier, 'standard') AS user_tier, count(*) AS events,
               sum(total_amount) AS total FROM docs GROUP BY ALL""",
    money="total", retail=False,
)
def landing_to_warehouse(shop) -> DataFrame:
    """JSON files land as they are, are flattened and typed, and end as parquet."""
    spark = shop.spark
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    documents.event_json(shop.events).write.text(landing)
    docs = files.read_documents(spark, landing, documents.EVENT_SCHEMA)
    parents = D.event_parents(docs)
    files.store_summary(parents, lake, "event_type")
    return (
        files.read_summary(parents, lake)
        .groupBy("event_type", "user_tier")
        .agg(F.count(F.lit(1)).alias("events"), total("total_amount").alias("total"))
    )


@query(
    "s8_order_details_view",
    """SELECT order_id, order_date, line_total, product_name FROM items JOIN all_orders USING (order_id)
       JOIN customers USING (customer_id) JOIN products USING (product_id)
       WHERE region = 'EUROPE' AND status = 'F' AND category = 'PROMO'""",
    money="line_total", dates="order_date",
)
def order_details_view(shop) -> DataFrame:
    """A named view queried with SQL; its filters are pushed into the five tables."""
    order_details(shop).createOrReplaceTempView("stocktake_order_details")
    return shop.spark.sql(
        """SELECT order_id, order_date, line_total, product_name FROM stocktake_order_details
           WHERE region = 'EUROPE' AND status = 'F' AND category = 'PROMO'"""
    )


@query("s9_stored_monthly_sales_refresh", MONTHLY_SQL, money="revenue", dates="month")
def stored_monthly_sales_refresh(shop) -> DataFrame:
    """Store the monthly summary as of mid-July 2001, then refresh only the late months."""
    path = scratch_path(shop.spark, "monthly")

    at = F.col("ordered_at")
    known, month = (
        F.lit(d).cast("timestamp_ntz") for d in (dt.date(2001, 7, 15), dt.date(2001, 7, 1))
    )
    early = monthly_sales(shop, shop.sales.where((at < known) | at.isNull()))
    files.store_summary(early, path, "month")
    late = monthly_sales(shop, shop.sales.where(at >= month))
    return files.refresh_summary(late, path, "month")


@query("s9_monthly_sales_by_differences", MONTHLY_SQL, money="revenue", dates="month")
def monthly_sales_by_differences(shop) -> DataFrame:
    """The monthly summary as of mid-July 2001, when orders counted that were cancelled since;
    then one refresh with the orders that came later and without the cancelled ones."""
    spark, at = shop.spark, F.col("ordered_at")
    early = (at < F.lit(dt.date(2001, 7, 15)).cast("timestamp_ntz")) | at.isNull()
    keys = ("month", "region", "category")
    summary = Summary(scratch_path(spark, "summary"), keys, "month", "customer_id", ("units", "revenue"))
    first = monthly_partials(shop, shop.orders.where(early))
    summary.refresh(first)
    cancelled = shop.orders.where(early & (F.col("status") == "P"))
    summary.refresh(
        monthly_partials(shop, shop.sales.where(~early)), monthly_partials(shop, cancelled)
    )
    found = summary.read(spark, first.schema, "unique_customers")
    return found.select(
        *keys, F.col("rows").alias("order_count"), "unique_customers", F.col("units").alias("units_sold"), "revenue"
    )


@query(
    "s10_batches_appended_once",
    """SELECT order_id, line_no, product_id, quantity, line_total, return_flag FROM items""",
    money="line_total",
)
def batches_appended_once(shop) -> DataFrame:
    """Order lines loaded in three batches, two of them sent again."""
    root = scratch_path(shop.spark, "facts")
    lines = shop.items.select("order_id", "line_no", "product_id", "quantity", "line_total", "return_flag")
    for batch in (0, 1, 1, 2, 0):
        append_batch(lines.where(F.col("order_id") % 3 == batch), root, "return_flag", f"load-{batch}")
    return read_appended(shop.spark, root, lines.schema)


@query(
    "s11_clustered_layout",
    """SELECT order_id, status, order_date FROM all_orders
       WHERE status = 'F' AND order_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'""",
    dates="order_date",
)
def clustered_layout(shop) -> DataFrame:
    """Orders partitioned by status and clustered by date; the filter prunes partitions
    and skips row groups."""
    path = scratch_path(shop.spark, "clustered")
    rows = shop.orders.select("order_id", "customer_id", "order_date", "amount", "status")
    files.write_clustered(rows, path, "status", ["order_date", "order_id"])
    stored = files.read_summary(rows, path)
    days = F.col("order_date").between(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 6, 30)))
    return stored.where((F.col("status") == "F") & days).select("order_id", "status", "order_date")


@query(
    "s11_z_ordered_layout",
    """WITH placed AS (
         SELECT order_id, line_no, customer_id, order_date, product_id, quantity
         FROM items JOIN all_orders USING (order_id)),
       picked AS (
         SELECT max(customer_id) // 2 AS customer, max(product_id) // 2 AS product FROM placed)
       SELECT 'customer' AS found_by, order_id, line_no, quantity FROM placed, picked
       WHERE customer_id BETWEEN customer AND customer + 20
       UNION ALL
       SELECT 'product', order_id, line_no, quantity FROM placed, picked
       WHERE product_id BETWEEN product AND product + 20
       UNION ALL
       SELECT 'date', order_id, line_no, quantity FROM placed
       WHERE order_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-07'""",
)
def z_ordered_layout(shop) -> DataFrame:
    """Order lines along a Z-curve over customer, date and product; a filter on each of the
    three reads a small part of the files."""
    path = scratch_path(shop.spark, "z-order")
    lines = shop.items.select("order_id", "line_no", "product_id", "quantity")
    orders = shop.orders.select("order_id", "customer_id", "order_date")
    rows = stage(lines.join(orders, "order_id"), "lines")
    files.write_z_ordered(rows, path, ["customer_id", "order_date", "product_id"], lookups=("order_id",))
    stored = files.read_summary(rows, path)
    top = stored.agg(F.max("customer_id").alias("customer"), F.max("product_id").alias("product")).first()
    customer, product = (top.customer or 0) // 2, (top.product or 0) // 2
    days = F.col("order_date").between(F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1997, 3, 7)))
    parts = (
        ("customer", F.col("customer_id").between(customer, customer + 20)),
        ("product", F.col("product_id").between(product, product + 20)),
        ("date", days),
    )
    return reduce(DataFrame.unionByName, [
        stored.where(hit).select(F.lit(name).alias("found_by"), "order_id", "line_no", "quantity")
        for name, hit in parts
    ])
