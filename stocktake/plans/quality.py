"""Quality queries over a raw, all-text copy of the orders.

The raw copy has what a careless export produces: urgent orders written twice, blank
and marker values, numbers that do not parse, and a few absurd amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators import quality as Q
from stocktake.plans.registry import query, scaled
from stocktake.session import scratch_path
from stocktake.sources import files

RAW_SCHEMA = "order_id:int, units:int, amount:float, note"
REQUIRED = ["customer_id", "ordered"]


def raw_orders(shop) -> DataFrame:
    o = shop.orders
    status, payment = F.col("status"), F.col("payment")
    new_year = (F.month("order_date") == 1) & (F.dayofmonth("order_date") == 1)
    rows = o.select(
        (F.col("order_id") + 1).alias("row_no"),
        F.col("order_id").cast("string").alias("order_id"),
        F.when((status == "P") & (payment == "5-LOW"), "")
        .when((status == "F") & (payment == "2-HIGH"), " N/A ")
        .otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
        F.when(payment == "3-MEDIUM", "null")
        .when((payment == "4-NOT SPECIFIED") & (status != "F"), F.col("amount").cast("string"))
        .when(payment == "5-LOW", "")
        .otherwise((F.col("order_id") % 100).cast("string")).alias("units"),
        F.when(new_year, F.col("amount") * 100).otherwise(F.col("amount")).cast("string").alias("amount"),
        F.when((payment == "5-LOW") & (status == "O"), "-")
        .otherwise(F.col("order_date").cast("string")).alias("ordered"),
        F.when(status == "O", F.lit("None")).when(status == "F", "nan").otherwise("ok").alias("note"),
        (payment == "1-URGENT").alias("urgent"),
    )
    again = rows.where("urgent").withColumn("row_no", F.col("row_no") + 1_000_000_000_000)
    return rows.unionByName(again).drop("urgent")


RAW_CTE = """
once AS (
  SELECT order_id + 1 AS row_no, CAST(order_id AS VARCHAR) AS order_id,
         CASE WHEN status = 'P' AND payment = '5-LOW' THEN ''
              WHEN status = 'F' AND payment = '2-HIGH' THEN ' N/A '
              ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
         CASE WHEN payment = '3-MEDIUM' THEN 'null'
              WHEN payment = '4-NOT SPECIFIED' AND status <> 'F' THEN CAST(amount AS VARCHAR)
              WHEN payment = '5-LOW' THEN '' ELSE CAST(order_id % 100 AS VARCHAR) END AS units,
         CAST(CASE WHEN month(order_date) = 1 AND day(order_date) = 1 THEN amount * 100
                   ELSE amount END AS VARCHAR) AS amount,
         CASE WHEN payment = '5-LOW' AND status = 'O' THEN '-'
              ELSE CAST(order_date AS VARCHAR) END AS ordered,
         CASE status WHEN 'O' THEN 'None' WHEN 'F' THEN 'nan' ELSE 'ok' END AS note, payment
  FROM all_orders),
raw AS (SELECT * EXCLUDE (payment) FROM once
        UNION ALL SELECT * EXCLUDE (payment) REPLACE (row_no + 1000000000000 AS row_no)
        FROM once WHERE payment = '1-URGENT'),
complete AS (SELECT * EXCLUDE (payment) FROM once
             WHERE lower(trim(customer_id)) NOT IN ('', 'n/a') AND ordered <> '-')"""
PARTS = ["order_id", "customer_id", "units", "amount", "ordered", "note"]
MISSING = "lower(trim({c})) IN ('', 'null', 'none', 'na', 'n/a', 'nan', '-')"
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(CASE WHEN {MISSING.format(c=c)} THEN 1 END)"
    " AS nulls FROM raw" for c in PARTS
)


@query(
    "q1_null_profile",
    f"""WITH {RAW_CTE.strip()} SELECT *, CAST(nulls AS DOUBLE) / rows AS null_share,
               nulls * 2 > rows AS warn FROM ({PROFILE_SQL})""",
)
def null_profile(shop) -> DataFrame:
    return Q.null_profile(raw_orders(shop).drop("row_no"))


@query(
    "q2_required_gate",
    f"""WITH {RAW_CTE.strip()}
        SELECT max(rows) AS rows, string_agg(CASE WHEN nulls > 0 THEN "column" END, ',' ORDER BY "column")
               AS broken_columns, count(CASE WHEN nulls > 0 THEN 1 END) = 0 AS is_valid
        FROM ({PROFILE_SQL}) WHERE "column" IN ('customer_id', 'ordered')""",
)
def required_gate(shop) -> DataFrame:
    profile = Q.null_profile(raw_orders(shop).drop("row_no"))
    gate = Q.required_gate(profile, [*REQUIRED, "not_there"])
    return gate.withColumn("broken_columns", F.array_join("broken_columns", ","))


@query(
    "q3_duplicate_rows",
    f"""WITH {RAW_CTE.strip()} SELECT count(*) AS rows, count(DISTINCT order_id) AS distinct_rows,
               count(*) - count(DISTINCT order_id) AS duplicates FROM raw""",
)
def duplicate_rows(shop) -> DataFrame:
    return Q.duplicate_summary(raw_orders(shop).drop("row_no"))


@query("n2_distinct_rows_keep_first", f"WITH {RAW_CTE.strip()} SELECT * EXCLUDE (payment) FROM once")
def distinct_rows_keep_first(shop) -> DataFrame:
    return Q.drop_exact_duplicates(raw_orders(shop), "row_no")


@query(
    "q4_type_errors",
    f"""WITH {RAW_CTE.strip()} SELECT row_no, 'units' AS "column", units AS value, 'int' AS expected
        FROM raw WHERE trim(units) <> '' AND NOT regexp_full_match(trim(units), '[+-]?[0-9]+')""",
)
def type_errors(shop) -> DataFrame:
    return Q.type_errors(raw_orders(shop), files.parse_schema(RAW_SCHEMA), "row_no")


@query(
    "q5_cast_with_rejects",
    f"""WITH {RAW_CTE.strip()} SELECT row_no, CAST(order_id AS BIGINT) AS order_id, customer_id,
               CASE WHEN regexp_full_match(units, '[0-9]+') THEN CAST(units AS BIGINT) END AS units,
               CAST(amount AS DOUBLE) AS amount, nullif(note, 'none') AS note,
               CASE WHEN units LIKE '%.%' THEN 'units=' || units ELSE '' END AS rejects
        FROM (SELECT * REPLACE (nullif(customer_id, '') AS customer_id) FROM raw)""",
)
def cast_with_rejects(shop) -> DataFrame:
    """Typed rows; text that does not parse goes to the reject map."""
    raw = raw_orders(shop).drop("ordered")
    cast = Q.cast_with_rejects(raw, files.parse_schema(RAW_SCHEMA))
    pairs = F.transform(F.map_entries("_rejects"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return cast.withColumn("rejects", F.array_join(pairs, ",")).drop("_rejects")


@query(
    "q6_quarantine_incomplete",
    f"""WITH {RAW_CTE.strip()} SELECT row_no, customer_id, ordered FROM raw
        WHERE lower(trim(customer_id)) IN ('', 'n/a') OR ordered = '-'""",
)
def quarantine_incomplete(shop) -> DataFrame:
    return Q.split_required(raw_orders(shop), REQUIRED)[1].select("row_no", "customer_id", "ordered")


@query(
    "f17_missing_in_column",
    f"WITH {RAW_CTE.strip()} SELECT row_no, note FROM raw WHERE note IN ('None', 'nan')",
)
def missing_in_column(shop) -> DataFrame:
    return Q.missing_in(raw_orders(shop), "note").select("row_no", "note")


def _stat_sql(column: str, source: str, name: str) -> str:
    return f"""SELECT '{name}' AS "column", count({column}) AS count, round(avg({column}), 3) AS mean,
        quantile_cont({column}, 0.5) AS median, round(stddev_samp({column}), 3) AS std_dev,
        min({column}) AS min, max({column}) AS max FROM {source}"""


AMOUNTS = "(SELECT row_no, CAST(amount AS DOUBLE) AS v FROM raw)"
UNITS = "(SELECT CASE WHEN trim(units) NOT IN ('', 'null') THEN CAST(units AS DOUBLE) END AS v FROM raw)"


def rounded(stats: DataFrame) -> DataFrame:
    return stats.select(
        "column", "count", F.round("mean", 3).alias("mean"), "median",
        F.round("std_dev", 3).alias("std_dev"), "min", "max",
    )


@query(
    "a17_text_column_stats",
    f"WITH {RAW_CTE.strip()} {_stat_sql('v', AMOUNTS, 'amount')} UNION ALL {_stat_sql('v', UNITS, 'units')}",
)
def text_column_stats(shop) -> DataFrame:
    return rounded(Q.column_stats(raw_orders(shop), ["amount", "units"]))


LINES = "(SELECT CAST({c} AS DOUBLE) AS v FROM items)"


@query(
    "a17_line_column_stats",
    " UNION ALL ".join(
        _stat_sql("v", LINES.format(c=c), c) for c in ("quantity", "line_total")
    ),
)
def line_column_stats(shop) -> DataFrame:
    """Profile of typed columns over all order lines, with exact medians."""
    return rounded(Q.column_stats(shop.items, ["quantity", "line_total"]))


@query(
    "q7_three_sigma_outliers",
    f"""WITH {RAW_CTE.strip()}, numbers AS (SELECT * FROM {AMOUNTS})
        SELECT 'amount' AS "column", row_no, v AS value FROM numbers
        WHERE abs(v - (SELECT avg(v) FROM numbers)) > 3 * (SELECT stddev_samp(v) FROM numbers)""",
)
def three_sigma_outliers(shop) -> DataFrame:
    raw = raw_orders(shop)
    return Q.outliers(raw, ["amount"], "row_no", Q.column_stats(raw, ["amount"]))


@query(
    "q8_key_violations",
    """SELECT order_id, line_no, count(*) AS occurrences FROM items
       GROUP BY order_id, line_no HAVING count(*) > 1""",
)
def key_violations(shop) -> DataFrame:
    return Q.key_violations(shop.items, ["order_id", "line_no"])


@query(
    "q9_orphan_lines",
    """SELECT order_id, line_no, product_id FROM items
       WHERE order_id NOT IN (SELECT order_id FROM sales)""",
)
def orphan_lines(shop) -> DataFrame:
    """Lines whose order is not among the orders that count."""
    lines = shop.items.select("order_id", "line_no", "product_id")
    return Q.orphans(lines, "order_id", shop.sales, "order_id")


@query(
    "q10_q11_rule_violations",
    """SELECT 'quantity positive' AS rule, count(CASE WHEN quantity <= 0 THEN 1 END) AS violations FROM items
       UNION ALL SELECT 'quantity at most 49', count(CASE WHEN quantity > 49 THEN 1 END) FROM items
       UNION ALL SELECT 'return flag known', count(CASE WHEN return_flag NOT IN ('A', 'N') THEN 1 END) FROM items
       UNION ALL SELECT 'ship date set', count(*) - count(ship_date) FROM items
       UNION ALL SELECT 'status fits one letter', count(CASE WHEN length(line_status) > 1 THEN 1 END) FROM items""",
)
def rule_violations(shop) -> DataFrame:
    """Range, domain, not-null and length rules in one pass."""
    return Q.rule_violations(
        shop.items,
        {
            "quantity positive": F.col("quantity") > 0,
            "quantity at most 49": F.col("quantity") <= 49,
            "return flag known": F.col("return_flag").isin("A", "N"),
            "ship date set": F.col("ship_date").isNotNull(),
            "status fits one letter": F.length("line_status") <= 1,
        },
    )


@query(
    "q14_header_line_gaps",
    """SELECT order_id, amount, line_sum, amount - coalesce(line_sum, 0) AS gap
       FROM all_orders LEFT JOIN (SELECT order_id, sum(line_total) AS line_sum FROM items GROUP BY 1)
       USING (order_id) WHERE amount <> coalesce(line_sum, 0)""",
    money="amount line_sum gap",
)
def header_line_gaps(shop) -> DataFrame:
    return Q.header_line_gaps(shop.orders, shop.items, "order_id", "amount", "line_total")


def _cleaned(shop) -> Q.Cleaning:
    schema = files.parse_schema(RAW_SCHEMA)
    return Q.Cleaning(raw_orders(shop), schema, "row_no", tuple(REQUIRED), ("amount", "units"))


@query(
    "q12_run_summary",
    f"""WITH {RAW_CTE.strip()}, n AS (SELECT (SELECT count(*) FROM raw) AS rows_in,
               (SELECT count(*) FROM once) AS unique_rows, (SELECT count(*) FROM complete) AS rows_out)
        SELECT rows_in, rows_in - unique_rows AS duplicates, unique_rows - rows_out AS incomplete_rows,
               rows_out, {scaled('rows_out * 100', 'rows_in', 1)} AS kept_pct FROM n""",
)
def run_summary(shop) -> DataFrame:
    return _cleaned(shop).summary


@query(
    "q13_recommendations",
    f"""WITH {RAW_CTE.strip()}, numbers AS (SELECT CAST(amount AS DOUBLE) AS v FROM complete)
        SELECT 'duplicates' AS finding, NULL AS "column",
               CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM once) AS DOUBLE) AS value
        UNION ALL SELECT 'high null share', "column", CAST(nulls AS DOUBLE) / rows
        FROM ({PROFILE_SQL}) WHERE nulls * 10 > rows * 3
        UNION ALL SELECT 'outliers', 'amount', CAST(count(*) AS DOUBLE) FROM numbers
        WHERE abs(v - (SELECT avg(v) FROM numbers)) > 3 * (SELECT stddev_samp(v) FROM numbers)
        HAVING count(*) > 0
        UNION ALL SELECT 'outliers', 'units', CAST(count(*) AS DOUBLE) FROM (
          SELECT CASE WHEN trim(units) NOT IN ('', 'null') THEN CAST(units AS DOUBLE) END AS v FROM complete)
        WHERE abs(v - (SELECT avg(CAST(units AS DOUBLE)) FROM complete WHERE trim(units) NOT IN ('', 'null')))
          > 3 * (SELECT stddev_samp(CAST(units AS DOUBLE)) FROM complete WHERE trim(units) NOT IN ('', 'null'))
        HAVING count(*) > 0""",
)
def quality_recommendations(shop) -> DataFrame:
    return _cleaned(shop).recommendations


@query(
    "q15_cleaned_rows",
    f"""WITH {RAW_CTE.strip()} SELECT row_no, CAST(order_id AS BIGINT) AS order_id, customer_id,
               CASE WHEN regexp_full_match(units, '[0-9]+') THEN CAST(units AS BIGINT) END AS units,
               CAST(amount AS DOUBLE) AS amount, ordered, note,
               CAST(units LIKE '%.%' AS INTEGER) AS rejects FROM complete""",
)
def cleaned_rows(shop) -> DataFrame:
    """Gate, copies removed, incomplete rows set aside, values cast."""
    return _cleaned(shop).rows.withColumn("rejects", F.size("_rejects")).drop("_rejects")


def _flow(shop) -> str:
    """Raw rows from CSV files, through the gate, to a published table."""
    files_, root = scratch_path(shop.spark, "csv"), scratch_path(shop.spark, "cleaned")
    files.export_csv(raw_orders(shop), files_)
    columns = ["row_no", *PARTS]
    raw = files.read_csv(shop.spark, files_, columns).drop(files.CORRUPT)
    raw = raw.withColumn("row_no", F.col("row_no").cast("long"))
    schema = files.parse_schema(RAW_SCHEMA)
    Q.publish_cleaned(raw, root, schema, "row_no", ("order_id", "amount"), tuple(REQUIRED))
    return root


@query(
    "q15_published_rows",
    f"""WITH {RAW_CTE.strip()} SELECT row_no, CAST(order_id AS BIGINT) AS order_id, customer_id,
               CASE WHEN regexp_full_match(units, '[0-9]+') THEN CAST(units AS BIGINT) END AS units,
               CAST(amount AS DOUBLE) AS amount, ordered, note,
               CAST(units LIKE '%.%' AS INTEGER) AS rejects FROM complete""",
)
def published_rows(shop) -> DataFrame:
    """The CSV flow as a whole: file, gate, copies removed, incomplete rows aside, cast."""
    rows = Q.published(shop.spark, _flow(shop))
    return rows.withColumn("rejects", F.size("_rejects")).drop("_rejects", "_copies")


@query(
    "q15_published_summary",
    f"""WITH {RAW_CTE.strip()}, n AS (SELECT (SELECT count(*) FROM raw) AS rows_in,
               (SELECT count(*) FROM once) AS unique_rows, (SELECT count(*) FROM complete) AS rows_out)
        SELECT rows_in, rows_in - unique_rows AS duplicates, unique_rows - rows_out AS incomplete_rows,
               rows_out, {scaled('rows_out * 100', 'rows_in', 1)} AS kept_pct FROM n""",
)
def published_summary(shop) -> DataFrame:
    return Q.published_summary(shop.spark, _flow(shop))
