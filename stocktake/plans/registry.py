"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.session import tune
from stocktake.sources.tables import Retail

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# Common table expressions of the checks: the retail view in SQL.
RETAIL_SQL = """
geography AS (
  SELECT n_nationkey AS nation_id, n_name AS nation, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, nation, region
  FROM customer JOIN geography ON c_nationkey = nation_id),
all_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CAST(round(o_totalprice * 100) AS HUGEINT) AS cents, o_orderpriority AS payment
  FROM orders),
sales AS (SELECT * FROM all_orders WHERE status <> 'P'),
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total,
         CAST(round(l_extendedprice * 100) AS HUGEINT) AS line_cents,
         CAST(abs(round(l_discount * 100)) AS HUGEINT) AS discount_pct,
         l_returnflag AS return_flag, l_linestatus AS line_status,
         CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
         p_size AS size, CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part)"""


def half_up(numerator: str, denominator: str) -> str:
    """SQL for numerator / denominator rounded half away from zero to a whole number,
    in exact integers; NULL for a zero denominator."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE"
        f" (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
        f" * ((2 * abs({n}) + abs({d})) // (2 * abs(CASE WHEN {d} = 0 THEN 1 ELSE {d} END))) END)"
    )


def scaled(numerator: str, denominator: str, digits: int) -> str:
    """SQL for numerator / denominator rounded to ``digits`` decimals, as DOUBLE."""
    return f"(CAST({half_up(f'({numerator}) * {10**digits}', denominator)} AS DOUBLE) / {10**digits})"


def portable(df: DataFrame) -> DataFrame:
    """Edge form of a result for comparison across engines: decimals as double,
    dates and timestamps as text."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema])


def check_sql(
    body: str, money: str = "", dates: str = "", times: str = "", ints: str = "",
    retail: bool = True,
) -> str:
    """The check: ``body`` may use the retail view; listed columns take the edge form."""
    swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in times.split()]
    swaps += [f"CAST({c} AS INTEGER) AS {c}" for c in ints.split()]
    head = f"WITH {RETAIL_SQL.strip()}\n" if retail else ""
    replace = f" REPLACE ({', '.join(swaps)})" if swaps else ""
    return f"{head}SELECT *{replace} FROM (\n{body.strip()}\n)"


def query(
    name: str, sql: str | None = None, money: str = "", dates: str = "", times: str = "",
    ints: str = "", retail: bool = True,
) -> Callable[[Callable[[Retail], DataFrame]], Callable[[Retail], DataFrame]]:
    """Register ``fn(retail) -> DataFrame`` under ``name`` with its check."""

    def register(fn: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(Retail(tune(spark), str(sf_dir).rstrip("/"))))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = check_sql(sql, money, dates, times, ints, retail)
        return fn

    return register
