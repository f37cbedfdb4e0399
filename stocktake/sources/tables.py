"""Table definitions and the retail view over the parquet tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(10, 2)
TOTAL = T.DecimalType(22, 2)



# The relational store's tables.
STORE_SCHEMAS = {
    "categories": "id BIGINT NOT NULL, name STRING NOT NULL, description STRING",
    "products": (
        "id BIGINT NOT NULL, name STRING NOT NULL, description STRING, price DECIMAL(10,2) NOT NULL, "
        "category_id BIGINT NOT NULL, stock_qty INT, created_at TIMESTAMP_NTZ"
    ),
    "customers": (
        "id BIGINT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "email STRING NOT NULL, city STRING, region STRING, signup_date DATE NOT NULL, "
        "is_premium BOOLEAN"
    ),
    "orders": (
        "id BIGINT NOT NULL, customer_id BIGINT NOT NULL, order_date TIMESTAMP_NTZ NOT NULL, "
        "status STRING NOT NULL, total_amount DECIMAL(12,2) NOT NULL, payment_method STRING"
    ),
    "order_items": (
        "id BIGINT NOT NULL, order_id BIGINT NOT NULL, product_id BIGINT NOT NULL, "
        "quantity INT NOT NULL, unit_price DECIMAL(10,2) NOT NULL"
    ),
}

# The star schema's tables.
WAREHOUSE_SCHEMAS = {
    "dim_date": (
        "date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
        "day_of_month INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN, "
        "fiscal_quarter STRING"
    ),
    "dim_customers_scd2": (
        "customer_sk BIGINT, customer_id STRING, first_name STRING, last_name STRING, "
        "email STRING, city STRING, region STRING, tier STRING, effective_date DATE, "
        "end_date DATE, is_current BOOLEAN"
    ),
    "dim_products": (
        "product_sk BIGINT, product_id STRING, product_name STRING, category STRING, "
        "current_price DECIMAL(10,2)"
    ),
    "fact_sales": (
        "sales_fact_id BIGINT, order_id STRING, date_key INT, customer_sk BIGINT, "
        "product_sk BIGINT, quantity INT, unit_price DECIMAL(10,2), gross_amount DECIMAL(12,2), "
        "discount_amount DECIMAL(10,2), net_revenue DECIMAL(12,2)"
    ),
}

# Defaults filled in on load, as SQL expressions.
STORE_DEFAULTS = {
    "products": {"stock_qty": "0", "created_at": "localtimestamp()"},
    "customers": {"signup_date": "current_date()", "is_premium": "false"},
    "orders": {"order_date": "localtimestamp()", "status": "'pending'"},
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL({**STORE_SCHEMAS, **WAREHOUSE_SCHEMAS}[table])


def apply_table(
    df: DataFrame, schema: T.StructType, defaults: dict[str, str | Column] | None = None
) -> DataFrame:
    """Project ``df`` onto a typed table: missing or null columns take their default."""
    defaults = defaults or {}

    def column(field: T.StructField) -> Column:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            default = defaults[field.name]
            default = F.expr(default) if isinstance(default, str) else default
            value = F.coalesce(value, default.cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema])


# Schemas read from the file footers, once per path: each look is a Spark job.
_SCHEMAS: dict[str, T.StructType] = {}


@dataclass(frozen=True)
class Retail:
    """The shop's tables as read from ``path``: customers, orders, items, products.

    Amounts are exact decimals. Status ``P`` plays the cancelled order.
    """

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        path = f"{self.path}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def geography(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("nation_id"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def people(self) -> DataFrame:
        """Customers without their place names."""
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation_id"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.people.join(self.geography, "nation_id").select(
            "customer_id", "customer_name", "segment", "nation", "region"
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("ordered_at"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.col("o_orderpriority").alias("payment"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Orders that count as revenue."""
        return self.orders.where(F.col("status") != "P")

    @cached_property
    def signups(self) -> DataFrame:
        """A customer signs up with the first order of any status."""
        return self.orders.groupBy("customer_id").agg(F.min("order_date").alias("signup_date"))

    @cached_property
    def items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("line_total"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.col("p_size").alias("size"),
            F.col("p_retailprice").cast(PRICE).alias("price"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")
