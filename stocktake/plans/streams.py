"""Streaming forms run over the tables as file streams, and the fixed-window marking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators.ttl import mark_repeats
from stocktake.plans.registry import query
from stocktake.plans.warehouse import VERSIONS_CTE
from stocktake.session import scratch_path
from stocktake.sources.tables import TOTAL
from stocktake.streaming import streams as X


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stream(shop, table: str) -> DataFrame:
    schema = shop.table(table).schema
    return X.read_stream(shop.spark, shop.path, f"{table}.parquet", schema)


def _collected(shop, stream: DataFrame) -> DataFrame:
    out, checkpoint = scratch_path(shop.spark, "stream-out"), scratch_path(shop.spark, "stream-ck")
    X.run_available(stream, out, checkpoint)
    return shop.spark.read.schema(stream.schema).parquet(out)


def _latest(shop, stream: DataFrame, keys: list[str]) -> DataFrame:
    out, checkpoint = scratch_path(shop.spark, "stream-out"), scratch_path(shop.spark, "stream-ck")
    return X.run_latest(stream, keys, out, checkpoint)


def _timed(shop) -> DataFrame:
    amount = F.col("value").cast("decimal(12,2)").alias("amount")
    return _stream(shop, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), amount
    )


@query(
    "x1_stream_revenue_per_window",
    """SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, sum(amount) AS revenue,
              count(*) AS n
       FROM (SELECT date_trunc('hour', ts) AS hour, CAST(value AS DECIMAL(12,2)) AS amount
             FROM events WHERE event_type = 'purchase') GROUP BY hour""",
    money="revenue", times="window_start window_end", retail=False,
)
def stream_revenue_per_window(shop) -> DataFrame:
    """Hourly purchase revenue, the windows still open included."""
    bought = _timed(shop).where(F.col("event_type") == "purchase")
    hours = X.windowed_revenue(bought, "ts", "amount", "1 hour", "10 minutes")
    return _latest(shop, hours.withColumn("revenue", F.col("revenue").cast(TOTAL)), ["window_start"])


@query(
    "x2_stream_first_arrival",
    """SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id FROM events
       ORDER BY user_id, event_type, ts, event_id""",
    retail=False,
)
def stream_first_arrival(shop) -> DataFrame:
    """The first event per user and type, over any span of time."""
    keys = ["user_id", "event_type"]
    first = X.first_per_key(_timed(shop), keys, "ts", "event_id")
    return _latest(shop, first, keys).select(*keys, "event_id")


@query(
    "x3_stream_scd2_load",
    f"WITH {VERSIONS_CTE.strip()} SELECT * FROM versions",
    dates="effective_date end_date",
)
def stream_scd2_load(shop) -> DataFrame:
    """The change feed as a stream, merged into the dimension batch by batch."""
    feed = _stream(shop, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("payment"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderkey").alias("order_id"),
    )
    root, checkpoint = scratch_path(shop.spark, "dim"), scratch_path(shop.spark, "stream-ck")
    X.scd2_stream(
        feed, root, checkpoint, "customer_id", ["payment"], "order_date", "order_id", "customer_sk",
        buckets=16,
    )
    schema = X.versions_schema(feed, "customer_id", "order_date", "order_id", "customer_sk")
    return X.read_dimension(shop.spark, root, schema, "customer_id")


@query(
    "x4_first_in_ttl_window",
    """WITH RECURSIVE chain AS (
         SELECT user_id, min(ts) AS opener FROM events GROUP BY user_id
         UNION ALL
         SELECT c.user_id, min(e.ts) FROM chain c JOIN events e
           ON e.user_id = c.user_id AND e.ts > c.opener + INTERVAL 1 DAY GROUP BY c.user_id)
       SELECT event_id, e.user_id, opener IS NULL AS is_repeat
       FROM events e LEFT JOIN chain c ON e.user_id = c.user_id AND e.ts = c.opener""",
    retail=False,
)
def first_in_ttl_window(shop) -> DataFrame:
    marked = mark_repeats(
        shop.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id", 86_400
    )
    return marked.select("event_id", "user_id", "is_repeat")


@query(
    "x5_stream_enrichment",
    """SELECT event_id, user_id, segment FROM events
       LEFT JOIN customers ON customer_id = user_id""",
)
def stream_enrichment(shop) -> DataFrame:
    profiles = shop.customers.select(F.col("customer_id").alias("user_id"), "segment")
    events = _timed(shop).select("event_id", "user_id")
    return _collected(shop, X.enrich(events, profiles, "user_id").select("event_id", "user_id", "segment"))


@query(
    "x4_stream_first_in_ttl_window",
    """WITH RECURSIVE chain AS (
         SELECT user_id, min(ts) AS opener FROM events GROUP BY user_id
         UNION ALL
         SELECT c.user_id, min(e.ts) FROM chain c JOIN events e
           ON e.user_id = c.user_id AND e.ts > c.opener + INTERVAL 1 DAY GROUP BY c.user_id),
       opening AS (SELECT c.user_id, opener, min(event_id) AS event_id FROM chain c
         JOIN events e ON e.user_id = c.user_id AND e.ts = c.opener GROUP BY 1, 2)
       SELECT e.event_id, e.user_id, o.event_id IS NULL AS is_repeat
       FROM events e LEFT JOIN opening o ON e.event_id = o.event_id""",
    retail=False,
)
def stream_first_in_ttl_window(shop) -> DataFrame:
    """The events as a stream of three batches, up to two days out of order."""
    spark = shop.spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    source, out, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("in", "out", "ck"))
    events = shop.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    low, high = events.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    arrives = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(2 * 86_400))
    length = ((high or 0) + 2 * 86_400 - (low or 0)) // 3 + 1
    batch = F.floor((arrives - F.lit(low or 0)) / length)
    marked = None
    for number in range(3):
        events.where(batch == number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        marks = X.first_in_window(stream, "user_id", "ts", "event_id", 86_400, "49 hours")
        marked = X.run_latest(marks, ["event_id"], out, checkpoint)
    return marked.select("event_id", F.col("key").alias("user_id"), "is_repeat")
