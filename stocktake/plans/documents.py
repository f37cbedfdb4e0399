"""Document queries over event documents.

The documents are made from the events table: nested user and device, an items array
sized by the event's ``k``, and no value where a key is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.operators import documents as D
from stocktake.plans.registry import query
from stocktake.session import broadcast_if_few
from stocktake.sources.files import inserts

EVENT_SCHEMA = (
    "_id STRING, event_id STRING, event_type STRING, timestamp STRING, "
    "user STRUCT<user_id: STRING, tier: STRING, city: STRING>, "
    "device STRUCT<os: STRING, type: STRING>, "
    "items ARRAY<STRUCT<product_id: STRING, qty: INT, price: DECIMAL(10,2)>>, "
    "total_amount DECIMAL(12,2), position BIGINT"
)

# The same documents in SQL, already flat; NULL stands for a missing key.
DOCS_CTE = """
docs AS (
  SELECT event_id AS position, 'EVT_' || event_id AS doc_id, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, 'U' || user_id AS user_id,
         CASE user_id % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'standard' END AS tier,
         CASE event_id % 4 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' END AS os,
         CAST(value AS DECIMAL(12,2)) AS total_amount,
         CAST(round(value * 100) AS HUGEINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
doc_items AS (
  SELECT doc_id, position, i, 'P' || (k * i) AS product_id, CASE WHEN i <> 2 THEN i END AS qty,
         total_amount + i AS price
  FROM (SELECT *, unnest(generate_series(1, k % 4)) AS i FROM docs))"""


def event_docs(shop) -> DataFrame:
    """The events as nested documents with the columns of ``EVENT_SCHEMA``."""
    return event_documents(shop.events)


def event_json(events: DataFrame) -> DataFrame:
    """The documents as JSON text, one per row; keys without a value are left out."""
    return event_documents(events).select(F.to_json(F.struct("*")).alias("value"))


def event_documents(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    amount = F.col("value").cast("decimal(12,2)")
    items = F.transform(
        F.when(k % 4 > 0, F.sequence(F.lit(1), k % 4)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.concat(F.lit("P"), (k * i).cast("string")).alias("product_id"),
            F.when(i != 2, i).alias("qty"),
            (amount + i).cast("decimal(10,2)").alias("price"),
        ),
    )
    user, event = F.col("user_id"), F.col("event_id")
    tier = F.when(user % 3 == 0, "premium").when(user % 3 == 1, "standard")
    system = F.when(event % 4 == 0, "iOS").when(event % 4 == 1, "Android").when(
        event % 4 == 2, "Windows")
    absent = F.lit(None).cast("string")
    return events.select(
        F.concat(F.lit("EVT_"), event.cast("string")).alias("_id"),
        absent.alias("event_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.struct(
            F.concat(F.lit("U"), user.cast("string")).alias("user_id"),
            tier.alias("tier"),
            absent.alias("city"),
        ).alias("user"),
        F.struct(system.alias("os"), absent.alias("type")).alias("device"),
        items.alias("items"),
        amount.alias("total_amount"),
        event.alias("position"),
    )

@query(
    "b30_purchase_revenue_by_tier",
    f"""WITH {DOCS_CTE.strip()}
        SELECT tier AS user_tier, sum(total_amount) AS total_revenue, count(*) AS purchase_count,
               CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_ticket_size
        FROM docs WHERE event_type = 'purchase' GROUP BY tier""",
    money="total_revenue", retail=False,
)
def purchase_revenue_by_tier(shop) -> DataFrame:
    """Match, group and project stages; the missing tier forms its own group."""
    return D.aggregate(
        event_docs(shop),
        [
            {"$match": {"event_type": "purchase"}},
            {"$group": {"_id": "$user.tier", "total_revenue": {"$sum": "$total_amount"},
                        "purchase_count": {"$sum": 1}, "avg_ticket_size": {"$avg": "$total_amount"}}},
            {"$project": {"user_tier": "$_id", "total_revenue": 1, "purchase_count": 1,
                          "avg_ticket_size": 1}},
        ],
    )


@query(
    "a14_group_whole_collection",
    f"""WITH {DOCS_CTE.strip()}
        SELECT NULL AS _id, count(*) AS n, sum(total_amount) AS total,
               CAST((2 * sum(coalesce(cents, 0)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS mean,
               CAST(0 AS DOUBLE) AS unknown_sum FROM docs""",
    money="total", ints="_id", retail=False,
)
def group_whole_collection(shop) -> DataFrame:
    """A constant group key; a path no document has sums to zero."""
    spec = {"_id": None, "n": {"$sum": 1}, "total": {"$sum": "$total_amount"},
            "mean": {"$avg": "$total_amount"}, "unknown_sum": {"$sum": "$user.credit"}}
    return D.group(event_docs(shop), spec).withColumn("_id", F.col("_id").cast("int"))


@query(
    "f13_find_documents",
    f"""WITH {DOCS_CTE.strip()} SELECT doc_id AS _id, user_id, total_amount FROM docs
        WHERE event_type = 'purchase' AND os = 'iOS' AND tier IS NULL""",
    money="total_amount", retail=False,
)
def find_documents(shop) -> DataFrame:
    """Equality on nested paths; ``None`` finds the documents without the key."""
    wanted = {"event_type": "purchase", "device.os": "iOS", "user.tier": None}
    found = D.find(event_docs(shop), wanted)
    return found.select("_id", F.col("user.user_id").alias("user_id"), "total_amount")


@query(
    "f14_find_one_document",
    f"""WITH {DOCS_CTE.strip()} SELECT doc_id AS _id, total_amount FROM docs
        WHERE event_type = 'signup' AND user_id = 'U7' ORDER BY position LIMIT 1""",
    money="total_amount", retail=False,
)
def find_one_document(shop) -> DataFrame:
    wanted = {"event_type": "signup", "user.user_id": "U7"}
    return D.find_one(event_docs(shop), wanted, ["position"]).select("_id", "total_amount")


@query(
    "f15_project_documents",
    f"""WITH {DOCS_CTE.strip()} SELECT event_type, tier AS "user.tier", os AS system, 0 AS zero,
               'web' AS channel, NULL AS nothing, position FROM docs""",
    ints="nothing", retail=False,
)
def project_documents(shop) -> DataFrame:
    """Kept paths, renamed paths, constants and a path that no document has."""
    spec = {"event_type": 1, "user.tier": 1, "system": "$device.os", "zero": 0,
            "channel": "web", "nothing": "$user.address.zip", "position": 1}
    return D.project(event_docs(shop), spec).withColumn("nothing", F.col("nothing").cast("int"))


@query(
    "f16_schemaless_paths",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CAST(json_extract_string(props, '$.a.b') AS VARCHAR) AS missing FROM events""",
    retail=False,
)
def schemaless_paths(shop) -> DataFrame:
    """Paths into JSON text of unknown shape."""
    doc = F.try_parse_json("props")
    return shop.events.select(
        "event_id",
        F.try_variant_get(doc, "$.k", "int").alias("k"),
        F.try_variant_get(doc, "$.a.b", "string").alias("missing"),
    )


@query(
    "k5_sort_skip_limit_stages",
    f"""WITH {DOCS_CTE.strip()} SELECT doc_id AS _id, total_amount FROM docs
        WHERE event_type = 'purchase' ORDER BY total_amount DESC, position LIMIT 20 OFFSET 10""",
    money="total_amount", retail=False,
)
def sort_skip_limit_stages(shop) -> DataFrame:
    stages = [
        {"$match": {"event_type": "purchase"}},
        {"$sort": {"total_amount": -1, "position": 1}},
        {"$skip": 10},
        {"$limit": 20},
        {"$project": {"_id": 1, "total_amount": 1}},
    ]
    return D.aggregate(event_docs(shop), stages)


@query(
    "n5_unwind_items",
    f"""WITH {DOCS_CTE.strip()} SELECT product_id, count(*) AS times, sum(price) AS total_price
        FROM doc_items GROUP BY product_id""",
    money="total_price", retail=False,
)
def unwind_items(shop) -> DataFrame:
    stages = [
        {"$unwind": "$items"},
        {"$group": {"_id": "$items.product_id", "times": {"$sum": 1},
                    "total_price": {"$sum": "$items.price"}}},
        {"$project": {"product_id": "$_id", "times": 1, "total_price": 1}},
    ]
    return D.aggregate(event_docs(shop), stages)


_ORDERS_OF = {
    "localField": "customer_id", "foreignField": "customer_id", "as": "orders",
    "order": ["order_date", "order_id"],
}


def _with_orders(shop, *stages: dict) -> DataFrame:
    orders = shop.orders.select("customer_id", "order_id", "order_date", "amount")
    customers = shop.customers.select("customer_id", "region")
    return D.aggregate(customers, [{"$lookup": {"from": orders, **_ORDERS_OF}}, *stages])


@query(
    "j22_lookup_stage",
    """SELECT c.customer_id, rn - 1 AS place, o.order_id FROM customers c LEFT JOIN (
         SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS rn
         FROM all_orders) o ON c.customer_id = o.customer_id""",
)
def lookup_stage(shop) -> DataFrame:
    """Orders of every customer with their place; customers without orders stay."""
    unwind = {"path": "$orders", "includeArrayIndex": "place", "preserveNullAndEmptyArrays": True}
    fields = {"customer_id": 1, "place": 1, "order_id": "$orders.order_id"}
    return _with_orders(shop, {"$unwind": unwind}, {"$project": fields})


@query(
    "j22_lookup_sizes",
    """SELECT region, n AS orders, count(*) AS customers FROM (
         SELECT region, c.customer_id, count(order_id) AS n FROM customers c
         LEFT JOIN all_orders o ON c.customer_id = o.customer_id GROUP BY 1, 2) GROUP BY 1, 2""",
    ints="orders",
)
def lookup_sizes(shop) -> DataFrame:
    """Customers by region and number of orders: each counts once, whatever it has."""
    counted = _with_orders(shop, {"$project": {"region": 1, "n": {"$size": "$orders"}}})
    return counted.groupBy("region", F.col("n").alias("orders")).agg(F.count(F.lit(1)).alias("customers"))


@query(
    "j22_lookup_then_group",
    "SELECT region AS _id, count(*) AS customers FROM customers GROUP BY 1",
)
def lookup_then_group(shop) -> DataFrame:
    return _with_orders(shop, {"$group": {"_id": "$region", "customers": {"$sum": 1}}})


@query(
    "b31_event_parents",
    f"""WITH {DOCS_CTE.strip()}
        SELECT doc_id AS event_id, event_type, timestamp, user_id,
               coalesce(tier, 'standard') AS user_tier, coalesce(os, 'unknown') AS device_os,
               'unknown' AS device_type, total_amount FROM docs""",
    money="total_amount", retail=False,
)
def event_parent_rows(shop) -> DataFrame:
    return D.event_parents(event_docs(shop))


@query(
    "b31_event_children",
    f"""WITH {DOCS_CTE.strip()}
        SELECT doc_id || '_item_' || i AS item_id, doc_id AS event_id, product_id,
               CAST(coalesce(qty, 1) AS INTEGER) AS quantity, price AS unit_price,
               coalesce(qty, 1) * price AS item_subtotal FROM doc_items""",
    money="unit_price item_subtotal", retail=False,
)
def event_child_rows(shop) -> DataFrame:
    return D.event_children(event_docs(shop))


@query(
    "d4_embed_items_in_orders",
    """SELECT order_id, count(*) AS n,
              string_agg(CAST(line_no AS VARCHAR) || ':' || product_id, ',' ORDER BY rn) AS lines
       FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                          ORDER BY line_no, product_id, ship_date, line_total) AS rn
             FROM items) GROUP BY 1""",
)
def embed_items_in_orders(shop) -> DataFrame:
    """Lines nested into their order, the inverse of unwinding."""
    lines = shop.items.select("order_id", "line_no", "product_id", "ship_date", "line_total")
    order = ["line_no", "product_id", "ship_date", "line_total"]
    nested = D.nest(lines, "order_id", order, ["line_no", "product_id"], "items")
    text = F.transform("items", lambda i: F.concat_ws(":", i["line_no"], i["product_id"]))
    return nested.select(
        "order_id", F.size("items").cast("long").alias("n"),
        F.array_join(text, ",").alias("lines"),
    )


@query(
    "s5_ingest_last_document_wins",
    """SELECT CASE WHEN event_type <> 'error' THEN 'D' || event_id % 3000 END AS given_id, event_id,
              event_type FROM (
         SELECT *, row_number() OVER (
                     PARTITION BY CASE WHEN event_type <> 'error' THEN 'D' || event_id % 3000
                                       ELSE 'E' || event_id END ORDER BY event_id DESC) AS rn
         FROM events) WHERE rn = 1""",
    retail=False,
)
def ingest_last_document_wins(shop) -> DataFrame:
    """Repeated ids keep the last document; documents without an id all stay."""
    given = F.when(
        F.col("event_type") != "error",
        F.concat(F.lit("D"), (F.col("event_id") % 3000).cast("string")),
    )
    docs = shop.events.select(given.alias("_id"), "event_id", "event_type", "props")
    kept = D.ingest(docs, "event_id")
    return kept.select(
        F.when(~F.startswith("_id", F.lit("doc_")), F.col("_id")).alias("given_id"),
        "event_id", "event_type",
    )


@query(
    "s7_insert_statements",
    f"""WITH {DOCS_CTE.strip()}
        SELECT 'INSERT INTO stg_events (event_id, event_type, device_os, total_amount) VALUES ('''
               || doc_id || ''', ''' || event_type || '''''s'', ' || coalesce('''' || os || '''', 'NULL')
               || ', ' || total_amount || ');' AS statement FROM docs""",
    retail=False,
)
def insert_statements(shop) -> DataFrame:
    """Rows as INSERT text: numbers bare, quotes doubled, NULL spelled out."""
    docs = event_docs(shop)
    rows = docs.select(
        F.col("_id").alias("event_id"),
        F.concat("event_type", F.lit("'s")).alias("event_type"),
        F.col("device.os").alias("device_os"),
        "total_amount",
    )
    return inserts(rows, "stg_events")


@query(
    "j21_profile_enrichment",
    """SELECT event_id, user_id, customer_name, segment FROM events
       LEFT JOIN (SELECT * FROM customers WHERE segment <> 'BUILDING') ON customer_id = user_id""",
)
def profile_enrichment(shop) -> DataFrame:
    """Keyed lookup of user profiles; a miss leaves NULLs. The profile table is
    broadcast when it is counted to be small."""
    profiles = shop.customers.where(F.col("segment") != "BUILDING").select(
        F.col("customer_id").alias("user_id"), "customer_name", "segment"
    )
    profiles = broadcast_if_few(profiles, shop.table("customer"))
    return shop.events.join(profiles, "user_id", "left").select(
        "event_id", "user_id", "customer_name", "segment"
    )
