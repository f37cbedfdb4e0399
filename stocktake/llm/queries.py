"""The operators of this folder as queries over whole tables, and their SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm import (
    audit,
    bpe,
    idpack,
    mixing,
    neighbours,
    quality,
    sharding,
    simhash,
    spotsigs,
    substring,
    toxicity,
    trie,
    urls,
)
from stocktake.llm.shared import prepare, table, whole
from stocktake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back."""
    coded = bpe.round_trip(table(prepare(spark), sf_dir, "documents"), bpe.Bpe(spark))
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to a packed corpus, and what is read back from it."""
    path = scratch_path(prepare(spark), "packed-ids")
    idpack.write_ids(table(spark, sf_dir, "documents"), path)
    return idpack.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes from every document."""
    documents = table(prepare(spark), sf_dir, "documents")
    sized = documents.select("doc_id", "source", mixing.words().alias("size"))
    mixed = mixing.mix(sized, size=F.col("size"))
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


_OFFSET = (
    "CAST('0x' || substr(md5('mix:' || coalesce(source, chr(0))), 1, 13) AS BIGINT)"
    " / CAST(4503599627370496 AS DOUBLE)"
)

SOURCE_MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
placed AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS bound,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
  FROM sources),
rated AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - coalesce(sum(bound) OVER (
               ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM placed),
level AS (SELECT min(place) AS level FROM rated WHERE bound >= rate * weight),
targets AS (
  SELECT source, source_size,
         CASE WHEN place < level THEN bound
              ELSE (SELECT rate FROM rated, level WHERE place = level) * weight END AS target
  FROM rated, level),
ranked AS (
  SELECT doc_id, size, source_size, target, {_OFFSET.replace("source", "s.source")} AS u,
         row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(r * rate + u) - floor((r - 1) * rate + u)) AS BIGINT) AS taken
FROM ranked"""


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines and sentences that an earlier document, or place, has."""
    kept = substring.dedup(table(prepare(spark), sf_dir, "documents"))
    span = F.transform("spans", lambda s: F.concat_ws("-", s["begin"], s["end"]))
    return kept.select(
        "doc.doc_id", "text", F.array_join(span, ",").alias("spans"), "units_removed", "words_removed"
    )


REPEATED_LINES_SQL = r"""
WITH docs AS (
  SELECT doc_id, text, coalesce(text, '') AS t,
         md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS row
  FROM documents),
lines AS (
  SELECT row, doc_id, unnest(regexp_extract_all(t, '{LINE}')) AS line,
         unnest(range(len(regexp_extract_all(t, '{LINE}')))) AS l
  FROM (SELECT DISTINCT row, doc_id, t FROM docs)),
parts AS (
  SELECT row, doc_id, l, unnest(ps) AS u, unnest(range(len(ps))) AS p
  FROM (SELECT *, regexp_extract_all(line, '{SENTENCE}') AS ps FROM lines)),
placed AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY l, p) AS i FROM parts),
normal AS (
  SELECT *, trim(regexp_replace(lower(u), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS plain,
         coalesce(sum(length(u)) OVER (PARTITION BY row ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed),
worded AS (
  SELECT row, doc_id, l, i, plain, len(string_split(plain, ' ')) AS words,
         row_number() OVER (PARTITION BY row ORDER BY i) AS place,
         count(*) OVER (PARTITION BY row, l) AS size,
         row_number() OVER (PARTITION BY row, l ORDER BY i DESC) AS to_end
  FROM normal WHERE plain <> ''),
-- A sentence under five words within a line is hashed with those after it, or, where the line
-- ends before there are five words, with the last ones of the line.
ahead AS (
  SELECT *, list(plain) OVER onward AS next, list(words) OVER onward AS counts FROM worded
  WINDOW onward AS (PARTITION BY row, l ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
tails AS (
  SELECT row, l, list(plain ORDER BY i DESC)[:5] AS back, list(words ORDER BY i DESC)[:5] AS back_counts,
         string_agg(plain, chr(10) ORDER BY i) AS everything
  FROM worded GROUP BY row, l),
reach AS (
  SELECT *, len(list_filter(range(1, len(counts) + 1), lambda k: list_sum(counts[1:k]) < 5)) + 1 AS m,
         len(list_filter(range(1, len(back_counts) + 1), lambda k: list_sum(back_counts[1:k]) < 5)) + 1 AS n
  FROM ahead JOIN tails USING (row, l)),
hashed AS (
  SELECT row, doc_id, i, place, words, CASE
           WHEN size = 1 OR words >= 5 THEN plain
           WHEN m <= len(counts) THEN chr(10) || array_to_string(next[1:m], chr(10))
           WHEN n <= len(back) THEN to_end || chr(10) || chr(10) || array_to_string(back[1:n], chr(10))
           ELSE to_end || chr(10) || everything END AS hashed
  FROM reach),
later AS (
  SELECT *, place - row_number() OVER (PARTITION BY row ORDER BY place) AS run
  FROM (SELECT *, row_number() OVER (PARTITION BY hashed ORDER BY doc_id NULLS LAST, row, place) AS nth
        FROM hashed)
  WHERE nth > 1),
removed AS (
  SELECT row, i, words FROM (
    SELECT *, sum(words) OVER (PARTITION BY row, run) AS length FROM later)
  WHERE length >= 10),
totals AS (
  SELECT row, count(*) AS units, sum(words) AS words FROM removed GROUP BY row),
kept AS (
  SELECT n.row, n.i, n.u, n.start, n.start + length(n.u) AS stop,
         n.i - row_number() OVER (PARTITION BY n.row ORDER BY n.i) AS island
  FROM normal n SEMI JOIN totals USING (row) ANTI JOIN removed r ON n.row = r.row AND n.i = r.i),
texts AS (SELECT row, string_agg(u, '' ORDER BY i) AS rest FROM kept GROUP BY row),
islands AS (
  SELECT row, min(start) AS a, max(stop) AS b FROM kept GROUP BY row, island),
spans AS (
  SELECT row, string_agg(CAST(a AS BIGINT) || '-' || CAST(b AS BIGINT), ',' ORDER BY a) AS spans
  FROM islands GROUP BY row)
SELECT d.doc_id,
       CASE WHEN c.row IS NULL THEN d.text ELSE coalesce(x.rest, '') END AS text,
       CASE WHEN c.row IS NULL THEN '0-' || length(d.t) ELSE coalesce(s.spans, '') END AS spans,
       CAST(coalesce(c.units, 0) AS BIGINT) AS units_removed,
       CAST(coalesce(c.words, 0) AS BIGINT) AS words_removed
FROM docs d LEFT JOIN totals c USING (row) LEFT JOIN texts x USING (row) LEFT JOIN spans s USING (row)"""
REPEATED_LINES_SQL = REPEATED_LINES_SQL.replace("{LINE}", substring.LINE).replace("{SENTENCE}", substring.SENTENCE)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    rows = table(prepare(spark), sf_dir, "embeddings")
    return neighbours.nearest(rows.where("vec_id % 20 = 0"), rows)


NEAREST_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]),
                     lambda a, b: a + b) AS score
  FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
           AS rank, vec_id, score
  FROM pairs) WHERE rank <= 20"""


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    documents = table(prepare(spark), sf_dir, "documents")
    return toxicity.judged(documents, table(spark, sf_dir, "labels"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or template verdict of every page's address."""
    labels = table(prepare(spark), sf_dir, "labels")
    marked = labels.select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"),
    )
    return urls.judged(table(spark, sf_dir, "pages"), marked)


def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    documents = table(prepare(spark), sf_dir, "documents")
    return quality.rated(documents, quality.grades_of(table(spark, sf_dir, "labels")))


def spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return spotsigs.fingerprinted(table(prepare(spark), sf_dir, "documents"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash.near_groups(table(prepare(spark), sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in eight shards of nearly equal bytes."""
    documents = table(prepare(spark), sf_dir, "documents")
    text = whole().cast("binary")
    narrow = documents.select(
        "doc_id", F.crc32(text).alias("text_crc32"), F.octet_length(text).alias("bytes"),
        sharding.digest(text).alias("key"),
        sharding.digest(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("tie"),
    )
    placed = sharding.sharded(narrow, 8, F.col("bytes") + 1, F.col("key"), F.col("tie"))
    return placed.select(
        "doc.doc_id", "size", "doc.text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The CRC-32 of the bytes of ``{text}``, for which DuckDB has no function: a table by the
# polynomial's rule, then one step a byte.
_CRC_TABLE = """
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of"""
_CRC = (
    "xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode({text})), '..'),"
    " lambda x: CAST('0x' || x AS BIGINT)),"
    " lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"
)

BYTE_SHARDS_SQL = f"""
WITH crcs AS ({_CRC_TABLE}),
docs AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS k,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS t,
         CAST({_CRC.format(text="coalesce(text, '')")} AS BIGINT) AS text_crc32
  FROM documents, crcs),
laid AS (
  SELECT *, row_number() OVER (ORDER BY k, t) AS place,
         CAST(sum(size) OVER (ORDER BY k, t ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM docs),
targets AS (
  SELECT i, (SELECT sum(size) FROM docs) * i / CAST(8 AS DOUBLE) AS goal,
         {sharding.TOLERANCE} * (SELECT sum(size) FROM docs) / 8 AS tolerance
  FROM range(1, 8) r(i)),
-- Candidates of each round: what lies below the multiples of a power of two, then below each row.
candidates AS (
  SELECT bits, max(place) AS place, max(upto) AS upto FROM laid, unnest([12, 20, 28, 36, 44, 52, 60]) b(bits)
  GROUP BY bits, k >> (60 - bits)
  UNION ALL SELECT 999, place, upto FROM laid
  UNION ALL SELECT bits, 0, 0 FROM unnest([12, 20, 28, 36, 44, 52, 60, 999]) b(bits)),
nearest AS (
  SELECT i, bits, arg_min(place, (abs(upto - goal), upto)) AS place, min(abs(upto - goal)) <= any_value(tolerance) AS fits
  FROM candidates, targets GROUP BY i, bits),
settled AS (
  SELECT i, arg_min(place, bits) FILTER (WHERE fits OR bits = 999) AS place FROM nearest GROUP BY i),
placed AS (
  SELECT *, CAST((SELECT count(*) FROM settled s WHERE s.place < l.place) AS INTEGER) AS shard FROM laid l)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed"""


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, by source, for every order of them."""
    documents = table(prepare(spark), sf_dir, "documents")
    return audit.interactions(audit.cells(documents, table(spark, sf_dir, "labels")))


FILTER_INTERACTIONS_SQL = r"""
WITH marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
          100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(docs.doc_id > min(docs.doc_id) OVER (PARTITION BY t), FALSE)] AS fails
  FROM docs LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, fails, len(list_filter(fails, lambda f: f)) AS n_fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, ord(substr(filter_order, step, 1)) - 64 AS own,
         list_transform(range(1, step), lambda i: ord(substr(filter_order, i, 1)) - 64) AS before
  FROM orders, range(1, 6) s(step)),
met AS (
  SELECT part, filter_order, step, n, good, toxic, n_fails, fails[own] AS fails_own,
         len(list_filter(before, lambda i: fails[i])) = 0 AS reached
  FROM cells, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN reached AND NOT fails_own THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN reached AND fails_own THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails_own AND NOT reached THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN fails_own AND n_fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN reached AND fails_own THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN reached AND fails_own THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails_own THEN n * 120 // n_fails ELSE 0 END) AS BIGINT) AS shapley
FROM met GROUP BY part, filter_order, step"""


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    turns = trie.numbered_turns(table(prepare(spark), sf_dir, "conversations"))
    return trie.prefix_trie(*trie.rebuilt(turns))


CONVERSATION_TRIE_SQL = f"""
WITH crcs AS ({_CRC_TABLE}),
turns AS (
  SELECT conv_id, md5(md5(coalesce(role, '')) || coalesce(text, '')) AS digest,
         strlen(coalesce(text, '')) AS size, turn
  FROM conversations WHERE conv_id IS NOT NULL),
places AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM turns),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS family,
         {_CRC.format(text="CAST(conv_id AS VARCHAR)")} % 9 AS h FROM turns, crcs),
rows AS (
  SELECT c.conv_id, 0 AS own, p.place, p.digest, p.size
  FROM convs c JOIN places p ON p.conv_id = c.family AND p.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, p.place, p.digest, p.size FROM convs c JOIN places p ON p.conv_id = c.conv_id AND p.place > c.h),
deep AS (
  SELECT conv_id, size, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS node
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY own, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size
  FROM deep GROUP BY node),
families AS (
  SELECT n.*, p.node AS parent, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = substr(n.node, 1, 32 * (n.depth - 1))),
kids AS (SELECT parent AS node, count(*) AS n_children FROM families WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node, b.node AS under
  FROM deep a JOIN deep b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
subtrees AS (
  SELECT b.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM below b JOIN nodes n ON n.node = b.under LEFT JOIN kids k ON k.node = b.under GROUP BY b.node),
ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM deep GROUP BY conv_id) GROUP BY node)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM families f LEFT JOIN kids k USING (node) JOIN subtrees s USING (node) LEFT JOIN ends e USING (node)"""


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": byte_bpe,
    "op2_packed_ids": packed_ids,
    "op3_source_mix": source_mix,
    "op4_repeated_lines": repeated_lines,
    "op5_nearest_vectors": nearest_vectors,
    "op6_toxicity": toxic_documents,
    "op7_url_filter": url_verdicts,
    "op8_quality": graded_documents,
    "op9_spotsigs": spot_signatures,
    "op10_simhash": simhash_groups,
    "op11_byte_shards": byte_shards,
    "op12_filter_interactions": filter_interactions,
    "op13_conversation_trie": conversation_trie,
}

CHECKS: dict[str, str] = {
    "op3_source_mix": SOURCE_MIX_SQL,
    "op4_repeated_lines": REPEATED_LINES_SQL,
    "op5_nearest_vectors": NEAREST_SQL,
    "op11_byte_shards": BYTE_SHARDS_SQL,
    "op12_filter_interactions": FILTER_INTERACTIONS_SQL,
    "op13_conversation_trie": CONVERSATION_TRIE_SQL,
}
