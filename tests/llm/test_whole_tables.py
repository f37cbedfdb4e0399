"""Shards, filter interactions and the conversation trie against their SQL on awkward tables."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stocktake.llm import audit, queries, sharding, simhash, trie
from stocktake.session import scratch_path

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def both(spark, folder, name, **tables):
    """Rows of a query and of its SQL over tables written to a folder."""
    con = duckdb.connect()
    for table, (schema, rows) in tables.items():
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema]
        pq.write_table(pa.Table.from_arrays(columns, schema=schema), f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = queries.QUERIES[name](spark, str(folder))
    cursor = con.execute(queries.CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    return sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr), sorted(cursor.fetchall(), key=repr), names


def some_docs(draw):
    words = ["w%d" % i for i in range(60)] + ["Aa", "BIG", "x#", "é", "日本"]
    rows = []
    for i in range(300):
        n = draw.choice([0, 1, 5, 49, 50, 60, 120])
        rows.append((i, draw.choice([" ", "\n", "\t \v"]).join(draw.choices(words, k=n)), draw.choice(["a", "b", None, ""])))
    rows += [(1000 + i, "the same text " * 40, "a") for i in range(150)]  # a third of all rows
    rows += [(7, "twice", "b")] * 40 + [(None, "no id", None)] * 3 + [(None, "twice", "c"), (2000, None, "a"), (2001, None, "a")]
    rows += [(3000, "long words " * 60000, "b"), (-5, "the same text " * 40, "c")]
    draw.shuffle(rows)
    return [(i, t, "en", s, 0) for i, t, s in rows]


def test_shards_equal_their_sql(llm, tmp_path):
    rows = some_docs(random.Random(1))
    got, want, _ = both(llm, tmp_path, "op11_byte_shards", documents=(DOCS, rows))
    assert got == want
    got, want, _ = both(llm, tmp_path, "op11_byte_shards", documents=(DOCS, []))
    assert got == want == []


@pytest.mark.parametrize("tolerance", [0.001, 0.05])
def test_shards_are_even_and_gapless(llm, monkeypatch, tolerance):
    draw = random.Random(2)
    rows = [(i, i, draw.randint(1, 100)) for i in range(4000)]
    rows += [(5, 5, 10)] * 3000  # more of one row than a shard holds
    monkeypatch.setattr(sharding, "PIECES", 12)
    df = llm.createDataFrame(rows, "doc string, shard long, _size int").repartition(5)
    text = F.col("shard").cast("string").cast("binary")
    placed = sharding.sharded(df, 6, F.col("_size"), sharding.digest(text), sharding.digest(text), tolerance).collect()
    sizes = {}
    for r in placed:
        sizes.setdefault(r.shard, []).append((r.slot, r.size))
    mean = sum(r.size for r in placed) / 6
    assert len(placed) == 7000 and sorted(sizes) == list(range(6))
    for shard in sizes.values():
        assert sorted(s for s, _ in shard) == list(range(len(shard)))
        assert abs(sum(n for _, n in shard) - mean) <= 2 * max(tolerance * mean, 100)
    keys = [(int(r.doc.doc), r.shard, r.slot) for r in placed]
    # A row's copies lie side by side, however many shards they fill.
    spread = sorted((s, t) for k, s, t in keys if k == 5)
    counts = {s: len(v) for s, v in sizes.items()}
    linear = [sum(counts[x] for x in range(s)) + t for s, t in spread]
    assert linear == list(range(linear[0], linear[0] + len(linear)))


def test_shards_of_few_rows(llm):
    for n in (1, 3):
        df = llm.createDataFrame([(i, "t") for i in range(n)], "id long, text string")
        key = sharding.digest(F.col("text").cast("binary"))
        tie = sharding.digest(F.col("id").cast("string").cast("binary"))
        got = sharding.sharded(df, 8, F.lit(None), key, tie).collect()
        assert sorted(r.doc.id for r in got) == list(range(n)) and all(r.size == 1 and 0 <= r.shard < 8 for r in got)
        assert len({(r.shard, r.slot) for r in got}) == n


def test_written_shards(llm):
    df = llm.createDataFrame([(i, "word " * (i % 50)) for i in range(500)], "id long, text string")
    text = F.col("text").cast("binary")
    placed = sharding.sharded(df, 4, F.octet_length(text), sharding.digest(text), sharding.digest(F.col("id").cast("string").cast("binary")))
    path = scratch_path(llm, "test-shards")
    sharding.write_shards(placed, path)
    back = llm.read.parquet(path)
    assert sorted(tuple(r) for r in back.select("id", "shard", "slot").collect()) == sorted(
        tuple(r) for r in placed.select("doc.id", "shard", "slot").collect()
    )
    with pytest.raises(ValueError, match="clash"):
        sharding.write_shards(placed.withColumn("doc", F.struct(F.lit(1).alias("Shard"))), path)


def test_interactions_equal_their_sql(llm, tmp_path):
    draw = random.Random(3)
    rows = some_docs(draw)
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 1200, 3)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1)]
    got, want, names = both(llm, tmp_path, "op12_filter_interactions", documents=(DOCS, rows), labels=(LABELS, labels))
    assert got == want
    removed, kept = names.index("removed"), names.index("kept")
    parts = {r[names.index("part")] for r in got}
    assert parts == {"a", "b", "c", ""} and len(got) == 4 * 600
    last = [r for r in got if r[names.index("step")] == 5]
    assert sum(r[kept] for r in last) == 120 * sum({r[names.index("part")]: r[kept] for r in last}.values())
    assert sum(r[removed] for r in got) == sum(r[names.index("shapley")] for r in got) / 120
    got, want, _ = both(llm, tmp_path, "op12_filter_interactions", documents=(DOCS, []), labels=(LABELS, []))
    assert got == want == []


def test_interactions_read_no_other_column(llm):
    rows = [(1, "a b", "x", "k", 1), (2, "a b", "x", "k", 1)]
    df = llm.createDataFrame(rows, "doc_id long, text string, source string, digest string, fails int")
    labels = llm.createDataFrame([(2, 1, 0, "z")], "doc_id long, quality int, toxic int, part string")
    got = {(r.cell, r.docs, r.good, r.toxic) for r in audit.cells(df, labels).where("docs > 0").collect()}
    assert got == {(16, 1, 0, 0), (17, 1, 1, 0)}


def test_a_long_text_is_counted_in_pieces(monkeypatch):
    draw = random.Random(4)
    text = "".join(draw.choices(["aa", "b", "é", " ", "\n", "\x85", " "], k=4000)).encode()
    whole = audit._counted(text)
    assert whole == (len(text.split()), len(set(text.split())))
    monkeypatch.setattr(audit, "PIECE", 7)
    assert audit._counted(text) == whole


def test_tensor_by_hand():
    counts = np.random.default_rng(5).integers(0, 9, (2, 3, 32))
    figures = {(o, s): f for o, s, f in audit.Tensor(counts).report()}
    assert len(figures) == 600
    for order, step in (("ABCDE", 1), ("CADBE", 3), ("EDCBA", 5)):
        bits = {f: 16 >> i for i, f in enumerate("ABCDE")}
        before, own = sum(bits[f] for f in order[: step - 1]), bits[order[step - 1]]
        reached = [c for c in range(32) if not c & before]
        assert (figures[order, step]["removed"] == counts[:, 0, [c for c in reached if c & own]].sum(1)).all()
        assert (figures[order, step]["kept"] == counts[:, 0, [c for c in reached if not c & own]].sum(1)).all()
        assert (figures[order, step]["unique_fails"] == counts[:, 0, own]).all()


def some_turns(draw):
    rows = []
    for c in range(0, 240):
        if c in (10, 25, 26):
            continue  # families without a first conversation, or without others
        for t in range(draw.randint(1, 12)):
            rows.append((c, t, draw.choice(["user", None]), draw.choice(["hello", "é?", None, "x" * 50])))
    for c in range(500, 640):  # copies of one conversation, a third of all
        rows += [(c, t, "user", f"turn {t}") for t in range(6)]
    rows += [(700, t, "user", f"turn {t}") for t in range(400)]  # goes on behind the copies
    rows += [(704, None, "user", "untimed"), (704, 1, "user", "b"), (704, 1, "user", "a"), (704, 1, "user", "a")]
    rows += [(None, 1, "user", "no id")]
    draw.shuffle(rows)
    return rows


def test_trie_equals_its_sql(llm, tmp_path):
    for seed in (1, 2):
        got, want, _ = both(llm, tmp_path, "op13_conversation_trie", conversations=(TURNS, some_turns(random.Random(seed))))
        assert got == want
    got, want, _ = both(llm, tmp_path, "op13_conversation_trie", conversations=(TURNS, []))
    assert got == want == []


def test_turnless_conversations_end_at_the_root(llm, tmp_path):
    # 1 to 4 and 6 to 9 have no family's first conversation; some lose their only turn.
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 4, 6, 7, 8, 9)]
    got, want, names = both(llm, tmp_path, "op13_conversation_trie", conversations=(TURNS, rows))
    assert got == want
    (root,) = [r for r in got if r[names.index("depth")] == 0]
    assert root[names.index("n_convs")] == 8 and root[names.index("ends_sha256")] != trie.EMPTY


def brute_trie(sequences):
    """sequences: {conv: [(digest, size)]}."""
    nodes = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(t for t, _ in turns[:d]), []).append(conv)
    size = {k: dict(sequences[v[0]][len(k) - 1 : len(k)]).get(k[-1], 0) if k else 0 for k, v in nodes.items()}
    kids = {k: sum(1 for n in nodes if len(n) == len(k) + 1 and n[: len(k)] == k) for k in nodes}
    out = set()
    for k, members in nodes.items():
        under = [n for n in nodes if n[: len(k)] == k]
        out.add((
            min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k],
            sum(kids[n] == 0 for n in under), sum((len(nodes[n]) - 1) * size[n] for n in under),
        ))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_forests_merge_across_borders(llm, seed):
    """Few kinds of turns, so that most nodes lie across partitions."""
    draw = random.Random(seed)
    sequences = {}
    for c in range(120):
        turns = [bytes([draw.randint(0, 1)]) * 16 for _ in range(draw.randint(0, 6))]
        sequences[c] = [(t, t[0] + 3) for t in turns]
    sequences |= {200 + c: [(b"\x00" * 16, 3)] * 3 for c in range(60)}
    rows = [(c, d + 1, t, n, len(ts)) for c, ts in sequences.items() for d, (t, n) in enumerate(ts)]
    turns = llm.createDataFrame(rows, "conv_id long, depth long, digest binary, size long, total long")
    got = trie.prefix_trie(turns, llm.createDataFrame([(c,) for c in sequences], "conv_id long")).collect()
    assert {tuple(r)[:7] for r in got} == brute_trie(sequences) and len(got) == len(brute_trie(sequences))


def test_one_document_of_each_group_stays(llm):
    """Rows of one key with unlike texts are groups of their own; columns may have any name."""
    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcde"}
    rows = [(1, texts["a"]), (1, texts["b"]), (2, texts["c"]), (3, texts["a"]), (0, texts["d"]), (0, texts["d"]), (0, texts["e"]),
            (None, texts["e"]), (None, "no key"), (None, "no key"), (9, None), (8, "")]
    df = llm.createDataFrame([(k, t, i, "x") for i, (k, t) in enumerate(rows)], "doc_id long, text string, kept int, root string")
    got = simhash.representatives(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(1, texts["a"]), (1, texts["b"]), (2, texts["c"]), (0, texts["d"]), (0, texts["e"]), (None, "no key"), (8, "")],
        key=repr,
    )
    assert simhash.representatives(df.limit(0)).count() == 0
