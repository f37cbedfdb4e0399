"""Neighbours, classifiers, URL filter and fingerprints against brute force."""

import hashlib
import random
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stocktake.llm import graph, neighbours, quality, queries, simhash, spotsigs, toxicity, urls
from tests.llm.conftest import docs


def test_nearest(llm, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(300, 8)).astype(np.float32)
    vectors[40:80] = vectors[40]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] + [1.0] * 7), (304, []),
           (305, [1.0, 2.0]), (320, [3.0, 4.0]), (None, [1.0] * 8), rows[7]]
    df = llm.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df.where("vec_id % 20 = 0"), df, 5)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    wide = vectors.astype(np.float64)
    for q in range(0, 300, 20):
        scores = sum(wide[q, d] * wide[:, d] for d in range(8))
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:5]
        assert [v for v, _ in found[q]] == order
        assert [s for _, s in found[q]] == [scores[i] for i in order]
    assert found[320] == [(305, 11.0)] and len(found) == 16
    assert neighbours.nearest(df.limit(0), df, 5).count() == 0


def test_toxicity_on_rows_held_out(llm):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in queries.QUERIES["op6_toxicity"](llm, folder).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)
    bad = [r.predicted for r in got if labels[r.doc_id]]
    good = [r.predicted for r in got if not labels[r.doc_id]]
    assert np.mean(bad) > 0.7 and np.mean(good) < 0.01  # learned from some 2,650 labels


def test_classifiers_on_odd_rows(llm):
    rows = docs(llm, [(1, None), (2, ""), (3, "word " * 50000), (3, "word"), (None, "word")])
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.judged(rows, none).collect()} == {0.5}
    assert quality.rated(rows, quality.grades_of(none)).count() == 5
    some = llm.createDataFrame([(2, 1, None), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.judged(rows.limit(0), some).count() == 0
    assert toxicity.clean(rows, none).columns == rows.columns


def test_quality_on_rows_held_out(llm):
    folder = "/root/testdata/sf0.1"
    grades = {r.doc_id: r.grade for r in quality.grades_of(llm.read.parquet(f"{folder}/labels.parquet")).collect()}
    got = [r for r in queries.QUERIES["op8_quality"](llm, folder).collect() if r.held_out and r.doc_id in grades]
    means = [np.mean([r.expected_grade for r in got if grades[r.doc_id] == g]) for g in range(3)]
    assert means == sorted(means)
    assert all(r.p_at_least_1 >= r.p_at_least_2 for r in got)
    right = [r.selected == (grades[r.doc_id] >= 1) for r in got]
    assert np.mean(right) > 0.9


def test_urls(llm):
    rows = [
        (1, "http://A.Example.ORG/es/1?x"), (2, "https://example.org/en/12#y"), (3, "http://example.org"), (4, None),
        (5, "no scheme/com/de/"), (6, "http://x.com/fr/1"), (7, "http://x.com/de/"), (8, "http://notcom/fr/"), (9, ""),
    ]
    many = [(100 + i, f"http://h.net/{'bad' if i % 2 else 'good'}/{i}.html") for i in range(400)]
    pages = llm.createDataFrame(rows + many, "page_id long, url string")
    labels = llm.createDataFrame([(100 + i, i % 2) for i in range(300)] + [(1, None)], "page_id long, bad int")
    got = {r.page_id: r for r in urls.judged(pages, labels).collect()}
    assert len(got) == len(rows) + len(many)
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(1, 10)] == [
        ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("example.org", "", None), ("", "", None), ("", "", None), ("x.com", "/fr/1", "com/fr/"),
        ("x.com", "/de/", "com/de/"), ("notcom", "/fr/", None), ("", "", None),
    ]
    assert [got[i].verdict for i in (1, 2, 6, 7)] == ["block", "block", "allow", "block"]
    # Two branches apart: 150 labelled pages each, all bad or none, smoothed by 20 at one half.
    assert {(got[100 + i].template, got[100 + i].verdict) for i in range(400)} == {
        (f"/bad/{urls.WILD}", "block"), (f"/good/{urls.WILD}", "allow")
    }
    assert abs(got[101].purity - 10 / 170) < 0.01
    assert urls.judged(pages.limit(0), labels).count() == 0


def test_small_section_of_a_hot_host(llm):
    """Sections of one in a hundred pages of a host, and one of sixty of another."""
    rows = [(i, f"http://hot.net/s{i % 100}/{i}.html", int(i % 100 == 7)) for i in range(4000)]
    rows += [(10_000 + i, f"http://even.net/s{i % 60}/{i}.html", int(i % 60 == 9)) for i in range(1800)]
    pages = llm.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, bad int")
    got = {r.page_id: r.verdict for r in urls.judged(pages, labels).collect()}
    assert got == {key: "block" if bad else "allow" for key, _, bad in rows}


def test_section_deep_in_a_path(llm):
    """A bad section below four and five segments, some of them different for every page."""
    rows = [(i, f"http://h.net/2024/05/12/{'spam' if i % 4 == 0 else 'news'}/p{i}", int(i % 4 == 0)) for i in range(400)]
    rows += [(1000 + i, f"http://x.net/u{i}/en/cat/{'spam' if i % 4 == 0 else 'fine'}/{i}/v", int(i % 4 == 0)) for i in range(400)]
    pages = llm.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, bad int")
    got = {r.page_id: r for r in urls.judged(pages, labels).collect()}
    assert {key: r.verdict for key, r in got.items()} == {key: "block" if bad else "allow" for key, _, bad in rows}
    assert got[0].template == "/2024/05/12/spam/?" and got[1000].template == "/?/en/cat/spam/?/v"


def test_segment_that_is_a_star(llm):
    """Bad pages below a segment that is a star, and good ones of which each has its own."""
    rows = [(i, f"http://h.net/*/p{i}", 1) for i in range(30)]
    rows += [(1000 + i, f"http://h.net/u{i}/p{i}", 0) for i in range(200)]
    pages = llm.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, bad int")
    got = {r.page_id: r for r in urls.judged(pages, labels).collect()}
    assert {key: r.verdict for key, r in got.items()} == {key: "block" if bad else "allow" for key, _, bad in rows}
    assert got[0].template == "/*/?" and got[1000].template == "/?/?"


def signed(h):
    return h - (1 << 32) if h >> 31 else h


def murmur(*words):
    """Murmur3 as Spark's hash function has it: rest bytes are mixed one by one."""
    low = 0xFFFFFFFF
    h = 42

    def turned(x, by):
        return ((x << by) | (x >> (32 - by))) & low

    for word in words:
        data = word.encode()
        whole = len(data) // 4 * 4
        parts = [int.from_bytes(data[i : i + 4], "little") for i in range(0, whole, 4)]
        for part in parts + [b - 256 if b > 127 else b for b in data[whole:]]:
            k = turned(part * 0xCC9E2D51 & low, 15) * 0x1B873593 & low
            h = (turned(h ^ k, 13) * 5 + 0xE6546B64) & low
        h ^= len(data)
        h = (h ^ (h >> 16)) * 0x85EBCA6B & low
        h = (h ^ (h >> 13)) * 0xC2B2AE35 & low
        h ^= h >> 16
    return signed(h)


def brute_signatures(text):
    import regex

    words = [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", text.lower()) if w]
    content = [w for w in words if w not in spotsigs.ANCHORS]
    out, seen = [], 0
    for w in words:
        if w not in spotsigs.ANCHORS:
            seen += 1
        elif seen + 2 <= len(content):
            out.append(murmur(w, *content[seen : seen + 2]))
    wanted = max(min(len(words), 20) - 4 * len(out), len(words) / 5 - len(out))
    share = max(0.0, wanted / max(len(words), 1))
    chains = [murmur(*three) for three in zip(words, words[1:], words[2:])]
    out = set(out) | {h for h in chains if h % 65536 < share * 65536}
    own = xxhash.xxh64_intdigest(text.encode(), 42)
    return out or ({signed(own & 0xFFFFFFFF), signed(own >> 32)} if text else set())


def test_spotsigs(llm):
    draw = random.Random(5)
    vocabulary = "the of and le der cat dog house tree éclair river stone 42".split()
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    rows = list(zip(draw.sample(range(-500, 5000), 36), texts)) + [(7000, None), (7001, "😀" * 10), (7002, "no anchor"), (7003, texts[0])]
    got = {r.doc_id: r for r in spotsigs.fingerprinted(docs(llm, rows).withColumnRenamed("lang", "sig")).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])

    def like(a, b):
        x, y = brute_signatures(a), brute_signatures(b)
        return len(x & y) / len(x | y) if x | y else 1.0

    for at, (key, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r = got[key]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - like(text, edited)) < 1e-12
        assert abs(r.near_next - like(text, following)) < 1e-12
        assert len(r.fingerprint) == 8 * len(brute_signatures(text))
    assert got[7003].fingerprint == got[rows[0][0]].fingerprint
    assert spotsigs.fingerprinted(docs(llm, rows).limit(0)).count() == 0
    single = spotsigs.fingerprinted(docs(llm, [(None, "the cat dog house")])).collect()
    assert single[0].near_next == 1.0


def test_spotsigs_without_anchors(llm):
    """Near copies of texts in other languages, without spaces, and of lists."""
    draw = random.Random(8)
    russian = " ".join("".join(draw.choice("бвгджклмнопрст") for _ in range(7)) for _ in range(200))
    chinese = "".join(chr(draw.randint(0x4E00, 0x9FA0)) for _ in range(400))
    numbers = " ".join(str(draw.randint(1000, 10**6)) for _ in range(200))
    for text in (russian, chinese, numbers, chinese + " the first cat"):
        copy = text[:100] + text[110:]
        rows = docs(llm, [(1, text), (2, copy)])
        got = {r.doc_id: r for r in spotsigs.fingerprinted(rows).collect()}
        assert got[1].near_next > 0.8 and got[1].near_edited > 0.3
        pairs, members = spotsigs.near_pairs(rows)
        assert pairs.count() == 1 or {r["class"] for r in members.collect()} == {1}


def test_spotsigs_change_by_degrees(llm):
    """A word more changes few signatures, whatever the number of words and of anchors."""
    draw = random.Random(9)
    words = ["".join(draw.choice("bcdfgklmnprst") for _ in range(6)) for _ in range(1700)]
    for anchored in (0, 1, 20, 40):
        rows = []
        for n in (12, 19, 20, 21, 39, 40, 79, 80, 399, 400, 401, 799, 800, 801, 1600):
            own = list(words[:n])
            for at in range(min(anchored, n // 3)):
                own[3 * at] = "the"
            rows += [(len(rows), " ".join(own)), (len(rows) + 1, " ".join(own + ["more"]))]
        sets = spotsigs.with_signatures(docs(llm, rows), "text", "sig").select("doc_id", "sig").collect()
        found = {r.doc_id: set(r.sig) for r in sets}
        for key, text in rows[::2]:
            one, two = found[key], found[key + 1]
            # Of few signatures, one more or less weighs more.
            assert len(one & two) / len(one | two) >= (0.8 if len(text.split()) > 40 else 0.6)
            assert one == brute_signatures(text)


def test_spotsigs_of_short_texts(llm):
    """Texts without a signature have 64 bits of their own."""
    rows = llm.range(200_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    sets = spotsigs.with_signatures(rows, "text", "sig")
    assert sets.select("sig").distinct().count() == 200_000


def test_sample_passes_over_what_does_not_fit(llm):
    long = [(i, "long " * 40) for i in range(4)]
    rows = docs(llm, long + [(10 + i, f"short {i}") for i in range(20)] + [(10, "short 0"), (11, "another")])
    labels = llm.createDataFrame([(i, 0) for i in range(4)] + [(10 + i, i % 2) for i in range(20)], "doc_id long, toxic int")
    texts, toxic = toxicity.sample(rows, labels, "toxic", chars=190)
    assert sorted(texts) == sorted([f"short {i}" for i in range(20)] + ["another"])
    assert {t: y for t, y in zip(texts, toxic)} == {f"short {i}": i % 2 for i in range(20)} | {"another": 1}
    assert toxicity.sample(rows, labels, "toxic", chars=3) == ([], [])
    assert toxicity.sample(rows.limit(0), labels, "toxic") == ([], [])
    texts, _ = toxicity.sample(rows, labels, "toxic", rows=5)
    assert len(texts) == 5


def test_neighbours_of_any_magnitude(llm):
    """Vectors whose norms leave the range of doubles, in tiles that rule candidates out."""
    draw = np.random.default_rng(6)
    vectors = {i: draw.normal(size=3) * 10.0 ** draw.integers(-300, 100) for i in range(300)}
    vectors |= {300: np.array([1e200, 0.0, 0.0]), 301: np.array([0.0, 1e-310, 0.0]), 302: np.array([1e200, 1e200, -1e200])}
    rows = llm.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    asked = [0, 20, 40, 300, 301, 302]
    got = neighbours.nearest(rows.where(F.col("vec_id").isin(*asked)), rows, k=5).collect()
    for query in asked:
        with np.errstate(all="ignore"):
            every = [(i, neighbours._exact(vectors[query], v[None, :])[0]) for i, v in vectors.items() if i != query]
        best = sorted(every, key=lambda x: (-x[1], x[0]))[:5]
        found = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [(i, s) for _, i, s in found] == best


def test_spotsigs_pairs(llm):
    base = [f"the w{i} x{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:56] + ["the q r"])), (4, " ".join(base[:20])), (5, None), (6, "")]
    pairs, members = spotsigs.near_pairs(docs(llm, rows))
    sets = {i: brute_signatures(t or "") for i, t in rows}
    want = {
        (a, b) for a in (1, 3, 4) for b in (1, 3, 4)
        if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    }
    assert {(r.a, r.b) for r in pairs.collect()} == want == {(1, 3)}
    assert sorted(tuple(r) for r in members.collect()) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5)]


def brute_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashed) * 2 > len(hashed) > 0)


def test_simhash(llm, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "ROWS", 4)
    draw = random.Random(9)
    base = [f"w{draw.randint(0, 999)}" for _ in range(300)]
    rows = [(i, " ".join(f"v{draw.randint(0, 999)}" for _ in range(draw.randint(0, 30)))) for i in range(150)]
    for i in range(60):
        copy = list(base)
        copy[draw.randrange(300)] = f"x{i}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(900, None), (901, "  "), (902, "One\ttwo"), (903, "one TWO"), (None, "one two"), (904, "É é a b")]
    fps = [brute_fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    lowest = {}
    for (key, _), own in zip(rows, label):
        if key is not None:
            lowest[own] = min(lowest.get(own, key), key)
    want = sorted((str(k), f"{fp:016x}", str(lowest.get(own))) for (k, _), fp, own in zip(rows, fps, label))
    got = simhash.near_groups(docs(llm, rows)).select("doc_id", simhash.as_hex("fp").alias("f"), "component_id")
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == want
    kept = simhash.representatives(docs(llm, rows + rows[:3]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(lowest.values())
    assert simhash.representatives(docs(llm, rows).limit(0)).count() == 0
    keyless = simhash.representatives(docs(llm, [(None, "a b c"), (None, "a b c"), (None, "z")]))
    assert sorted(r.text for r in keyless.collect()) == ["a b c", "z"]


def test_components(llm):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 9), (9, 1)] + [(7, 700 + i) for i in range(40)]
    got = {r.node: r.root for r in graph.components(llm.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {3: 1, 5: 1, 9: 1} | {700 + i: 7 for i in range(40)}
    assert got == want
