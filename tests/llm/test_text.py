"""Tokens, packed ids, mixing and substring dedup against brute force."""

import base64
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from stocktake.llm import bpe, idpack, mixing, queries, substring
from stocktake.session import scratch_path
from tests.llm.conftest import docs

AWKWARD = [
    None, "", " ", "\n\n", "a", "a  b", " lead", "trail ", "x\x1cy \t \tz", "it's we'll 'tis", "é́ ñ ﬁ 日本語 😀",
    "aaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "ab" * 3000, " " * 500 + "x", "foo,&&& bar.. baz$$$", "Σίσυφος ΟΔΟΣ", "İstanbul J̌",
    "<|endoftext|> <|startoftext|>", "word\r\nnext line　wide", "0123 45 6", "\n", "\na \nb\n c",
]


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        return bpe.Coder(file.read())


def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.rank, special_tokens={})


def test_bpe_equals_the_library(coder, monkeypatch):
    encoding, draw = library(coder), random.Random(7)
    texts = [t or "" for t in AWKWARD]
    for alphabet in ("abcdeh thing tion", "the \n\t  \x1c\x85 's,.&", "éçäß日한р😀 ", "aab \n"):
        texts += ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 300))) for _ in range(100)]
    monkeypatch.setattr(bpe, "SEGMENT", 64)
    monkeypatch.setattr(bpe, "PARTS", 50)
    for text in texts:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_bpe_query(llm, coder):
    source = docs(llm, list(enumerate(AWKWARD)) + [(0, None), (None, "a")]).withColumn("ids", mixing.words())
    got = bpe.round_trip(source, bpe.Bpe(llm)).collect()
    encoding = library(coder)
    want = sorted((i, t or "") for i, t in enumerate(AWKWARD)) + [(0, "")]
    assert sorted((r.doc_id, r.decoded.decode()) for r in got if r.doc_id is not None) == sorted(want)
    assert all(r.n_tokens == len(encoding.encode_ordinary(r.decoded.decode())) for r in got)
    assert bpe.round_trip(source.limit(0), bpe.Bpe(llm)).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype("<u4")
    packed = idpack.pack(ids, bits)
    assert len(packed) == -(-1000 * bits // 8)
    for start, count in ((0, 1000), (3, 0), (17, 500), (999, 1)):
        assert idpack.unpack(packed, bits, start, count).tolist() == ids[start : start + count].tolist()


SPECIAL = [
    "<|endoftext|>", "a<|endoftext|>b", "one <|startoftext|> two", "<|ENDOFTEXT|>", "<|endoftext", "é<|endoftext|>Σ",
    "<|endoftext|><|endoftext|>", " <|endoftext|> ",
]


def test_packed_corpus(llm, monkeypatch):
    rows = [(i * 3, t) for i, t in enumerate(AWKWARD)] + [(500 + i, "some words, again") for i in range(50)]
    rows += [(600, "long " * 40000), (600, "twice")]
    rows += [(700 + i, t) for i, t in enumerate(SPECIAL)]
    path = scratch_path(llm, "test-ids")
    idpack.write_ids(docs(llm, rows), path)
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in idpack.read_ids(llm, path).collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path(idpack.VOCABULARY))
    start = 0
    for (at, doc, n, ids), (key, text) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or ""))):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (at, doc, n) == (start, key, len(want))
        assert zlib.crc32(ids) == zlib.crc32(np.array(want, "<u4").tobytes())
        start += n
    assert len(got) == len(rows)
    empty = scratch_path(llm, "test-ids")
    idpack.write_ids(docs(llm, rows).limit(0), empty)
    assert idpack.read_ids(llm, empty).count() == 0


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not above:
            return target | {s: 3.0 * sizes[s] for s in full}
        full |= above


def test_mix(llm):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(0, 60), "big") for i in range(600)]
    rows += [(1000 + i, "w " * draw.randint(1, 9), f"s{i % 5}") for i in range(60)]
    rows += [(2000, None, None), (2001, "a b c", None), (2001, "a b c", None), (2002, "", "void")]
    mixed = mixing.mix(docs(llm, rows))
    got = mixed.select("doc.doc_id", "doc.source", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(want[source])
        assert max(r.copies for r in own) <= 3
        taken = sum(r.size * r.copies for r in own)
        assert abs(taken - want[source]) <= max(r.size for r in own)
    again = mixing.mix(docs(llm, rows).repartition(7)).select("doc.doc_id", "size", "copies")
    assert sorted(again.collect()) == sorted((r.doc_id, r.size, r.copies) for r in got)
    assert mixing.emitted(mixed).count() == sum(r.copies for r in got)
    assert mixing.mix(docs(llm, rows).limit(0)).count() == 0


def pieces(text):
    """The lines, each as the list of its pieces, cut after the ends of sentences."""
    for line in re.split("(?<=\n)", text):
        cut = re.split(r"(?<=[.!?])(?=[^.!? \t\n\x0b\f\r])|(?<=[.!?][ \t\n\x0b\f\r])(?=[^.!? \t\n\x0b\f\r])"
                       r"|(?<=[.!?][ \t\n\x0b\f\r]{2})(?=[^.!? \t\n\x0b\f\r])", line)  # fmt: skip
        yield [c for c in cut if c]


def brute_units(text):
    """(piece, words, what stands for it) in order; None stands for a piece without words."""
    for line in pieces(text):
        plain = [re.sub("[ \t\n\x0b\f\r]+", " ", piece.lower()).strip(" ") for piece in line]
        worded = [p.split(" ") for p in plain if p]
        at = -1
        for piece, own in zip(line, plain):
            if not own:
                yield piece, 0, None
                continue
            at += 1
            size = len(worded[at])
            if size >= 5 or len(worded) == 1:
                yield piece, size, (own,)
                continue
            chain, until = [], at
            while until < len(worded) and sum(map(len, chain)) < 5:
                chain.append(worded[until])
                until += 1
            if sum(map(len, chain)) >= 5:
                yield piece, size, ("onward", *map(tuple, chain))
                continue
            back = len(worded)
            while back > 0 and sum(map(len, worded[back:])) < 5:
                back -= 1
            yield piece, size, ("ending", len(worded) - at, *map(tuple, worded[back:]))


def brute_lines(rows, least=10):
    keyed = sorted({(d is None, d, t or "") for d, t in rows}, key=lambda r: (r[0], r[1] or 0))
    seen, out = set(), {}
    for _, doc, text in keyed:
        marks = []
        for piece, words, unit in brute_units(text):
            marks.append((piece, words, unit in seen))
            if unit:
                seen.add(unit)
        worded, kept = [i for i, m in enumerate(marks) if m[1]], set(range(len(marks)))
        run = []
        for i in [*worded, None]:
            if i is not None and marks[i][2]:
                run.append(i)
                continue
            if sum(marks[j][1] for j in run) >= least:
                kept -= set(run)
            run = []
        out[doc, text] = "".join(marks[i][0] for i in sorted(kept))
    return out


def test_repeated_lines(llm):
    long, short = " ".join(f"w{i}" for i in range(60)), "few words"
    passage = " ".join(" ".join(f"p{i}" for i in range(n, n + 9)) + "." for n in range(0, 63, 9))
    chat = " ".join(f"Yes {i}. No! Go on, {i * 7 % 5}. Why {i % 3}?" for i in range(40))
    rows = [
        (1, f"start\n{long}\nend"), (2, f"other\n\n  {long.upper()} \nmore"), (3, long), (4, f"{short}\n{short}"),
        (5, f"{short}\nalone"), (6, "a b c d e\nf g h i j"), (7, "x\na b c d e\n\nf g h i j\ny"), (8, None), (9, ""),
        (10, "q\n" * 30), (11, "unique text"), (11, "unique text"), (None, long),
        (12, f"Begin here. {passage} The end."), (13, f"Another way to begin, {passage} Done.\n  And on."),
        (14, "Ja. Nein. Ja ja. So so. Ja. Nein. Ja ja. So so. Ja. Nein. Ja ja. So so."),
        (15, chat), (16, chat.upper()), (17, f"Quite another start. {chat} And another end of it."),
        (18, "No. Yes. Go on. Why? Not now. Yes. No. Ja. Nein. Go. Stop it. Who? Me. Yes. Why? No. No."),
    ]
    source = docs(llm, rows).withColumn("spans", mixing.words())
    got = substring.dedup(source).select("doc.doc_id", "doc.text", "text", "spans").collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    for doc, original, text, spans in [tuple(r) for r in got]:
        assert (text or "") == want[doc, original or ""]
        assert "".join((original or "")[s.begin : s.end] for s in spans) == (text or "")
    texts = {r.doc_id: r[2] for r in got}
    assert texts[13].split() == ["Another", "way", "to", "begin,", *passage.split()[:9], "Done.", "And", "on."]
    assert texts[14].startswith("Ja. Nein.") and len(texts[14].split()) == 18
    # Copies go however short their sentences are, and sentences that only occur apart stay.
    assert texts[16] == "" and len(texts[17].split()) < 20 and texts[18] == dict(rows)[18]
    assert substring.dedup(source.limit(0)).count() == 0


def test_repeated_sentences_of_other_scripts(llm):
    """A passage within a line, in a script with spaces and a danda, and in one without spaces."""
    hindi = "".join(" ".join(f"शब्द{n}{c}" for c in "कखगघचछ") + "। " for n in range(9))
    chinese = "".join("".join(chr(0x4E00 + 17 * n + i) for i in range(16)) + "。" for n in range(12))
    rows = [
        (1, f"पहला वाक्य यहाँ है। {hindi}अंत।"), (2, f"दूसरा लेख अलग है। {hindi}समाप्त।"),
        (3, f"甲乙丙。{chinese}丁戊。"), (4, f"己庚辛！{chinese}壬癸？"), (5, "你好。再见。"), (6, "好的。你好。再见。"),
    ]
    got = {r.doc_id: r for r in substring.dedup(docs(llm, rows)).select("doc.doc_id", "text", "words_removed").collect()}
    assert got[2].text == "दूसरा लेख अलग है। समाप्त।" and got[2].words_removed == 54
    assert got[4].text == "己庚辛！壬癸？" and got[4].words_removed == 12 * 8
    assert all(got[i].text == dict(rows)[i] for i in (1, 3, 5, 6))


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_sql(llm, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](llm, folder)
    columns = sorted(df.columns)
    cursor = con.execute(queries.CHECKS[name])
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())


def test_pipeline(llm):
    """Every stage on its predecessor's rows, and the last against the library."""
    folder = "/root/testdata/sf0.001"
    docs_ = llm.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs_.columns, [docs_.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(llm, "test-pipeline")
        function(llm, docs_, folder).write.parquet(path)
        before, docs_ = docs_, llm.read.parquet(path)
        assert docs_.columns == columns
        counts.append(docs_.count())
        if name == "repeated_lines":
            texts = {r.doc_id: r.text for r in docs_.collect()}
            assert texts == {k: v for (k, _), v in brute_lines([(r.doc_id, r.text) for r in before.collect()]).items()}
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    got = corpus_pipeline.encode(llm, docs_, folder).collect()
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [
        (r.doc_id, hashlib.sha256(np.array(encoding.encode_ordinary(r.text), "<u4").tobytes()).hexdigest())
        for r in docs_.collect()
    ]
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == sorted(want)
