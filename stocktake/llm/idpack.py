"""Token ids in fixed-width packed files.

An id takes the minimum number of bits that the vocabulary needs. A corpus is a folder of two
Parquet tables, so that Spark's committer makes writing safe against lost executors on any
store that Spark reads:

``blocks``  one row per block of whole documents, at least BLOCK_IDS ids unless a shard ends:
            ``shard``, ``first`` (ids of the shard before the block), ``n_ids``, ``bits``,
            ``doc_ids``, ``lengths`` (ids of each document), ``payload`` (id i of the block
            is in bits i*bits to (i+1)*bits, lowest bit first).
``shards``  ``shard``, ``base`` (ids of all shards before it), ``n_ids``.

Shards are ranges of the document order, so id ``base + first + i`` of the corpus is id ``i``
of a block: any stretch of ids can be read by ``unpack`` without the rest of its block.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W
from tokenizers import Tokenizer

from stocktake.llm.shared import held, named, whole

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 16
WORDS = 300_000  # remembered words per Python worker, and as many of the generation before
WORD_CHARS = 48
# Marks after a word are a piece of their own. (Not the apostrophe, which can begin one with
# the letters after it.)
MARKS = ".,;:!?$#%&*|-)]}"
GROUP_CHARS = 1 << 21  # texts are encoded together up to this size


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a bit string, lowest bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from id ``start`` on; only their bytes are touched."""
    first, last = start * bits // 8, -(-(start + count) * bits // 8)
    raw = np.frombuffer(payload, np.uint8, last - first, first)
    if bits in (8, 16, 32):
        return raw.view(f"<u{bits // 8}").astype("<u4")
    at = start * bits - first * 8
    spread = np.unpackbits(raw, bitorder="little")[at : at + count * bits].reshape(count, bits)
    return spread.astype("<u4") @ (np.uint32(1) << np.arange(bits, dtype="<u4"))


class WordTokenizer:
    """The tokenizers library behind a memory of words.

    The tokenizer drops white space, so a text has the ids of its words one after the other.
    New words are encoded together: a word of letters is one piece, whose last token carries
    the word end. Anything less plain is encoded on its own. The library cuts strings of added
    tokens out before it splits, so a text that may hold one goes to it whole.
    """

    def __init__(self, json: str):
        self.library = Tokenizer.from_str(json)
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        # The batch form that leaves out the offsets, which nobody reads here.
        ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _learn_letters(self, words: list[str]) -> None:
        if not words:
            return
        ids = np.frombuffer(self._encode(" ".join(words)), "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            self.words.update((w, self._encode(w)) for w in words)
            return
        starts = np.concatenate([[0], stops[:-1]])
        raw = ids.tobytes()
        spans = zip(words, (4 * starts).tolist(), (4 * stops).tolist())
        self.words.update((w, raw[a:b]) for w, a, b in spans)

    def _learn(self, wanted: list[str]) -> None:
        if len(self.words) >= WORDS:
            self.before, self.words = self.words, {"": b""}
        words, before = self.words, self.before
        new = [w for w in wanted if w not in words]
        again = [w for w in new if w in before]
        words.update(zip(again, map(before.__getitem__, again)))
        new = [w for w in new if w not in before and len(w) <= WORD_CHARS]
        letters = [w for w in new if w.isalpha()]
        other = [w for w in new if not w.isalpha()]
        stems = [w.rstrip(MARKS) for w in other]
        marked = [(w, stem) for w, stem in zip(other, stems) if stem.isalpha()]
        words.update((w, self._encode(w)) for w, stem in zip(other, stems) if not stem.isalpha())
        lacking = {stem for _, stem in marked if stem not in words}.difference(letters)
        words.update((w, before[w]) for w in lacking if w in before)
        self._learn_letters(letters + [w for w in lacking if w not in before])
        for word, stem in marked:
            marks = word[len(stem) :]
            if marks not in words:
                words[marks] = self._encode(marks)
            words[word] = words[stem] + words[marks]

    def _words(self, lowered: list[str]) -> list[bytes]:
        """Ids of texts whose words are parted by spaces. Arrow numbers the distinct words, so
        only these are looked up, and their ids are gathered by number."""
        split = pc.split_pattern(pa.array(lowered, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(distinct)
        known = self.words
        # Long words are not remembered.
        ids = [known[w] if w in known else self._encode(w) for w in distinct]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(size) - size
        number = coded.indices.to_numpy()
        count = size[number]
        stop = np.cumsum(count)
        at = np.repeat(begin[number] - stop + count, count) + np.arange(stop[-1])
        raw = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        bounds = (4 * np.concatenate([[0], stop])[split.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out, lowered, places = [b""] * len(texts), [], []
        for place, text in enumerate(texts):
            low = text.lower()
            plain = unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)
            # The tokenizer composes, then lowers letter by letter; where nothing is to be
            # composed and no letter depends on its neighbours, lowering first is the same.
            if plain and "Σ" not in text and not self.added.search(text):
                for gap in "\n\t\r":
                    low = low.replace(gap, " ")
                lowered.append(low)
                places.append(place)
            else:
                out[place] = self._encode(text)
        if lowered:
            for place, ids in zip(places, self._words(lowered)):
                out[place] = ids
        return out


def _tokenizer(json: str) -> WordTokenizer:
    return held(("words", json), lambda: WordTokenizer(json))


_BLOCK = pa.schema(
    [
        ("shard", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("bits", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts in groups of about GROUP_CHARS characters."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def write_ids(
    df: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending key order.

    A null or empty text is its end id alone. Equal keys are neighbours, in the order of
    their texts; null keys come first. Other columns are left out, whatever their names. An
    empty table gives a corpus without blocks. The tokenizer file (under two megabytes) is
    read by the driver and broadcast.
    """
    spark = df.sparkSession
    with open(tokenizer or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        json = spark.sparkContext.broadcast(file.read())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(json.value)
        bits, shard = bits_for(coder.size), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        first, size, keys, lengths, held = 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(held), "<u4"), bits)
            row = [shard, first, size, bits, keys, lengths, payload]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK
            )

        for group_keys, group_texts in _texts(batches):
            for doc, ids in zip(group_keys, coder.encode(group_texts)):
                held += [ids, end]
                keys.append(doc)
                lengths.append(len(ids) // 4 + 1)
                size += lengths[-1]
                if size >= BLOCK_IDS:
                    yield block()
                    first, size, keys, lengths, held = first + size, 0, [], [], []
        if keys:
            yield block()

    (
        df.select(named(key).cast("long").alias("k"), whole(text).alias("t"))
        .repartitionByRange("k")
        .sortWithinPartitions("k", "t")
        .mapInArrow(
            blocks,
            "shard int, first long, n_ids long, bits int, doc_ids array<long>, "
            "lengths array<long>, payload binary",
        )
        .write.parquet(f"{path}/blocks")
    )
    # One row per shard: as few as there are write tasks.
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = W.Window.orderBy("shard").rowsBetween(W.Window.unboundedPreceding, -1)
    totals.select(
        "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "n_ids"
    ).coalesce(1).write.parquet(f"{path}/shards")


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """The documents of a corpus: key, start (ids of all documents before it), n_tokens and
    ids (little-endian unsigned 32-bit). Blocks are read independently of each other."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                starts = np.cumsum(lengths) - lengths
                raw = unpack(row["payload"], row["bits"], 0, int(row["n_ids"])).tobytes()
                spans = zip((4 * starts).tolist(), (4 * (starts + lengths)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["base"] + row["first"], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([raw[a:b] for a, b in spans], pa.binary()),
                    ],
                    names=["k", "start", "n_tokens", "ids"],
                )

    shards = spark.read.parquet(f"{path}/shards").select("shard", "base")
    return (
        spark.read.parquet(f"{path}/blocks")
        .join(F.broadcast(shards), "shard")  # one row per write task
        .mapInArrow(documents, "k long, start long, n_tokens long, ids binary")
        .withColumnRenamed("k", key)
    )
