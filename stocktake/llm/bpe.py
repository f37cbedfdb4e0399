"""Byte-level BPE over a public rank file.

The bytes of a piece are read as Latin-1, so that a string automaton over all tokens finds
the longest token that starts at a byte. The encoder walks over the piece taking longest
tokens and steps back to shorter ones where the new token cannot stand after the last one.
Two tokens can stand side by side when merging the bytes of the pair gives exactly this
pair; a sequence in which every neighbour pair passes is the sequence that the merges give
(for ranks in which a token comes after the two that it is merged from). The verdict on a pair is remembered, and each byte position is given up at most once, so the
walk is linear in the length of the piece.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.shared import held, named, whole

RANKS = "byte_bpe_multi_50k.tiktoken"

# The characters with the Unicode property White_Space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern never joins a non-space with a space that follows it, so these stretches can be
# split on their own, and most of them repeat throughout a corpus.
_STRETCH = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_SIMPLE = re.compile(f"[ \n][^{_SPACE}]+")
_ODD = re.compile("[" + _SPACE.replace("\t-\r ", "\t\x0b-\r") + "]")
_CUT = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")

PARTS = 150_000  # remembered words per Python worker, and as many of the generation before
PART_CHARS = 48
MARKS = ".,;:!?$#%&*|-)]}"
MARKINGS = 10_000
PAIRS = 200_000  # remembered pair verdicts per Python worker
SEGMENT = 1 << 20  # characters handled at once


class _Parts(dict):
    """Ids of words. A key stands for the word after one space, or after the line end that it
    begins with. When full, the words become the generation before, from which those met
    again come back: frequent words are never forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.before: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            stem = part.rstrip(MARKS)
            if len(stem) < len(part) and stem[-1:].isalpha():
                # Marks after a letter are a piece of their own.
                marks = part[len(stem) :]
                if marks not in self.marks:
                    if len(self.marks) >= MARKINGS:
                        self.marks.clear()
                    self.marks[marks] = self.encode(marks)
                ids = self[stem] + self.marks[marks]
            else:
                ids = self.encode(part if part[0] == "\n" else " " + part)
        if len(part) <= PART_CHARS:
            if len(self) >= PARTS:
                self.before = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Coder:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: bytes, pattern: str = public_tokenizers.PATTERN):
        self.pattern = regex.compile(pattern)
        self.rank: dict[bytes, int] = {}
        for line in ranks.split(b"\n"):
            if line.strip():
                token, number = line.split()
                self.rank[base64.b64decode(token)] = int(number)
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("the rank file lacks a byte")
        self.number: dict[str, int] = {}  # by the bytes as Latin-1
        self.automaton = ahocorasick.Automaton()
        for token, number in self.rank.items():
            self.bytes_of[number] = token
            self.number[token.decode("latin-1")] = number
            self.automaton.add_word(token.decode("latin-1"), number)
        self.automaton.make_automaton()
        self.sizes = [len(t) for t in self.bytes_of]
        self.packed = [n.to_bytes(4, "little") for n in range(len(self.bytes_of))]
        self.width = max(self.sizes)
        self.span = 8 * self.width  # bytes searched at once
        self.shorter: dict[int, int] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts = _Parts(self._stretch)

    def merged(self, data: bytes, below: int = 1 << 30) -> list[int]:
        """The merges of ranks under ``below`` themselves, lowest first: for short inputs."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [r for r in ranks if r is not None and r < below]
            if not found:
                break
            at = ranks.index(min(found))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joins; None for a single byte, and
        for a token that the merges never make."""
        if token not in self.split:
            data = self.bytes_of[token]
            parts = self.merged(data, below=token) if len(data) > 1 else []
            self.split[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.split[token]

    def stands(self, last: int, token: int) -> bool:
        """Whether ``token`` can follow ``last`` (-1: begin a piece).

        Merges are undone from both sides of the border, latest first. The pair falls if two
        tokens that meet at the border would have been merged while both were there; of equal
        ranks the left one is merged first."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        verdict = self.pairs[last, token] = self._stands(last, token)
        return verdict

    def _stands(self, left: int, right: int) -> bool:
        made = all(len(self.bytes_of[t]) == 1 or self.halves(t) for t in (left, right) if t >= 0)
        if left < 0 or not made:
            return made
        until = len(self.bytes_of)
        while True:
            across = self.rank.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < until:
                return False
            a, b = self.halves(left), self.halves(right)
            if a and (not b or left > right):
                until, left = left, a[1]
            elif b:
                until, right = right + 1, b[0]
            else:
                return True

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        if token not in self.shorter:
            data = self.bytes_of[token]
            prefixes = (self.rank.get(data[:n], -1) for n in range(len(data) - 1, 0, -1))
            self.shorter[token] = next((p for p in prefixes if p >= 0), -1)
        return self.shorter[token]

    def piece(self, data: str) -> list[int]:
        """The ids of one match of the pattern, given as Latin-1."""
        whole_piece = self.number.get(data)
        if whole_piece is not None:
            return [whole_piece]
        size, span, width = len(data), self.span, self.width
        verdicts, sizes, shorter = self.pairs, self.sizes, self.shorter
        dead: set[int] = set()
        taken: list[int] = []
        at, last, base = 0, -1, 0
        # The longest tokens one after the other; each byte is a token, so none is passed over.
        run = self.automaton.iter_long(data[:span])
        _, token = next(run)
        longest = True
        while True:
            while token >= 0:
                end = at + sizes[token]
                if end not in dead:
                    verdict = verdicts.get((last, token))
                    if verdict or verdict is None and self.stands(last, token):
                        break
                longest = False
                token = shorter.get(token) or self.next_shorter(token)
            if token >= 0:
                taken.append(token)
                if end == size:
                    return taken
                at, last = end, token
                if not longest or at + width > base + span:
                    # Back on another way, or too near to the end of what is searched.
                    base, longest = at, True
                    run = self.automaton.iter_long(data[at : at + span])
                _, token = next(run)
            else:
                dead.add(at)
                token = taken.pop()
                at -= sizes[token]
                last = taken[-1] if taken else -1
                longest = False

    def _stretch(self, stretch: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(stretch):
            ids += self.piece(piece if piece.isascii() else piece.encode().decode("latin-1"))
        return b"".join(map(self.packed.__getitem__, ids))

    def _segment(self, text: str) -> Iterator[bytes]:
        parts = text.replace("\n", " \n").split(" ")
        if "" not in parts and "\n" not in parts and not _ODD.search(text):
            # Single spaces and line ends between words, and no other white space.
            yield self._stretch(parts[0])
            yield from map(self.parts.__getitem__, parts[1:])
            return
        for stretch in _STRETCH.findall(text):
            if _SIMPLE.fullmatch(stretch):
                yield self.parts[stretch if stretch[0] == "\n" else stretch[1:]]
            else:
                yield self._stretch(stretch)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(ids for segment in _segments(text) for ids in self._segment(segment))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _segments(text: str) -> Iterator[str]:
    """The text in parts of about SEGMENT characters, cut only between stretches."""
    begin = 0
    while len(text) - begin > SEGMENT:
        cut = _CUT.search(text, begin + SEGMENT)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def _coder(ranks: bytes, pattern: str) -> Coder:
    return held(("byte bpe", ranks, pattern), lambda: Coder(ranks, pattern))


class Bpe:
    """Encoding and decoding columns. The rank file (under a megabyte) is read once by the
    driver and broadcast."""

    def __init__(
        self, spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN
    ):
        with open(path or public_tokenizers.path(RANKS), "rb") as file:
            self.ranks = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Text to the bytes of its ids (little-endian unsigned 32-bit). Null gives no ids."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            coder = _coder(ranks.value, pattern)
            for batch in batches:
                yield pd.Series([coder.encode(t or "") for t in batch], dtype=object)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for. Null gives no bytes."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            coder = _coder(ranks.value, pattern)
            for batch in batches:
                yield pd.Series([coder.decode(i or b"") for i in batch], dtype=object)

        return decoded(ids)

    def round_trip(self, text: Column) -> Column:
        """Ids as ``encode`` gives them, and the bytes that they decode to, in one pass."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("ids binary, decoded binary")
        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            coder = _coder(ranks.value, pattern)
            for batch in batches:
                ids = [coder.encode(t or "") for t in batch]
                yield pd.DataFrame({"ids": ids, "decoded": [coder.decode(i) for i in ids]}, dtype=object)

        return both(text)


def round_trip(df: DataFrame, bpe: Bpe, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``df``: key, ids, n_tokens and the decoded bytes.

    Null and empty texts have no ids. Rows stay as they are, so repeated rows, ties and null
    keys each give one row; other columns are ignored, whatever their names; an empty table
    gives none. A text of any length is encoded whole, a segment at a time.
    """
    coded = df.select(named(key).alias(key), bpe.round_trip(whole(text)).alias("_coded"))
    return coded.select(
        named(key),
        "_coded.ids",
        (F.length("_coded.ids") / 4).cast("long").alias("n_tokens"),
        "_coded.decoded",
    )
