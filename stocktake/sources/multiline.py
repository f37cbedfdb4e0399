"""Records of CSV files whose quoted fields may hold line ends, read block by block.

Whether a line end ends a record depends on whether it lies in a quoted field, which depends on
everything before it. But a line is entered in one of two states only: a record begins (0), or a
quoted field goes on (1). Every byte block therefore maps these two states to the state it ends
in. The maps of all blocks, a row each, are composed along a file; then each block knows its
state, and joins its lines to records by itself. Only what crosses a block's border, at most two
pieces a block, is put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktake.session import stage

QUOTE, BYTE_ORDER_MARK = chr(34), chr(0xFEFF)

# A quote opens a field only where the field begins; two quotes in it are one; text behind the
# closing quote belongs to the field until the next delimiter or line end.
_CLOSING = r'[^"]*+(?:""[^"]*+)*+"[^,\n]*+'
_FIELD = rf'(?:"{_CLOSING}|(?!")[^,\n]*+)'
RECORD = re.compile(rf"(?:{_FIELD},)*+{_FIELD}\n")
REST = re.compile(rf"{_CLOSING}(?:,{_FIELD})*+\n")  # of a record entered in a quoted field

_MAPS = "_file string, _block long, from_0 int, from_1 int"
_RECORDS = "_file string, _block long, _no long, _record string, _whole boolean"
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _schema(kind: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in kind.split(", "))])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of each block in a batch. A block's rows come together."""
    for batch in batches:
        while batch.num_rows:
            file, start = batch.column("_file")[0], batch.column("_block")[0]
            same = pc.and_(pc.equal(batch.column("_file"), file), pc.equal(batch.column("_block"), start))
            count = pc.sum(same).as_py()
            yield file.as_py(), start.as_py(), batch.slice(0, count)
            batch = batch.slice(count)


def records_end(text: str, at: int = 0) -> int:
    """Where the last whole record in ``text`` ends, from the beginning of one."""
    while found := RECORD.match(text, at):
        at = found.end()
    return at


def goes_on(text: str, inside: bool) -> bool:
    """Whether a quoted field goes on behind these lines."""
    if inside:
        rest = REST.match(text)
        # Lines that end in another quoted field are entered by closing this one.
        if not rest:
            closed = re.match(_CLOSING, text)
            return not closed or goes_on(text[closed.end() :].removeprefix(","), False)
        return records_end(text, rest.end()) < len(text)
    return records_end(text) < len(text)


def _block_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The end state of each block for either state at its beginning; lines without a quote
    come as null and change nothing."""
    schema, key, ends = _schema(_MAPS), None, (0, 1)

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, *ends), schema)], schema=schema)

    for file, start, rows in _runs(batches):
        first = (file, start) != key
        if first:
            if key:
                yield row()
            key, ends = (file, start), (0, 1)
        lines = rows.column("value").drop_null().to_pylist()
        if lines:
            text = "\n".join(lines) + "\n"
            if first and start == 0:
                text = text.removeprefix(BYTE_ORDER_MARK)
            after = [int(goes_on(text, bool(s))) for s in (0, 1)]
            ends = after[ends[0]], after[ends[1]]
    if key:
        yield row()


class _Block:
    """The records of one block, and its pieces of records that cross its borders."""

    schema = _schema(_RECORDS)

    def __init__(self, file: str, start: int, entered: int):
        self.file, self.start, self.no = file, start, 0
        self.heading = bool(entered)  # within the record that the block before left open
        self.first = start == 0
        self.open: list[str] = []  # lines of a record that is not closed yet

    def _batch(self, texts: pa.Array, whole: bool = True, numbered: bool = True) -> pa.RecordBatch:
        count = len(texts)
        numbers = pa.array(range(self.no, self.no + count), pa.int64()) if numbered else pa.nulls(count, pa.int64())
        self.no += count if numbered else 0
        columns = [pa.repeat(self.file, count), pa.repeat(pa.scalar(self.start, pa.int64()), count), numbers, texts]
        return pa.RecordBatch.from_arrays([*columns, pa.repeat(whole, count)], schema=self.schema)

    def _records(self, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        texts = pc.utf8_rtrim(texts, "\r")
        texts = texts.filter(pc.not_equal(pc.utf8_trim_whitespace(texts), ""))
        if len(texts):
            yield self._batch(texts)

    def lines(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quoted = pc.any(pc.match_substring(lines, QUOTE)).as_py()
        if not quoted and (self.open or self.heading):
            self.open += lines.to_pylist()
            return
        if not quoted and not self.first:
            yield from self._records(lines)
            return
        text = "\n".join([*self.open, *lines.to_pylist()]) + "\n"
        if self.first:
            text, self.first = text.removeprefix(BYTE_ORDER_MARK), False
        at, self.open = 0, []
        if self.heading:
            rest = REST.match(text)
            if rest:
                at, self.heading = rest.end(), False
                yield self._batch(pa.array([text[: at - 1].rstrip("\r")]), False, False)
        found = []
        while not self.heading and (record := RECORD.match(text, at)):
            found.append(text[at : record.end() - 1])
            at = record.end()
        yield from self._records(pa.array(found, pa.string()))
        if at < len(text):
            self.open = [text[at:-1]]

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self._batch(pa.array(["\n".join(self.open)]), False, not self.heading)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None
    for file, start, rows in _runs(batches):
        if block is None or (block.file, block.start) != (file, start):
            if block:
                yield from block.end()
            block = _Block(file, start, rows.column("entered")[0].as_py())
        yield from block.lines(rows.column("value"))
    if block:
        yield from block.end()


def _entered(maps: DataFrame) -> DataFrame:
    """The state that each block is entered in. A block keeps the state, turns it
    round, or ends in one state whatever it began with: the last block of the third kind, and
    the turns since, give the state behind a block."""
    order = Window.partitionBy("_file").orderBy("_block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum(F.when((F.col("from_0") == 1) & (F.col("from_1") == 0), 1).otherwise(0)).over(upto)
    fixed = F.when(F.col("from_0") == F.col("from_1"), F.struct(F.col("from_0").alias("state"), "turns"))
    known = maps.withColumn("turns", turns).withColumn("fixed", F.last(fixed, ignorenulls=True).over(upto))
    since = F.col("turns") - F.coalesce("fixed.turns", F.lit(0))
    behind = ((F.coalesce("fixed.state", F.lit(0)) + since) % 2).cast("int")
    return known.withColumn("behind", behind).select(
        "_file", "_block", F.coalesce(F.lag("behind").over(order), F.lit(0)).alias("entered")
    )


def _repaired(pieces: DataFrame) -> DataFrame:
    """Records that begin in one block and end in another. A piece without number belongs to
    the last record that was left open before it."""
    order = Window.partitionBy("_file").orderBy("_block", F.col("_no").asc_nulls_first())
    begun = F.when(F.col("_no").isNotNull(), F.struct("_block", "_no"))
    owner = F.last(begun, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.sort_array(F.collect_list(F.struct(F.col("_block").alias("at"), F.col("_record").alias("text"))))
    return (
        pieces.withColumn("_owner", owner).groupBy("_file", "_owner").agg(parts.alias("_parts"))
        .select(
            "_file", "_owner._block", "_owner._no",
            F.array_join(F.transform("_parts", lambda p: p["text"]), "\n").alias("_record"),
        )
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record that is not blank: its file, the start of the byte block that it begins in,
    its number there (from 0), and its text without line end. A field that the file ends in
    goes on to that end. A record must fit a row, as any value must.

    Files are split as other text is, if their compression allows it. The states are broadcast:
    at most a row for each block that a quoted field crosses into. The records are staged.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )
    quoted = F.when(F.col("value").contains(QUOTE), F.col("value"))
    states = _entered(lines.withColumn("value", quoted).mapInArrow(_block_maps, _MAPS))
    told = lines.join(F.broadcast(states.where("entered = 1")), ["_file", "_block"], "left")
    told = told.withColumn("entered", F.coalesce("entered", F.lit(0)))
    records = stage(told.mapInArrow(_assembled, _RECORDS), "csv")
    whole = records.where("_whole").drop("_whole")
    return whole.unionByName(_repaired(records.where("NOT _whole").drop("_whole")))
