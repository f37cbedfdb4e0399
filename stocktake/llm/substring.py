"""Substring dedup by hashing lines (or paragraphs) and the sentences in them.

A text is cut into lines, and lines into sentences, so that a passage is found in whatever
line it stands. Each unit that has a word is normalised (lower case, white space runs as one
space) and hashed; the digests of all documents are grouped, and the occurrence ranked first
(smallest document id, then place) is the one that stays. Sentences of few words repeat by
chance, so one that is not a line of its own is hashed as a chain: together with as many of
the line's next sentences (at the end of the line: of the ones before) as make up the words
that a sentence needs to tell something. Repeats are removed in runs: consecutive repeated
units of a document go if the run has at least ``min_words`` words. What stays keeps its
original offsets.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stocktake.llm.shared import forget, fresh, named, whole
from stocktake.session import stage

# Patterns whose matches, one after the other, are the whole text. White space after an end
# belongs to what it ends. Texts with one of OTHER_ENDS are cut there too, by a pattern that
# takes three times as long and is kept from all other texts.
LINE = r"[^\n]*\n|[^\n]+"
PARAGRAPH = r"(?s).+?\n\n+|.+"
SENTENCE = r"[^.!?]+[.!?\x20\t\n\x0B\f\r]*|[.!?][.!?\x20\t\n\x0B\f\r]*"
OTHER_ENDS = "。！？।"
_WIDER = {SENTENCE: SENTENCE.replace(".!?", ".!?" + OTHER_ENDS)}
# Scripts without spaces between words: two letters count as a word.
_SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
MIN_WORDS = 10
SENTENCE_WORDS = 5  # words from which a sentence within a line is hashed by itself

# The white space of normalisation.
_BLANK = " \t\n\x0b\f\r"


def _row_key(key: str, text: str) -> Column:
    """Rows that agree in id and text are one document."""
    own = F.coalesce(named(key).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws(":", own, F.md5(whole(text)))))


def _words(plain: Column) -> Column:
    """Words between spaces, or half the letters of scripts without spaces if that is more."""
    spaced = F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1
    letters = F.length(F.regexp_replace(plain, f"[^{_SPACELESS}]+", ""))
    # Such letters are three bytes long: other texts are not searched for them.
    possible = F.octet_length(plain) - F.length(plain) >= 4 * spaced
    return F.when(possible, F.greatest(spaced, F.floor(letters / 2).cast("int"))).otherwise(spaced)


def _chain(units_of_line: Column) -> Column:
    """The first units, as many as have SENTENCE_WORDS words, each after a line end (which no
    unit holds); null if all of them have fewer. A unit has a word at least."""
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("words"))
    return F.aggregate(
        units_of_line,
        begin,
        lambda done, u: F.when(done["words"] >= SENTENCE_WORDS, done).otherwise(
            F.struct(
                F.concat(done["text"], F.lit("\n"), u["plain"]).alias("text"),
                (done["words"] + u["words"]).alias("words"),
            )
        ),
        lambda done: F.when(done["words"] >= SENTENCE_WORDS, done["text"]),
    )


def _hashed(us: Column, u: Column, i: Column) -> Column:
    """What is hashed for unit ``i`` of a line's units: its own text if it has the words or the
    line; else its chain. A chain that the end of the line cuts off is the one that ends there,
    and the number of units to the end tells the units that share it apart."""
    size = F.size(us)
    onward = _chain(F.slice(us, i + 1, F.lit(SENTENCE_WORDS)))
    # The whole line if that has too few words.
    last = F.reverse(F.slice(us, F.greatest(size - SENTENCE_WORDS + 1, F.lit(1)), F.lit(SENTENCE_WORDS)))
    all_of_it = F.array_join(F.transform(us, lambda x: x["plain"]), "\n")
    ending = F.concat_ws("\n", (size - i).cast("string"), F.coalesce(_chain(last), all_of_it))
    alone = (size == 1) | (u["words"] >= SENTENCE_WORDS)
    return F.when(alone, u["plain"]).otherwise(F.coalesce(onward, ending))


def units(df: DataFrame, key: str, text: str, line: str = LINE, part: str = SENTENCE) -> DataFrame:
    """One row per unit with a word: row key, document id, place among these units, digest and
    number of words."""
    other = reduce(Column.__or__, [F.contains(whole(text), F.lit(end)) for end in OTHER_ENDS])
    lines = F.regexp_extract_all(F.lower(whole(text)), F.lit(line), F.lit(0))

    def cut(pattern: str) -> Column:
        return F.transform(lines, lambda l: F.regexp_extract_all(l, F.lit(pattern), F.lit(0)))

    def normal(p: Column) -> Column:
        return F.trim(F.regexp_replace(p, r"[ \t\n\x0B\f\r]+", " "))

    # The choice is made once for a text, not once for a line.
    parts = F.when(other, cut(_WIDER.get(part, part))).otherwise(cut(part))
    worded = F.transform(parts, lambda ps: F.filter(F.transform(ps, normal), lambda p: p != ""))
    sized = F.transform(
        worded,
        lambda ps: F.transform(ps, lambda p: F.struct(p.alias("plain"), _words(p).alias("words"))),
    )
    hashed = F.transform(
        sized,
        lambda us: F.transform(
            us, lambda u, i: F.struct(_hashed(us, u, i).alias("hashed"), u["words"].alias("words"))
        ),
    )
    return (
        df.select(_row_key(key, text).alias("row"), named(key).alias("doc"), F.flatten(hashed).alias("units"))
        .select("row", "doc", F.posexplode("units").alias("place", "unit"))
        .select("row", "doc", "place", F.unhex(F.md5("unit.hashed")).alias("digest"), "unit.words")
    )


def repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", line: str = LINE, part: str = SENTENCE,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Per document with repeats to remove: row key, places (sorted) and words removed."""
    # Texts are cut and hashed once; what is staged is the digests.
    found = stage(units(df, key, text, line, part), "units")
    rank = F.struct(F.col("doc").isNull().alias("last"), "doc", "row", "place")
    # Staged, so that neither side of the join is an aggregate: Spark can split a hot digest.
    groups = stage(
        found.groupBy("digest")
        .agg(F.min(rank).alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("group"), F.col("kept.row").alias("kept_row"), F.col("kept.place").alias("kept_place")),
        "repeated-units",
    )
    later = found.join(groups, F.col("digest") == F.col("group")).where(
        "row <> kept_row OR place <> kept_place"
    )
    # Repeated rows of the table give the same units twice.
    once = later.groupBy("row", "place").agg(F.first("words").alias("words"))
    along = W.Window.partitionBy("row").orderBy("place")
    runs = once.withColumn("run", F.col("place") - F.row_number().over(along))
    length = F.sum("words").over(W.Window.partitionBy("row", "run"))
    return (
        runs.withColumn("length", length)
        .where(F.col("length") >= min_words)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("place")).alias("places"), F.sum("words").alias("words"))
    )


def _without(line: str, part: str):
    lines, plain, wider = re.compile(line), re.compile(part), re.compile(_WIDER.get(part, part))

    @F.pandas_udf("text string, spans array<struct<begin:long,end:long>>")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        forget()
        out = []
        for text, gone in zip(texts, places):
            gone = {int(p) for p in gone}
            parts = wider if any(end in text for end in OTHER_ENDS) else plain
            spans, at, place = [], 0, 0
            for unit in (p for l in lines.finditer(text) for p in parts.findall(l.group())):
                end = at + len(unit)
                worded = bool(unit.strip(_BLANK))
                if not (worded and place in gone):
                    if spans and spans[-1]["end"] == at:
                        spans[-1]["end"] = end
                    else:
                        spans.append({"begin": at, "end": end})
                at, place = end, place + worded
            out.append({"text": "".join(text[s["begin"] : s["end"]] for s in spans), "spans": spans})
        return pd.DataFrame(out, columns=["text", "spans"])

    return cut


def dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", line: str = LINE, part: str = SENTENCE,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``df`` as a struct column ``doc`` with its rest: text, spans, units_removed and
    words_removed.

    ``text`` is what stays, and ``spans`` are the stretches [begin, end) of the original, in
    code points, that it is made of. Of a passage that starts or ends within a sentence, that
    sentence stays; text without line or sentence ends is one unit. A text without repeats
    is passed on as it is (null stays null) in one span. Documents of which nothing stays
    have an empty text; none is dropped.

    The id ranks occurrences, null last; rows that agree in id and text are one document and
    are treated alike; of documents with equal ids and different texts the digest of the text
    decides. Units are compared by 128-bit digests, and only they are shuffled: a unit that
    occurs in very many documents is counted before the shuffle, and its join is split by
    Spark. Empty tables give empty results.
    """
    row, inner = fresh("row"), fresh("doc")
    docs = df.select(
        F.struct(*[named(c).alias(c) for c in df.columns]).alias(inner),
        _row_key(key, text).alias(row),
    )
    marked = repeats(df, key, text, line, part, min_words).withColumnRenamed("row", row)
    joined = docs.join(marked, row, "left")
    original = F.col(inner)[text]
    changed = F.col("places").isNotNull()
    cut = fresh("cut")
    # Python sees the changed texts only.
    some = joined.withColumn(
        cut,
        _without(line, part)(
            F.when(changed, original).otherwise(F.lit("")),
            F.coalesce("places", F.array().cast("array<int>")),
        ),
    )
    all_of_it = F.array(
        F.struct(
            F.lit(0).cast("long").alias("begin"),
            F.length(F.coalesce(original, F.lit(""))).cast("long").alias("end"),
        )
    )
    return some.select(
        F.col(inner).alias("doc"),
        F.when(changed, F.col(cut)["text"]).otherwise(original).alias("text"),
        F.when(changed, F.col(cut)["spans"]).otherwise(all_of_it).alias("spans"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("units_removed"),
        F.coalesce("words", F.lit(0)).cast("long").alias("words_removed"),
    )
