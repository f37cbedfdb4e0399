"""SpotSigs: signatures of chains of content words that follow common-word anchors.

A signature is an anchor (a very common word) and the next content words, other anchors
skipped. Where anchors are rare, as in other languages, lists or code, hashed chains of words
are signatures too. A text's fingerprint is the set of its signatures; likeness is the Jaccard
index of two sets. Near duplicates are found among sets of similar length only: sets are partitioned
by length, each set looks for partners by its rarest signatures, and only as many of these
as a partner must share at least one of.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stocktake.llm.shared import named, whole

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be been but by for from had has have he in is it its not of on or "
    "that the their there they this to was were which with you "
    "au aux ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une "
    "als auch auf aus das dem den der die ein eine er es für ich im ist mit nicht sich sie "
    "und von zu con del el los las lo no por se su una y"
).split()
CHAIN = 2
EVERY = 5  # words for each signature, which chains of words make up for where anchors are rare
FEW = 20  # signatures of a text that has words for no more
ANCHORED = 4  # of these few, what one by an anchor counts for
# Scripts without spaces between words: each letter is a word.
_SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
BLOCK_BITS = 7  # 128 neighbouring document ids are a block
SPAN_BITS = 12  # 4096 blocks are a group when the next block is looked for
SIMILAR = 0.8


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits; letters of scripts without spaces one by one."""
    border = rf"[^\p{{L}}\p{{M}}\p{{N}}]+|(?<=[{_SPACELESS}])|(?=[{_SPACELESS}])"
    # Such letters are three bytes long: other texts are cut by the plain pattern.
    spaced = F.octet_length(text) - F.length(text) < 2
    plain = F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
    cut = F.when(spaced | ~F.rlike(text, F.lit(f"[{_SPACELESS}]")), plain).otherwise(F.split(F.lower(text), border))
    return F.filter(cut, lambda w: w != "")


def _is_anchor(word: Column) -> Column:
    return word.isin(*ANCHORS)


def _chains(words: Column, chain: int, share: Column) -> Column:
    """Hashes of chains of ``chain`` + 1 words: the lowest ``share`` of all hashes."""
    of = F.transform(
        words, lambda w, i: F.when(i + chain < F.size(words), F.hash(w, *[F.get(words, i + 1 + c) for c in range(chain)]))
    )
    return F.filter(of, lambda h: h.isNotNull() & (F.pmod(h, F.lit(1 << 16)) < share * (1 << 16)))


def _share(words: Column, listed: Column) -> Column:
    """The share of chains that fills the signatures up to one in EVERY words, or up to FEW, of
    which a signature by an anchor counts for ANCHORED. A word or an anchor more or less changes
    the number wanted by a few, so nothing hangs on a limit that a small edit passes."""
    wanted = F.greatest(F.least(words, F.lit(FEW)) - ANCHORED * listed, words / EVERY - listed)
    return F.greatest(F.lit(0.0), wanted / F.greatest(words, F.lit(1)))


def _own(text: Column) -> Column:
    """A 64-bit hash in two halves."""
    hashed = F.xxhash64(text)
    halves = (F.shiftright(F.shiftleft(hashed, 32), 32), F.shiftright(hashed, 32))
    return F.array_sort(F.array_distinct(F.array(*[h.cast("int") for h in halves])))


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted set of signatures, as 32-bit hashes.

    The content words after the j-th anchor, at place p, begin at place p - j of the content
    words. An anchor followed by fewer than ``chain`` of them makes no signature. Where these
    signatures are few for the words, chains of neighbouring words, chosen by their hash, are
    signatures too, so that an edit changes a part of them only; how many are taken changes by
    degrees with the words and anchors. A text without any signature (of up to ``chain`` words,
    as a rule) has its own 64-bit hash in two halves, so equal texts agree and others do not;
    an empty text has none.
    """
    words, content, anchors = f"{out}_words", f"{out}_content", f"{out}_anchors"
    chained = F.transform(
        anchors,
        lambda p, j: F.when(
            p - j + chain <= F.size(content),
            F.hash(F.get(words, p), *[F.get(content, p - j + i) for i in range(chain)]),
        ),
    )
    anchored, listed = f"{out}_anchored", F.col(f"{out}_anchored")
    share = _share(F.size(words), F.size(listed))
    both = F.when(share > 0, F.concat(listed, _chains(F.col(words), chain, share))).otherwise(listed)
    found = F.array_sort(F.array_distinct(both))
    places = F.transform(words, lambda w, i: F.when(_is_anchor(w), i))
    plain = F.when(named(text) == "", F.array().cast("array<int>")).otherwise(_own(named(text)))
    return (
        df.withColumn(words, tokens(named(text)))
        .withColumn(content, F.filter(words, lambda w: ~_is_anchor(w)))
        .withColumn(anchors, F.filter(places, lambda p: p.isNotNull()))
        .withColumn(anchored, F.filter(chained, lambda s: s.isNotNull()))
        .withColumn(out, found)
        .withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(plain))
        .drop(words, content, anchors, anchored)
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets; 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def as_text(signatures: Column) -> Column:
    """Eight hex digits for each signature, ascending."""
    digits = F.transform(signatures, lambda s: F.right(F.concat(F.lit("0000000"), F.hex(s)), F.lit(8)))
    return F.lower(F.array_join(digits, ""))


def near_pairs(
    df: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR
) -> tuple[DataFrame, DataFrame]:
    """Pairs of class representatives (a < b, likeness of at least ``similar``), and the
    membership of every row (key, class).

    Rows with equal sets form a class, named by its smallest key; copies are not expanded
    into pairs. Null texts are empty; empty texts form one class without partners. Null keys
    are members, and name no class that has another key. Two sets of lengths m <= n can only
    be similar if m >= similar * n, so lengths are put into bands and a set meets its own and
    the next band. Ordered from rare to common, similar sets share a signature among the
    first n - ceil(similar * n) + 1, so common signatures bring nobody together.
    """
    plain = df.select(named(key).alias("key"), whole(text).alias("text"))
    sets = with_signatures(plain, "text", "sig").select("key", "sig", F.sha2(as_text(F.col("sig")), 256).alias("set"))
    names = sets.groupBy("set").agg(F.min("key").alias("class"))
    members = sets.join(names, "set").select("key", "class")
    one = sets.groupBy("set").agg(F.min("key").alias("class"), F.first("sig").alias("sig")).where(F.size("sig") > 0)
    size = F.size("sig")
    band = F.floor(F.log(size.cast("double")) / -math.log(similar)).cast("int")
    listed = one.select("class", F.explode("sig").alias("s"))
    common = listed.groupBy("s").agg(F.count("*").alias("n"))
    ordered = listed.join(common, "s").groupBy("class").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "s"))), lambda x: x["s"]).alias("ordered")
    )
    prefix = F.slice("ordered", 1, (size - F.ceil(size * similar - 1e-9) + 1).cast("int"))
    probes = one.join(ordered, "class").select("class", "sig", band.alias("band"), F.explode(prefix).alias("s"))
    left = probes.select(F.col("class").alias("a"), F.col("sig").alias("sa"), "s", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("band").alias("own"))
    right = probes.select(F.col("class").alias("b"), F.col("sig").alias("sb"), "s", "band")
    near_size = (F.size("sa") >= similar * F.size("sb") - 1e-9) & (F.size("sb") >= similar * F.size("sa") - 1e-9)
    met = left.join(right, ["s", "band"]).where((F.col("a") != F.col("b")) & near_size)
    once = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = (
        met.withColumn("likeness", likeness(F.col("sa"), F.col("sb")))
        .where(F.col("likeness") >= similar)
        .select(once.alias("pair"), "likeness")
        .distinct()
        .select("pair.a", "pair.b", "likeness")
    )
    return pairs, members


def _blocks_in_order(blocks: DataFrame) -> DataFrame:
    """block, following: the next lower block that has rows; after the lowest the highest.

    Two steps: within a group of blocks, and across groups: where ids are dense, one group
    for half a million documents.
    """
    group = F.shiftright("block", SPAN_BITS).alias("group")
    grouped = blocks.select("block", group)
    within = W.Window.partitionBy("group").orderBy(F.col("block").desc())
    heads = grouped.groupBy("group").agg(F.max("block").alias("head"))
    across = W.Window.orderBy(F.col("group").desc())
    around = across.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    next_head = F.coalesce(F.lead("head").over(across), F.first("head").over(around))
    return (
        grouped.withColumn("following", F.lead("block").over(within))
        .join(heads.select("group", next_head.alias("next_head")), "group")
        .select("block", F.coalesce("following", "next_head").alias("following"))
    )


def with_next_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text and next_text: the text of the next document in descending key order, after
    the last one that of the first.

    Neighbouring integer keys lie in one block, where a window finds the next row; the last
    row of a block gets the first row of the next block that has any. All texts are shuffled
    once. Equal keys follow each other by descending text; null keys come last, ordered by a
    hash of the text, and lie in blocks by that hash. A single row is its own next.
    """
    own, hashed = named(key).cast("long"), F.xxhash64(whole(text))
    keyless = F.lit(-(1 << 60)) + F.shiftrightunsigned(hashed, 44)
    block = F.coalesce(F.shiftright(own, BLOCK_BITS), keyless).alias("block")
    dealt = df.select(block, named(key).alias("key"), whole(text).alias("text"))
    down = W.Window.partitionBy("block").orderBy(
        F.col("key").desc_nulls_last(), F.when(F.col("key").isNull(), F.xxhash64("text")).desc(), F.col("text").desc()
    )
    rows = dealt.repartition("block").select(
        "block", "key", "text", F.lead("text").over(down).alias("next_text"),
        F.row_number().over(down).alias("place"),
    )
    heads = rows.where("place = 1").select(F.col("block").alias("following"), F.col("text").alias("head_text"))
    order = _blocks_in_order(df.select(block).distinct())
    # ``next_text`` is null in the last row of a block only.
    borders = (
        rows.where("next_text IS NULL").join(order, "block").join(heads, "following")
        .select("key", "text", F.col("head_text").alias("next_text"))
    )
    return rows.where("next_text IS NOT NULL").select("key", "text", "next_text").unionAll(borders)


def fingerprinted(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.

    The edited text has its last third of characters replaced by as many (or all) first ones
    of the next document. Null texts are empty; equal texts have equal fingerprints; two
    empty fingerprints are alike (1). Repeated rows give a row each and are each other's
    next; texts are taken whole; other columns are left out; an empty table gives none.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - third)"), F.expr("substring(next_text, 1, third)"))
    rows = (
        with_next_text(df, key, text)
        .withColumn("n_chars", n)
        .withColumn("third", third)
        .withColumn("edited", edited)
    )
    for column, out in (("text", "sig"), ("next_text", "next_sig"), ("edited", "edited_sig")):
        rows = with_signatures(rows, column, out)
    return rows.select(
        F.col("key").alias(key),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
