"""URL filter: rules, and a tree of path templates per host for what no rule decides.

Segments of a path that vary become wildcards: a branch stays literal only if it holds enough
pages, however many its node has. Sibling branches whose labelled shares do not differ beyond chance are
merged into one. A template is rejected if its share of good pages, smoothed towards its
host's and the corpus's share, is under a threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.shared import named
from stocktake.session import stage

# (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
LEAST = 20  # pages that a literal branch has at least
Z = 1.96  # sibling branches closer than this many standard errors are one
PRIOR = 20.0  # labelled pages that the smoothing counts as
PURITY = 0.5
WILD = "?"  # a wildcard in a template: a path ends before the first question mark

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(host, empty), F.coalesce(path, empty)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own in sorted(rules, key=lambda r: len(r[0] + r[1])):
        same = (host == own_host) | F.endswith(host, F.lit("." + own_host))
        fits = same & F.startswith(path, F.lit(own_path))
        rule = F.when(fits, own_host + own_path).otherwise(rule)
        verdict = F.when(fits, own).otherwise(verdict)
    return rule, verdict


def with_templates(pages: DataFrame) -> DataFrame:
    """Adds ``template`` to rows with host and path. Counts are taken over all rows.

    Level by level, a segment stays literal with at least LEAST pages of its node; the others
    are one wildcard, and go on as a node if they are as many together. Of a node with fewer
    pages all that follows is one wildcard. Every level needs LEAST pages that reach it, so
    the rounds end with the paths. No segment of a path reads like the wildcard.
    """
    rows, level, done = pages.withColumn("template", F.lit("")), 0, []
    while True:
        rows = rows.withColumn("segment", F.get(F.split("path", "/"), F.lit(level + 1)))
        counts = rows.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        nodes = stage(
            counts.groupBy("host", "template", F.when(F.col("n") >= LEAST, F.col("segment")).alias("segment"))
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST)
            .drop("n"),
            "branches",
        )
        wild = F.concat("template", F.lit(f"/{WILD}"))
        if nodes.isEmpty():
            last = F.when(F.col("segment").isNull(), F.col("template")).otherwise(wild)
            done.append(rows.withColumn("template", last).drop("segment"))
            break
        literal = nodes.where("segment IS NOT NULL").withColumn("literal", F.lit(True))
        others = nodes.where("segment IS NULL").select("host", "template", F.lit(True).alias("others"))
        shown = F.when(F.col("literal"), F.concat("template", F.lit("/"), "segment")).otherwise(wild)
        goes_on = F.col("segment").isNotNull() & (F.col("literal").isNotNull() | F.col("others").isNotNull())
        stepped = stage(
            rows.join(literal, ["host", "template", "segment"], "left")
            .join(others, ["host", "template"], "left")
            .select(
                *pages.columns,
                F.when(F.col("segment").isNull(), F.col("template")).otherwise(shown).alias("template"),
                goes_on.alias("goes_on"),
            ),
            "level",
        )
        done.append(stepped.where("NOT goes_on").drop("goes_on"))
        rows, level = stepped.where("goes_on").drop("goes_on"), level + 1
    return reduce(DataFrame.unionByName, done)


def merged(templates: DataFrame) -> DataFrame:
    """Adds ``branch`` to rows of host, template, labelled, bad: the template after similar
    siblings were merged, from the leaves up."""
    rows = templates.withColumn("branch", F.split("template", "/"))
    depth = (rows.agg(F.max(F.size("branch"))).first()[0] or 1) - 1
    for level in range(depth, 0, -1):
        rows = rows.withColumn("above", F.slice("branch", 1, level)).withColumn("own", F.get("branch", F.lit(level)))
        # Staged, so that every level reads what the one before found instead of finding it again.
        child = stage(
            rows.where(F.size("branch") >= level)
            .groupBy("host", "above", "own")
            .agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")),
            "children",
        )
        node = child.groupBy("host", "above").agg(
            F.sum("n").alias("all_n"), F.sum("b").alias("all_b"), F.count("own").alias("branches")
        )
        rest_n, rest_b = F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b")
        known = (F.col("n") > 0) & (rest_n > 0)
        rate = F.try_divide("all_b", "all_n")
        one = F.lit(1.0)
        error = F.sqrt(rate * (1 - rate) * (F.try_divide(one, F.col("n")) + F.try_divide(one, rest_n)))
        gap = F.abs(F.try_divide("b", "n") - F.try_divide(rest_b, rest_n))
        apart = known & (error > 0) & (gap >= Z * error)
        tested = child.join(node, ["host", "above"]).select(
            "host", "above", "own",
            ((F.col("branches") > 1) & ~F.coalesce(apart, F.lit(False))).alias("similar"),
        )
        wild = F.concat("above", F.array(F.lit(WILD)), F.slice("branch", level + 2, 1 << 30))
        rows = stage(
            rows.join(tested, ["host", "above", "own"], "left")
            .withColumn("branch", F.when(F.col("similar"), wild).otherwise(F.col("branch")))
            .drop("above", "own", "similar"),
            "merged",
        )
    return rows.withColumn("branch", F.array_join("branch", "/"))


def judged(
    pages: DataFrame, labels: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", purity: float = PURITY
) -> DataFrame:
    """Per row of ``pages``: key, host, path, rule, verdict (allow or block), template and
    purity.

    ``labels`` has ``key`` and ``bad`` (0 or 1); of several labels of one key the worse one
    counts, and a null one is no label. A null url, or one without ``://``, has an empty host
    and path and is judged by the template of those. A template without labels has the
    smoothed purity of its host; without any label the purity is 1 and nothing is rejected.
    Null and repeated keys give a row for each page; other columns are left out; an empty
    table gives an empty result.

    Only branches and templates are joined back to the pages; they are staged, and Spark
    broadcasts them only under its size limit.
    """
    host, path = host_and_path(named(url))
    parsed = pages.select(named(key).alias("page"), host.alias("host"), path.alias("path"))
    known = labels.where("bad IS NOT NULL").groupBy(named(key).alias("page")).agg(F.max("bad").alias("bad"))
    rows = with_templates(parsed)
    counted = (
        rows.join(known, "page", "left")
        .groupBy("host", "template")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    counted = stage(counted, "templates")
    total = counted.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")).first()
    common = 1.0 - total.b / total.n if total and total.n else 1.0
    good = F.sum("labelled") - F.sum("bad")
    tree = merged(counted)
    hosts = counted.groupBy("host").agg(
        ((good + PRIOR * common) / (F.sum("labelled") + PRIOR)).alias("host_purity")
    )
    branches = (
        tree.groupBy("host", "branch")
        .agg(good.alias("good"), F.sum("labelled").alias("seen"))
        .join(hosts, "host")
        .select(
            "host", "branch",
            ((F.col("good") + PRIOR * F.col("host_purity")) / (F.col("seen") + PRIOR)).alias("purity"),
        )
    )
    graded = tree.select("host", "template", "branch").join(branches, ["host", "branch"])
    graded = stage(graded, "purity")
    rule, own = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < purity, "block").otherwise("allow")
    return rows.join(graded, ["host", "template"], "left").select(
        F.col("page").alias(key), "host", "path",
        rule.alias("rule"), F.coalesce(own, method).alias("verdict"),
        F.col("branch").alias("template"), "purity",
    )
