"""Quality rules: adaptive thresholds from mergeable quantile sketches per language and source.

Every document gets its counts; documents that pass the base rules feed one quantile sketch for
each (lang, source, feature).  A sketch is a set of log-linear buckets with their counts (relative
error at most 1/128), so sketches merge by adding counts, in any order, with the same result, and
hold a few hundred rows however large their group is.

A group's limit comes from its own sketch: the middle q50, a unit, and a spread.  The unit is twice
the lower quarter (q50 - q25), which the worst half of a group can't widen, and the share that one
event (a symbol, a line, two like windows) makes in a document of the group's median size, so that
features that most documents have none of have a unit too.  The spread is the mean logarithm of what
lies BODY units above the middle, in units: every document adds to it, none has much weight, and no
quantile decides at which share of bad documents it begins to grow.  The limit is
middle + unit * (BODY + exp(REACH * spread) - 1).

Where a group's spread is larger than its parent's (its language's, and a language's than that of
all), its tail is the heavier one and the parent's counts: a source with more junk gets no looser
rule for it.  A source that is of another kind as a whole differs in its middle and its unit.  A
small group leans on its parent: each sketch is taken with WEIGHT documents' worth of the parent's
distribution, whatever its size, so no size is a switch.  A document is rejected if a feature exceeds
its group's limit by more than one event.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, stash, table

MIN_WORDS = 50
#: Documents' worth of the parent's distribution in every sketch.
WEIGHT = 100
#: Units above the middle that count as a group's body, and how far a limit follows the spread beyond it.
BODY, REACH = 4, 4
#: Feature -> its counts (part per whole), the scale of its rate, and the part in one event.
FEATURES = {
    "word_length": ("word_chars", "n_words", 10_000, 0),
    "symbols": ("n_symbols", "word_chars", 1_000_000, 1),
    "dup_lines": ("n_dup_lines", "n_lines", 1_000_000, 1),
    "repeats": ("n_repeat_words", "n_words", 1_000_000, 6),
}
#: The sketches of the wholes, for the share of one event.
SIZES = {f"{name}_size": (name, whole) for name, (_, whole, _, event) in FEATURES.items() if event}
#: Thresholds are broadcast up to this many groups, and shuffled beyond.
BROADCAST_GROUPS = 100_000

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])


def count_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, lines with a word, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeats = 0
    if len(set(windows)) < len(windows):
        seen: dict = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        upto = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeats


@F.pandas_udf(COUNTS)
def text_counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([count_text(x) for x in texts], columns=COUNTS.names)


def base_failed() -> Column:
    return (F.col("q.n_words") < MIN_WORDS) | (100 * F.col("q.n_repeat_words") > 50 * F.col("q.n_words"))


def feature(name: str) -> Column:
    part, whole, scale, _ = FEATURES[name]
    return F.expr(f"q.{part} * {scale} div greatest(q.{whole}, 1)")


def within(name: str, limit: Column) -> Column:
    """Whether the feature, as a whole number, is at most one event over the limit; true without a limit."""
    part, whole, scale, event = FEATURES[name]
    return F.coalesce((F.col(f"q.{part}") - event) * scale < (limit + 1) * F.greatest(F.col(f"q.{whole}"), F.lit(1)), F.lit(True))


def bucket(v: Column) -> Column:
    """The lower end of v's bucket: v with all but its eight highest bits cleared."""
    return F.when(v < 256, v).otherwise(v - v % width(v))


def width(v: Column) -> Column:
    return F.when(v < 256, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2.0), F.length(F.bin(v)) - 8).cast("long"))


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, feature, v, n: the sketch of each group, from rows with lang, source and q."""
    given = {**{f: feature(f) for f in FEATURES}, **{s: F.col(f"q.{whole}") for s, (_, whole) in SIZES.items()}}
    return (
        counted.filter(~base_failed())
        .select("lang", "source", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), x.alias("x")) for f, x in given.items()])).alias("f"))
        .groupBy("lang", "source", F.col("f.feature").alias("feature"), bucket(F.col("f.x")).alias("v"))
        .agg(F.count("*").alias("n"))
    )


def leaning(sizes: DataFrame, counts: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """feature, v and p, a group's share of documents in the bucket: its own counts and the parent's share.

    sizes: key, feature, total and the parent's own columns; parent: those, v and p.
    """
    shared = [c for c in parent.columns if c not in ("v", "p")]
    grid = sizes.join(parent, shared).join(counts, [key, "feature", "v"], "left")
    p = (F.coalesce("n", F.lit(0)) + F.lit(float(WEIGHT)) * F.col("p")) / (F.col("total") + F.lit(float(WEIGHT)))
    return grid.select(*dict.fromkeys([key, *shared]), "v", p.alias("p"))


def shapes(shares: DataFrame) -> DataFrame:
    """node, feature, middle, unit, spread of distributions (node, feature, v, p).

    Shares count as whole billionths and logarithms as whole millionths: sums don't depend on their order.
    """
    part = Window.partitionBy("node", "feature")
    weighed = shares.withColumn("w", F.floor(F.col("p") * 1e9))
    ranked = weighed.withColumn("upto", F.sum("w").over(part.orderBy("v"))).withColumn("all", F.sum("w").over(part))
    at = lambda quarters: F.min(F.when(F.col("upto") * 4 >= F.col("all") * quarters, F.col("v"))).over(part)
    marked = ranked.withColumn("middle", at(2)).withColumn("quarter", at(1))
    # the median sizes beside the features they belong to: an event's share is one of the features' size
    size = F.coalesce(*[F.when(F.col("feature") == f, F.max(F.when(F.col("feature") == s, F.col("middle"))).over(Window.partitionBy("node"))) for s, (f, _) in SIZES.items()])
    scales = F.create_map(*[F.lit(x) for f, (_, _, scale, event) in FEATURES.items() if event for x in (f, scale * event)])
    one = F.coalesce(F.floor(scales[F.col("feature")] / F.greatest(size, F.lit(1))), F.lit(0))
    unit = F.greatest(width(F.col("middle")), 2 * (F.col("middle") - F.col("quarter")) + one).cast("long")
    excess = F.floor(F.log(1 + F.greatest(F.lit(0.0), (F.col("v") - F.col("middle")) / F.col("unit") - BODY)) * 1e6)
    spread = F.sum(F.col("w") * excess) / F.sum("w") / 1e6
    return marked.withColumn("unit", unit).filter(F.col("feature").isin(*FEATURES)).groupBy("node", "feature", "middle", "unit").agg(spread.alias("spread"))


def thresholds(counted: DataFrame) -> DataFrame:
    """lang, source and a limit per feature (max_*) for each group with a document that passes the base rules.

    Groups are structs here: structs of null are equal, so a null lang or source joins like others.
    """
    sketch = cut(sketches(counted).select(F.struct("lang", "source").alias("group"), F.struct("lang").alias("family"), "feature", "v", "n"))
    counts = lambda *key: sketch.groupBy(*key, "feature", "v").agg(F.sum("n").alias("n"))
    sizes = lambda *key: sketch.groupBy(*key, "feature").agg(F.sum("n").alias("total"))
    # some thousand buckets by the sketch's design, whatever the number of rows
    every = F.broadcast(counts().join(sizes(), "feature").select("feature", "v", (F.col("n") / F.col("total")).alias("p")))
    family = cut(leaning(sizes("family"), counts("family"), every, "family"))
    group = leaning(sizes("group", "family"), counts("group"), family, "group")
    node = lambda level, lang, source: F.struct(F.lit(level).alias("level"), lang.cast("string").alias("lang"), source.cast("string").alias("source")).alias("node")
    none = F.lit(None)
    levels = [every.withColumn("node", node(0, none, none)), family.withColumn("node", node(1, F.col("family.lang"), none)), group.withColumn("node", node(2, F.col("group.lang"), F.col("group.source")))]
    shape = cut(shapes(functools.reduce(DataFrame.unionByName, [x.select("node", "feature", "v", "p") for x in levels])))
    of = lambda level: shape.filter(F.col("node.level") == level)
    spread_of = lambda level, name: of(level).select(node(1, F.col("node.lang"), none).alias("family"), "feature", F.col("spread").alias(name))
    leaves = of(2).withColumn("family", node(1, F.col("node.lang"), none))
    judged = leaves.join(spread_of(1, "in_lang"), ["family", "feature"]).join(spread_of(0, "in_all").drop("family"), "feature")
    spread = F.least("spread", "in_lang", "in_all")
    limit = F.col("middle") + BODY * F.col("unit") + F.floor(F.col("unit") * (F.exp(REACH * spread) - 1))
    found = judged.groupBy("node").agg(*[F.max(F.when(F.col("feature") == f, limit)).alias(f"max_{f}") for f in FEATURES])
    return cut(found.select("node.lang", "node.source", *[f"max_{f}" for f in FEATURES]))


def judge(counted: DataFrame, limit: DataFrame | None = None) -> DataFrame:
    """counted (any columns with lang, source and q) plus base_failed and kept."""
    limit = thresholds(counted) if limit is None else limit
    renamed = limit.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    renamed = F.broadcast(renamed) if limit.count() <= BROADCAST_GROUPS else renamed
    on = F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(F.col("limit_source"))
    fine = functools.reduce(lambda a, f: a & within(f, F.col(f"max_{f}")), FEATURES, ~base_failed())
    return counted.join(renamed, on, "left").select(*[F.col(f"`{c}`") for c in counted.columns], base_failed().alias("base_failed"), fine.alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, q (counts), base_failed, kept for every row of docs.

    Null text: no words, base_failed.  Null lang or source is a value of its own.  Repeated rows
    are judged alike, each with its own row.  Extra columns are not returned; filter_quality
    returns the input's columns.
    """
    counted = cut(docs.select("doc_id", "lang", "source", text_counts("text").alias("q")))
    return judge(counted)


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with docs' own columns.

    Rows are stored once with their counts, as Parquet in the shared folder: thresholds then read
    the counts only, and the texts are not counted twice.
    """
    stored = stash(docs.select(F.struct("*").alias("row"), "lang", "source", text_counts("text").alias("q")), "counted")
    return judge(stored, thresholds(stored.select("lang", "source", "q"))).filter("kept").select("row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "base_failed", "kept"
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2
), dup AS (
  SELECT doc_id, sum(c) AS n_lines, sum(c - 1) AS n_dup_lines FROM lines GROUP BY 1
), tri AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), often AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) AS o(k) GROUP BY 1
), q AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q
), f AS (
  SELECT doc_id, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS feature,
    unnest([word_chars, n_symbols, n_dup_lines, n_repeat_words]) AS part,
    greatest(unnest([n_words, word_chars, n_lines, n_words]), 1) AS whole,
    unnest([10000, 1000000, 1000000, 1000000]) AS scale, unnest([0, 1, 1, 6]) AS event FROM b
), x AS (
  SELECT lang, source, feature, part * scale // whole AS x FROM f WHERE NOT base_failed
  UNION ALL SELECT lang, source, feature || '_size', CASE feature WHEN 'symbols' THEN word_chars WHEN 'dup_lines' THEN n_lines ELSE n_words END
  FROM b, unnest(['symbols', 'dup_lines', 'repeats']) AS o(feature) WHERE NOT base_failed
), s AS (
  SELECT lang, source, feature, CASE WHEN x < 256 THEN x ELSE x - x % (1::BIGINT << (length(bin(x)) - 8)) END AS v FROM x
), a AS (
  SELECT feature, v, count(*) / sum(count(*)) OVER (PARTITION BY feature)::DOUBLE AS p FROM s GROUP BY 1, 2
), l AS (
  SELECT g.lang, g.feature, a.v, (coalesce(n, 0) + 1e2 * p) / (total + 1e2) AS p
  FROM (SELECT lang, feature, count(*) AS total FROM s GROUP BY 1, 2) g JOIN a ON a.feature = g.feature
  LEFT JOIN (SELECT lang, feature, v, count(*) AS n FROM s GROUP BY 1, 2, 3) c
    ON c.lang IS NOT DISTINCT FROM g.lang AND c.feature = g.feature AND c.v = a.v
), g AS (
  SELECT g.lang, g.source, g.feature, l.v, (coalesce(n, 0) + 1e2 * p) / (total + 1e2) AS p
  FROM (SELECT lang, source, feature, count(*) AS total FROM s GROUP BY 1, 2, 3) g
  JOIN l ON l.lang IS NOT DISTINCT FROM g.lang AND l.feature = g.feature
  LEFT JOIN (SELECT lang, source, feature, v, count(*) AS n FROM s GROUP BY 1, 2, 3, 4) c
    ON c.lang IS NOT DISTINCT FROM g.lang AND c.source IS NOT DISTINCT FROM g.source AND c.feature = g.feature AND c.v = l.v
), every AS (
  SELECT 0 AS level, NULL AS lang, NULL AS source, feature, v, p FROM a
  UNION ALL SELECT 1, lang, NULL, feature, v, p FROM l UNION ALL SELECT 2, lang, source, feature, v, p FROM g
), r AS (
  SELECT level, lang, source, feature, v, w, sum(w) OVER (part ORDER BY v) AS upto, sum(w) OVER part AS total
  FROM (SELECT *, floor(p * 1e9)::BIGINT AS w FROM every) WINDOW part AS (PARTITION BY level, lang, source, feature)
), m AS (
  SELECT level, lang, source, feature, min(v) FILTER (upto * 4 >= total * 2) AS middle, min(v) FILTER (upto * 4 >= total) AS quarter FROM r GROUP BY ALL
), u AS (
  SELECT m.level, m.lang, m.source, m.feature, m.middle, greatest(CASE WHEN m.middle < 256 THEN 1 ELSE 1::BIGINT << (length(bin(m.middle)) - 8) END, 2 * (m.middle - m.quarter)
    + CASE m.feature WHEN 'word_length' THEN 0 WHEN 'repeats' THEN 6000000 // greatest(z.middle, 1) ELSE 1000000 // greatest(z.middle, 1) END) AS unit
  FROM m LEFT JOIN m z ON z.level = m.level AND z.lang IS NOT DISTINCT FROM m.lang AND z.source IS NOT DISTINCT FROM m.source AND z.feature = m.feature || '_size'
  WHERE m.feature NOT LIKE '%size'
), h AS (
  SELECT level, u.lang, u.source, feature, middle, unit,
    sum(w * floor(ln(1 + greatest(0, (v - middle) / unit::DOUBLE - 4)) * 1e6)::BIGINT)::BIGINT / sum(w)::DOUBLE / 1e6 AS spread
  FROM u JOIN r USING (level, feature) WHERE u.lang IS NOT DISTINCT FROM r.lang AND u.source IS NOT DISTINCT FROM r.source GROUP BY ALL
), t AS (
  SELECT g.lang, g.source, g.feature, g.middle + 4 * g.unit + floor(g.unit * (exp(4 * least(g.spread, l.spread, a.spread)) - 1))::BIGINT AS upper
  FROM h g JOIN h l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang AND l.feature = g.feature
  JOIN h a ON a.level = 0 AND a.feature = g.feature WHERE g.level = 2
), v AS (
  SELECT f.doc_id, bool_and(NOT f.base_failed AND coalesce((part - event) * scale < (upper + 1) * whole, true)) AS kept
  FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source AND f.feature = t.feature
  GROUP BY f.doc_id
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM b JOIN v USING (doc_id)
"""
