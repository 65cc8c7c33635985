"""Filter interaction audit: what each of five filters removes, in every order.

A document is reduced to the mask of the filters it fails.  In a permutation of
the filters a mask is removed at the first of its letters, so the permutations
in which step ``s`` removes it with a given choice of the ``s - 1`` letters
before it share a prefix and stand together in lexicographic order: an interval
of Lehmer ranks.  Each mask's counts are added at the start of each of its
intervals and subtracted after its end, and one running sum over the 120 ranks
gives the removals of every order and step; the other counts follow from it.

Counting takes one row per document: the text stays in the scan and is replaced
by four bits, its hash and its id.  "Identical to the text of a smaller id" is
found without bringing copies together: least ids per hash are pre-aggregated,
and rows are matched with them by hash *and* id, so a text held by a third of
the rows has as many join keys as rows.

Defined results: a null text is empty; rows without id never count as later
copies and make no row one; repeated rows of one id and text each count, none
as a copy of the other; a label row is good or toxic if any row of its id says
so; a null lang and the empty lang are one part; very long texts are split
whole, in their task; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import let, pick, register, stored, table, words

FILTERS = "ABCDE"
FEW_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
#: counts carried through the ranks
COUNTS = ("n", "good", "toxic")


def own_mask(text: Column) -> Column:
    """Bits of the filters that look at the text alone (A = 1, B = 2, C = 4, D = 8)."""
    bit = lambda cond, place: F.when(cond, 1 << place).otherwise(0)
    by_words = let(words(text), lambda w: let(F.size(w), lambda n: (
        bit(n < FEW_WORDS, 0) + bit(100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * n, 1))))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return (by_words + bit(100 * capitals > CAPITAL_PERCENT * F.length(text), 2) + bit(text.rlike(SYMBOLS), 3)).cast("int")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = (pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id is not null")
             .groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))
    text = F.coalesce(F.col("text"), F.lit(""))
    src = pick(docs, doc_id="doc_id", text="text", lang="lang")
    rows = (src.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("hash"),
                       own_mask(text).alias("own"))
            .groupBy("hash", "doc_id", "part", "own").agg(F.count("*").alias("n")))
    # one row per hash: the id that is no copy
    least = src.where("doc_id is not null").groupBy(F.unhex(F.sha2(text, 256)).alias("hash")).agg(
        F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(least, ["hash", "doc_id"], "left").join(known, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("own") + F.when(copy, 1 << 4).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def rank_of(prefix: tuple[int, ...], size: int) -> int:
    """Lexicographic rank of the first permutation of range(size) that starts with ``prefix``:
    the Lehmer digit of a place counts the smaller letters not used before it."""
    return sum((letter - sum(p < letter for p in prefix[:at])) * math.factorial(size - 1 - at)
               for at, letter in enumerate(prefix))


def intervals(size: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, low, high): the ranks [low, high) in which ``step`` removes ``mask``
    after one particular choice of passed filters."""
    out = []
    for mask in range(1, 1 << size):
        passed = [f for f in range(size) if not mask >> f & 1]
        failed = [f for f in range(size) if mask >> f & 1]
        for before in range(len(passed) + 1):
            for head in itertools.permutations(passed, before):
                for f in failed:
                    low = rank_of((*head, f), size)
                    out.append((mask, before + 1, low, low + math.factorial(size - 1 - before)))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step; see the module's docstring."""
    spark, size = docs.sparkSession, len(FILTERS)
    of_mask = stored(masks(docs, labels), "audit-masks")      # at most 32 rows a part; read twice below
    spans = F.broadcast(spark.createDataFrame(intervals(size), "mask int, step int, low int, high int"))
    ends = F.explode(F.array(F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign"))))
    marks = (of_mask.join(spans, "mask").select("part", "step", *COUNTS, ends.alias("e"))
             .groupBy("part", "step", "e.rank").agg(*[F.sum(F.col("e.sign") * F.col(c)).alias(c) for c in COUNTS]))
    orders = spark.createDataFrame(
        [(rank, "".join(FILTERS[f] for f in order)) for rank, order in enumerate(itertools.permutations(range(size)))],
        "rank int, filter_order string")
    steps = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step")).select(
        "*", F.expr("substring(filter_order, step, 1)").alias("letter"))
    fails = lambda f: F.col("mask").bitwiseAND(1 << f) != 0
    letters = F.explode(F.array(*[F.struct(F.lit(c).alias("letter"), fails(f).alias("fails"),
                                           (F.col("mask") == 1 << f).alias("alone")) for f, c in enumerate(FILTERS)]))
    # per part and filter: all documents, those failing it, those failing nothing else
    totals = (of_mask.select("part", "n", letters.alias("x")).groupBy("part", "x.letter").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("x.fails"), F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("x.alone"), F.col("n")).otherwise(0)).alias("unique_fails")))
    grid = totals.join(F.broadcast(steps), "letter").join(marks, ["part", "step", "rank"], "left")
    by_rank = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = grid.select("part", "filter_order", "step", "letter", "total", "failing", "unique_fails",
                          *[F.sum(F.coalesce(c, F.lit(0))).over(by_rank).alias(f"gone_{c}") for c in COUNTS])
    by_step = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    long = lambda c, name: c.cast("long").alias(name)
    return removed.select(
        "part", "filter_order", "step",
        long(F.col("total") - F.sum("gone_n").over(by_step), "kept"), long(F.col("gone_n"), "removed"),
        long(F.col("failing") - F.col("gone_n"), "redundant"), long(F.col("unique_fails"), "unique_fails"),
        long(F.col("gone_good"), "good_lost"), long(F.col("gone_toxic"), "toxic_lost"),
        long(F.sum("gone_n").over(Window.partitionBy("part", "letter")), "shapley"))


#: The same counts without ranks: every order's first failing letter, mask by mask.
ORACLE_AUDIT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM d),
x AS (SELECT w.doc_id, part,
             (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END)
             || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
             || (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) THEN 'C' ELSE '' END)
             || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
             || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS mask
      FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM x LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
f(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM f a, f b, f c, f d, f e
      WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
p AS (SELECT part, filter_order, step, n, good, toxic, mask,
             filter_order[step] AS letter, contains(mask, filter_order[step]) AS fails,
             len(list_filter(string_split(substr(filter_order, 1, CAST(step AS INTEGER) - 1), ''),
                             lambda y: y <> '' AND contains(mask, y))) > 0 AS before
      FROM m, s),
r AS (SELECT part, filter_order, step, letter,
             sum(CASE WHEN NOT fails AND NOT before THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = letter THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
      FROM p GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""


@register("op13_filter_audit", ORACLE_AUDIT)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
