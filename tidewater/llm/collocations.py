"""Phrase collocations mined with stripes.

A stripe is a prefix of zero to four words with a counter of the words that
follow it.  A task counts the stripes of a few million words at a time and
emits, for a prefix, a map of its next words; stripes are shuffled by (lang,
prefix, shard) and merged elementwise.  The stripes of the empty prefix (the
vocabulary) and of prefixes that hold a ``HOT_SHARE`` of all words are dealt into
shards by next word, so they never meet in one task; no more prefixes of a size
than its inverse can hold such a share.  The merged stripes give everything: an entry is the count
of prefix and next word, and the largest entry of a prefix is what its
extensions can subsume.

A phrase can only be as frequent as its parts, so it is counted only where all
its words (then all its pairs, then all its triples) are frequent.  "Is frequent" is asked of a bitmap
of ``BITS`` bits that every task gets: its size does not depend on the input,
and a false yes costs a counted phrase that the exact counts drop again.  Within
a task a phrase is a chain of exact numbers, not a hash.  The input is read four
times: words, pairs, triples, and phrases of four and five words.

Scores use decimals of 38 digits and whole-number division, so nothing is
rounded.

Defined results: a null text is empty, a null lang is ``und``; rows are counted
whatever their id, repeated rows each time; ties are ordered by score, count and
the phrase's bytes; a very long text is cut into pieces in its task; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import pick, register, stored, table

LONGEST = 5
LEAST = 100
SUBSUMED_PERCENT = 100
TOP = 2000
#: Size of the frequency bitmap (8 MB), characters a task counts before it emits, stripes it emits at
#: once, shards of the empty prefix's stripe and of a hot one, and the share of all words that makes it hot.
BITS = 1 << 26
FLUSH_CHARS = 1 << 25
STRIPES_A_BATCH = 20_000
SHARDS_OF_WORDS, SHARDS_OF_HOT = 4096, 64
HOT_SHARE = 1 / 2000

_GAP = b"\n"
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", _GAP * 9 + b" ")
_STRIPE = "lang string, prefix string, size int, shard int, stripe map<string,bigint>"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """Words of all texts as numbers, 0 between pieces, and the words by number."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").lower().translate(_BREAKS).replace(_GAP, b" \n ")
    tokens = raw.split(b" ")
    number: dict = defaultdict(count().__next__)
    number[_GAP], number[b""]
    ids = np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    ids = ids[ids != 1]
    return np.r_[0, ids, np.zeros(LONGEST, dtype=np.int64)], list(number)


def word_hashes(vocabulary: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in vocabulary), dtype=np.uint64, count=len(vocabulary))


def chained(hashes: list[np.ndarray]) -> np.ndarray:
    """The hash of a phrase from its words' hashes."""
    h = hashes[0]
    for nxt in hashes[1:]:
        h = (h ^ (h >> np.uint64(29))) * _MULT + nxt
    return h ^ (h >> np.uint64(32))


class Frequent:
    """A fixed-size bitmap of the phrases known to be frequent."""

    def __init__(self, bitmap: np.ndarray | None = None):
        self.bitmap = np.zeros(BITS // 8, dtype=np.uint8) if bitmap is None else bitmap

    def may_have(self, h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(BITS)
        return (self.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrases_in(ids: np.ndarray, hashes: np.ndarray, size: int,
               frequent: dict[int, Frequent]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct phrases of ``size`` words whose parts may be frequent: their word numbers place by
    place, the numbers of their prefixes, and their counts."""
    n = len(ids) - size + 1
    good = ids != 0
    if 1 in frequent:
        good &= frequent[1].may_have(chained([hashes]))[ids]
    keep = good[:n].copy()
    for j in range(1, size):
        keep &= good[j:j + n]
    at = np.flatnonzero(keep)
    h = hashes[ids]
    for part in (k for k in sorted(frequent) if 1 < k < size):
        for j in range(size - part + 1):
            at = at[frequent[part].may_have(chained([h[at + j + i] for i in range(part)]))]
    # a chain of exact numbers: (number of the first j words, next word)
    prefix = np.zeros(len(at), dtype=np.int64)
    for j in range(size):
        if j:
            _, prefix = np.unique(chain, return_inverse=True)
        chain = (prefix << 32) | ids[at + j]
    _, first, counts = np.unique(chain, return_index=True, return_counts=True)
    return [ids[at[first] + j] for j in range(size)], prefix[first], counts


def shards_of(places: list[np.ndarray], hashes: np.ndarray, hot: dict[int, np.ndarray]) -> np.ndarray | np.uint64:
    """Into how many shards each phrase's stripe is dealt, by its prefix (by its first words, where
    only they have been counted)."""
    known = min(len(places) - 1, max(hot, default=0))
    if len(places) == 1:
        return np.uint64(SHARDS_OF_WORDS)
    prefix = chained([hashes[p] for p in places[:known]])
    return np.where(np.isin(prefix, hot[known]), SHARDS_OF_HOT, 1).astype(np.uint64)


def stripes_of(texts: list[str], lang: str, sizes: range, frequent: dict[int, Frequent],
               hot: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The stripes of all phrases of the given sizes in texts of one language."""
    ids, vocabulary = word_numbers(texts)
    hashes = word_hashes(vocabulary, lang)
    text = pa.array(vocabulary, pa.binary()).cast(pa.string())
    for size in sizes:
        places, prefix, counts = phrases_in(ids, hashes, size, frequent)
        shard = (hashes[places[-1]] % shards_of(places, hashes, hot)).astype(np.int64)
        key = prefix * SHARDS_OF_WORDS + shard
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        for lo in range(0, len(starts), STRIPES_A_BATCH):
            some = starts[lo:lo + STRIPES_A_BATCH]
            end = starts[lo + STRIPES_A_BATCH] if lo + STRIPES_A_BATCH < len(starts) else len(order)
            entries, heads = order[some[0]:end], order[some]
            stripe = pa.MapArray.from_arrays(pa.array(np.r_[some, end] - some[0], pa.int32()),
                                             text.take(pa.array(places[-1][entries])), pa.array(counts[entries], pa.int64()))
            before = [text.take(pa.array(p[heads])) for p in places[:-1]]
            prefixes = pc.binary_join_element_wise(*before, " ") if before else pa.repeat("", len(some))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(some)), prefixes, pa.repeat(pa.scalar(size, pa.int32()), len(some)),
                 pa.array(shard[heads], pa.int32()), stripe], names=["lang", "prefix", "size", "shard", "stripe"])


def count_stripes(docs: DataFrame, sizes: range, bitmaps: dict, hot: dict[int, np.ndarray]) -> DataFrame:
    """(lang, prefix, size, next, f): the counts of phrases of the given sizes, from stripes merged
    elementwise; only of phrases whose shorter parts may be frequent, by the broadcast bitmap of their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(list)
        frequent = {k: Frequent(b.value) for k, b in bitmaps.items()}
        chars = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                yield from stripes_of(texts, lang, sizes, frequent, hot)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held[lang].append(text)
                chars += len(text)
                if chars >= FLUSH_CHARS:
                    yield from flush()
                    chars = 0
        yield from flush()

    stripes = docs.mapInArrow(run, _STRIPE).repartition("lang", "prefix", "shard")
    # the groups below lie within one (lang, prefix, shard): merged where the stripes are
    merged = (stripes.select("lang", "prefix", "size", "shard", F.explode("stripe").alias("next", "n"))
              .groupBy("lang", "prefix", "shard", "next", "size").agg(F.sum("n").alias("f")))
    return merged.select("lang", "prefix", "size", "next", "f")


def bitmap_of(frequent: DataFrame) -> np.ndarray:
    """The bitmap of the frequent phrases (lang, phrase): at most ``BITS`` / 64 rows reach the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slots = []
            for lang, group in batch.groupby("lang")["phrase"]:
                parts = [p.encode().split(b" ") for p in group]
                hashes = word_hashes([w for p in parts for w in p], lang).reshape(len(parts), -1)
                slots.append(chained(list(hashes.T)) % np.uint64(BITS))
            at = np.unique(np.concatenate(slots)) if slots else np.zeros(0, dtype=np.uint64)
            yield pd.DataFrame({"cell": (at >> np.uint64(6)).astype(np.int64),
                                "bits": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    cells = (frequent.select("lang", "phrase").mapInPandas(run, "cell long, bits long")
             .groupBy("cell").agg(F.bit_or("bits").alias("bits")).toPandas())
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint8)


def hot_prefixes(frequent: DataFrame, words: int) -> np.ndarray:
    """Hashes of the phrases that occur at a ``HOT_SHARE`` of all words: at most 1 / ``HOT_SHARE`` rows."""
    rows = frequent.where(F.col("f") >= words * HOT_SHARE).select("lang", "phrase").collect()
    return np.array([chained(list(word_hashes(r["phrase"].encode().split(b" "), r["lang"])[:, None]))[0] for r in rows], dtype=np.uint64)


def _frequent(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, head, f): ``head`` is the stripe's prefix."""
    return stripes.where(F.col("f") >= least).select(
        "lang", F.when(F.col("size") == 1, F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next")).alias("phrase"),
        "size", F.col("prefix").alias("head"), "f")


def mine(docs: DataFrame, least: int = LEAST, subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one subsumes."""
    spark = docs.sparkSession
    src = pick(docs, text="text", lang="lang").select(F.coalesce("lang", F.lit("und")).alias("lang"),
                                                      F.coalesce("text", F.lit("")).alias("text"))
    broadcast = spark.sparkContext.broadcast
    vocabulary = stored(count_stripes(src, range(1, 2), {}, {}), "stripes-words")
    total = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    found = {1: _frequent(vocabulary, least)}
    words = vocabulary.agg(F.sum("f")).first()[0] or 0
    bitmaps, hot = {}, {}
    for sizes in (range(2, 3), range(3, 4), range(4, LONGEST + 1)):
        last = sizes[0] - 1
        bitmaps[last] = broadcast(bitmap_of(found[last]))
        hot[last] = hot_prefixes(found[last], words)
        found[sizes[0]] = stored(_frequent(count_stripes(src, sizes, bitmaps, dict(hot)), least), f"stripes-{sizes[0]}")
    singles = found.pop(1)
    candidates = functools.reduce(DataFrame.unionByName, found.values())
    parts = singles.unionByName(candidates).select("lang", "phrase", "f")
    scored = worst_cut(candidates, parts, total)
    # the largest extension of a phrase: to the right within its own stripe, to the left by the tail
    split = F.split("phrase", " ")
    tail = F.array_join(F.slice(split, 2, LONGEST), " ")
    extensions = (candidates.where("size > 2").select("lang", F.explode(F.array("head", tail)).alias("phrase"), "f")
                  .groupBy("lang", "phrase").agg(F.max("f").alias("widest")))
    return (scored.join(extensions, ["lang", "phrase"], "left")
            .where(F.col("widest").isNull() | (100 * F.col("widest") < subsumed_percent * F.col("a")))
            .select("lang", "phrase", "a", "l", "r", "n", "score"))


def worst_cut(candidates: DataFrame, parts: DataFrame, total: DataFrame) -> DataFrame:
    """Each candidate with the counts and score of its lowest-scoring cut, of equal ones the first."""
    words = F.split("phrase", " ")
    joined = lambda a: F.array_join(a, " ")
    cuts = (candidates.select("lang", "phrase", F.col("f").alias("a"), "size", words.alias("w"),
                              F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", joined(F.slice("w", F.lit(1), F.col("k"))).alias("first"),
                    joined(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest")))
    side = lambda c, f: parts.select("lang", F.col("phrase").alias(c), F.col("f").alias(f))
    cuts = cuts.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"]).join(total, "lang")
    best = F.min(F.struct(whole_score("a", "n", "l", "r").alias("score"), "k", "l", "r", "n"))
    return cuts.groupBy("lang", "phrase", "a").agg(best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.n", "b.score")


def whole_score(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    return F.expr(f"cast(1000 * cast({a} as decimal(17,0)) * cast({n} as decimal(17,0)) as decimal(38,0)) "
                  f"div cast(cast({l} as decimal(18,0)) * cast({r} as decimal(18,0)) as decimal(38,0))")


def top_phrases(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """Each language's first ``top`` phrases by score, count and phrase, with their rank from 1."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = mine(docs, least).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE_TOP = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
s AS (SELECT lang, ws, i, unnest(range(1, 6)) AS size FROM g),
f AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM s
      WHERE i + size - 1 <= len(ws) GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE size > 1 AND f >= {LEAST}),
k AS (SELECT lang, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS ws, size FROM c),
x AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, n.n,
             (CAST(1000 AS HUGEINT) * k.a * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(ws[1:k.k], ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(ws[k.k + 1:], ' ') JOIN n ON n.lang = k.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT * FROM y WHERE NOT EXISTS (
        SELECT 1 FROM c WHERE c.lang = y.lang AND c.size > len(string_split(y.phrase, ' ')) AND 100 * c.f >= {SUBSUMED_PERCENT} * y.a
        AND contains(' ' || c.phrase || ' ', ' ' || y.phrase || ' '))),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= {TOP}"""


@register("op12_collocations", ORACLE_TOP)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_phrases(table(spark, sf_dir, "documents"))
