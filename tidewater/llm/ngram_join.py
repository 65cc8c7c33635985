"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct three-word shingles; two link when their
Jaccard similarity reaches ``PERCENT``.  All sets are sorted by one order, the
shingles least frequent in the corpus first (a fixed-size table of hashed
counts over all rows tells which ones stand out; the rest go by hash).  Two
linked sets share at least ``l`` of their first ``|s| - ceil(PERCENT |s| / 100) + l``
shingles, for every ``l``.  Each document picks its own ``l``: a longer prefix
reads more postings but asks for more shared shingles, and the estimated cost of
both decides.  A pair is verified only if it shares as many prefix shingles as
the smaller ``l`` of the two asks for.

Equal sets are one class from the start.  Shingles that only one prefix holds
fall away.  A posting list of up to ``SMALL`` classes names its pairs, which are
counted.  The histograms of two sets over ``CELLS`` cells of the hash bound how many
shingles they can share; pairs that cannot reach ``PERCENT`` by that bound need no
texts.  A longer list names no pairs: a frequent shingle says little about its classes.  They are cut into
parts, a few more than the shingles in which two linked sets can differ, so that linked sets have
whole parts in common (``part_names``); what shares a part is nearly always alike.
The other pairs and the common parts tie their classes into families; a family is dealt into slots, and each slot is searched inside one
task (histograms first, then, for the classes that may link there, shared prefix shingles and the whole sets), which emits only edges
that span what it found linked: never more rows than it read.  Families of several
slots are dealt a second time another way, and then every class outside the
family's largest component meets every slot, so no link is lost whatever the size
of a family.

Defined results: a document without words or text has the empty set and links
with nothing; one of fewer than three words has one shingle; rows of one id are
taken each by its own text; a row without id takes part, and its component is
named by the least id in it (null if there is none); very long texts are
shingled whole, in their task; ties in the order go by hash; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import Scratch, WordHasher, mix, pick, register, stored, table
from tidewater.llm.dart_minhash import components, maybe_in, members_in

SHINGLE = 3
PERCENT = 90
#: Largest number of shared prefix shingles a document may ask for, and the cost of verifying a
#: candidate against that of reading a posting.
MOST_SHARED, VERIFY_COST = 6, 8.0
#: Counters of the frequency table (one megabyte), classes of a list that names its pairs, and
#: classes and shingles of a slot.
COUNTER_BITS = 18
SMALL = 4
SLOT, SLOT_SHINGLES = 2048, 1 << 22
SALTS = 16
#: Largest sizes of the groups of sets that are cut into equally many parts, each at most 27/20 of the group's least.
HIGHS = []
while not HIGHS or HIGHS[-1] < 1 << 40:
    HIGHS.append((HIGHS[-1] + 1 if HIGHS else 1) * 27 // 20)
#: Cells of a set's histogram, a byte each; a cell of ``FULL`` holds that many shingles or more.
CELLS, FULL = 256, 255

_MULT = np.uint64(0x9E3779B97F4A7C15)
_PREFIX = "node binary, n int, asks int, tokens array<long>, cells binary, parts array<long>"


class Shingles:
    """The distinct shingles of a text, as sorted 64-bit hashes."""

    def __init__(self, k: int = SHINGLE):
        self.k, self.hashes = k, WordHasher()

    def __call__(self, text: str | None) -> np.ndarray:
        h = self.hashes((text or "").encode("utf-8", "surrogatepass").lower())
        if not len(h):
            return np.zeros(0, dtype=np.uint64)
        k = min(self.k, len(h))
        rolling = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for j in range(k):
            rolling = rolling * _MULT + h[j:j + len(rolling)]
        return np.unique(mix(rolling + np.uint64(k)))


def counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def excess_counts(docs: DataFrame) -> np.ndarray:
    """How far each counter of hashed shingles stands above what chance gives it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, counts = Shingles(), np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(counts, counter(shingles(text)), 1)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"slot": at, "n": counts[at]})

    # at most one row a counter reaches the driver
    rows = docs.select("text").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNTER_BITS, dtype=np.float64)
    counts[rows["slot"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    usual = np.median(counts)
    return np.maximum(counts - usual - 5 * np.sqrt(usual + 1), 0).astype(np.float32)


def ordered_set(tokens: np.ndarray, excess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set in the corpus order, and the excess counts in that order."""
    above = excess[counter(tokens)]
    if above.any():
        order = np.lexsort((tokens, above))
        return tokens[order], above[order]
    return tokens, above


def shared_to_ask(above: np.ndarray, percent: int = PERCENT) -> int:
    """The ``l`` of least estimated cost.  With ``d`` postings in the prefix there are at most ``d / l``
    candidates that share ``l`` of them, each to be verified."""
    n = len(above)
    least = -(-percent * n // 100)
    choices = np.arange(1, min(MOST_SHARED, least) + 1)
    postings = np.cumsum(above, dtype=np.float64)[n - least + choices - 1]
    return int(choices[np.argmin(postings * (1 + VERIFY_COST / choices))])


def part_names(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Names of parts of a set (sorted hashes); two different sets that link share at least one.

    The hashes are cut into ``differ + 1 + spare`` ranges.  Linked sets have at most ``differ`` shingles in one set
    only, so the same ones in at least ``1 + spare`` ranges.  Each set leaves out its ``spare`` weakest parts, by
    an order that rests on a part's content alone: the strongest of the common parts is weakest in neither.  A set takes part in the
    group of every size that a smaller partner, or itself, may have."""
    n, out = len(tokens), [np.zeros(0, dtype=np.uint64)]
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(tokens, dtype=np.uint64)])
    for g in range(bisect_left(HIGHS, -(-percent * n // 100)), bisect_left(HIGHS, n) + 1) if n else ():
        differ = (HIGHS[g] + 100 * HIGHS[g] // percent) * (100 - percent) // (100 + percent)
        if differ:                                                  # else only equal sets link
            spare = 2 + differ // 8
            many = differ + 1 + spare
            at = np.searchsorted(tokens >> np.uint64(32), -(-(np.arange(many + 1, dtype=np.int64) << 32) // many).astype(np.uint64))
            name = mix(sums[at[1:]] - sums[at[:-1]] + mix((np.arange(many) + ((g + 1) << 40)).astype(np.uint64)))
            out.append(name[np.lexsort((name, np.diff(at)))[spare:]])
    return np.concatenate(out)


def cells(tokens: np.ndarray) -> bytes:
    """How many shingles of a set lie in each cell."""
    counts = np.bincount((tokens & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return np.minimum(counts, FULL).astype(np.uint8).tobytes()


def most_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most shingles that two sets can share, for rows of cells; cells that are full in both set no bound."""
    least = np.minimum(a, b)
    return np.where((least == FULL).any(axis=1), np.iinfo(np.int64).max // 1000, least.sum(axis=1, dtype=np.int64))


class Sets:
    """Texts to (set in the corpus order, prefix length, ``l``)."""

    def __init__(self, excess: np.ndarray, percent: int):
        self.shingles, self.excess, self.percent = Shingles(), excess, percent

    def __call__(self, text: str | None) -> tuple[np.ndarray, int, int]:
        tokens, above = ordered_set(self.shingles(text), self.excess)
        if not len(tokens):
            return tokens, 0, 0
        asks = shared_to_ask(above, self.percent)
        return tokens, len(tokens) + self.percent * len(tokens) // -100 + asks, asks


def prefix_column(text: Column, excess, percent: int = PERCENT) -> Column:
    """struct of ``_PREFIX``: the set's name (a digest of it, null if empty), size, ``l``, prefix, histogram and parts."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sets = Sets(excess.value, percent)
        for batch in batches:
            out = []
            for t in batch:
                tokens, p, asks = sets(t)
                whole = np.sort(tokens)
                name, grid = (hashlib.md5(whole.tobytes()).digest(), cells(whole)) if len(whole) else (None, None)
                out.append((name, len(tokens), asks, tokens[:p].view(np.int64), grid, part_names(whole, percent).view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "n", "asks", "tokens", "cells", "parts"])

    return F.pandas_udf(run, _PREFIX)(text)


def may_link(n_a: Column, n_b: Column, cells_a: Column, cells_b: Column, percent: int) -> Column:
    """Whether two sets of these sizes and histograms can reach ``percent``; true for all that do."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for n, a, b in batches:
            grid = lambda x: np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), CELLS)
            shared = most_shared(grid(a), grid(b))
            yield pd.Series(100 * shared >= percent * (n.to_numpy(dtype=np.int64) - shared))

    return F.pandas_udf(run, "boolean")(n_a.cast("long") + n_b, cells_a, cells_b)


# -- inside one block ---------------------------------------------------------

def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Shared elements of every two sets, by products of their incidence matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = counts > 1
    owner, column = owner[twice[column]], (np.cumsum(twice) - 1)[column[twice[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for lo in range(0, int(twice.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[owner[a:b], column[a:b] - lo] = 1
        total += has @ has.T
    return total


def linked_in(sets: list[np.ndarray], p: np.ndarray, asks: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Boolean matrix of the links among the sets of a block."""
    n = np.array([len(s) for s in sets])
    ask = overlaps([s[:k] for s, k in zip(sets, p)]) >= np.minimum(asks[:, None], asks[None, :])
    ask &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    np.fill_diagonal(ask, False)
    rows = np.flatnonzero(ask.any(axis=1))
    out = np.zeros(ask.shape, dtype=bool)
    if len(rows):
        shared = overlaps([sets[i] for i in rows])
        within = np.ix_(rows, rows)
        both = n[rows][:, None] + n[rows][None, :] - shared.astype(np.float64)
        out[within] = ask[within] & (100 * shared.astype(np.float64) >= percent * both)
    return out


def spanning(links: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j) that join the block's components: one for each that is not its group's first."""
    label = comp.copy()
    same = links | (comp[:, None] == comp[None, :])
    while True:
        least = np.where(same, label[None, :], len(label)).min(axis=1)
        if (least == label).all():
            break
        label = least
    _, first = np.unique(comp, return_index=True)      # one member of each component
    head = {c: i for i, c in zip(first, comp[first])}
    to = np.array([head[c] for c in label[first]], dtype=np.int64)
    moved = to != first
    return first[moved], to[moved]


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks of rows sorted by (family, i, j); a block may go on in the next batch."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        at = pd.factorize(pd.MultiIndex.from_frame(rows[["family", "i", "j"]]))[0]
        starts = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
        rest = rows.iloc[starts[-1]:]
        for lo, hi in zip(starts[:-1], starts[1:]):
            yield rows.iloc[lo:hi]
    if rest is not None:
        yield rest


def promising(n: np.ndarray, grid: np.ndarray, comp: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which sets of a block (ascending sizes, rows of cells) may link with one of another component."""
    out = np.zeros(len(n), dtype=bool)
    for k, end in enumerate(np.searchsorted(n, 100 * n // percent, side="right")):
        if end > k + 1:
            shared = most_shared(grid[k + 1:end], grid[k])
            may = (100 * shared >= percent * (n[k] + n[k + 1:end] - shared)) & (comp[k + 1:end] != comp[k])
            out[k] |= may.any()
            out[k + 1:end] |= may
    return out


def block_candidates(percent: int = PERCENT):
    """The rows of every block that may link inside it: never more than there are."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in blocks(batches):
            rows = rows.drop_duplicates("node").sort_values("n", kind="stable")
            grid = np.frombuffer(b"".join(rows["cells"]), dtype=np.uint8).reshape(len(rows), CELLS)
            may = promising(rows["n"].to_numpy(dtype=np.int64), grid, pd.factorize(rows["comp"])[0], percent)
            yield rows.loc[may, ["family", "i", "j", "node", "comp"]]
    return run


def block_edges(excess, percent: int = PERCENT):
    """Edges of every block in rows sorted by (family, i, j); a block may go on in the next batch."""
    def edges(rows: pd.DataFrame, sets: Sets) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        comp = pd.factorize(rows["comp"])[0].astype(np.int64)
        tokens, p, asks = zip(*map(sets, rows["text"]))
        a, b = spanning(linked_in(list(tokens), np.array(p), np.array(asks), percent), comp)
        node = rows["node"].to_numpy()
        return pd.DataFrame({"a": node[a], "b": node[b]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(excess.value, percent)
        for rows in blocks(batches):
            yield edges(rows, sets)
    return run


# -- the join -----------------------------------------------------------------

def _slots(rows: DataFrame, slot: int) -> DataFrame:
    """(family, slots): how many slots each family takes, by its classes and their shingles."""
    return rows.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / slot), F.ceil(F.sum("n") / SLOT_SHINGLES)).cast("int").alias("slots"))


def _dealt(salt: int, slots: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(slots)).cast("int")


def _edges(rows: DataFrame, sets_of, texts_of, excess, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b) from rows (family, i, j, node, comp): histograms go to the blocks first, and the texts of
    those classes alone that may link there."""
    key = ["family", "i", "j"]
    rows = scratch.stored(rows.select(*key, "node", "comp"), "blocks")
    grouped = lambda df: df.repartition(*key).sortWithinPartitions(*key, "node")
    may = (grouped(rows.join(sets_of(rows.select("node")), "node").select(*key, "node", "comp", "n", "cells"))
           .mapInPandas(block_candidates(percent), rows.schema))
    may = scratch.stored(may, "candidates")
    return (grouped(texts_of(may).select(*key, "node", "comp", "text"))
            .mapInPandas(block_edges(excess, percent), "a binary, b binary"))


def within_slots(families: DataFrame, sizes: DataFrame, sets_of, texts_of, excess, percent: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that span the links within each slot, for two ways of dealing families into slots."""
    rows = families.join(sizes, "family").withColumn("comp", F.col("node")).withColumn("j", F.lit(0))
    ways = F.when(F.col("slots") > 1, F.array(_dealt(0, "slots"), F.col("slots") + _dealt(1, "slots"))).otherwise(F.array(F.lit(0)))
    return _edges(rows.withColumn("i", F.explode(ways)), sets_of, texts_of, excess, percent, scratch)


def across_slots(families: DataFrame, wide: DataFrame, links: DataFrame, sets_of, texts_of, excess, percent: int, slot: int,
                 scratch: Scratch) -> DataFrame:
    """Edges (a, b) that span what is left in families of several slots: classes outside the family's
    largest component, against every slot."""
    split = families.join(wide, "family")
    own = links.join(split.select(F.col("node").alias("a")), "a", "left_semi").join(
        split.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b")
    groups = scratch.stored(components(split.select("node"), own, scratch=scratch), "family-groups")
    split = split.join(groups, "node")
    home = (split.groupBy("family", "comp").agg(F.count("*").alias("size")).groupBy("family")
            .agg(F.max(F.struct("size", "comp")).alias("home")).select("family", F.col("home.comp").alias("home")))
    split = split.join(home, "family").withColumn("outside", F.col("comp") != F.col("home"))
    asking = split.where("outside").groupBy("family").agg(F.ceil(F.count("*") / slot).cast("int").alias("asking"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    answers = F.transform(upto("asking"), lambda i: block(i, _dealt(0, "slots")))
    asks = F.transform(upto("slots"), lambda j: block(_dealt(2, "asking"), j))
    blocks = F.explode(F.when(F.col("outside"), F.array_union(answers, asks)).otherwise(answers)).alias("x")
    split = split.join(asking, "family").select("family", "node", "comp", blocks).select("*", "x.i", "x.j")
    return _edges(split, sets_of, texts_of, excess, percent, scratch)


def small_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of lists of up to ``SMALL`` classes that share as many prefix shingles as they ask for.  Pairs that
    share one of a longer list are left to ``part_ties``."""
    rows = lists.where(F.col("c") <= SMALL).select("token", F.struct("node", "n", "asks").alias("x"))
    group = rows.groupBy("token").agg(F.sort_array(F.collect_list("x")).alias("xs"))     # at most SMALL
    pair = F.transform("xs", lambda x, i: F.transform(F.slice("xs", i + 2, SMALL), lambda y: F.struct(
        x["node"].alias("a"), y["node"].alias("b"), F.least(x["n"], y["n"]).alias("low"), F.greatest(x["n"], y["n"]).alias("high"),
        F.least(x["asks"], y["asks"]).alias("asks"))))
    return (group.select(F.explode(F.flatten(pair)).alias("x")).select("x.*")
            .where((F.col("a") != F.col("b")) & (100 * F.col("low") >= percent * F.col("high")))
            .groupBy("a", "b", "asks").agg(F.count("*").alias("shared"))
            .where("shared >= asks").select("a", "b"))


def part_ties(firsts: DataFrame, long: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that tie all classes with a part in common, among those (rows node, parts) named in ``long`` and
    few others, which a bounded bit map lets through."""
    held = firsts.where(maybe_in(long.select("node"))).select("node", "parts")
    common = scratch.stored(held.select(F.explode("parts").alias("part")).groupBy("part").agg(F.count("*").alias("c"))
                            .where("c > 1").select("part"), "common-parts")
    held = scratch.stored(held.select("node", F.explode(members_in(F.col("parts"), common)).alias("part")), "held-parts")
    centre = held.groupBy("part").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b <> last").select("part", "b")
    return held.join(centre, "part").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by the sizes and histograms of their sets (rows node, n, cells)."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("cells").alias(f"cells_{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(may_link(F.col("n_a"), F.col("n_b"), F.col("cells_a"), F.col("cells_b"), percent)).select("a", "b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       slot: int = SLOT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; see the module's docstring."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    keep = scratch.stored
    ends = lambda df: df.select(F.col("a").alias("node")).unionByName(df.select(F.col("b").alias("node"))).distinct()
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("hash", F.xxhash64("text")).withColumn(
        "key", F.coalesce("doc_id", "hash"))
    excess = spark.sparkContext.broadcast(excess_counts(src))
    rows = keep(src.withColumn("s", prefix_column(F.col("text"), excess, percent)).select("doc_id", "key", "hash", "s.*"), "prefixes")
    classes = keep(rows.where("n > 0").groupBy("node", "n").agg(
        F.min(F.struct("key", "hash")).alias("head"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies")), "classes")
    # the rows of one text of each class; rows that a bounded bit map shows to have no copies stay where they are
    twins = keep(classes.where("copies > 1").select("node", "head"), "twins")
    held = rows.where("n > 0").withColumn("maybe", maybe_in(twins.select("node")))
    copied = held.where("maybe").join(twins, "node", "left").where(F.col("head").isNull() | (F.col("head") == F.struct("key", "hash")))
    firsts = held.where("not maybe").unionByName(copied.select(held.columns))
    postings = firsts.select("node", "n", "asks", F.explode("tokens").alias("token"))
    shared = keep(postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    # of the postings only those move that a bounded bit map does not show to be alone
    postings = firsts.select("node", "n", "asks", F.explode(members_in(F.col("tokens"), shared.select("token"))).alias("token"))
    lists = keep(postings.join(shared, "token").distinct(), "lists")
    named = keep(small_pairs(lists, percent), "named-pairs")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, n, cells)"""
        return firsts.where(maybe_in(nodes.distinct())).select("node", "n", "cells").dropDuplicates(["node"])

    pairs = keep(bounded(named, sets_of(ends(named)), percent), "pairs")
    long = keep(lists.where(F.col("c") > SMALL).select("node").distinct(), "in-long-lists")
    ties = keep(pairs.unionByName(part_ties(firsts, long, scratch)), "ties")

    # (family, node, n) of classes tied by pairs that may link or by common parts, and the slots of each family
    families = components(ends(ties), ties, scratch=scratch).withColumnRenamed("comp", "family")
    families = keep(families.join(classes.select("node", "n"), "node"), "families")
    sizes = keep(_slots(families, slot), "family-slots")

    def texts_of(nodes: DataFrame) -> DataFrame:
        """``nodes`` with the text of each class; sets are made again where they are compared.  Only rows that a
        bounded bit map of their hashes names are moved, once, and equal rows of an id fold where they are."""
        wanted = keep(nodes.join(classes.select("node", "head.*"), "node"), "wanted")
        heads = (src.where(maybe_in(wanted.select("hash"))).join(wanted.select("key", "hash"), ["key", "hash"], "left_semi")
                 .groupBy("key", "hash").agg(F.first("text").alias("text")))
        return wanted.join(heads, ["key", "hash"]).drop("key", "hash")

    links = keep(within_slots(families, sizes, sets_of, texts_of, excess, percent, scratch), "links")
    wide = sizes.where("slots > 1")
    if not wide.isEmpty():
        more = across_slots(families, wide, links, sets_of, texts_of, excess, percent, slot, scratch)
        links = keep(links.unionByName(more), "links")
    named = components(ends(links), links, scratch=scratch).join(classes.select("node", "least_id"), "node")
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "comp").select("node", "component_id")
    # labels of the classes with copies or links, repeated over salts so that a class held by many rows meets them in many tasks
    alone = classes.where("copies > 1").join(named, "node", "left_anti").select("node", F.col("least_id").alias("component_id"))
    labels = named.unionByName(alone).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = (rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(
        labels.withColumn("named", F.lit(True)), ["node", "salt"], "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
    out = stored(out, "ngram-components")
    scratch.clear()
    return out


@register("op11_ngram_join")
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
