"""MinHash near-duplicates with DartMinHash signatures.

A text is the multiset of its five-word shingles; its likeness to another is
the weighted Jaccard similarity, 0.8 or more being a near-duplicate.

*Signature.*  Every unit of an element's weight, and every unit of rank, is a
cell into which a hash throws Poisson(1) darts; a dart counts if it lies below
the element's weight.  A dart falls on one of ``COORDINATES`` coordinates, and
each coordinate keeps the dart of least rank.  Ranks are opened up just far
enough to fill all coordinates, about (k ln k + 2k) darts however many shingles
there are.  Two texts agree on a coordinate with probability equal to their
similarity.  The darts of an Arrow batch are thrown in one pass.

*Candidates.*  Different texts are the nodes: the first row of a digest stands for
its copies.  Signatures are cut into bands; texts with an equal band share a bucket; of buckets with the same
texts one is looked at.  Inside a bucket the texts whose signatures (one byte a
coordinate) do not rule each other out are tied by a spanning forest, never by
their pairs; a bucket of over ``SLOT`` texts is tied as a whole.  The tied texts
are families: every two texts that share a bucket and that the estimate allows
lie in one family.

*Links.*  Shingles move for families only: a bit map of the families' rows, of at
most ``MAP_BITS``, holds back nearly all others (a row too many costs its bytes, no
result).  A family is one block of one task, or
is dealt into slots of up to ``SLOT`` texts.  In a block the pairs that the
estimate allows are verified on the shingles, most alike first, leaving out those
already in one group; only a spanning forest of the verified links comes out, so
no step makes more rows than it reads.  Families of several slots are dealt a
second time another way, and then every text outside the family's largest group
meets every slot, so no link is lost whatever the size of a family.

Defined results: null and empty texts are one class; texts of fewer than five
words have a single shingle; very long texts are shingled whole, in their task;
every row is taken by its own text, so rows of one id with different texts are in
the classes of those texts and none is lost (both classes may then bear that id); a row
without id takes part under a key made from its text; of rows tied for a class's
least id and text one is kept; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import Scratch, WordHasher, fresh, mix, pick, register, stored, table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
COORDINATES = BANDS * ROWS
#: Texts and shingles of a slot, and the estimate below which a pair is ruled out (over four
#: standard errors of the estimate under the threshold).
SLOT, SLOT_SHINGLES = 2048, 1 << 22
LEAST_ESTIMATE = 0.65
#: Bits of a map of values to look for, for each value and at most.
ROW_BITS, MAP_BITS = 32, 1 << 26
#: Copies of a class's label, so that a text on very many rows meets it in many tasks.
SALTS = 16
#: Cells that darts are thrown into at once, and bytes of a block's bit sets.
CELLS, BIT_BYTES = 1 << 18, 1 << 26

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(20)])


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def units(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, element, nth) of every unit of the elements' weights."""
    cells = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(elements)), cells)
    nth = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
    return mix(elements[element] + mix((nth + 1).astype(np.uint64) * _GOLD)), element, nth


def throw_darts(name: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, id, rank) of all darts that fall on units, each with ranks of its own from ``low`` to ``high``."""
    ranks = high - low
    of = np.repeat(np.arange(len(name)), ranks)
    rank = np.arange(len(of)) - np.repeat(np.cumsum(ranks) - ranks - low, ranks)
    key = mix(name[of] ^ mix((rank + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    count = np.searchsorted(_POISSON, unit(key), side="right")
    cell = np.repeat(np.arange(len(key)), count)
    nth = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
    dart = mix(key[cell] + (nth + 1).astype(np.uint64) * _GOLD)
    return of[cell], dart, rank[cell] + unit(dart)


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """For each of ``n`` texts, the dart of least rank on each of ``k`` coordinates; ``owner`` is an
    element's text, and every text has some."""
    name, element, nth = units(elements, weights)
    text = owner[element]
    total = np.bincount(owner, weights=weights, minlength=n)
    part = np.ceil(weights) != weights
    best, out = np.full(n * k, np.inf), np.zeros(n * k, dtype=np.uint64)
    low = np.zeros(n, dtype=np.int64)
    high = np.maximum(1, np.ceil((k * math.log(k) + 2 * k) / total)).astype(np.int64)
    while True:
        of, dart, rank = throw_darts(name, low[text], high[text])
        if part.any():
            hit = nth[of] + unit(mix(dart ^ np.uint64(0x5851F42D4C957F2D))) < weights[element[of]]
            of, dart, rank = of[hit], dart[hit], rank[hit]
        at = text[of] * k + (mix(dart ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(k)).astype(np.int64)
        before = best.copy()
        np.minimum.at(best, at, rank)
        first = (rank == best[at]) & (rank < before[at])
        out[at[first]] = dart[first]
        open_ = np.isinf(best).reshape(n, k).any(axis=1)
        if not open_.any():
            return out.reshape(n, k)
        still = open_[text]
        name, element, nth, text = name[still], element[still], nth[still], text[still]
        low, high = high, 2 * high


def signature(elements: np.ndarray, weights: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    return signatures(elements, weights, np.zeros(len(elements), dtype=np.int64), 1, k)[0]


class Shingler:
    """The weighted five-word shingles of a text, as hashes."""

    def __init__(self, k: int = SHINGLE):
        self.k = k
        self.hashes = WordHasher()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        h = self.hashes((text or "").encode("utf-8", "surrogatepass"))
        if not len(h):
            return np.zeros(0, dtype=np.uint64), np.zeros(0)
        k = min(self.k, len(h))
        rolling = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for j in range(k):
            rolling = rolling * _GOLD + h[j:j + len(rolling)]
        elements, counts = np.unique(mix(rolling + np.uint64(k)), return_counts=True)
        return elements, counts.astype(np.float64)


def weighted_members(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One 32-bit name for each unit of integer weight, so that the plain
    Jaccard similarity of two name sets is the weighted one of the texts."""
    return np.unique((units(elements, weights)[0] >> np.uint64(32)).astype(np.uint32).view(np.int32))


def bands_of(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The buckets (texts x bands) of signatures (texts x coordinates)."""
    rows = sig.reshape(len(sig), bands, -1)
    bucket = np.tile((np.arange(bands) + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), (len(sig), 1))
    for j in range(rows.shape[2]):
        bucket = mix(bucket * _GOLD + rows[:, :, j])
    return bucket.view(np.int64)


def sketches(texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, bytes, np.ndarray]]:
    """(buckets, brief, members) of each text's (elements, weights), none of them empty; darts are thrown for
    as many texts at once as take ``CELLS`` cells."""
    cells = np.cumsum([max(COORDINATES * 8, int(w.sum())) for _, w in texts])
    out = []
    for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(cells // CELLS)) + 1):
        parts = [texts[i] for i in group]
        owner = np.repeat(np.arange(len(parts)), [len(e) for e, _ in parts])
        sig = signatures(np.concatenate([e for e, _ in parts]), np.concatenate([w for _, w in parts]), owner, len(parts))
        buckets, brief = bands_of(sig), sig.astype(np.uint8)
        out += [(b, x.tobytes(), weighted_members(e, w)) for b, x, (e, w) in zip(buckets, brief, parts)]
    return out


def signature_column(text: Column) -> Column:
    """struct(bucket, brief, members) of a text: its buckets, its signature at
    one byte a coordinate, its shingles' names; empty for a text without words."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingle = Shingler()
        none = (np.zeros(0, dtype=np.int64), b"", np.zeros(0, dtype=np.int32))
        for batch in batches:
            texts = [shingle(t) for t in batch]
            found = iter(sketches([t for t in texts if len(t[0])]) if any(len(t[0]) for t in texts) else [])
            yield pd.DataFrame([next(found) if len(t[0]) else none for t in texts], columns=["bucket", "brief", "members"])

    return F.pandas_udf(run, "bucket array<long>, brief binary, members array<int>")(text)


# -- inside one block ---------------------------------------------------------

def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(rows, bounds) of whole blocks, from rows sorted by ``block``; a block may go on in the next batch."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        key = rows["block"].to_numpy()
        bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
        rest = rows.iloc[bounds[-1]:]
        if len(bounds) > 1:
            yield rows.iloc[:bounds[-1]], bounds
    if rest is not None:
        yield rest, np.array([0, len(rest)])


def matrix(brief: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(brief), dtype=np.uint8).reshape(len(brief), -1)


def allowed(brief: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(agreeing coordinates, whether the estimate allows the pair) of every two texts."""
    n, k = brief.shape
    agree = np.zeros((n, n), dtype=np.uint8)
    if n <= 64:
        agree[:] = (brief[:, None, :] == brief[None, :, :]).sum(axis=2)
    else:
        for c in brief.T:
            agree += c[:, None] == c[None, :]
    near = agree >= least_agreement(k)
    np.fill_diagonal(near, False)
    return agree, near


def least_agreement(k: int = COORDINATES) -> int:
    """Bytes that must agree: unequal darts agree in a byte by chance once in 256."""
    return math.ceil(k * (LEAST_ESTIMATE * 255 / 256 + 1 / 256))


def roots(near: np.ndarray) -> np.ndarray:
    """The least member of each row's component."""
    label = np.arange(len(near))
    while True:
        least = np.minimum(label, np.where(near, label[None, :], len(label)).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def bucket_ties(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b): a spanning forest of the pairs that the estimate allows, bucket by bucket."""
    for rows, bounds in blocks(batches):
        brief, node = matrix(rows["brief"]), rows["node"].to_numpy()
        size = np.diff(bounds)
        twos = bounds[:-1][size == 2]
        twos = twos[(brief[twos] == brief[twos + 1]).sum(axis=1) >= least_agreement()]
        a, b = [twos + 1], [twos]
        for lo, hi in zip(bounds[:-1][size > 2], bounds[1:][size > 2]):
            root = roots(allowed(brief[lo:hi])[1])
            moved = np.flatnonzero(root != np.arange(hi - lo))
            a.append(lo + moved)
            b.append(lo + root[moved])
        yield pd.DataFrame({"a": node[np.concatenate(a)], "b": node[np.concatenate(b)]})


class Overlaps:
    """Shared members of pairs of sets: on bit sets of the members that several sets have, or by merging where
    bits would take too much memory."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.bits = sets, None
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        twice = counts > 1
        at = (np.cumsum(twice) - 1)[column[twice[column]]]
        owner = owner[twice[column]]
        width = -(-int(twice.sum()) // 64) * 8
        if len(sets) * width <= BIT_BYTES:
            bits = np.zeros((len(sets), width), dtype=np.uint8)
            np.bitwise_or.at(bits, (owner, at >> 3), (1 << (at & 7)).astype(np.uint8))
            self.bits = bits.view(np.uint64)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.array([len(np.intersect1d(self.sets[x], self.sets[y], assume_unique=True)) for x, y in zip(i, j)])
        step = max(1, (1 << 22) // max(1, self.bits.shape[1]))
        return np.concatenate([np.bitwise_count(self.bits[i[s:s + step]] & self.bits[j[s:s + step]]).sum(axis=1, dtype=np.int64)
                               for s in range(0, len(i), step)])


def linked_roots(label: np.ndarray, brief: np.ndarray, sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """The groups of a block's texts: ``label`` (each text's first fellow in the groups so far) joined by all
    links among them."""
    up, n = label.copy(), np.array([len(x) for x in sets])

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    agree, near = allowed(brief)
    near &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1e-9
    near &= label[:, None] != label[None, :]
    i, j = np.nonzero(np.triu(near))
    order = np.argsort(-agree[i, j].astype(np.int16), kind="stable")
    i, j = i[order], j[order]
    overlaps, step = Overlaps(sets) if len(i) else None, 2 * len(n)
    while len(i):
        shared = overlaps(i[:step], j[:step])
        found = shared >= threshold * (n[i[:step]] + n[j[:step]] - shared) - 1e-9
        for x, y in zip(i[:step][found], j[:step][found]):
            x, y = find(x), find(y)
            up[max(x, y)] = min(x, y)
        root = np.array([find(x) for x in range(len(n))])
        i, j = i[step:], j[step:]
        apart = root[i] != root[j]
        i, j, step = i[apart], j[apart], 2 * step
    return np.array([find(x) for x in range(len(n))])


def block_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b): edges that join the texts of each block into its groups, as far as ``comp`` has not."""
    for rows, bounds in blocks(batches):
        brief, node, members = matrix(rows["brief"]), rows["node"].to_numpy(), list(rows["members"])
        comp = pd.factorize(rows["comp"])[0]
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo == 1:
                continue
            _, first, inverse = np.unique(comp[lo:hi], return_index=True, return_inverse=True)
            label = first[inverse]
            root = linked_roots(label, brief[lo:hi], members[lo:hi])
            moved = first[root[first] != first]      # one member of each component that has joined another
            a.append(lo + moved)
            b.append(lo + root[moved])
        yield pd.DataFrame({"a": node[np.concatenate(a)], "b": node[np.concatenate(b)]})


# -- the groups ---------------------------------------------------------------

def node_key(doc_id: Column, text: Column) -> Column:
    """The document's id; a row without one is known by its text."""
    return F.coalesce(doc_id, F.xxhash64(F.coalesce(text, F.lit(""))))


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64, scratch: Scratch | None = None) -> DataFrame:
    """(node, comp): the least node of each connected component.  Each round
    hooks every component to its least neighbour, follows that hook once more,
    and contracts the edges; every round's tables are written to the shared folder."""
    keep = (scratch or Scratch(nodes.sparkSession)).stored
    labels = nodes.select("node", F.col("node").alias("comp"))
    edges = keep(edges.select("a", "b").distinct(), "edges")
    for _ in range(max_rounds):
        if edges.isEmpty():
            return labels
        both = edges.union(edges.select("b", "a"))
        hook = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("c"), "p"), "hook")
        nxt = hook.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        hook = keep(hook.join(nxt, "p", "left").select("c", F.coalesce("pp", "p").alias("p")), "hook")
        labels = keep(labels.join(hook, labels["comp"] == hook["c"], "left")
                        .select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        ha, hb = (hook.select(F.col("c").alias(x), F.col("p").alias(f"p{x}")) for x in ("a", "b"))
        moved = edges.join(ha, "a", "left").join(hb, "b", "left").select(
            F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
        edges = keep(moved.where("a <> b").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def bit_map(values: DataFrame, at: Callable[[Column], Column] = F.xxhash64):
    """(bits, words shared with the tasks): a map, of bounded size, of the hashes ``at`` of the only column of ``values``."""
    bits = min(MAP_BITS, 1 << max(16, (ROW_BITS * values.count()).bit_length()))
    at_word = values.select(F.pmod(at(F.col(values.columns[0])), F.lit(bits)).alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("has")).toPandas()
    words = np.zeros(bits // 64, dtype=np.int64)
    words[at_word["word"].to_numpy(dtype=np.int64)] = at_word["has"].to_numpy(dtype=np.int64)
    return bits, values.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def in_map(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (words[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1


def maybe_in(values: DataFrame) -> Column:
    """Of the column that is the only one of ``values``: true for every one of them and for few others,
    by a bit map whose size is bounded."""
    bits, shared = bit_map(values)

    # no iterators: maps asked of the same rows are then asked by one worker
    def run(h: pd.Series) -> pd.Series:
        return pd.Series(in_map(shared.value, h.to_numpy(dtype=np.int64)))

    return F.pandas_udf(run, "boolean")(F.pmod(F.xxhash64(values.columns[0]), F.lit(bits)))


def members_in(arrays: Column, values: DataFrame) -> Column:
    """The members of arrays of hashes that are in the only column of ``values`` (hashes too), and few others."""
    bits, shared = bit_map(values, lambda c: c)

    def run(batch: pd.Series) -> pd.Series:
        ends = np.cumsum([len(x) for x in batch])[:-1]
        flat = np.concatenate([np.zeros(0, dtype=np.int64), *batch])
        has = in_map(shared.value, flat & (bits - 1))
        return pd.Series([x[h] for x, h in zip(np.split(flat, ends), np.split(has, ends))])

    return F.pandas_udf(run, "array<long>")(arrays)


def ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()


def _in_blocks(rows: DataFrame, run) -> DataFrame:
    """(a, b) of ``run`` over the blocks.  A block's work follows its texts, not its bytes: the number of
    tasks is the session's, so that adaptive execution does not merge them."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "block").sortWithinPartitions("block", "node").mapInPandas(run, "a long, b long")


def family_ties(firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): edges that tie every two texts which share a bucket and which the estimate allows."""
    banded = firsts.select("node", F.explode("bucket").alias("bucket"))
    # which buckets are shared at all is asked with nothing but the bucket moving
    common = scratch.stored(banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "n"), "common")
    held = scratch.stored(banded.where(maybe_in(common.select("bucket"))).join(common, "bucket"), "held")
    # buckets of the same texts: one of them is enough
    once = (held.groupBy("bucket", "n").agg(F.min("node").alias("centre"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
            .groupBy("n", "centre", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "centre"))
    shared = scratch.stored(held.join(once, "bucket"), "buckets")
    small = shared.where(F.col("n") <= SLOT).select("node", F.col("bucket").alias("block"))
    small = small.join(firsts.select("node", "brief").where(maybe_in(shared.select("node"))), "node")
    large = shared.where((F.col("n") > SLOT) & (F.col("node") != F.col("centre"))).select(
        F.col("node").alias("a"), F.col("centre").alias("b"))
    return scratch.stored(_in_blocks(small, bucket_ties).unionByName(large).distinct(), "ties")


def _dealt(salt: int, slots: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(slots)).cast("int")


def _block(*key: Column) -> Column:
    """A block's name; blocks that by chance share one are compared together, which changes no result."""
    return F.xxhash64("family", *key)


def within_slots(families: DataFrame, details: DataFrame) -> DataFrame:
    """Edges (a, b) of the links within each slot, for two ways of dealing families into slots."""
    ways = F.when(F.col("slots") > 1, F.array(_dealt(0, "slots"), -1 - _dealt(1, "slots"))).otherwise(F.array(F.lit(0)))
    rows = families.withColumn("i", F.explode(ways)).select("node", F.col("node").alias("comp"), _block(F.col("i")).alias("block"))
    return _in_blocks(rows.join(details, "node"), block_links)


def across_slots(wide: DataFrame, links: DataFrame, details: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) of what is left in families of several slots: texts outside the family's largest
    group, against every slot."""
    own = links.join(wide.select(F.col("node").alias("a")), "a", "left_semi")
    groups = scratch.stored(components(wide.select("node"), own, scratch=scratch), "family-groups")
    named = wide.join(groups, "node")
    home = (named.groupBy("family", "comp").agg(F.count("*").alias("size")).groupBy("family")
            .agg(F.max(F.struct("size", "comp")).alias("home"), F.sum("size").alias("all"))
            .select("family", F.col("home.comp").alias("home"), F.ceil((F.col("all") - F.col("home.size")) / SLOT).cast("int").alias("asking"))
            .where("asking > 0"))
    named = named.join(home, "family").withColumn("outside", F.col("comp") != F.col("home"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    answers = F.transform(upto("asking"), lambda i: _block(i, _dealt(0, "slots")))
    asks = F.transform(upto("slots"), lambda j: _block(_dealt(2, "asking"), j))
    met = F.when(F.col("outside"), F.array_union(answers, asks)).otherwise(answers)
    rows = named.select("node", "comp", F.explode(met).alias("block"))
    return _in_blocks(rows.join(details, "node"), block_links)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node, hash, text_class, class_id, is_kept of every row: its id or a key made from its text, a digest
    of its text, the least id with the same text, the least of its group of near-duplicates, and
    whether it is the one row that stands for that group."""
    scratch = Scratch(docs.sparkSession)
    keep = scratch.stored
    src = pick(docs, doc_id=id_col, text=text_col)
    rows = src.withColumn("s", signature_column(F.col("text"))).select(
        "doc_id", node_key(F.col("doc_id"), F.col("text")).alias("id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("hash"), "s.*").withColumn("node", F.monotonically_increasing_id())
    rows = keep(rows, "signatures")
    # one row for each different text; of its copies only (hash, id, node) is shuffled
    texts = keep(rows.groupBy("hash").agg(F.min(F.struct("id", "node")).alias("first"), F.count("*").alias("copies"))
                 .select("hash", "copies", "first.*"), "texts")
    # a row whose text may have copies stays if it is the first of them; any other row is alone and does not move
    copied = texts.where("copies > 1").select(F.xxhash64("hash").alias("h"), "node")
    held = rows.where(F.size("bucket") > 0).select("node", "bucket", "brief", F.size("members").alias("n"), F.xxhash64("hash").alias("h"))
    held = held.withColumn("maybe", maybe_in(copied.select("h")))
    twins = held.where("maybe").join(texts.select("node"), "node", "left_semi")
    firsts = keep(held.where("not maybe").unionByName(twins).select("node", "bucket", "brief", "n"), "firsts")
    ties = family_ties(firsts, scratch)
    families = components(ends(ties), ties, scratch=scratch).withColumnRenamed("comp", "family")
    families = keep(families.join(firsts.select("node", "n"), "node"), "families")
    sizes = families.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / SLOT), F.ceil(F.sum("n") / SLOT_SHINGLES)).cast("int").alias("slots"))
    families = keep(families.join(sizes, "family"), "family-slots")
    details = rows.where(maybe_in(families.select("node"))).select("node", "brief", "members")
    links = keep(within_slots(families, details).distinct(), "links")
    wide = families.where("slots > 1")
    if not wide.isEmpty():
        links = keep(links.unionByName(across_slots(wide, links, details, scratch)).distinct(), "links")
    groups = keep(components(ends(links), links, scratch=scratch).join(texts, "node"), "groups")
    least = groups.groupBy("comp").agg(F.min(F.struct("id", "hash", "node")).alias("head"))
    # labels of the texts that have copies or links; any other row stands for itself
    label = lambda df, head: df.select("hash", F.col("id").alias("text_class"), head.alias("head"))
    alone = texts.where("copies > 1").join(groups, "hash", "left_anti")
    labels = label(groups.join(least, "comp"), F.struct("head.id", "head.node")).unionByName(label(alone, F.struct("id", "node")))
    labels = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = (rows.select("doc_id", "id", "hash", "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
           .join(labels, ["hash", "salt"], "left")
           .select("doc_id", F.col("id").alias("node"), "hash", F.coalesce("text_class", "id").alias("text_class"),
                   F.coalesce("head.id", "id").alias("class_id"),
                   F.coalesce(F.col("head.node") == F.col("node"), F.lit(True)).alias("is_kept")))
    out = stored(out, "near-groups")
    scratch.clear()
    return out


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group; all columns as they were."""
    key, text, turn = fresh(docs, "near_key"), fresh(docs, "near_hash"), fresh(docs, "near_turn")
    heads = near_groups(docs).where("is_kept").select(F.col("node").alias(key), F.col("hash").alias(text))
    kept = (docs.withColumn(key, node_key(F.col("doc_id"), F.col("text"))).withColumn(text, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
            .join(heads, [key, text], "left_semi"))
    # rows that repeat both id and text: one, by its other columns
    others = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    order = Window.partitionBy(key, text).orderBy(F.xxhash64(*others))
    return kept.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1).select(*docs.columns)


@register("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "text_class", "class_id", "is_kept")
