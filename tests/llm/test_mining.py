"""The n-gram join, collocations and the filter audit against plain versions."""

import collections
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, SF_SMALL
from tidewater.llm import collocations, filter_audit, ngram_join
from tidewater.llm.base import table

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- op11 -----------------------------------------------------------------------

def plain_join(rows, percent=90):
    """(doc_id, text) rows to sorted (doc_id, n_shingles, component_id), over all pairs."""
    sets = []
    for _, text in rows:
        w = [x for x in re.split(r"[ \t-\r]+", (text or "").translate(ASCII_LOWER)) if x]
        sets.append(frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(b)] = find(a)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, len(sets[i]), min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)), key=repr)


def joined(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ngram_join.jaccard_components(df, **how).collect()), key=repr)


def family(rng, n, words, edits, shared=None):
    base = shared or [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_op11_equals_all_pairs_on_families_around_the_threshold(spark, monkeypatch):
    rng = random.Random(1)
    texts = [t for _ in range(6) for t in family(rng, 14, 120, 5)] + family(rng, 40, 60, 2) + [LONG, LONG.upper(), LONG + " x"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = plain_join(rows)
    assert 10 < len({c for _, _, c in want}) < len(rows)
    assert joined(spark, rows) == want
    monkeypatch.setattr(ngram_join, "SMALL", 4)                    # every family through slots
    assert joined(spark, rows, slot=16) == want


def test_op11_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(docs).collect()), key=repr)
    assert got == plain_join([(r.doc_id, r.text) for r in docs.collect()])


def test_op11_odd_rows(spark, odd_docs, no_docs):
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(odd_docs).collect()), key=repr)
    assert got == plain_join([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert ngram_join.jaccard_components(no_docs).count() == 0
    # one id on rows with different texts, rows without id, copies under other white space
    rows = [(5, "a b c d e"), (5, "f g h i j"), (7, "f g h  i j"), (3, "A b c\td e"), (None, "a b c d e"), (None, "k l"), (9, "k l"),
            (None, "alone here now"), (8, "k l m")]
    assert joined(spark, rows) == plain_join(rows)


def test_op11_prefixes_keep_every_link():
    rng = random.Random(2)
    for _ in range(200):
        base = rng.sample(range(10**6), rng.randrange(1, 60))
        a = set(base)
        b = set(base[rng.randrange(0, 4):]) | set(rng.sample(range(10**6), rng.randrange(0, 3)))
        if not b or 100 * len(a & b) < 90 * len(a | b):
            continue
        order = sorted(a | b, key=lambda x: (x % 7, x))
        for la, lb in itertools.product(range(1, 5), repeat=2):
            prefix = lambda s, l: [x for x in order if x in s][:len(s) - -(-90 * len(s) // 100) + l]  # noqa: E741,E731
            need = min(la, lb, -(-90 * len(a) // 100), -(-90 * len(b) // 100))
            assert len(set(prefix(a, la)) & set(prefix(b, lb))) >= need


def test_op11_linked_sets_share_a_part():
    rng = random.Random(5)
    seen = 0
    for k in range(3000):
        percent = (90, 90, 75, 50)[k % 4]
        n = round(2 ** rng.uniform(1, 9))
        most = n * (100 - percent) // 100
        gone, new = rng.randrange(most + 1), rng.randrange(n * 100 // percent - n + 1)
        pool = np.array([rng.randrange(2**64) for _ in range(n + new)], dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[gone:])
        if gone + new and 100 * (n - gone) >= percent * (n + new):
            seen += 1
            assert len(np.intersect1d(ngram_join.part_names(a, percent), ngram_join.part_names(b, percent)))
    assert seen > 500
    assert not len(ngram_join.part_names(np.zeros(0, dtype=np.uint64)))


def test_op11_frequent_shingles_make_no_families(spark, monkeypatch):
    """Sets that share a third of their shingles, and so long lists, but no part: a block per pair of slots before."""
    rng = random.Random(6)
    texts = [" ".join([f"common{j}" for j in range(30)] + [f"t{i}w{j}" for j in range(50)]) for i in range(200)]
    texts += family(rng, 20, 120, 5) + texts[:3]
    rows = list(enumerate(texts))
    monkeypatch.setattr(ngram_join, "excess_counts", lambda docs: np.zeros(1 << ngram_join.COUNTER_BITS, dtype=np.float32))
    searched, edges = [], ngram_join._edges
    monkeypatch.setattr(ngram_join, "_edges", lambda blocks, *args: searched.append(blocks.count()) or edges(blocks, *args))
    assert joined(spark, rows, slot=16) == plain_join(rows)
    assert sum(searched) < len(rows)


def test_op11_bound_keeps_every_link_and_drops_other_pairs(spark):
    rng = random.Random(3)
    sizes = [1, 2, 50, 400, 90_000]                                 # the last fills its cells
    pairs = []
    for n in sizes:
        a = [rng.randrange(2**64) for _ in range(n)]
        for gone in (0, n // 50, n // 20, n // 10, n):
            pairs.append((np.unique(np.array(a, dtype=np.uint64)), np.unique(np.array(
                a[gone:] + [rng.randrange(2**64) for _ in range(gone)], dtype=np.uint64))))
    rows = [(i, len(a), len(b), ngram_join.cells(a), ngram_join.cells(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, na int, nb int, a binary, b binary")
    may = {r.i for r in df.where(ngram_join.may_link(F.col("na"), F.col("nb"), F.col("a"), F.col("b"), 90)).collect()}
    shared = [len(np.intersect1d(a, b)) for a, b in pairs]
    link = {i for i, (a, b) in enumerate(pairs) if 100 * shared[i] >= 90 * (len(a) + len(b) - shared[i])}
    assert link <= may and {14, 19}.isdisjoint(may)                 # 50 and 400 other shingles

    # classes whose prefixes meet often, but whose sets differ: their texts are not compared
    texts = [" ".join(f"t{i}w{j}" if j > 8 else f"common{j}" for j in range(80)) for i in range(40)] + [
        " ".join(f"n{j}" for j in range(80)), " ".join(f"n{j}" for j in range(79)) + " n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    excess = spark.sparkContext.broadcast(np.zeros(1 << ngram_join.COUNTER_BITS, dtype=np.float32))
    sets = docs.withColumn("s", ngram_join.prefix_column(F.col("text"), excess)).select("s.*").cache()
    every = sets.select(F.col("node").alias("a")).crossJoin(sets.select(F.col("node").alias("b"))).where("a < b")
    assert ngram_join.bounded(every, sets, 90).count() == 1


# -- op12 -----------------------------------------------------------------------

def plain_phrases(rows, least, top):
    """(lang, text) rows to the ranked phrases, by counting every phrase."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII_LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in cand.items():
        inside = any(la == lang and len(q) > len(p) and b * 100 >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (la, q), b in cand.items())
        if not inside:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                        for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, le, ri, n[lang], -s) for lang, ps in out.items()
                  for i, (s, a, p, le, ri) in enumerate(sorted(ps)[:top]))


def mined(df, **how):
    return sorted(tuple(r) for r in collocations.top_phrases(df, **how).collect())


def test_op12_equals_counting_every_phrase(spark, monkeypatch):
    rng = random.Random(4)
    words = ["der", "The", "été", "日本", "a.b", "x", "y", "zz", "İ", "no-break space"]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words[:rng.randrange(2, 11)]) for _ in range(rng.randrange(60)))
             .replace(" zz ", rng.choice(["\n", " \t ", "? ", "  "]))) for _ in range(150)]
    rows += [("en", None), (None, None), ("en", ""), ("en", " .. \t"), ("fr", "one two three four five six seven " * 30)]
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id long, lang string, text string, shard int")
    want = plain_phrases(rows, 20, 2000)
    assert len(want) > 50 and mined(df, least=20) == want
    monkeypatch.setattr(collocations, "FLUSH_CHARS", 500)          # many stripes of one prefix to merge
    assert mined(df, least=20, top=7) == plain_phrases(rows, 20, 7)


def test_op12_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**12, 10**14, 3, 10**12 + 7)], "a long, n long, l long, r long")
    assert big.select(collocations.whole_score("a", "n", "l", "r")).first()[0] == 1000 * 10**12 * 10**14 // (3 * (10**12 + 7))


def test_op12_odd_rows(spark, odd_docs, no_docs):
    want = plain_phrases([(r.lang, r.text) for r in odd_docs.collect()], 100, 2000)
    assert mined(odd_docs) == want
    assert collocations.top_phrases(no_docs).count() == 0


# -- op13 -----------------------------------------------------------------------

def plain_audit(docs, labels):
    """Every order applied document by document."""
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    fails = []
    for d, text, lang in docs:
        t = text or ""
        w = [x for x in re.split(r"[ \t-\r]+", t) if x]
        own = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d}
        fails.append((lang or "", {k for k, v in own.items() if v}, d in good, d in toxic))
    out, shapley = {}, collections.Counter()
    for part in {f[0] for f in fails}:
        rows = [f for f in fails if f[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, c in enumerate(order, 1):
                hit, rest = [r for r in left if c in r[1]], [r for r in left if c not in r[1]]
                out[part, order, step] = [len(rest), len(hit), sum(c in r[1] for r in rows) - len(hit), sum(r[1] == {c} for r in rows),
                                          sum(r[2] for r in hit), sum(r[3] for r in hit)]
                shapley[part, c] += len(hit)
                left = rest
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


def test_op13_equals_applying_every_order(spark, odd_docs, no_docs, no_labels):
    rng = random.Random(6)
    docs = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    docs += [(100 + i, " ".join(rng.choice(["Aa", "BB", "c#", f"d{i}", f"e{rng.randrange(300)}"]) for _ in range(rng.choice([5, 90, 150]))),
              rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(300 + i, docs[-1 - 2 * i][1], "en") for i in range(10)]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in docs if d and d % 2] + [(101, 1, 1), (101, 0, 0)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, mask int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit(df, lab).collect())
    assert got == plain_audit(docs, labels)
    assert filter_audit.audit(no_docs, no_labels).count() == 0
    assert {r.good_lost for r in filter_audit.audit(df, no_labels).collect()} == {0}


def test_op13_ranks_are_lexicographic():
    orders = list(itertools.permutations(range(5)))
    assert [filter_audit.rank_of(o, 5) for o in orders] == list(range(120))
    for mask, step, low, high in filter_audit.intervals(5):
        for o in orders[low:high]:
            assert mask >> o[step - 1] & 1 and not any(mask >> f & 1 for f in o[:step - 1])
    covered = collections.Counter()
    for mask, _, low, high in filter_audit.intervals(5):
        covered[mask] += high - low
    assert all(n == 120 for n in covered.values()) and len(covered) == 31


