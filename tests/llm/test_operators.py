"""Each operator against a plain re-computation on small tables."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SF_MID, SF_SMALL
from tidewater.llm import base, compress_quality, dart_minhash, license_scan, quality_rules, sentencepiece_scan, toxicity
from tidewater.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(sf):
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    from tests.test_oracle import _rows
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert _rows(got.columns, got.collect()) == _rows(cols, cur.fetchall())


def test_op1_ids_equal_the_library(spark):
    model = sentencepiece_scan.load_model()
    texts = texts_of(SF_SMALL)
    docs = base.table(spark, SF_SMALL, "documents")
    pieces = sentencepiece_scan.Pieces(model)
    whole = {i: pieces.coder.encode(t) for i, t in texts.items()}
    for size in (64, sentencepiece_scan.CHUNK):             # 64: nearly every text is cut into chunks
        rows = sentencepiece_scan.encode_documents(docs, model, size).collect()
        assert len(rows) == len(texts)
        assert all(list(r.token_ids) == whole[r.doc_id] and r.round_trip for r in rows)


@pytest.mark.parametrize("text", [
    "a" * 700, "thethethethe" * 50, "strawberrystrawberry" * 40, " " * 400, "▁" * 90 + "x y" * 60, "0123456789" * 60,
    "日本語テキスト" * 60, "\U0001d518\U0001d518" * 80, "xqzjv" * 100, "in in  in   in    in" * 20])
def test_op1_scan_without_spaces(text):
    pieces = sentencepiece_scan.Pieces(sentencepiece_scan.load_model())
    for size in (33, 50, 111):
        cut = sentencepiece_scan.cut_text(text, size, pieces.longest)
        states = sentencepiece_scan.best_states([pieces.transfer(a, b, c, k == 0, z) for k, a, b, c, z in cut])
        ids = []
        for (_, _, body, right, _), (i, j) in zip(cut, states):
            part = body[i % 4096:] + right[:j % 4096]
            ids += pieces.encode(part) if part else []
        assert ids == pieces.coder.encode(text)


def test_op1_products_are_associative():
    pieces = sentencepiece_scan.Pieces(sentencepiece_scan.load_model())
    cut = sentencepiece_scan.cut_text("unbelievablestrawberries" * 30, 40, pieces.longest)
    m = [pieces.transfer(a, b, c, k == 0, z) for k, a, b, c, z in cut]
    left = sentencepiece_scan.combine(sentencepiece_scan.combine(m[0], m[1]), m[2])
    assert left == sentencepiece_scan.combine(m[0], sentencepiece_scan.combine(m[1], m[2]))


def test_op1_decode(spark):
    model = sentencepiece_scan.load_model()
    df = spark.createDataFrame([(1, "Hello  world\n日𝔘"), (2, "")], "doc_id long, text string")
    ids = sentencepiece_scan.encode_documents(df, model)
    out = ids.select("doc_id", sentencepiece_scan.decode_column(model, ids["token_ids"]).alias("t")).collect()
    assert {r.doc_id: r.t for r in out} == {1: "Hello  world\n日𝔘", 2: ""}


def _repeat_words(w):
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    return len({i + j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(8)})


def test_op2_base_counts_and_list(spark):
    rows = QUERIES["op2_quality_rules"](spark, SF_MID).collect()
    texts = texts_of(SF_MID)
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id]
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), _repeat_words(w))
        assert r.base_failed == (len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w))
        assert r.kept == (not r.base_failed and r.rule == 0)
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall())
    good = [r.kept for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if label.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_op2_rules_recover_a_planted_list():
    rng = np.random.default_rng(3)
    x = {"symbol_share": rng.random(3000), "bang_share": rng.random(3000), "n_words": rng.integers(1, 500, 3000).astype(float)}
    bad = ((x["symbol_share"] > 0.8) & (x["n_words"] < 300)) | (x["bang_share"] > 0.9)
    rules = quality_rules.learn_rules(x, bad)
    hit = np.zeros(3000, dtype=bool)
    for r in rules:
        hit |= r.covers(x)
    assert (hit == bad).mean() > 0.97 and len(rules) <= 8


def test_op2_rules_apply_in_spark_as_in_numpy(spark):
    rules = [quality_rules.Rule((("n_words", ">=", 5.0), ("mean_word", "<=", 4.0))), quality_rules.Rule((("n_words", "<=", 2.0),))]
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a"), (3, "longer words stay")], "doc_id long, text string")
    assert {r.doc_id: r.rule for r in quality_rules.judge_quality(df, rules).collect()} == {1: 1, 2: 2, 3: 0}


def brute_groups(texts):
    """Least doc_id of each near-duplicate group, over all pairs."""
    bags = {}
    for i, t in texts.items():
        w = t.split()
        bags[i] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inter = sum((bags[a] & bags[b]).values())
            total = sum(bags[a].values()) + sum(bags[b].values())
            if texts[a] == texts[b] or (inter and inter >= 0.8 * (total - inter)):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_op3_groups_equal_all_pairs(spark):
    rng = np.random.default_rng(11)
    base_words = [f"t{rng.integers(5000)}" for _ in range(300)]
    texts = dict(list(texts_of(SF_SMALL).items())[:100])
    for n in range(120):                        # one large group of near copies, some far out
        w = list(base_words)
        for at in rng.integers(0, 300, n // 12):
            w[at] = f"new{n}"
        texts[10_000 + n] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.node: r.class_id for r in dart_minhash.near_groups(df).collect()}
    want = brute_groups(texts)
    assert got == want
    assert {r.doc_id for r in dart_minhash.one_of_each(df).collect()} == set(want.values())


def template_texts(pairs=30, alone=60):
    """Texts just under the threshold to each other, some of them with one other just over it."""
    rng = np.random.default_rng(5)
    base_words = [f"t{n}" for n in range(600)]
    texts, places = {}, None
    for n in range(2 * pairs + alone):
        second = n < 2 * pairs and n % 2
        if second:                              # three edits are the first one's, six its own
            free = np.setdiff1d(np.arange(118), places)
            places = np.r_[places[:3], rng.choice(free, 6, replace=False)]
        else:
            places = rng.choice(118, 9, replace=False)
        w = list(base_words)
        for k, at in enumerate(places):
            w[at * 5 + 4] = f"new{n - 1 if second and k < 3 else n}"
        texts[n] = " ".join(w)
    return texts


def test_op3_links_within_a_family_under_the_threshold(spark):
    texts = template_texts()
    want = brute_groups(texts)
    assert len(set(want.values())) == 88
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.node: r.class_id for r in dart_minhash.near_groups(df).collect()} == want


def test_op3_slots_are_compared_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "SLOT", 2)
    texts = template_texts(30, 10)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.node: r.class_id for r in dart_minhash.near_groups(df).collect()} == brute_groups(texts)


def test_op3_rows_of_one_id_keep_their_own_texts(spark):
    a = " ".join(f"a{n}" for n in range(60))
    b = " ".join(f"b{n}" for n in range(60))
    rows = [(3, a), (5, a), (5, b), (7, b), (7, b), (9, b + " end"), (9, "else"), (None, "else")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.text for r in dart_minhash.one_of_each(df).collect()]
    assert sorted(kept) == sorted([a, b, "else"])
    groups = dart_minhash.near_groups(df)
    assert groups.count() == len(rows) and groups.where("is_kept").count() == 3
    named = {(r.doc_id, r.class_id) for r in groups.collect()}
    assert {(3, 3), (5, 3), (5, 5), (7, 5), (9, 5)} <= named


def test_op3_loses_no_link_of_a_whole_table(spark):
    """Against every pair of sf0.01's texts that share a shingle."""
    texts = texts_of(SF_MID)
    got = {r.doc_id: r.class_id for r in QUERIES["op3_near_dedup"](spark, SF_MID).collect()}
    bags, holders = {}, {}
    for i, t in texts.items():
        w = t.split()
        bags[i] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
        for g in bags[i]:
            holders.setdefault(g, []).append(i)
    pairs = {(x, y) for ids in holders.values() for n, y in enumerate(ids) for x in ids[:n]}
    links = []
    for x, y in pairs:
        inter = sum((bags[x] & bags[y]).values())
        if inter >= 0.8 * (sum(bags[x].values()) + sum(bags[y].values()) - inter):
            links.append((x, y))
    assert len(links) > 50 and all(got[x] == got[y] for x, y in links)


def test_op3_block_makes_fewer_edges_than_rows():
    """A family of texts alike but all under the threshold, and one of links only: no pairs come out."""
    for threshold_edits, links in ((12, False), (1, True)):
        texts = []
        for n in range(150):
            w = [f"t{k}" for k in range(300)]
            for at in range(threshold_edits):
                w[(7 * n + 23 * at) % 300] = f"new{n}x{at}"
            texts.append(" ".join(w))
        shingle = dart_minhash.Shingler()
        sketch = dart_minhash.sketches([shingle(t) for t in texts])
        rows = pd.DataFrame({"block": 1, "node": [str(n).encode() for n in range(150)], "brief": [s[1] for s in sketch],
                             "members": [s[2] for s in sketch]})
        rows["comp"] = rows["node"]
        ties = pd.concat(dart_minhash.bucket_ties(iter([rows[:70], rows[70:]])))
        found = pd.concat(dart_minhash.block_links(iter([rows[:70], rows[70:]])))
        assert len(ties) < 150 and len(found) == (149 if links else 0)


def test_op3_overlaps_by_bits_and_by_merging(monkeypatch):
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 150))).astype(np.int32) for _ in range(30)]
    i, j = np.triu_indices(30, 1)
    want = [len(set(sets[x].tolist()) & set(sets[y].tolist())) for x, y in zip(i, j)]
    assert dart_minhash.Overlaps(sets)(i, j).tolist() == want
    monkeypatch.setattr(dart_minhash, "BIT_BYTES", 0)
    assert dart_minhash.Overlaps(sets)(i, j).tolist() == want


def test_op3_signatures_of_a_batch_equal_those_one_by_one():
    shingle = dart_minhash.Shingler()
    bags = [shingle(t) for t in ("one", "a b c d e f g a b c d e f g", " ".join(f"w{n % 700}" for n in range(9000)))]
    together = dart_minhash.sketches(bags)
    for bag, (bucket, brief, members) in zip(bags, together):
        sig = dart_minhash.signature(*bag)
        assert (dart_minhash.bands_of(sig[None, :])[0] == bucket).all() and sig.astype(np.uint8).tobytes() == brief
        assert len(members) == bag[1].sum()


def test_op3_signature_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(2)
    e = rng.integers(0, 2 ** 62, 300).astype(np.uint64)
    a, b = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300).astype(float)
    a[3] = b[7] = 0.5                           # weights need not be whole
    agree = np.mean(dart_minhash.signature(e, a, 1024) == dart_minhash.signature(e, b, 1024))
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.06


def test_op3_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 30)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 103, 200]], "node long")
    got = dart_minhash.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.comp for r in got} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 200: 200}


def test_op4_held_out_accuracy(spark):
    rows = QUERIES["op4_quality_classifier"](spark, SF_MID).collect()
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.9


def test_op4_held_out_labels_are_not_read(spark):
    docs, labels = base.table(spark, SF_MID, "documents"), base.table(spark, SF_MID, "labels")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end"
                                " as quality", "toxic")
    assert compress_quality.fit(docs, labels) == compress_quality.fit(docs, flipped)


def test_op5_base_places(spark):
    rows = QUERIES["op5_license_scan"](spark, SF_MID).collect()
    texts = texts_of(SF_MID)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    phrases = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])]
    assert len(rows) == len(texts)
    for r in rows:
        w = word.findall(texts[r.doc_id].translate(lower))
        at = [(i, n) for n, p in phrases for i in range(len(w)) if w[i:i + len(p)] == p]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({n for _, n in at})))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_op5_edited_notice_and_repeats(spark):
    notice = license_scan.TEMPLATES[4].text
    w = notice.split()
    edited = " ".join([*w[:6], "very", *w[6:12], *w[13:]])          # one word put in, one left out
    rows = [(1, f"x y {notice.upper()} z"), (2, edited), (3, " ".join(w[:5])), (4, "MIT License, mit-license; MIT  LICENSE")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == got[2].labels == "mit" and got[1].score == 1.0 and 0.75 <= got[2].score < 1.0
    assert got[3].labels == "" and (got[4].n_base, got[4].first_word, got[4].last_word) == (3, 0, 4)


def plain_licenses(text):
    """Labels and score by trying every diagonal of every template."""
    w = [x.decode() for x in license_scan.words_of(text)]
    pairs, labels, score = {}, set(), 0.0
    for i in range(len(w) - 1):
        pairs.setdefault((w[i], w[i + 1]), []).append(i)
    for t in license_scan.TEMPLATES:
        p = [x.decode() for x in license_scan.words_of(t.text)]
        if t.base or len(p) <= license_scan.WHOLE_UNTIL:
            held = len(p) if any(w[i:i + len(p)] == p for i in range(len(w))) else 0
        else:
            hits = [(i, at) for at in range(len(p) - 1) for i in pairs.get((p[at], p[at + 1]), [])]
            held = 0
            for d in {i - at for i, at in hits}:
                near = sorted((i, at) for i, at in hits if 0 <= i - at - d <= license_scan.DRIFT)
                run = []
                for n, (i, at) in enumerate(near):
                    run.append(1 + max((run[m] for m in range(n) if near[m][0] < i and near[m][1] < at), default=0))
                held = max(held, max(run) + 1)
            held = held if held >= license_scan.MIN_SHARE * len(p) else 0
        if held:
            labels.add(t.label)
            score = max(score, held / len(p))
    return ",".join(sorted(labels)), score


def test_op5_labels_and_scores_against_plain(spark):
    texts = texts_of(SF_MID)
    for r in QUERIES["op5_license_scan"](spark, SF_MID).collect():
        labels, score = plain_licenses(texts[r.doc_id])
        assert (r.labels, r.score) == (labels, pytest.approx(score)), r.doc_id


def test_op5_words_of_a_notice_in_another_order(spark):
    rng = np.random.default_rng(5)
    rows = []
    for t in license_scan.TEMPLATES:
        w = t.text.split()
        pairs = [w[i:i + 2] for i in range(len(w) - 1)]
        rows += [" ".join(x for p in pairs[::-1] for x in p), " ".join(w[::-1]), " ".join(rng.permutation(w)),
                 " ".join([*w[:len(w) // 2], *(["and"] * 9), *w[len(w) // 2:]]), f"{t.text} {t.text} so {t.text}"]
        for _ in range(6):                                          # words put in, left out and replaced
            e = list(w)
            for _ in range(rng.integers(1, 5)):
                i = int(rng.integers(0, len(e) + 1))
                e[i:i + rng.integers(0, 2)] = ["odd"] * int(rng.integers(0, 2))
            rows.append(" ".join(e))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, text in enumerate(rows):
        labels, score = plain_licenses(text)
        assert (got[i].labels, got[i].score) == (labels, pytest.approx(score)), text
    notice = license_scan.TEMPLATES[4].text.split()
    reverse = " ".join(x for i in range(len(notice) - 2, -1, -1) for x in notice[i:i + 2])
    assert plain_licenses(reverse) == ("", 0.0)
    spans = license_scan.find_spans(docs.where(F.col("text").contains(" so "))).where("label is not null and not base")
    assert spans.groupBy("doc_id", "label").count().where("count < 3").count() == 0


def test_op8_against_plain_sketches(spark):
    rows = QUERIES["op8_fingerprint"](spark, SF_SMALL).collect()
    texts = texts_of(SF_SMALL)
    ids = sorted(texts)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    below = -(1 << 63) + (1 << 62)

    def plain(t):
        w = WORD.findall(t)
        runs = [w[i:i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w] if w else []
        out = set()
        for run in runs:
            h = 42
            for x in run:
                h = xxhash.xxh64_intdigest(x.encode(), seed=h)
            out.add(h - (1 << 64) if h >> 63 else h)
        low = [h for h in out if h < below]
        return sorted(low) if low else sorted(out)[:1]

    text_of = lambda s: ",".join(format(h & ((1 << 64) - 1), "x") for h in s)
    share = lambda a, b: 1.0 if not a and not b else len(set(a) & set(b)) / max(1, len(a))
    assert len(rows) == len(texts)
    for r in rows:
        t, u = texts[r.doc_id], texts[after[r.doc_id]]
        q = len(t) // 4
        e = t[:len(t) - q] + u[:q]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (text_of(plain(t)), text_of(plain(e)))
        assert (r.near_edited, r.near_next) == (share(plain(t), plain(e)), share(plain(t), plain(u)))


def test_op10_catches_toxic_and_leaves_clean(spark):
    rows = QUERIES["op10_toxicity"](spark, SF_MID).collect()
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_MID}/labels.parquet'").fetchall())
    hit = [r.is_toxic for r in rows if label.get(r.doc_id) == 1]
    clean = [r.is_toxic for r in rows if label.get(r.doc_id) == 0]
    assert np.mean(hit) > 0.8 and np.mean(clean) < 0.02


def test_op10_later_models_see_earlier_out_of_fold_probabilities():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4)).astype(np.float32)
    first = (x[:, 0] > 0).astype(float)
    second = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(float)
    models = toxicity.fit_chain(x, [first, second], np.ones(900), np.arange(900) % 3)
    assert [len(m) for m in models] == [5, 6] and models[1][4] > 0.1
    chain = toxicity.Chain(("a",), ("first", "second"), models)
    p = chain.probabilities(x)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.97 and ((p[:, 1] > 0.5) == second).mean() > 0.85


def test_word_hashes_are_those_of_the_words(monkeypatch):
    raw = ("aa b\tccc\n" * 40 + "é日 x" + " " * 9 + "longer" * 30).encode()
    whole = base.WordHasher()(raw)
    one = base.WordHasher()
    assert whole.tolist() == [int(one(w)[0]) for w in raw.split()]
    monkeypatch.setattr(base.WordHasher, "PIECE", 16)           # pieces end at white space, whatever their size
    assert base.WordHasher()(raw).tolist() == whole.tolist()
    assert len(set(whole.tolist())) == len(set(raw.split())) and len(base.WordHasher()(b"")) == 0
