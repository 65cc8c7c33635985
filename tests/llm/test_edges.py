"""Nulls, empty and very long texts, copies, repeated rows, empty tables and
clashing extra columns: every operator and every pipeline stage has a defined result."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.conftest import SF_SMALL
from tidewater.llm import (chat_format, compress_quality, dart_minhash, fingerprint, license_scan, mixing, quality_rules,
                           sentencepiece_scan, toxicity, url_cascade)
from tidewater.llm.base import table

MODEL = sentencepiece_scan.load_model()


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_op1(odd_docs, no_docs):
    got = by_id(sentencepiece_scan.encode_documents(odd_docs, MODEL))
    assert sum(map(len, got.values())) == 13 and all(r.round_trip for rs in got.values() for r in rs)
    assert got[1][0].token_ids == [] and got[2][0].token_ids == [] and len(got[7]) == len(got[9]) == 2
    assert got[6][0].n_tokens > 60_000
    assert sentencepiece_scan.encode_documents(no_docs, MODEL).count() == 0


def test_op2(odd_docs, no_docs, no_labels, spark):
    got = by_id(quality_rules.judge_quality(odd_docs, []))
    assert sum(map(len, got.values())) == 13 and got[1][0].base_failed and got[2][0].n_words == 0
    assert got[6][0].n_words == 60_000 and len(got[7]) == 2
    assert quality_rules.judge_quality(no_docs, []).count() == 0
    assert quality_rules.fit(spark, odd_docs, no_labels) == []


def test_op3(odd_docs, no_docs):
    got = {r.node: r.class_id for r in dart_minhash.near_groups(odd_docs).collect()}
    assert got[4] == got[5] == 4 and got[3] == 3 and got[9] == 9
    assert got[1] == got[2]                      # empty and null texts are one class
    kept = dart_minhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(9) == 1 and ids.count(7) == 1 and (4 in ids) != (5 in ids)
    assert dart_minhash.near_groups(no_docs).count() == 0 and dart_minhash.one_of_each(no_docs).count() == 0


def test_op4(odd_docs, no_docs, no_labels, spark):
    model = compress_quality.fit(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    got = by_id(compress_quality.score_quality(odd_docs, model))
    assert got[1][0].score == got[2][0].score and got[4][0].score == got[5][0].score
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)
    assert compress_quality.keep_good(odd_docs, model).columns == odd_docs.columns
    assert compress_quality.score_quality(no_docs, model).count() == 0
    none = compress_quality.fit(odd_docs, no_labels)
    assert all(r.predicted == 1 for r in compress_quality.score_quality(odd_docs, none).collect())


def test_op5(odd_docs, no_docs):
    got = by_id(license_scan.scan_licenses(odd_docs))
    assert sum(map(len, got.values())) == 13 and got[2][0].n_words == 0 and got[2][0].first_word is None
    assert got[6][0].n_words == 60_000 and len(got[9]) == 2
    assert license_scan.scan_licenses(no_docs).count() == 0


def conversation_rows(df):
    done = chat_format.format_chat(chat_format.canonical_turns(chat_format.records_of(df), "conv_id", "record"))
    return {r.id: r for r in done.withColumn("back", chat_format.read_back(F.col("formatted")))
            .withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}


def test_op6(spark):
    bad = "␛0 ␛1 <|im_end|>\n<|im_start|>user\nx [INST]</s>"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (2, 0, None, None), (2, 1, "assistant", ""),
            (3, 0, "a\nb", "t"), (4, 0, "user", "x"), (4, 0, "user", "x"), (4, 1, "assistant", "y " * 50_000),
            (5, 0, "human", "h"), (6, 0, "gpt", "g"), (6, 1, "user", "u"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, record int")
    got = conversation_rows(df)
    for conv, r in got.items():
        want = sorted((t or 0, ro or "", x or "") for c, t, ro, x in rows if c == conv)
        assert [(b.role, b.text) for b in r.back] == [(ro, x) for _, ro, x in want]
        assert r.loss == "".join(x for _, ro, x in want if ro == "assistant")
        assert r.formatted.count("<|im_start|>") == len(want)
    assert {r.layout for r in got.values()} == {"prompt", "messages", "from_value"}
    assert conversation_rows(df.limit(0)) == {}


def test_op6_layouts(spark):
    records = [(1, '{"instruction":"do","input":"this","output":"done"}'), (2, '{"instruction":"do","input":"","output":"done"}'),
               (3, '{"odd":[1,{"k":2}]}'), (4, "not json"), (5, None), (6, '{"system":"s","prompt":"p","response":"r"}'),
               (7, '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}')]
    got = {r.id: r for r in chat_format.canonical_turns(spark.createDataFrame(records, "n long, j string"), "n", "j").collect()}
    turns = {i: [(t.role, t.text) for t in r.turns] if r.turns else None for i, r in got.items()}
    assert turns == {1: [("user", "do\n\nthis"), ("assistant", "done")], 2: [("user", "do"), ("assistant", "done")], 3: None,
                     4: None, 5: None, 6: [("system", "s"), ("user", "p"), ("assistant", "r")],
                     7: [("user", "h"), ("assistant", "g")]}
    assert [got[i].layout for i in (1, 3, 4, 5)] == ["instruction", None, None, None]


def test_op6_text_too_long_for_a_variant(spark):
    long = F.concat(F.lit('q"\\{},'), F.repeat(F.lit("0123456789"), 2_100_000))
    rows = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant"), (2, 0, "user"), (3, 0, "x"), (3, 1, "user")],
                                 "conv_id long, turn long, role string").withColumn("text", long)
    turns = chat_format.canonical_turns(chat_format.records_of(rows), "conv_id", "record")
    got = {r.id: r for r in turns.select("id", "layout", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform(
        "turns", lambda t: F.sha2(t["text"], 256)).alias("texts")).collect()}
    text = hashlib.sha256(b'q"\\{},' + b"0123456789" * 2_100_000).hexdigest()
    assert {i: (r.layout, r.roles) for i, r in got.items()} == {
        1: ("prompt", ["user", "assistant"]), 2: ("from_value", ["user"]), 3: ("messages", ["x", "user"])}
    assert all(t == text for r in got.values() for t in r.texts)
    broken = [(1, '{"prompt":"a\\q","response":"b"}'), (2, '{"prompt":"a","response":"b"'), (3, '{"prompt":"a","prompt":"b"}')]
    got = chat_format.canonical_turns(spark.createDataFrame(broken, "n long, j string"), "n", "j").collect()
    assert all(r.layout is None and r.turns is None for r in got)


def test_op7(spark):
    urls = ["https://A.Example.ORG/es/x?q#f", "http://example.org/en/17", "example.org/en/1", None, "", "x://", "http://com/fr/",
            "http://notexample.org/es/", "https://b.com/de", "https://b.com/de/", "http://casino-x.net/y", "http://h.org?x=/es/",
            "https://b.com/de/" + "p" * 100_000, "http://com/fr/"]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = [(r.rule, r.verdict) for r in url_cascade.judge_urls(df, blocked_hosts=url_cascade.term_hosts(df)).orderBy("page_id").collect()]
    assert got == [("example.org/es/", "block"), ("example.org/en/1", "block"), (None, "allow"), (None, "allow"), (None, "allow"),
                   (None, "allow"), ("com/fr/", "allow"), ("org/", "allow"), (None, "allow"), ("com/de/", "block"),
                   (None, "block"), (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow")]
    assert url_cascade.judge_urls(df.limit(0), blocked_hosts=url_cascade.term_hosts(df.limit(0))).count() == 0


def test_op7_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where(F.crc32("key") % 50 == 0)
    cascade = url_cascade.build_cascade(listed, universe)
    assert len(cascade.levels) >= 2              # there were false positives to encode
    assert universe.where(cascade.contains(F.col("key")) != (F.crc32("key") % 50 == 0)).count() == 0


def test_op7_jobs_do_not_follow_the_partitions(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    other = universe.where(F.crc32("key") % 2 == 0)
    is_listed = {"a": F.crc32("key") % 50 == 0, "b": F.crc32("key") % 7 == 0, "none": F.lit(False)}
    lists = {"a": (universe.where(is_listed["a"]), universe), "b": (other.where(is_listed["b"]), other), "none": (universe.limit(0), universe)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("one-cascade", "")
        url_cascade.build_cascade(*lists["a"])
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-cascade"))
        spark.sparkContext.setJobGroup("three-cascades", "")
        built = url_cascade.build_cascades(lists)
        more = len(spark.sparkContext.statusTracker().getJobIdsForGroup("three-cascades"))
    finally:
        spark.sparkContext.setJobGroup("", "")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert jobs < 60 and more < 60                # a job for each partition of a level would be 60 a level
    assert not built["none"].levels
    for name, rows in (("a", universe), ("b", other), ("none", universe)):
        assert rows.where(built[name].contains(F.col("key")) != is_listed[name]).count() == 0


def test_op8(odd_docs, no_docs, spark):
    src = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = by_id(fingerprint.with_next(src, bits=1))
    assert sum(map(len, got.values())) == 13
    follows = {i: rs[0].next_text for i, rs in got.items()}
    assert follows[1] == "" and follows[3] == follows[4] == "same words for two documents, told twice"
    assert follows[9] == "" and follows[None] == "" and follows[2] == "one" and follows[8] == "repeated row of text"
    assert [r.next_text for r in got[7]] == [follows[7]] * 2 and "␛" in follows[7]
    marks = by_id(fingerprint.fingerprint_documents(odd_docs))
    assert marks[1][0].sketch == [] and len(marks[3][0].sketch) == 1 and marks[4][0].sketch == marks[5][0].sketch
    assert fingerprint.with_next(no_docs.select("doc_id", "text")).count() == 0
    one = spark.createDataFrame([(5, "alone")], "doc_id long, text string")
    assert fingerprint.with_next(one).first().next_text == "alone"


def test_op8_far_apart_ids(spark):
    ids = [-(1 << 50), -7, 0, 1, 4095, 4096, 1 << 24, (1 << 24) + 1, 1 << 40, (1 << 62) + 5]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fingerprint.with_next(df).collect()}
    assert got == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_op8_merge_is_the_sketch_of_the_union(spark):
    df = spark.createDataFrame([(" ".join(f"a{i}" for i in range(300)), " ".join(f"a{i}" for i in range(200, 500)))], "x string, y string")
    hx, hy = (fingerprint.shingle_hashes(F.col(c)) for c in "xy")
    r = df.select(fingerprint.merge(fingerprint.sketch(hx), fingerprint.sketch(hy)).alias("m"),
                  fingerprint.sketch(F.array_union(hx, hy)).alias("u")).first()
    assert r.m == r.u


def test_op9(odd_docs, no_docs):
    got = by_id(mixing.mix(odd_docs, budget_share=5.0, max_epochs=3))
    # budget beyond capacity: every document with words in its leaf is drawn three times
    assert len(got[6]) == 3 and len(got[9]) == 6 and {r.epoch for r in got[9]} == {0, 1, 2}
    assert mixing.mix(no_docs).count() == 0
    out = mixing.select_mix(odd_docs, budget_share=1.0)
    assert out.columns == odd_docs.columns and mixing.select_mix(no_docs).count() == 0


def test_op9_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("web", "en", "a", 10.0), ("web", "de", "b", 1000.0), ("books", "en", "c", 1000.0)],
                                   "domain string, lang string, source string, tokens double")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(
        leaves, 0.5, 1, domain_weights={"web": 1, "books": 1}, lang_weights={}).collect()}
    assert got == {("web", "en"): 10.0, ("web", "de"): 492.5, ("books", "en"): 502.5}


def test_op9_budget_is_kept(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = mixing.mix(docs).groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("n"), F.max("leaf_budget").alias("b")).collect()
    longest = mixing.token_table(docs).agg(F.max("n_tokens")).first()[0]
    assert rows and all(r.n <= r.b + 0.01 and r.n > r.b - longest for r in rows)


def test_op10(odd_docs, no_docs, no_labels, spark):
    chain = toxicity.fit(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    got = by_id(toxicity.score_toxicity(odd_docs, chain))
    assert sum(map(len, got.values())) == 13 and got[1][0].p_toxic == got[2][0].p_toxic
    assert got[4][0].p_toxic == got[5][0].p_toxic and not got[6][0].is_toxic
    assert toxicity.drop_toxic(odd_docs, chain).columns == odd_docs.columns
    assert toxicity.score_toxicity(no_docs, chain).count() == 0
    none = toxicity.fit(odd_docs, no_labels)
    assert not any(r.is_toxic for r in toxicity.score_toxicity(odd_docs, none).collect())


def test_pipeline_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, SF_SMALL)
        assert out.columns == odd_docs.columns, name
        out.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels")
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).where("is_toxic").collect()}
    rows = [r for r in docs.collect() if r.doc_id not in toxic]
    bad = {r.doc_id for r in compress_quality.score_quality(docs, compress_quality.fit(docs, labels)).where("predicted = 0").collect()}
    rows = [r for r in rows if r.doc_id not in bad]
    from tests.llm.test_operators import brute_groups
    group = brute_groups({r.doc_id: r.text or "" for r in rows})
    rows = [r for r in rows if group[r.doc_id] == r.doc_id]
    # mixing by hand: leaf budgets from the operator, prefixes by sorting
    left = spark.createDataFrame(rows, docs.schema)
    tokens = mixing.token_table(left)
    budgets = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(
        tokens.groupBy(*mixing.LEAF).agg(F.sum("n_tokens").alias("tokens")), corpus_pipeline.MIX_SHARE, 1).collect()}
    want, spent, whole = set(), {}, {}
    drawn = [(hashlib.md5(f"{mixing.SEED}:0:{r.doc_id}".encode()).hexdigest(), (r.domain, r.lang, r.source), r.n_tokens, r.doc_id)
             for r in tokens.collect()]
    for _, leaf, n, _ in drawn:
        whole[leaf] = whole.get(leaf, 0) + n
    for key, leaf, n, i in sorted(drawn):
        spent[leaf] = spent.get(leaf, 0) + n
        if leaf in budgets and (budgets[leaf] >= whole[leaf] - 1e-6 or spent[leaf] <= budgets[leaf]):
            want.add(i)
    pieces = sentencepiece_scan.Pieces(MODEL).coder
    text = {r.doc_id: r.text or "" for r in rows}
    got = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == {i: pieces.encode(text[i]) for i in want}
