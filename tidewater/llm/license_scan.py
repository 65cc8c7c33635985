"""License scans by diagonal voting.

A license template is a word sequence.  Every rolling word k-gram of a document
is hashed; the hashes are joined to the templates' k-gram positions, and each
match votes for its diagonal (document position - template position).  Votes are
summed by (document, template, diagonal); a diagonal and those up to ``DRIFT``
further (words put in or left out) are merged, and as a diagonal is no longer than its template, so do
their spans meet.  A merged span is verified by order: the longest run of its matches in
which document and template positions both rise, as a share of the template's words.
Of merged spans that lie within ``DRIFT`` of each other the best is kept (ties: the first diagonal).

A document's k-grams whose hash is in no template cannot vote, so the scan
leaves them out before the join: the hash set of the templates is small and its
size is known.  Each match row carries its words, and the join compares them
too, so a vote is never a hash collision.

Base phrases are short templates that must match whole, on one diagonal.  The
longer templates add the method's own labels.

Words: the text with A-Z lower-cased, runs of 0-9, a-z and characters from
U+0080.  Defined results: a null or empty text has no words and no places;
very long texts are scanned whole; repeated rows each get a row; null ids stay null; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import WordHasher, pick, register, table

GRAM = 2
#: Diagonals this far apart (in words) can be one span with words put in or left out.
DRIFT = 3
#: A template counts as found from this share of its words on; one of few words
#: must stand whole, as a single other word makes it another license.
MIN_SHARE = 0.75
WHOLE_UNTIL = 8
MAX_TEMPLATE_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False              # a phrase of the contract: must stand as it is


#: The contract's phrases, then common license notices.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("mit", "released under the MIT License"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                    " and associated documentation files"),
    Template("apache", "licensed under the Apache License Version 2.0"),
    Template("gpl", "this work is licensed under the GNU General Public License version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the"
                    " GNU General Public License"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0"),
    Template("cc-by", "licensed under CC BY 4.0"),
    Template("cc0", "CC0 1.0 Universal"),
    Template("mpl", "Mozilla Public License Version 2.0"),
    Template("all-rights", "all rights reserved"),
)

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))


def spaced(text: str | None) -> bytes:
    """A whole text as UTF-8, lower-cased, with spaces for all that is no word."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS)


def words_of(text: str | None) -> list[bytes]:
    return spaced(text).split()


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rolling 64-bit hashes of all runs of ``k`` word hashes."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + len(out)]
    return out


def _gram_hash(words: list[str]) -> int:
    """The hash of one k-gram, as a signed 64-bit number."""
    return int(gram_hashes(WordHasher()(" ".join(words).encode()), len(words)).view(np.int64)[0])


def template_positions(spark: SparkSession, templates=TEMPLATES, k: int = GRAM) -> DataFrame:
    """template, label, base, size (grams), at, hash, gram: one row per template k-gram."""
    rows = []
    for n, t in enumerate(templates):
        w = [x.decode() for x in words_of(t.text)]
        if len(w) < k:
            raise ValueError(f"template {t.text!r} has fewer than {k} words")
        rows += [(n, t.label, t.base, len(w) - k + 1, i, _gram_hash(w[i:i + k]), " ".join(w[i:i + k])) for i in range(len(w) - k + 1)]
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{len(rows)} template k-grams: more than the {MAX_TEMPLATE_WORDS} that may be broadcast")
    return spark.createDataFrame(rows, "template int, label string, base boolean, size int, at int, hash long,"
                                       " gram string")


class Scanner:
    """Finds a text's k-grams that some template has."""

    def __init__(self, grams: list[str], k: int):
        self.k = k
        self.hashes = WordHasher()
        self.known = np.sort(np.array([_gram_hash(g.split(" ")) for g in grams], dtype=np.int64))

    def __call__(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        raw = spaced(text)
        hashes = self.hashes(raw)
        rolling = gram_hashes(hashes, self.k).view(np.int64)
        if not len(rolling):
            return len(hashes), [], [], []
        spot = np.minimum(np.searchsorted(self.known, rolling), len(self.known) - 1)
        hits = np.flatnonzero(self.known[spot] == rolling).tolist()
        words = raw.split() if hits else []
        return len(hashes), hits, rolling[hits].tolist(), [b" ".join(words[i:i + self.k]).decode("utf-8", "replace") for i in hits]


def scan_column(text: Column, templates=TEMPLATES, k: int = GRAM) -> Column:
    """struct(n_words, at, hash, gram): word count, and places, hashes and words of all template k-grams."""
    grams = sorted({" ".join(w[i:i + k]) for w in ([x.decode() for x in words_of(t.text)] for t in templates)
                    for i in range(len(w) - k + 1)})

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scan = Scanner(grams, k)
        for batch in batches:
            yield pd.DataFrame([scan(t) for t in batch], columns=["n_words", "at", "hash", "gram"])

    return F.pandas_udf(run, "n_words long, at array<long>, hash array<long>, gram array<string>")(text)


def rising_run(places: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(length, first, last document position) of the longest run of (document, template) positions in which both rise."""
    tails, ends, before = [], [], {}
    places = sorted(places, key=lambda p: (p[0], -p[1]))            # of one document position at most one is taken
    for n, (_, at) in enumerate(places):
        spot = bisect_left(tails, at)
        before[n] = ends[spot - 1] if spot else None
        tails[spot:spot + 1], ends[spot:spot + 1] = [at], [n]
    if not ends:
        return 0, 0, 0
    n = first = ends[-1]
    while before[first] is not None:
        first = before[first]
    return len(ends), places[first][0], places[n][0]


def _rising(merged: Column) -> Column:
    """struct(n, first, last): ``rising_run`` of diagonals with their template positions (JSON; null: none)."""
    def run(column: pd.Series) -> pd.DataFrame:
        out = []
        for text in column:
            lines = json.loads(text) if text else []
            out.append(rising_run([(d["diagonal"] + at, at) for d in lines for at in d["held"]]))
        return pd.DataFrame(out, columns=["n", "first", "last"])

    return F.pandas_udf(run, "n long, first long, last long")(merged)


def find_spans(docs: DataFrame, templates=TEMPLATES, k: int = GRAM, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """row_id, doc_id, n_words, and for every verified span: label, base,
    first_word, last_word (of the span, from 0), share.  A document without any
    span has one row with nulls there."""
    spark = docs.sparkSession
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("scan", scan_column(F.col("text"), templates, k))
    # documents without a vote are done; only matches are numbered, joined and shuffled
    rows = src.select("doc_id", F.col("scan.n_words").alias("n_words"),
                      F.arrays_zip(F.col("scan.at").alias("at"), F.col("scan.hash").alias("hash"),
                                   F.col("scan.gram").alias("gram")).alias("m"))
    rows = rows.withColumn("row_id", F.monotonically_increasing_id())
    votes = rows.select("row_id", "doc_id", "n_words", F.explode_outer("m").alias("m")).select(
        "row_id", "doc_id", "n_words", F.col("m.at").alias("pos"), F.col("m.hash").alias("hash"),
        F.col("m.gram").alias("gram"))
    votes = votes.join(F.broadcast(template_positions(spark, templates, k)), ["hash", "gram"], "left")
    votes = votes.withColumn("diagonal", F.col("pos") - F.col("at"))
    # one row for each place where the template was begun, on a diagonal: at most as many matches as it has k-grams
    lines = votes.groupBy("row_id", "doc_id", "n_words", "template", "label", "base", "size", "diagonal").agg(
        F.count("pos").alias("votes"), F.collect_list("at").alias("held"))
    words = F.col("size") + (k - 1)
    lines = lines.withColumn("alone", F.col("base") | (words <= WHOLE_UNTIL)).withColumn(
        "need", F.when(~F.col("alone"), F.ceil(words * MIN_SHARE) - (k - 1)))
    # a long template's diagonal meets those up to DRIFT further, if together they have votes enough
    by = Window.partitionBy("row_id", "template").orderBy("diagonal")
    ahead, behind, around = by.rangeBetween(0, DRIFT), by.rangeBetween(-DRIFT, 0), by.rangeBetween(-DRIFT, DRIFT)
    lines = lines.withColumn("enough", F.coalesce(F.sum("votes").over(ahead) >= F.col("need"), F.lit(False)))
    mine = F.when(F.max("enough").over(behind), F.struct("diagonal", "held"))
    lines = lines.withColumn("merged", F.collect_list(mine).over(ahead))
    lines = lines.withColumn("run", _rising(F.when(F.col("enough"), F.to_json("merged"))))
    whole = F.col("alone") & (F.col("votes") == F.col("size"))
    lines = lines.withColumn("n_held", F.when(whole, F.col("size")).when(F.col("run.n") >= F.col("need"), F.col("run.n")))
    best = F.max(F.when(~F.col("alone"), F.struct("n_held", -F.col("diagonal")))).over(around)
    spans = lines.withColumn("best", best).withColumn("fits", F.col("n_held").isNotNull() & (
        F.col("alone") | (F.col("best") == F.struct("n_held", -F.col("diagonal")))))
    spans = spans.withColumn("first_word", F.when(F.col("alone"), F.col("diagonal")).otherwise(F.col("run.first")))
    spans = spans.withColumn("last_word", F.when(F.col("alone"), F.col("diagonal") + words - 1).otherwise(F.col("run.last") + (k - 1)))
    share = (F.col("n_held") + (k - 1)) / words
    only = lambda c: F.when(F.col("fits"), c)
    return spans.select("row_id", "doc_id", "n_words", only(F.col("label")).alias("label"), only(F.col("base")).alias("base"),
                        only(F.col("first_word")).alias("first_word"), only(F.col("last_word")).alias("last_word"),
                        only(share).alias("share"))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, k: int = GRAM, **cols) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spans = find_spans(docs, templates, k, **cols)
    own = F.col("base")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (spans.groupBy("row_id", "doc_id", "n_words").agg(
        F.count_if(own).alias("n_base"), F.min(F.when(own, F.col("first_word"))).alias("first_word"),
        F.max(F.when(own, F.col("first_word"))).alias("last_word"),
        listed(F.when(own, F.col("label"))).alias("base_labels"), listed("label").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score")).drop("row_id"))


_PHRASES = [(t.label, " ".join(w.decode() for w in words_of(t.text))) for t in TEMPLATES if t.base]


@register("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
