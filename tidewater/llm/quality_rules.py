"""Quality rules as a learned decision list.

Text statistics of every document are computed in Arrow batches.  From a
bounded sample of labelled statistics a sequential-covering learner makes an
ordered list of rules: grow a conjunction of thresholds by FOIL gain on two
thirds of the sample, prune it on the last third, keep it while it is precise
there, remove what it covers, go on.  The list is emitted as one ordered Spark
CASE expression over the statistics columns, so it applies to all rows inside
the plan and can be read as it stands.

Words are runs of anything but 0x20 and 0x09-0x0D.  Defined results: a null or
empty text has all counts 0 and fails the base rule; repeated rows each get a
row; null ids stay null; with no labelled rows, or none of one class, the list
is empty and keeps everything; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import pick, register, table

#: At most so many labelled rows of each class are used to learn the rules.
MAX_ROWS_PER_CLASS = 4000
WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
STATS_SCHEMA = BASE_SCHEMA + (", n_lines long, n_bangs long, n_upper long, n_digits long, n_letters long,"
                              " n_distinct long, max_word long, top_word long")
#: Statistics the rules may test: name -> expression over the columns of STATS_SCHEMA.
FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "bang_share": "n_bangs / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_letters, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "letter_share": "n_letters / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "top_word_share": "top_word / greatest(n_words, 1)",
    "max_word": "max_word",
}


def repeated_window_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found at least twice.  Runs are
    named exactly by doubling: pairs of pairs get the rank of their names."""
    n = len(ids)
    if n <= window:
        return 0
    names, span = ids.astype(np.int64), 1
    while span < window:
        step = min(span, window - span)
        joined = names[:len(names) - step] * np.int64(n + 1) + names[step:]
        names = np.unique(joined, return_inverse=True)[1].astype(np.int64)
        span += step
    twice = np.bincount(names)[names] > 1
    edge = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_stats(text: str | None) -> tuple:
    """The values of STATS_SCHEMA for one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    codes = np.frombuffer(raw, dtype=np.uint8)
    count = np.bincount(codes, minlength=256)
    n_upper, n_lower = int(count[65:91].sum()), int(count[97:123].sum())
    counts = np.bincount(ids) if len(ids) else np.zeros(1, dtype=np.int64)
    return (len(words), len(text) - int(sum(count[ord(c)] for c in SPACES)), int(sum(count[ord(c)] for c in SYMBOLS)),
            len(lines) - len(set(lines)), repeated_window_words(ids), len(lines), int(count[33]), n_upper,
            int(count[48:58].sum()), n_upper + n_lower + int(count[192:].sum()), len(seen),
            max(map(len, seen), default=0), int(counts.max()))


def _stats(text: str) -> Column:
    names = [c.split()[0] for c in STATS_SCHEMA.split(",")]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([text_stats(t) for t in batch], columns=names)

    return F.pandas_udf(run, STATS_SCHEMA)(text)


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics columns of every row."""
    src = pick(docs, doc_id=id_col, text=text_col)
    return src.select("doc_id", _stats("text").alias("s")).select("doc_id", "s.*")


@dataclass(frozen=True)
class Rule:
    """All ``tests`` (feature, op, threshold) hold -> the row is rejected."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.tests:
            value = F.expr(f"cast({FEATURES[name]} as double)")
            out = out & (value >= at if op == ">=" else value <= at)
        return out

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), dtype=bool)
        for name, op, at in self.tests:
            hit &= x[name] >= at if op == ">=" else x[name] <= at
        return hit

    def __str__(self) -> str:
        return " and ".join(f"{n} {o} {a:.6g}" for n, o, a in self.tests)


def _precision(p: float, n: float) -> float:
    return (p + 1) / (p + n + 2)


def _grow(x, bad, tests=()) -> Rule:
    """Add the threshold of greatest FOIL gain until no clean row is covered."""
    hit = Rule(tests).covers(x)
    while (n0 := (hit & ~bad).sum()) and len(tests) < 4:
        p0 = (hit & bad).sum()
        best = (1e-9, None)
        for name, v in x.items():
            for at in np.unique(np.quantile(v[hit], np.linspace(0, 1, 41))):
                for op in (">=", "<="):
                    got = hit & (v >= at if op == ">=" else v <= at)
                    p, n = (got & bad).sum(), (got & ~bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(max(p0, 1) / (p0 + n0)))
                        best = max(best, (gain, (name, op, float(at))), key=lambda b: b[0])
        if best[1] is None:
            break
        tests = (*tests, best[1])
        hit = Rule(tests).covers(x)
    return Rule(tests)


def _prune(rule: Rule, x, bad) -> Rule:
    """The shortest prefix of tests with the best precision on the pruning rows."""
    value = lambda r: _precision((r.covers(x) & bad).sum(), (r.covers(x) & ~bad).sum())
    cuts = [Rule(rule.tests[:k]) for k in range(1, len(rule.tests) + 1)]
    return max(cuts, key=lambda r: (round(value(r), 6), -len(r.tests)), default=rule)


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.95, max_rules: int = 16,
                seed: int = 7) -> list[Rule]:
    """An ordered list of rejecting rules by sequential covering."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    prune_row = np.random.default_rng(seed).random(len(bad)) < 1 / 3
    sub = lambda rows: {k: v[rows] for k, v in x.items()}
    while len(rules) < max_rules and (left & bad & ~prune_row).any():
        g, p = left & ~prune_row, left & prune_row
        rule = _prune(_grow(sub(g), bad[g]), sub(p), bad[p])
        hit = rule.covers(x)
        good_p, bad_p = (hit & p & ~bad).sum(), (hit & p & bad).sum()
        all_good, all_bad = (hit & left & ~bad).sum(), (hit & left & bad).sum()
        if not rule.tests or bad_p < 1 or all_bad < 5 or min(
                bad_p / (bad_p + good_p), all_bad / (all_bad + all_good)) < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the number (from 1) of the
    first rule that rejects the row, 0 if none does."""
    out = F.lit(0)
    for n in range(len(rules), 0, -1):
        out = F.when(rules[n - 1].column(), F.lit(n)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text, label: at most ``per_class`` labelled rows of either class,
    by hash of the id.  The chosen ids (their number is bounded) are broadcast,
    so the texts of all other documents stay where they are."""
    marks = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    spread = lambda v: marks.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    chosen = spread(0).unionByName(spread(1))
    return pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = MAX_ROWS_PER_CLASS) -> list[Rule]:
    sample = labelled_sample(docs, labels, "quality", per_class)
    stats = sample.select("doc_id", "label", _stats("text").alias("s")).select("doc_id", "label", "s.*")
    rows = (stats.select("doc_id", "label", *[F.expr(f"cast({e} as double)").alias(n) for n, e in FEATURES.items()])
            .toPandas().sort_values(["doc_id", *FEATURES]))
    x = {n: rows[n].to_numpy() for n in FEATURES}
    return learn_rules(x, rows["label"].to_numpy() == 0) if len(rows) else []


def judge_quality(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, statistics, base_failed, rule (0: none fits) and kept of every row."""
    out = document_stats(docs, id_col, text_col).withColumn("base_failed", base_failed())
    return out.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = judge_quality(docs, fit(spark, docs, labels))
    return out.select("doc_id", *[c.split()[0] for c in BASE_SCHEMA.split(", ")], "base_failed", "kept",
                      F.col("rule").cast("long").alias("rule"))
