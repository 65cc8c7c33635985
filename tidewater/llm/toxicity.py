"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models; each later
model also sees the earlier categories' probabilities.  In training those are
out-of-fold predictions, so a later model learns from probabilities as unsure
as the ones it will meet.

Features are rates of terms (lower-cased words, and word beginnings of 5 to 7
characters, which catch inflected and compounded forms in any language) and a
few shape statistics.  Which terms matter is counted by Spark over the labelled
sample; the driver fits the models on a matrix of bounded size.

Defined results: a null or empty text has no terms and the models' intercept
scores; equal texts have equal scores; repeated rows each get a row; without
labelled rows of both kinds nothing is toxic; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import fresh, pick, register, stored, table
from tidewater.llm.quality_rules import labelled_sample

#: At most so many labelled rows of each class are used to fit the chain.
MAX_ROWS_PER_CLASS = 2500
MAX_TERMS = 1200
FOLDS = 3
#: Categories in chain order, as conditions on the labels table.  Earlier ones
#: are wider or easier; the last is the verdict.
CATEGORIES = (
    ("unclean", "toxic = 1 or quality = 0"),
    ("toxic_junk", "toxic = 1 and quality = 0"),
    ("toxic", "toxic = 1"),
)
SHAPES = 5
_WORD = re.compile(r"[^\W_]+")


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings of 5 to 7 characters."""
    return [word, *("^" + word[:n] for n in range(5, 8) if len(word) > n)]


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def _shape(text: str, n_words: int, n_distinct: int) -> list[float]:
    n = max(len(text), 1)
    marks = sum(text.count(c) for c in "#*$%&|<>")
    return [min(10 * marks / n, 2.0), min(10 * text.count("!") / n, 2.0), n_distinct / max(n_words, 1),
            float(n_words < 20), min(text.count("\n") / max(n_words, 1), 1.0)]


class Featurizer:
    """Text -> (indexes, values) of the chosen terms' rates, and the shape statistics."""

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > 100_000:
                self.cache.clear()
            got = self.cache[word] = tuple(self.index[t] for t in terms_of(word) if t in self.index)
        return got

    def rows(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), len(self.index) + SHAPES), dtype=np.float32)
        for r, text in enumerate(texts):
            text = text or ""
            words = _WORD.findall(text.lower())
            for w in words:
                for i in self.hits(w):
                    out[r, i] += 1.0
            rate = 100.0 / max(len(words), 50)
            out[r, :len(self.index)] = np.minimum(out[r, :len(self.index)] * rate, 3.0)
            out[r, len(self.index):] = _shape(text, len(words), len(set(words)))
        return out


@dataclass(frozen=True)
class Chain:
    terms: tuple[str, ...]
    names: tuple[str, ...]
    weights: tuple[np.ndarray, ...]         # each: features + earlier probabilities + 1

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """One column for each category, in chain order."""
        earlier: list[np.ndarray] = []
        for w in self.weights:
            earlier.append(_apply(w, x, earlier))
        return np.column_stack(earlier) if earlier else np.zeros((len(x), 0))


def _apply(w: np.ndarray, x: np.ndarray, earlier: list[np.ndarray]) -> np.ndarray:
    n = x.shape[1]
    z = x @ w[:n] + sum((p * c for p, c in zip(earlier, w[n:-1])), np.float32(0)) + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 2e-4, steps: int = 250) -> np.ndarray:
    """Weighted logistic regression by accelerated gradient steps."""
    x1 = np.column_stack([x, np.ones(len(x), dtype=np.float32)]).astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)
    # a bound of the loss's curvature, from a few power iterations
    v = np.ones(x1.shape[1], dtype=np.float32)
    for _ in range(12):
        v = x1.T @ (weight * (x1 @ v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    rate = 1.0 / (0.25 * norm * 1.05 + l2)
    y = y.astype(np.float32)
    w = prior = np.zeros(x1.shape[1], dtype=np.float32)
    keep = np.r_[np.ones(x1.shape[1] - 1), 0.0].astype(np.float32)
    for t in range(steps):
        at = w + np.float32(t / (t + 3)) * (w - prior)
        p = 1 / (1 + np.exp(-np.clip(x1 @ at, -30, 30)))
        grad = x1.T @ (weight * (p - y)) + np.float32(l2) * keep * at
        prior, w = w, at - np.float32(rate) * grad
    return w.astype(np.float64)


def fit_chain(x: np.ndarray, ys: list[np.ndarray], weight: np.ndarray, folds: np.ndarray) -> tuple[np.ndarray, ...]:
    """The models of all categories; later ones are trained with the earlier
    categories' out-of-fold probabilities as further columns."""
    models, seen = [], x
    for y in ys:
        held = np.zeros(len(y))
        for f in range(FOLDS):
            rest, out = folds != f, folds == f
            if out.any() and rest.any():
                held[out] = _apply(fit_linear(seen[rest], y[rest], weight[rest]), seen[out], [])
        models.append(fit_linear(seen, y, weight))
        seen = np.column_stack([seen, held.astype(np.float32)])
    return tuple(models)


def choose_terms(sample: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """The terms whose document frequencies differ most between toxic and other
    rows, counted by Spark over the sample (columns text, label)."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted({t for w in word_counts(x) for t in terms_of(w)}) for x in batch])

    per_doc = sample.select("label", F.explode(F.pandas_udf(run, "array<string>")("text")).alias("term"))
    counts = per_doc.groupBy("term").agg(F.sum("label").cast("double").alias("a"),
                                         F.sum(1 - F.col("label")).cast("double").alias("b"))
    sizes = sample.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).first()
    na, nb = float(sizes["a"] or 0), float(sizes["b"] or 0)
    if not na or not nb:
        return []
    pa, pb = F.col("a") / na, F.col("b") / nb
    p = (F.col("a") + F.col("b")) / (na + nb)
    z = F.abs(pa - pb) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / na + 1 / nb))
    top = counts.where("a + b >= 3").select("term", z.alias("z")).orderBy(F.col("z").desc(), "term").limit(limit)
    return [r["term"] for r in top.collect()]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = MAX_ROWS_PER_CLASS, categories=CATEGORIES) -> Chain:
    """The chain, from a bounded sample of labelled rows of either kind."""
    names = tuple(n for n, _ in categories)
    marks = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"),
                                                                 F.min("quality").alias("quality"))
    marks = marks.select("doc_id", "toxic", *[F.coalesce(F.expr(f"cast(({c}) as int)"), F.lit(0)).alias(n)
                                              for n, c in categories if n != "toxic"])
    sample = stored(labelled_sample(docs, marks, "toxic", per_class).select("doc_id", "text", "label"), "toxic-sample")
    terms = choose_terms(sample)
    if not terms:
        return Chain((), names, ())
    rows = (sample.join(F.broadcast(marks.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id")), "doc_id")
            .toPandas().sort_values(["doc_id", "text"], kind="stable").drop_duplicates(["doc_id", "text"]))
    x = Featurizer(terms).rows(list(rows["text"]))
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    label = rows["label"].to_numpy()
    weight = np.where(label == 1, counts[1] / (label == 1).sum(), counts[0] / (label == 0).sum())
    folds = (rows["doc_id"].to_numpy().astype(np.int64) % FOLDS)
    ys = [rows[n].to_numpy(dtype=float) for n in names]
    return Chain(tuple(terms), names, fit_chain(x, ys, weight, folds))


def chain_column(chain: Chain, text: Column) -> Column:
    """A struct of the categories' probabilities."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Featurizer(list(chain.terms))
        for batch in batches:
            texts, parts = list(batch), []
            for i in range(0, len(texts), 256):
                parts.append(chain.probabilities(features.rows(texts[i:i + 256])))
            yield pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, len(chain.names))), columns=list(chain.names))

    if not chain.weights:
        return F.struct(*[F.lit(0.0).alias(n) for n in chain.names])
    return F.pandas_udf(run, ", ".join(f"{n} double" for n in chain.names))(text)


def score_toxicity(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a probability for each category, is_toxic (the last one's verdict) of every row."""
    out = pick(docs, doc_id=id_col, text=text_col).select("doc_id", chain_column(chain, F.col("text")).alias("p"))
    return out.select("doc_id", *[F.col(f"p.{n}").alias(f"p_{n}") for n in chain.names],
                      (F.col(f"p.{chain.names[-1]}") >= 0.5).alias("is_toxic"))


def drop_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without the rows judged toxic; all columns as they were."""
    name = fresh(docs, "toxicity")
    return docs.withColumn(name, chain_column(chain, F.col("text"))).where(
        F.col(name)[chain.names[-1]] < 0.5).drop(name)


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
