"""Quality classifier by compression.

Two zstandard dictionaries are made, one from good and one from bad labelled
text.  A text is compressed with each, in blocks of 8 KiB so that the
dictionary still tells in long texts, and the difference of the compressed
sizes over the text's bytes says which kind it resembles.  A logistic
calibration, fitted on other labelled rows, turns that difference and the
better of the two compressed shares (repeated text is small under both) into a
probability of label 1.

Labelled rows split by crc32(doc_id) mod 3: 0 makes the dictionaries, 2 the
calibration, 1 is held out.  Only the text enters a score.

Defined results: null and empty texts have the score of the labelled rows'
share of label 1 among short texts, i.e. the calibration at difference 0;
equal texts have equal scores; repeated rows each get a row; without labelled
rows of both classes every score is the share of label 1 (1.0 if there are no
labels); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import fresh, pick, register, table
from tidewater.llm.quality_rules import labelled_sample

#: At most so many labelled rows of each class for dictionaries, and for calibration.
MAX_ROWS_PER_CLASS = 1500
DICT_BYTES = 112_640
#: At most so many bytes of sample text go into one dictionary's training.
MAX_TRAIN_BYTES = 8 << 20
BLOCK = 8192
LEVEL = 3


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def make_dictionary(texts: list[str]) -> bytes:
    """A dictionary of typical passages of the texts; raw text if they are too few to train on."""
    sample, size = [], 0
    for b in (b for t in texts for b in blocks(t)):
        if size >= MAX_TRAIN_BYTES:
            break
        sample.append(b)
        size += len(b)
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(size // 4, 1024)), sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-DICT_BYTES:]


class Sizer:
    """Compressed sizes under two dictionaries (made once in each task)."""

    def __init__(self, good: bytes, bad: bytes):
        self.coders = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                        write_checksum=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, float]:
        """(bad size - good size) / bytes, smaller size / bytes."""
        parts = blocks(text)
        if not parts:
            return 0.0, 0.0
        good, bad = (sum(len(c.compress(b)) for b in parts) for c in self.coders)
        n = sum(map(len, parts))
        return (bad - good) / n, min(good, bad) / n


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    center: tuple[float, float]
    scale: tuple[float, float]
    weights: tuple[float, float, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.center)) / np.array(self.scale) @ np.array(self.weights[:2]) + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple:
    """Weighted logistic regression on two features by Newton's method."""
    center, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - center) / scale, np.ones(len(x))]
    b = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (p - y)) + 1e-3 * b
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(3)
        b = b - np.linalg.solve(hess, grad)
    return tuple(center.tolist()), tuple(scale.tolist()), tuple(b.tolist())


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def fit(docs: DataFrame, labels: DataFrame, per_class: int = MAX_ROWS_PER_CLASS) -> Model:
    """Dictionaries and calibration from bounded samples of labelled rows outside the held-out fold."""
    learn = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 1))
    sample = lambda f: (labelled_sample(docs, learn.where(fold(F.col("doc_id")) == f), "quality", per_class)
                        .toPandas().sort_values(["doc_id", "text"], kind="stable"))
    texts, rest = sample(0), sample(2)
    counts = {r["quality"]: r["n"] for r in learn.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    good, bad = (make_dictionary(list(texts["text"][texts["label"] == v].dropna())) for v in (1, 0))
    y = rest["label"].to_numpy(dtype=float)
    if len(set(y)) < 2 or not good or not bad:
        share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 1.0
        logit = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Model(b"", b"", (0.0, 0.0), (1.0, 1.0), (0.0, 0.0, logit))
    sizer = Sizer(good, bad)
    x = np.array([sizer.features(t) for t in rest["text"]])
    # the sample is capped for each class: weights bring back the classes' shares
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    return Model(good, bad, *calibrate(x, y, weight / weight.mean()))


def score_column(model: Model, text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad) if model.good else None
        for batch in batches:
            x = [sizer.features(t) if sizer else (0.0, 0.0) for t in batch]
            yield pd.Series(model.scores(np.array(x, dtype=float).reshape(-1, 2)))

    return F.pandas_udf(run, "double")(text)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    out = pick(docs, doc_id=id_col, text=text_col).select("doc_id", score_column(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows predicted 0; all columns as they were."""
    name = fresh(docs, "quality_score")
    return docs.withColumn(name, score_column(model, F.col("text"))).where(F.col(name) >= 0.5).drop(name)


@register("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")
