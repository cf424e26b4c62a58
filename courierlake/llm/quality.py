"""A quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A text that resembles the
good ones compresses better with the good dictionary. The compressed sizes, normalised by the text's
size, and their differences become a calibrated score by a ridge logistic regression.

The model is fitted on a bounded sample of labelled rows: of each class the ``SAMPLE_ROWS`` rows whose
id has the smallest hash. For the calibration each half of it is measured against dictionaries built
from the other half, so that no text meets a dictionary that holds it. Class counts over all labelled rows weigh the sample.
Scoring reads every whole text and needs no shuffle.

Defined results: null text counts as empty; empty text has the sizes of empty output; without labels
of both classes every score is the share of good labels (0.5 without any); labels that contradict
each other for an id, null labels and null ids are not learnt from; a null id is not held out;
repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import whole_text

SAMPLE_ROWS = 4000
DICTIONARY_BYTES = 112_640
#: Long texts are shown to the dictionary builder in parts of this size.
PART_BYTES = 16_384
#: A dictionary is built from at most so many bytes of the sample.
BUILD_BYTES = 32 << 20
LEVEL = 3
RIDGE = 1e-5
THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Model:
    """Dictionaries, scaling and weights; small enough to travel with each task."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def build_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train on."""
    import zstandard

    parts, held = [], 0
    for text in texts:
        if held >= BUILD_BYTES:
            break
        parts += [text[k : k + PART_BYTES] for k in range(0, len(text), PART_BYTES)]
        held += len(text)
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard

    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=LEVEL)
    trained = dictionary[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)


def features(text: bytes, good: bytes, bad: bytes) -> list[float]:
    n = len(text) + 1
    a = len(_compressor(good).compress(text))
    b = len(_compressor(bad).compress(text))
    c = len(_compressor(b"").compress(text))
    return [(b - a) / n, (b - a) / max(a, b), a / n, b / n, c / n, math.log(n)]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ridge logistic regression by damped Newton steps: mean, scale, weights."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    ridge = RIDGE * weight.sum() * np.eye(a.shape[1])

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + w @ ridge @ w / 2)

    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        slope = a.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, slope)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if size * np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from labelled rows outside the held-out fold."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg(F.min(label).alias("y"), F.max(label).alias("high"))
        .where(F.col("y") == F.col("high"))
        .select("id", F.col("y").cast("int").alias("y"), F.xxhash64("id").alias("order"))
    )
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    bounded = [known.where(F.col("y") == y).orderBy("order", "id").limit(sample_rows) for y in (0, 1)]
    # At most 2 * sample_rows narrow rows go to every task, and their texts to the driver.
    picked = F.broadcast(bounded[0].unionByName(bounded[1]))
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(F.col(text)).alias("text"))
        .join(picked, "id")
        .groupBy("id", "y", "order")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values(["order", "id"], ignore_index=True)
    )
    of = {y: [t.encode() for t in rows.loc[rows["y"] == y, "text"]] for y in (0, 1)}
    if not (len(of[0]) > 1 and len(of[1]) > 1):
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return Model(b"", b"", (0.0,) * 6, (1.0,) * 6, (math.log(share / (1 - share)), *(0.0,) * 6))
    measured = []
    for half in (0, 1):
        good, bad = (build_dictionary(of[y][1 - half :: 2]) for y in (1, 0))
        measured += [(y, features(t, good, bad)) for y in (0, 1) for t in of[y][half::2]]
    good, bad = build_dictionary(of[1]), build_dictionary(of[0])
    y = np.array([m[0] for m in measured], dtype=float)
    weight = np.where(y == 1, counts[1] / len(of[1]), counts[0] / len(of[0]))
    mean, scale, w = _logistic(np.array([m[1] for m in measured]), y, weight / weight.mean())
    return Model(good, bad, tuple(mean), tuple(scale), tuple(w))


def score_text(text: str, model: Model) -> float:
    x = np.array(features(text.encode(), model.good, model.bad))
    z = model.weights[0] + float(((x - model.mean) / model.scale) @ np.array(model.weights[1:]))
    return 1 / (1 + math.exp(-min(max(z, -40.0), 40.0)))


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: score_text(t, shared.value)).astype("float64")

    return docs.withColumn(into, score(whole_text(F.col(text))))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    narrow = docs.select("doc_id", "text")
    return scored(narrow, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not predicted to be bad."""
    rows = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    good = scored(rows, fit(docs, labels), "__text", "__score").where(F.col("__score") >= THRESHOLD)
    return good.select("__row.*")
