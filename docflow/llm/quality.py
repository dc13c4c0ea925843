"""Quality classifier by compression with two dictionaries.

A zstandard dictionary is trained on good and another on bad labelled texts. A text that resembles one kind
compresses better with that kind's dictionary; the normalised difference of the compressed sizes, with the
sizes a byte as covariates, goes through a logistic calibration fitted on labelled texts that neither dictionary
has seen and weighted to the label shares of the whole label table.

Null and empty texts get the score of an empty text: the calibrated share of good texts. Repeated rows get equal
scores. Without labels of both kinds, every score is the share of good labels (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents, id_bucket, utf8
from docflow.llm.labels import labelled_sample

SAMPLE_ROWS = 6000  # labelled texts the model is fitted on, half of each label
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    dictionaries = [zstandard.ZstdCompressionDict(x) for x in (good, bad)]
    for d in dictionaries:
        d.precompute_compress(level=LEVEL)
    return [zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            for d in dictionaries] + [zstandard.ZstdCompressor(level=LEVEL)]


def features(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Normalised size difference, and the sizes of the text in bytes per byte with the dictionaries and without."""
    compressors = _compressors(good, bad)
    sizes = np.array([[len(c.compress(t)) for c in compressors] for t in texts], float).reshape(len(texts), 3)
    n = np.array([max(len(t), 1) for t in texts], float)
    ratio = sizes / n[:, None]
    difference = (sizes[:, 1] - sizes[:, 0]) / (sizes[:, 0] + sizes[:, 1])
    x = np.stack([np.ones(len(texts)), 10 * difference, 10 * difference * np.abs(difference), ratio[:, 0].clip(0, 2),
                  ratio[:, 1].clip(0, 2), np.log(ratio[:, 2].clip(1e-6)), np.log(n)], axis=1)
    x[[not t for t in texts]] = 0
    return x


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where there are too few to train on."""
    pieces = [t[i:i + 4096] for t in texts for i in range(0, len(t), 4096)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY_BYTES]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled texts (``labels``: doc_id, quality)."""
    sample, counts = labelled_sample(docs, labels, "quality", rows)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    sample = [(t, y) for t, y in sample if t]
    if len({y for _, y in sample}) < 2:
        return Model(b"", b"", (), prior)
    base = [s for i, s in enumerate(sample) if i % 2]
    held = [s for i, s in enumerate(sample) if not i % 2]
    if len({y for _, y in base}) < 2 or len({y for _, y in held}) < 2:
        base = held = sample
    good, bad = (_dictionary([t for t, y in base if y == kind]) for kind in (1, 0))
    x, y = features([t for t, _ in held], good, bad), np.array([y for _, y in held], float)
    share = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return Model(good, bad, tuple(_logistic(x, y, share)), prior)


def scorer(model: Model):
    """A Column function: text -> score."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        texts = utf8(column)
        out = np.full(len(texts), model.prior)
        if model.weights:
            z = features(texts, model.good, model.bad) @ np.array(model.weights)
            out = np.where([bool(t) for t in texts], 1 / (1 + np.exp(-z.clip(-30, 30))), model.prior)
        return pa.array(out, pa.float64())

    return score


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    return scorer(model)(F.col(text_col))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted: fitted without the rows whose id falls into the held-out fold."""
    model = fit(docs, labels.where(id_bucket("doc_id", folds) != held))
    out = documents(docs).select("doc_id", (id_bucket("doc_id", folds) == held).alias("held_out"),
                                 score_quality(docs, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
