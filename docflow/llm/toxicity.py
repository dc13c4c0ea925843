"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

Every character n-gram of every word (with the word's borders) has a vector in a hashed table; a text is the mean
of its n-gram vectors, and a softmax over two classes reads that mean. Table and softmax are trained jointly in
numpy with AdaGrad. An unseen misspelling shares most n-grams with the word it comes from. Because the mean is
linear, a text's score needs one number per n-gram: its vector times the softmax direction.

Null texts and texts without letters score the share of toxic labels. Repeated rows get equal scores. Without labels of both
kinds, every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents, give_back, id_bucket, utf8, words
from docflow.llm.hashing import joined
from docflow.llm.labels import labelled_sample

SAMPLE_ROWS = 6000  # labelled texts the model is trained on, half of each label
BITS = 20
DIM = 8
NGRAMS = (3, 4, 5, 6)
MIN_TEXTS = 5  # n-grams of fewer sampled texts keep a zero vector: names and random words teach nothing
SCALE = np.float32(10)  # of the mean, so that a few n-grams in a long text move the softmax
SMOOTH = 100  # added to the number of n-grams in a mean: a few n-grams alone decide little
EPOCHS = 12
RATE = 0.5
PIECE = 1 << 20  # bytes hashed at once; some 40 bytes of memory for each

# ASCII letters in lower case and all bytes of other scripts are word bytes; the rest are borders (0).
LETTER = np.zeros(256, np.uint8)
LETTER[ord("a"):ord("z") + 1] = LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTER[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    bias: float
    prior: float
    trained: bool


def ngrams(texts: list[bytes]):
    """(n-gram buckets, index of the text) for each n-gram length, over the distinct words of each text.

    N-grams reach over a word's borders by one.
    """
    data, starts = joined([b" " + b" ".join(dict.fromkeys(words(t))) for t in texts])
    data = LETTER[data]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(starts))
    border = data == 0
    hashed = data.astype(np.uint32)
    inside = np.ones(len(data), bool)
    for n in range(2, max(NGRAMS) + 1):
        if n > len(data):
            return
        hashed = hashed[:-1] * np.uint32(0x01000193) + data[n - 1:]
        inside = inside[:-1]
        if n > 2:
            inside = inside & ~border[n - 2:-1]
        if n in NGRAMS:
            keep = inside & ~border[1:len(inside) + 1]
            h = hashed[keep] + np.uint32(n)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            yield (h >> np.uint32(32 - BITS)).astype(np.int32), owner[:len(keep)][keep]


def _bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: distinct buckets and their shares."""
    out = []
    for t in texts:
        parts = [b for b, _ in ngrams([t])]
        ids, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int32), np.empty(0))
        out.append((ids, (n / (n.sum() + SMOOTH)).astype(np.float32)))
    return out


def train(texts: list[bytes], y: np.ndarray, weight: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """The n-gram table times the softmax direction, and the bias."""
    rng = np.random.default_rng(seed)
    bags = _bags(texts)
    spread = np.zeros(1 << BITS, np.int32)
    for ids, _ in bags:
        spread[ids] += 1
    for i, (ids, share) in enumerate(bags):  # one after the other: both lists at once are some hundred MB
        known = spread[ids] >= MIN_TEXTS
        bags[i] = ids[known], share[known]
    table = rng.random((1 << BITS, DIM), np.float32)
    table *= 2
    table -= 1
    table /= DIM
    softmax, bias = rng.normal(0, 1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_s, seen_b = np.full(1 << BITS, 1e-6, np.float32), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), 32):
            rows = order[at:at + 32]
            ids = np.concatenate([bags[r][0] for r in rows])
            if not len(ids):
                continue
            share = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            unique, inverse = np.unique(ids, return_inverse=True)
            used = np.zeros((len(rows), len(unique)), np.float32)
            used[owner, inverse] = share
            mean = SCALE * (used @ table[unique])
            z = mean @ softmax + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[rows][:, None] / len(rows)
            g_softmax, g_bias, g_table = mean.T @ p, p.sum(0), SCALE * (used.T @ (p @ softmax.T))
            seen[unique] += (g_table ** 2).mean(1)
            seen_s += g_softmax ** 2
            seen_b += g_bias ** 2
            rate = RATE * (1 - epoch / EPOCHS)
            table[unique] -= rate * 0.2 * g_table / np.sqrt(seen[unique])[:, None]
            softmax -= (rate * g_softmax / np.sqrt(seen_s)).astype(np.float32)
            bias -= (rate * g_bias / np.sqrt(seen_b)).astype(np.float32)
    table[spread < MIN_TEXTS] = 0
    direction = softmax[:, 1] - softmax[:, 0]
    return SCALE * (table @ direction), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` labelled texts (``labels``: doc_id, toxic)."""
    sample, counts = labelled_sample(docs, labels, "toxic", rows)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if len({y for _, y in sample}) < 2:
        return Model(np.zeros(0, np.float32), 0.0, prior, False)
    y = np.array([y for _, y in sample])
    # half way between equal classes and their shares, in the logarithm: a missed toxic text costs more than its share
    share = np.sqrt(prior) / (np.sqrt(prior) + np.sqrt(1 - prior))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())).astype(np.float32)
    table, bias = train([t for t, _ in sample], y, weight)
    del sample
    give_back()
    return Model(table, bias, prior, True)


def _logits(texts: list[bytes], model: Model) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for buckets, owner in ngrams(texts):
        total += np.bincount(owner, model.table[buckets], len(texts))
        count += np.bincount(owner, minlength=len(texts))
    share = min(max(model.prior, 1e-6), 1 - 1e-6)
    return np.where(count > 0, total / (count + SMOOTH) + model.bias, np.log(share / (1 - share)))


def scorer(model: Model):
    """A Column function: text -> score."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        texts = utf8(column)
        if not model.trained:
            return pa.array(np.full(len(texts), model.prior), pa.float64())
        out, at = [], 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) < PIECE):
                size += len(texts[end])
                end += 1
            out.append(1 / (1 + np.exp(-_logits(texts[at:end], model).clip(-30, 30))))
            at = end
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: trained without the rows whose id falls into the held-out fold."""
    model = fit(docs, labels.where(id_bucket("doc_id", folds) != held))
    out = documents(docs).select("doc_id", (id_bucket("doc_id", folds) == held).alias("held_out"),
                                 scorer(model)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; all columns stay."""
    return docs.where(scorer(model)(F.col(text_col)) < threshold)
