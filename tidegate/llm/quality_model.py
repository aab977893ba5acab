"""Quality classification with supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs and character n-grams (3 to 5
bytes); a softmax over two classes follows. The vectors are trained by stochastic gradient descent in numpy
on a bounded sample of labelled documents. After training the output is linear in the average, so each hash
bucket keeps one number, its share of the log-odds, and scoring reads one number per feature.

Defined results: a null or empty text has no feature and gets the probability that the bias alone gives.
Without labelled text of both classes the model is the constant share of label 1 (0.5 without any label).
A label is 1 or 0, others and nulls teach nothing; a document with several labels counts with each.
Repeated rows are scored one by one; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import flat_bytes, text_blocks

SAMPLE_ROWS = 2500  # bound of the labelled sample, documents
SAMPLE_BYTES = 8_000_000  # and bytes
LONGEST_PIECE = 20_000  # of a longer labelled document the first characters are taken
BUCKETS = 1 << 18
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.5
BLOCK_BYTES = 1_500_000

SCHEMA = "doc_id long, score double"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = np.uint32(0x9E3779B1)


class QualityModel(NamedTuple):
    weights: np.ndarray  # log-odds of each bucket
    bias: float


def _bucket(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint32(15))) * _MULTIPLIER
    return (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and each n-gram length: buckets in text order, and where each document's begin.

    `data` holds the bytes of all documents, `starts` where each starts, the end included.
    """
    out = []
    n = len(data)
    # Words: a polynomial hash of the bytes up to each place; the difference of two places is the word's.
    space = np.ones(n + 2, bool)
    space[1:-1] = _SPACE[data]
    wall = np.zeros(n + 1, bool)
    wall[starts] = True
    begins = np.flatnonzero(~space[1:-1] & (space[:-2] | wall[:-1]))
    ends = np.flatnonzero(~space[1:-1] & (space[2:] | wall[1:])) + 1
    mixed = (data.astype(np.uint32) + np.uint32(1)) * _MULTIPLIER
    power = np.full(n + 1, 0x01000193, np.uint32)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint32)
    inverse = np.full(n + 1, pow(0x01000193, -1, 1 << 32), np.uint32)
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint32)
    upto = np.concatenate([np.zeros(1, np.uint32), np.cumsum(mixed * power[:n], dtype=np.uint32)])
    word = (upto[ends] - upto[begins]) * inverse[begins] + np.uint32(77)
    first = np.searchsorted(begins, starts)
    out.append((_bucket(word), first))
    pair = word[:-1] * np.uint32(31) + word[1:] * np.uint32(0x85EBCA6B) + np.uint32(5)
    inner = np.ones(max(len(word) - 1, 0), bool)
    inner[(first[1:-1] - 1)[(first[1:-1] > 0) & (first[1:-1] <= len(inner))]] = False
    kept = np.concatenate([[0], np.cumsum(inner)])
    out.append((_bucket(pair[inner]), kept[np.minimum(first, len(inner))]))
    # Character n-grams: every window of bytes inside a document.
    gram = data.astype(np.uint32)
    for size in (2, 3, 4, 5):
        gram = gram[:-1] * np.uint32(0x01000193) + data[size - 1 :] if n >= size else np.zeros(0, np.uint32)
        if size > 2:
            ends_at = np.maximum(starts[1:] - size + 1, starts[:-1])
            out.append((_bucket(gram * np.uint32(2 * size + 1)), np.stack([starts[:-1], ends_at])))
    return out


def _by_document(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Buckets of each document."""
    parts = features(data, starts)
    out = []
    for i in range(len(starts) - 1):
        out.append(
            np.concatenate(
                [b[s[i] : s[i + 1]] if s.ndim == 1 else b[s[0, i] : s[1, i]] for b, s in parts]
            )
        )
    return out


def fit(texts: list[str], labels: list[int], seed: int = 7) -> QualityModel:
    """Train on texts and labels (0 or 1)."""
    share = float(np.mean(labels)) if labels else 0.5
    if share in (0.0, 1.0) or not labels:
        share = min(max(share, 0.01), 0.99)
        return QualityModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    documents = []
    for text in texts:
        data, starts = flat_bytes(pa.array([text]))
        buckets, counts = np.unique(_by_document(data, starts)[0], return_counts=True)
        documents.append((buckets, (counts / max(counts.sum(), 1)).astype(np.float32)))
    chance = np.random.default_rng(seed)
    vectors = (chance.random((BUCKETS, DIMENSIONS), np.float32) - np.float32(0.5)) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, done = EPOCHS * len(documents), 0
    for _ in range(EPOCHS):
        for i in chance.permutation(len(documents)):
            rate = RATE * (1 - done / steps)
            done += 1
            buckets, weight = documents[i]
            hidden = weight @ vectors[buckets]
            scores = hidden @ output + bias
            odds = np.exp(scores - scores.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            # A feature's own frequency is small; the step is scaled so that rare features move as well.
            vectors[buckets] -= rate * np.outer(weight * np.float32(len(buckets) ** 0.5), back)
    return QualityModel(vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def learn(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> QualityModel:
    """Fit on a bounded sample of at most SAMPLE_ROWS labelled documents, picked by a hash of the id.

    Of a document above LONGEST_PIECE characters so many are learned from. The pick is made on both sides
    before they are joined, so no text of other documents is moved.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    bound = 1.2 * SAMPLE_ROWS / max(known.count(), 1)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.substring(text, 1, LONGEST_PIECE).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (place <= bound))
    picked = texts.join(known.where(place <= bound), "doc_id").select("text", "label", place.alias("place"))
    sample, marks, size = [], [], 0
    for row in sorted(picked.collect(), key=lambda r: (r.place, r.text, r.label))[:SAMPLE_ROWS]:
        size += len(row.text.encode())
        if size <= SAMPLE_BYTES:
            sample.append(row.text)
            marks.append(row.label)
    return fit(sample, marks)


def log_odds(data: np.ndarray, starts: np.ndarray, model: QualityModel) -> np.ndarray:
    """Of each document."""
    total = np.zeros(len(starts) - 1)
    count = np.zeros(len(starts) - 1)
    for buckets, at in features(data, starts):
        upto = np.concatenate([[0.0], np.cumsum(model.weights[buckets], dtype=np.float64)])
        low, high = (at[:-1], at[1:]) if at.ndim == 1 else at
        total += upto[np.minimum(high, len(buckets))] - upto[np.minimum(low, len(buckets))]
        count += high - low
    return total / np.maximum(count, 1) + model.bias


def score(documents: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every document; only its text is looked at."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            odds = log_odds(*flat_bytes(block.column("text")), shared.value)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))), pa.float64())],
                ["doc_id", "score"],
            )

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def held_out(doc_id: str = "doc_id"):
    """The rows that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1
