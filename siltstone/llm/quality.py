"""Quality classifier: supervised subword embeddings.

Vectors of hashed words, pairs of neighbouring words and character n-grams are learned, averaged over a document (each
kind apart, so that the many n-grams do not drown the words) and given to a softmax, all by stochastic gradient descent
in numpy. As the average and the output layer are linear, scoring needs one number for each bucket, looked up for every
feature of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .hashing import char_ngrams, char_pieces, groups, ngram_sums, text_words, window_hashes
from .sampling import labelled_sample

SIZES = [2, 3, 4]
BITS = 16
#: Kinds of features: n-grams of each size, then words, then pairs of words; each has 2 ** BITS buckets.
WORDS, PAIRS = len(SIZES), len(SIZES) + 1
FEATURES = (len(SIZES) + 2) << BITS


def word_buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Bucket of each word with the one after it, also across texts; one fewer than words."""
    return word_buckets(window_hashes(hashes, 2))


@dataclass
class QualityModel:
    tables: list[np.ndarray]  # for each n-gram size, then for words: what a feature in that bucket adds to the logit
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1; texts without a feature get the share of label 1 among the labels."""
        clean = [t or "" for t in texts]
        sums, counts = ngram_sums(clean, SIZES, BITS, self.tables[:WORDS])
        logit = sums[:, 0] / np.maximum(counts, 1) + self.bias
        for a, b in groups(clean):
            words, first = text_words(clean[a:b], lower=False)
            for table, found, size in ((self.tables[WORDS], word_buckets(words), 1), (self.tables[PAIRS], pair_buckets(words), 2)):
                run = np.zeros(len(found) + 1)
                np.cumsum(table[found], dtype=np.float64, out=run[1:])
                n = np.maximum(first[1:] - first[:-1] - size + 1, 0)
                begin = np.minimum(first[:-1], len(found))
                logit[a:b] += (run[begin + n] - run[begin]) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-logit))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids (kind and bucket) of a text, and the share that each has of all of its kind (n-grams are one kind)."""
    found = []
    for codes, _, _, _ in char_pieces([text], max(SIZES) - 1, limit=1 << 40):
        found += [char_ngrams(codes, s, BITS).astype(np.int64) + (k << BITS) for k, s in enumerate(SIZES)]
    words, _ = text_words([text], lower=False)
    found += [word_buckets(words) + (WORDS << BITS), pair_buckets(words) + (PAIRS << BITS)]
    ids, n = np.unique(np.concatenate(found), return_counts=True)
    kind = np.maximum(ids >> BITS, WORDS - 1)
    return ids, n / np.maximum(np.bincount(kind, n, FEATURES >> BITS), 1)[kind]


def fit_quality_model(texts: DataFrame, labels: DataFrame, per_label: int = 1500, dim: int = 8, epochs: int = 6, rate: float = 0.3) -> QualityModel:
    """texts(id, text), labels(id, label in 0, 1). ``per_label`` bounds the labelled rows that are used for each label."""
    sample, counts = labelled_sample(texts, labels.select("id", "label", F.lit("").alias("group")), per_label)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return QualityModel([np.zeros(1 << BITS, np.float32) for _ in range(PAIRS + 1)], prior)
    found = [(*features(t), int(y)) for t, y, _ in sample]
    used = [sum(y == k for _, _, y in found) for k in (0, 1)]
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.1, (FEATURES, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, 2)).astype(np.float32)
    grown, out_grown = np.full(FEATURES, 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    bias = np.zeros(2, np.float32)
    weight = [len(found) / (2 * max(1, u)) for u in used]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(found)):
            ids, tf, y = found[i]
            if not len(ids):
                continue
            share = tf.astype(np.float32)
            own = vectors[ids]
            mean = share @ own
            s = mean @ out + bias
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            back = out @ p
            out_grown += p * p * (mean @ mean)
            out -= step * np.outer(mean, p) / np.sqrt(out_grown)
            bias -= 0.05 * step * p
            grown[ids] += share**2 * (back @ back)
            vectors[ids] = own - (step * share / np.sqrt(grown[ids]))[:, None] * back
    each = vectors @ (out[:, 1] - out[:, 0])
    balance = float(np.log(weight[1] * max(1, used[1]) / (weight[0] * max(1, used[0]))))
    return QualityModel([np.ascontiguousarray(each[k << BITS : (k + 1) << BITS], np.float32) for k in range(PAIRS + 1)], float(bias[1] - bias[0]) + prior - balance)


def score_quality(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``score`` double (0 to 1).

    Null and empty texts get the prior; a null id stays null; repeated rows give repeated rows and equal scores."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            scores = shared.value.score(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"id {kind}, score double").withColumnRenamed("id", id_col)
