"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained on the driver with follow-the-regularised-leader (elastic net) on a bounded sample of labelled rows, then
calibrated by temperature on a part of the sample that training does not see. The model is a few MB at any input size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, map_arrow
from .hashing import char_ngrams, char_pieces, ngram_sums, trim
from .sampling import labelled_sample

SIZES = [1, 2, 3]
#: Buckets of each n-gram size, as powers of two: BITS, and as many fewer as keep a model under MOST_WEIGHTS where there
#: are many languages (from 43 on), but LEAST_BITS at least.
BITS, LEAST_BITS, MOST_WEIGHTS = 16, 9, 1 << 23
#: Shares of n-grams are small numbers; steps are right for values of this size.
SCALE = 30
LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    languages: list[str]
    tables: list[np.ndarray]  # for each n-gram size: rows by bucket, columns by language; IDF and temperature are in
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text; ('und', 0) if it has no letter."""
        und = np.array([not (t and LETTER.search(t)) for t in texts], bool)
        if not self.languages or und.all():
            return ["und"] * len(texts), np.zeros(len(texts))
        sums, counts = ngram_sums([(t or "").lower() for t in texts], SIZES, len(self.tables[0]).bit_length() - 1, self.tables)
        logits = sums / np.maximum(counts, 1)[:, None] + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return ["und" if u else self.languages[b] for u, b in zip(und, best, strict=True)], np.where(und, 0.0, p[np.arange(len(best)), best])


def bits_for(languages: int) -> int:
    bits = BITS
    while bits > LEAST_BITS and (len(SIZES) << bits) * languages > MOST_WEIGHTS:
        bits -= 1
    return bits


def term_frequencies(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids (size and bucket) of a text and the share that each has of all its n-grams."""
    found = []
    for codes, offsets, _starts, _ in char_pieces([text.lower()], max(SIZES) - 1, limit=1 << 40):
        found += [char_ngrams(codes[: offsets[-1]], s, bits).astype(np.int64) + (k << bits) for k, s in enumerate(SIZES)]
    ids, n = np.unique(np.concatenate(found), return_counts=True)
    return ids, n / max(1, n.sum())


class Ftrl:
    """Follow the regularised leader for each coordinate, with elastic net, for softmax regression."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, ids: np.ndarray) -> np.ndarray:
        z = self.z[ids]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[ids])) / self.alpha + self.l2))

    def step(self, ids: np.ndarray, x: np.ndarray, y: int) -> None:
        """One row: the values x of the features ``ids``, class y."""
        w = self.weights(ids)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[y] -= 1
        g = x[:, None] * p
        self.z[ids] += g - (np.sqrt(self.n[ids] + g * g) - np.sqrt(self.n[ids])) / self.alpha * w
        self.n[ids] += g * g


def document_frequencies(texts: DataFrame, bits: int = BITS) -> tuple[int, np.ndarray]:
    """Number of texts(text) that are not null, and how many of them have each feature. All texts count, whole."""
    features = len(SIZES) << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts_seen = np.zeros(features, np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = [t.lower() for t in batch.column(0).slice(i, 1024).to_pylist() if t is not None]
                texts_seen += len(some)
                total += distinct_features(some, bits)
        at = np.flatnonzero(total)
        trim()
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], texts_seen), pa.int64())], names=["feature", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(features)
    for r in rows:  # one for each feature at most
        if r["feature"] >= 0:
            out[r["feature"]] = r["n"]
    return next((r["n"] for r in rows if r["feature"] < 0), 0), out


def distinct_features(texts: list[str], bits: int = BITS) -> np.ndarray:
    """How many of the texts have each feature."""
    total = np.zeros(len(SIZES) << bits, np.int64)
    open_text, open_ids = -1, [np.empty(0, np.int64) for _ in SIZES]  # the last text so far, which may go on
    for codes, offsets, starts, owner in char_pieces(texts, max(SIZES) - 1):
        for k, size in enumerate(SIZES):
            at = char_ngrams(codes, size, bits)
            first = np.minimum(offsets[:-1], len(at))
            last = np.clip(np.minimum(offsets[1:] - size + 1, offsets[:-1] + starts), first, len(at))
            n = last - first
            place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            pairs = np.unique((np.repeat(owner, n) << bits) | at[place])
            text, ids = pairs >> bits, pairs & ((1 << bits) - 1)
            known = (text == open_text) & np.isin(ids, open_ids[k])
            total[k << bits : (k + 1) << bits] += np.bincount(ids[~known], minlength=1 << bits)
            own = ids[text == owner[-1]]
            open_ids[k] = np.union1d(open_ids[k], own) if owner[-1] == open_text else own
        open_text = owner[-1]
    return total


def fit_language_model(texts: DataFrame, labels: DataFrame, per_language: int = 400, most_rows: int = 10_000, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4) -> LanguageModel:
    """texts(id, text), labels(id, label). ``per_language`` bounds the labelled rows that the classifier is fitted on for
    each language, ``most_rows`` those of all languages; the document frequencies behind the IDF are those of all ``texts``."""
    bound_batches(texts.sparkSession)
    sample, _ = labelled_sample(texts, labels.select("id", "label", F.lit("").alias("group")), per_language, most_rows=most_rows)
    languages = sorted({label for _, label, _ in sample})
    if not sample:
        return LanguageModel([], [], np.zeros(0))
    bits = bits_for(len(languages))
    features = len(SIZES) << bits
    number = {language: k for k, language in enumerate(languages)}
    found = [(*term_frequencies(t, bits), number[label]) for t, label, _ in sample if t]
    train, tune = [x for i, x in enumerate(found) if i % 5], [x for i, x in enumerate(found) if not i % 5]
    n_texts, df = document_frequencies(texts, bits)
    idf = np.log((1 + n_texts) / (1 + df)) + 1
    learner = Ftrl(features, len(languages), alpha, beta, l1, l2)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            ids, tf, y = train[i]
            if len(ids):
                learner.step(ids, tf * idf[ids] * SCALE, y)
    held = [((tf * idf[ids] * SCALE) @ learner.weights(ids), y) for ids, tf, y in tune if len(ids)]

    def loss(t: float) -> float:
        total = 0.0
        for s, y in held:
            s = s / t
            total += np.log(np.exp(s - s.max()).sum()) + s.max() - s[y]
        return total

    temperature = min(np.geomspace(0.05, 5, 40), key=loss) if held else 1.0
    w = learner.weights(np.arange(features)) * idf[:, None] * SCALE / temperature
    return LanguageModel(languages, [np.ascontiguousarray(w[k << bits : (k + 1) << bits], np.float32) for k in range(len(SIZES))], np.zeros(len(languages)))


def predict_languages(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred`` string, ``score`` double.

    Null, empty and letterless texts give ``und`` and 0; a null id stays null; repeated rows give repeated rows; a
    model without languages gives ``und``. Whole texts are read, long ones in pieces."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            langs, scores = shared.value.predict(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(df: DataFrame, model: LanguageModel, text_col: str = "text", least_score: float = 0.3) -> DataFrame:
    """Rows of ``df``, all columns, whose text has a letter and a language of ``least_score`` or more.

    Null and empty texts go, as they have no letter; null ids and repeated rows stay as they are; very long texts are read
    whole, in pieces; an empty table, or a model without languages, gives no row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                langs, scores = shared.value.predict(part.column(at).to_pylist())
                yield part.filter(pa.array([lang != "und" and s >= least_score for lang, s in zip(langs, scores, strict=True)], pa.bool_()))
        trim()

    return df.mapInArrow(run, df.schema)
