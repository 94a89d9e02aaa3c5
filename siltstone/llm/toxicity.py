"""Toxicity: a convolutional classifier over hashed word embeddings.

Words (runs of ASCII letters, digits and non-ASCII bytes, ASCII in lower case) and their beginnings are hashed to
buckets; buckets seen in training have a vector each, all others share one, and a word's embedding is the sum of its
own and its beginnings' vectors, so that unseen forms of a word are known by how they begin. Filters of several widths slide over the words, the maximum of each
filter over the whole text goes through a ReLU and a dense layer. Trained in numpy; a threshold for each language,
found on a part of the sample that training does not see, is built into the score, so that 0.5 always decides. The
language is guessed from the words themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .hashing import LOWER, NOT_ALNUM, groups, joined, mix, word_hashes, word_spans
from .sampling import labelled_sample

BITS = 22
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
#: A toxic text that is missed counts as much as this many clean texts that are not.
MISS_COST = 3
#: Words that are convolved at once.
WORDS = 100_000


#: Bytes, at most, of a word's beginnings that are hashed beside the word; whole characters.
PREFIXES = (7, 5)
KINDS = 1 + len(PREFIXES)


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word and of its beginnings, index of each text's first word)."""
    data, offsets = joined(texts)
    data = LOWER[data]
    begin, end = word_spans(data, offsets[:-1][offsets[:-1] < offsets[1:]], NOT_ALNUM)
    hashes = [word_hashes(data, begin, end)]
    for n in PREFIXES:
        stop = np.minimum(end, begin + n)
        for _ in range(3):  # not inside a character
            stop -= (stop < end) & ((data[np.minimum(stop, len(data) - 1)] & 0xC0) == 0x80)
        hashes.append(mix(word_hashes(data, begin, stop) + np.uint64(n)))
    return np.stack([(h >> np.uint64(64 - BITS)).astype(np.int64) for h in hashes], axis=1), np.searchsorted(begin, offsets)


@dataclass
class ToxicityModel:
    rows: np.ndarray  # vector row of each bucket; 0 is shared by all buckets that training did not see
    responses: list[np.ndarray]  # for each width: (place in the filter, vector row, filter); the last row is padding
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: np.ndarray  # (vector row, language): log-probabilities
    thresholds: np.ndarray  # for each language, in logits

    def raw(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logit and guessed language of each text."""
        logits, langs = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        filters, pad = self.filter_bias.shape[1], self.responses[0].shape[1] - 1
        for a, b in groups(texts):
            ids, first = buckets(texts[a:b])
            size = first[1:] - first[:-1]
            most = np.full((b - a, len(WIDTHS) * filters), -np.inf, np.float32)
            guess = np.zeros((b - a, self.languages.shape[1]))
            # each text is followed by padding, and has at least one place to convolve
            begin = first[:-1] + np.arange(b - a) * (PAD + 1)
            rows = np.full((len(ids) + (b - a) * (PAD + 1), KINDS), pad, np.int32)
            rows[np.arange(len(ids)) + np.repeat(np.arange(b - a) * (PAD + 1), size)] = self.rows[ids]
            text_of = np.repeat(np.arange(b - a), np.maximum(size, 1))
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(np.maximum(size, 1))[:-1]]), np.maximum(size, 1)) + np.arange(len(text_of))
            for lo in range(0, len(at), WORDS):
                where, owner = at[lo : lo + WORDS], text_of[lo : lo + WORDS]
                cuts = np.flatnonzero(np.diff(owner, prepend=-1))
                for k, width in enumerate(WIDTHS):
                    got = np.zeros((len(where), filters), np.float32)
                    for j in range(width):
                        near = rows[where + j]
                        for kind in range(KINDS):
                            got += self.responses[k][j][near[:, kind]]
                    part = most[:, k * filters : (k + 1) * filters]
                    part[owner[cuts]] = np.maximum(part[owner[cuts]], np.maximum.reduceat(got, cuts, axis=0))
                guess[owner[cuts]] += np.add.reduceat(self.languages[rows[where, 0]], cuts, axis=0)
            logits[a:b] = np.maximum(most + self.filter_bias.reshape(-1), 0) @ self.out + self.out_bias
            langs[a:b] = guess.argmax(axis=1)
        return logits, langs

    def score(self, texts: list[str | None]) -> np.ndarray:
        logits, langs = self.raw(texts)
        return 1 / (1 + np.exp(-np.clip(logits - self.thresholds[langs], -30, 30)))


def fit_toxicity_model(texts: DataFrame, labels: DataFrame, per_label: int = 2000, dim: int = 16, filters: int = 8, epochs: int = 6, rate: float = 0.1, least_words: int = 3, least_steps: int = 12_000, own_rows: int = 20, most_languages: int = 64) -> ToxicityModel:
    """texts(id, text), labels(id, label in 0, 1, group).

    ``per_label`` bounds the labelled rows that are used for each label (half as many more where languages are small);
    ``group``, the language, only forms the groups for thresholds and teaches the guess from words. Buckets that
    ``least_words`` rows of the sample have get a vector. Training goes ``epochs`` times through the sample, a small one
    (up to five times as often) until ``least_steps`` rows were seen. A language's threshold stands between the common
    one and its own best, the nearer to its own the more tuning rows of its rarer label it has, half way at ``own_rows``.
    The ``most_languages`` that most rows of the sample have are told apart; all others have one threshold together."""
    sample, counts = labelled_sample(texts, labels, per_label, by_group=True)
    langs_of, docs_text, labels_of = [x[2] or "" for x in sample], [x[0] for x in sample], [int(x[1]) for x in sample]
    common_ones = {lang for lang, _ in Counter(langs_of).most_common(most_languages)}
    langs_of = [lang if lang in common_ones else "" for lang in langs_of]
    names = sorted(set(langs_of)) or [""]
    docs = [buckets([t])[0] for t in docs_text]
    seen, n = np.unique(np.concatenate([np.unique(d) for d in docs]) if docs else np.empty(0, np.int64), return_counts=True)
    kept = seen[n >= least_words]
    row_of = np.zeros(1 << BITS, np.int32)
    row_of[kept] = np.arange(1, len(kept) + 1)
    size = len(kept) + 2
    docs = [np.concatenate([row_of[d].astype(np.int64), np.full((PAD + 1, KINDS), size - 1)]) for d in docs]

    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.3, (size, dim)).astype(np.float32)
    vectors[-1] = 0
    kernels = [rng.normal(0, 0.3 / np.sqrt(w), (w, dim, filters)).astype(np.float32) for w in WIDTHS]
    bias = np.zeros((len(WIDTHS), filters), np.float32)
    out, out_bias = rng.normal(0, 0.3, len(WIDTHS) * filters).astype(np.float32), 0.0
    g_vec, g_ker, g_bias, g_out = np.full(size, 1e-6, np.float32), [np.full(k.shape, 1e-6, np.float32) for k in kernels], np.full(bias.shape, 1e-6, np.float32), np.full(out.shape, 1e-6, np.float32)
    fit, tune = [i for i in range(len(docs)) if i % 4], [i for i in range(len(docs)) if not i % 4]
    total = [max(1, sum(labels_of[i] == k for i in fit)) for k in (0, 1)]
    weight = [len(fit) / (2 * t) for t in total]
    for _ in range(max(epochs, min(5 * epochs, least_steps // max(1, len(fit))))):
        for i in rng.permutation(fit):
            doc, y = docs[i], labels_of[i]
            places = len(doc) - PAD
            own = vectors[doc].sum(axis=1)
            tops, values = [], []
            for k, width in enumerate(WIDTHS):
                r = own[:places] @ kernels[k][0]
                for j in range(1, width):
                    r += own[j : j + places] @ kernels[k][j]
                top = r.argmax(axis=0)
                tops.append(top)
                values.append(r[top, np.arange(filters)] + bias[k])
            h = np.concatenate(values)
            s = float(np.maximum(h, 0) @ out) + out_bias
            d = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) * weight[y]
            back = np.where(h > 0, d * out, 0).astype(np.float32)
            grad = (d * np.maximum(h, 0)).astype(np.float32)
            g_out += grad * grad
            out -= rate * grad / np.sqrt(g_out)
            out_bias -= 0.02 * d
            for k, width in enumerate(WIDTHS):
                b = back[k * filters : (k + 1) * filters]
                if not b.any():
                    continue
                g_bias[k] += b * b
                bias[k] -= rate * b / np.sqrt(g_bias[k])
                for j in range(width):
                    at = doc[tops[k] + j]
                    dk, dv = own[tops[k] + j].T * b, kernels[k][j].T * b[:, None]
                    g_ker[k][j] += dk * dk
                    kernels[k][j] -= rate * dk / np.sqrt(g_ker[k][j])
                    for kind in range(KINDS):
                        np.add.at(g_vec, at[:, kind], (dv * dv).mean(axis=1))
                        np.add.at(vectors, at[:, kind], -rate * dv / np.sqrt(g_vec[at[:, kind]])[:, None])
            vectors[-1] = 0
    counts_by = np.ones((size, len(names)))
    for doc, lang in zip(docs, langs_of, strict=True):
        np.add.at(counts_by[:, names.index(lang)], doc[: -PAD - 1, 0], 1)
    counts_by[[0, -1]] = 1
    model = ToxicityModel(row_of, [np.stack([vectors @ k[j] for j in range(w)]) for k, w in zip(kernels, WIDTHS, strict=True)], bias, out, float(out_bias), np.log(counts_by / counts_by.sum(axis=1, keepdims=True)).astype(np.float32), np.zeros(len(names)))
    if tune:
        s, guess = model.raw([docs_text[i] for i in tune])
        y = np.array([labels_of[i] for i in tune])
        true_share = counts.get(1, 0) / max(1, sum(counts.values()))
        w = np.where(y == 1, MISS_COST * true_share / max(1, y.sum()), (1 - true_share) / max(1, (1 - y).sum()))

        def best(where: np.ndarray) -> float:
            """The middle of the widest gap between neighbouring logits that errs least, as rows stand in the corpus."""
            ss, order = np.sort(s[where]), np.argsort(s[where])
            yy, ww = y[where][order], w[where][order]
            cuts = np.concatenate([[ss[0] - 2], (ss[1:] + ss[:-1]) / 2, [ss[-1] + 2]])
            wrong = np.concatenate([[0], np.cumsum(ww * (yy == 1))]) + np.concatenate([np.cumsum((ww * (yy == 0))[::-1])[::-1], [0]])
            gaps = np.concatenate([[4], np.diff(ss), [4]])
            least = np.flatnonzero(wrong <= wrong.min() + 1e-12)
            return float(cuts[least[np.argmax(gaps[least])]])

        common = best(np.ones(len(y), bool)) if 0 < y.sum() < len(y) else 0.0
        model.thresholds[:] = common
        for k in range(len(names)):
            own = guess == k
            rarer = min(y[own].sum(), (1 - y[own]).sum())
            if rarer:
                model.thresholds[k] = (own_rows * common + rarer * best(own)) / (own_rows + rarer)
    return model


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``score`` double (0 to 1).

    Null and empty texts are scored as texts of padding alone; a null id stays null; repeated rows give repeated rows
    and equal scores; whole texts are read, long ones in pieces that overlap by the widest filter."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            scores = shared.value.score(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"id {kind}, score double").withColumnRenamed("id", id_col)
