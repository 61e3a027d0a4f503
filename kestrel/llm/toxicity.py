"""Toxicity: cumulative-link (proportional odds) regression over sparse text features.

Grades 0 (clean) to 3 are ordered; P(grade <= j) = 1 / (1 + exp(w.x - t_j)) with one weight vector for all
thresholds t_0 < t_1 < t_2. Features are hashed: the words of a text and their first three, four and five letters, valued
log(1 + count). The labels give toxic 0/1 only; a toxic text's grade grows with the number of its words that
the sample ties to toxic texts (``GRADE_CUTS``), so the ordered thresholds are learned from data.

The model is fitted on a bounded sample: at most ``MAX_SAMPLE`` labelled texts, the first ones in the order
of a hash of doc_id. Scoring covers every row of the table.

A null or empty text has severity 0; without labels every severity is 0; a document with several labels
counts as toxic if one says so; null labels are not used; repeated rows are scored each; extra columns are
dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import CACHES, id_and_text, map_rows, struct

MAX_SAMPLE = 8000
FEATURES = 1 << 18
PREFIXES = (3, 4, 5)
#: Grade 1 up to 2 telling words in a toxic text, grade 2 up to 5, grade 3 beyond.
GRADE_CUTS = (2, 5)
GRADES = len(GRADE_CUTS) + 2
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[int, ...]:
    """Hash bins of a word and of the beginnings that are shorter than it."""
    mask = FEATURES - 1
    return (xxhash.xxh32_intdigest(word) & mask, *(xxhash.xxh32_intdigest("^" + word[:k]) & mask for k in PREFIXES if len(word) > k))


class _Bins(dict):
    """Features of each word; emptied when it has grown."""

    def __missing__(self, word):
        if len(self) >= 500_000:
            self.clear()
        got = self[word] = word_features(word)
        return got


_bins = _Bins()
CACHES.append(_bins)


def count_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their counts."""
    ids = np.fromiter(chain.from_iterable(map(_bins.__getitem__, _WORD.findall(text.lower()))), np.int32)
    return np.unique(ids, return_counts=True)


@dataclass
class Model:
    weights: np.ndarray  # FEATURES floats
    thresholds: np.ndarray  # GRADES - 1, increasing

    def latent(self, text: str) -> float:
        features, n = count_features(text)
        return float(self.weights[features] @ np.log1p(n))

    def severity(self, z: float) -> float:
        """Expected grade: the sum over thresholds of P(grade > j)."""
        return float((1.0 / (1.0 + np.exp(np.clip(self.thresholds - z, -60, 60)))).sum())


def grades(toxic: np.ndarray, doc: np.ndarray, feature: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Severity grades of the sample: 0 for clean texts, else by the number of telling features."""
    seen = np.bincount(feature, minlength=FEATURES)
    bad = np.bincount(feature, weights=toxic[doc], minlength=FEATURES)
    base = toxic.mean() if len(toxic) else 0.0
    telling = (bad >= 3) & (bad > max(0.9, (1 + base) / 2) * seen)
    hits = np.bincount(doc, weights=n * telling[feature], minlength=len(toxic))
    return np.where(toxic == 0, 0, 1 + np.searchsorted(GRADE_CUTS, hits, side="left"))


def fit_ordinal(y: np.ndarray, doc: np.ndarray, feature: np.ndarray, n: np.ndarray, steps: int = 200, l2: float = 1e-3, rate: float = 0.05) -> Model:
    """Weights and thresholds by Adam on the mean negative log-likelihood; features in 2 or more texts only.

    Values are scaled by each feature's log-odds between toxic and clean texts (Wang and Manning 2012), so that few
    labels are enough for words that only one side has."""
    seen = np.bincount(feature, minlength=FEATURES)
    bad = np.bincount(feature, weights=(y > 0)[doc], minlength=FEATURES)
    n_bad = (y > 0).sum()
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((seen - bad + 0.5) / (len(y) - n_bad + 1))
    used = np.flatnonzero(seen >= 2)
    if not len(used) or not (y > 0).any():
        return Model(np.zeros(FEATURES, np.float32), np.full(GRADES - 1, 60.0))
    column = np.full(FEATURES, -1)
    column[used] = np.arange(len(used))
    some = column[feature] >= 0
    doc, col, val = doc[some], column[feature[some]], np.log1p(n[some]) * odds[feature[some]]
    n_docs, n_thresholds = len(y), GRADES - 1
    at = np.arange(n_docs)
    p = np.zeros(len(used) + n_thresholds)  # weights, first threshold, log gaps
    p[len(used)] = 2.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, raw = p[:len(used)], p[len(used):]
        gaps = np.exp(raw[1:])
        t = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(doc, val * w[col], n_docs)
        below = np.concatenate([np.zeros((n_docs, 1)), 1.0 / (1.0 + np.exp(np.clip(z[:, None] - t[None, :], -60, 60))), np.ones((n_docs, 1))], axis=1)
        slope = below * (1 - below)
        prob = np.maximum(below[at, y + 1] - below[at, y], 1e-12)
        up, down = slope[at, y + 1] / prob, slope[at, y] / prob
        dz = (up - down) / n_docs  # of the negative log-likelihood
        dt = np.array([(down[y == j + 1].sum() - up[y == j].sum()) / n_docs for j in range(n_thresholds)])
        tail = np.cumsum(dt[::-1])[::-1]
        g = np.concatenate([np.bincount(col, val * dz[doc], len(used)) + l2 * w, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = p[len(used):]
    weights = np.zeros(FEATURES, np.float32)
    weights[used] = p[:len(used)] * odds[used]
    return Model(weights, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))]))


def fit(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Model:
    """Fit on at most ``max_sample`` labelled texts; features are extracted on the executors."""
    picked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))
    texts = id_and_text(docs).join(F.broadcast(picked), "doc_id").select("toxic", "text")

    def make():
        def one(toxic, text):
            feature, n = count_features(text)
            return toxic, feature.tolist(), n.tolist()

        return one

    got = map_rows(texts, make, struct("toxic int, feature array<int>, n array<int>")).toArrow()
    toxic = got["toxic"].to_numpy().astype(np.int64)
    features = got["feature"].combine_chunks()
    doc = np.repeat(np.arange(len(toxic)), np.array([len(x) for x in features], np.int64)) if len(toxic) else np.zeros(0, np.int64)
    flat = lambda c: got[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    feature, n = flat("feature"), flat("n")
    return fit_ordinal(grades(toxic, doc, feature, n), doc, feature, n)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, toxic): expected severity, its nearest grade (1 at least for toxic texts, 0 for others),
    and whether grade 1 or more is likelier than 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^18 floats

    def make():
        m = shared.value

        def one(doc_id, text):
            z = m.latent(text)
            severity, toxic = m.severity(z), bool(z > m.thresholds[0])
            return doc_id, severity, max(1, round(severity)) if toxic else 0, toxic

        return one

    return map_rows(id_and_text(docs), make, struct("doc_id long, severity double, grade int, toxic boolean"))
