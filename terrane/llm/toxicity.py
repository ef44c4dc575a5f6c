"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

Only documents are labelled.  A sentence has the probability
p = sigmoid(b + sum of the weights of its words' features), a document
P = 1 - prod(1 - p) over its sentences, and weights and b are fitted to the
document labels through P.  The sentences with a high p are the offending ones.
A word's features are the word and its first three, four and five letters, so
inflected forms of a rude stem are met without having been seen.  Sentences of
fewer than ``MIN_WORDS`` words are taken together with the next ones and those of
more than ``MAX_WORDS`` are cut, so a text of a thousand one-word sentences is not
a thousand chances; a word counts once in a sentence.

The fit uses a bounded sample (``PER_CLASS`` documents of each label, of a long one the
sentences of the smallest hashes with ``FEATURES`` features together); scoring covers every sentence of
every document in Arrow batches, without a shuffle.

Defined results: NULL and empty texts, and texts without a word, score 0; a text
of any length is scored whole; repeated rows each get their row; without labelled
rows of both classes every score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .training import adam, labelled_sample, segment_sums, sigmoid

PER_CLASS = 2000
BUCKETS = 1 << 18
THRESHOLD = 0.3
SENTENCE_THRESHOLD = 0.2
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
MIN_WORDS, MAX_WORDS = 8, 40
FEATURES = 1 << 14  # of a sampled document, in whole sentences: at most 4 bytes each go to the driver
BIAS = -4.0  # where the fit of the bias begins
_CACHE = 1 << 19

SCHEMA = "doc_id long, score double, sentences array<struct<start:int,length:int,score:double>>"


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text leaves 2 modulo 4 (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def word_features(word: str) -> list[int]:
    h = xxhash.xxh32_intdigest
    return sorted({h(f) % BUCKETS for f in [word] + ["^" + word[:n] for n in (3, 4, 5) if len(word) >= n]})


def instances(text: str | None) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of the sentences of a text, each of about MIN_WORDS to MAX_WORDS words."""
    start, end, words, n = 0, 0, set(), 0
    for m in _SENTENCE.finditer(text or ""):
        found = _WORD.findall(m.group().lower())
        if not found:
            continue
        if len(found) > MAX_WORDS:
            if words:
                yield start, end, words
            places = list(_WORD.finditer(m.group()))
            for i in range(0, len(places), MAX_WORDS):
                part = places[i:i + MAX_WORDS]
                yield m.start() + part[0].start(), m.start() + part[-1].end(), {w.group().lower() for w in part}
            words, n = set(), 0
            continue
        if not words:
            start = m.start()
        words.update(found)
        n += len(found)
        end = m.end()
        if n >= MIN_WORDS:
            yield start, end, words
            words, n = set(), 0
    if words:
        yield start, end, words


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self._cache: dict[str, float] = {}

    def __getstate__(self):
        return (self.weights, self.bias)

    def __setstate__(self, state) -> None:
        self.weights, self.bias = state
        self._cache = {}

    def word(self, w: str) -> float:
        if len(self._cache) > _CACHE:  # bounded memory; entries are recomputed when needed
            self._cache.clear()
        v = self._cache[w] = float(self.weights[word_features(w)].sum())
        return v

    def sentences(self, text: str | None) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(start, length) and probability of every sentence that has a word."""
        cache, word, spans, logits = self._cache, self.word, [], []
        for start, end, words in instances(text):
            total = self.bias
            for w in words:
                got = cache.get(w)
                total += word(w) if got is None else got
            logits.append(total)
            spans.append((start, end - start))
        return spans, sigmoid(np.array(logits))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"doc_id": [], "y": [], "weight": [], "sizes": [], "features": []}
        for doc_id, y, weight, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "weight", "text"))):
            bags = bounded([[f for w in sorted(words) for f in word_features(w)] for _, _, words in instances(text)])
            out["doc_id"].append(doc_id)
            out["y"].append(y)
            out["weight"].append(weight)
            out["sizes"].append(np.array([len(b) for b in bags], np.int32).tobytes())
            out["features"].append(np.array([f for b in bags for f in b], np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["y"], pa.int32()), pa.array(
            out["weight"], pa.float64()), pa.array(out["sizes"], pa.binary()), pa.array(out["features"], pa.binary())], names=list(out))


def bounded(bags: list[list[int]], limit: int | None = None) -> list[list[int]]:
    """The sentences of a document that the fit sees: all, or those of the smallest hashes with ``FEATURES`` features together."""
    limit = limit or FEATURES
    if sum(map(len, bags)) <= limit:
        return bags
    kept, room = [], limit
    for _, i in sorted((xxhash.xxh64_intdigest(str(b)), i) for i, b in enumerate(bags)):
        if len(bags[i]) > room:
            break
        kept.append(i)
        room -= len(bags[i])
    return [bags[i] for i in sorted(kept)]


class Bags:
    """The sampled documents (label, weight, sentence sizes, features) as arrays, with the loss of the noisy-or model.

    Features of fewer than ``least`` documents are left out: their weights stay zero.
    """

    def __init__(self, docs: list[tuple[int, float, np.ndarray, np.ndarray]], least: int):
        self.y = np.array([d[0] for d in docs], float)
        self.weight = np.array([d[1] for d in docs]) / sum(d[1] for d in docs)
        n_sentences = np.array([len(d[2]) for d in docs])
        self.first_sentence = np.cumsum(n_sentences) - n_sentences
        self.doc_of = np.repeat(np.arange(len(docs), dtype=np.int32), n_sentences)
        seen = np.zeros(BUCKETS, np.int32)
        for d in docs:
            seen[np.unique(d[3])] += 1
        self.buckets = np.flatnonzero(seen >= least)
        place = np.cumsum(seen >= least, dtype=np.int32) - 1
        features = np.concatenate([d[3] for d in docs])
        keep = seen[features] >= least
        sizes = np.concatenate([d[2] for d in docs])
        self.sentence_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[keep]
        self.features = place[features[keep]]
        self.starts = np.searchsorted(self.sentence_of, np.arange(len(sizes)))

    def sentences(self, x: np.ndarray) -> np.ndarray:
        """Probability of every sentence; the last of ``x`` is the bias over ``BIAS``."""
        return sigmoid(segment_sums(x[:-1][self.features], self.starts) + x[-1] + BIAS)

    def gradient(self, x: np.ndarray, l1: float = 0.0) -> np.ndarray:
        """Of the mean negative log-likelihood of the labels, and of ``l1`` times the weights' size."""
        p = self.sentences(x)
        q = np.exp(segment_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), self.first_sentence))
        pull = np.where(self.y == 1, -q / np.maximum(1 - q, 1e-9), 1.0) * self.weight
        gz = pull[self.doc_of] * p
        g = np.bincount(self.features, weights=gz[self.sentence_of], minlength=len(self.buckets)) + l1 * np.sign(x[:-1])
        return np.append(g, gz.sum())


def fit_bags(docs: list[tuple[int, float, np.ndarray, np.ndarray]], steps: int = 150, rate: float = 0.1,
             l1: float = 3e-4, least: int = 8) -> Model:
    """Fit to (label, weight, sentence sizes, features) of the sampled documents.

    The absolute penalty keeps words that only happen to stand in toxic documents at zero.
    """
    docs = [d for d in docs if len(d[2])]
    if len({d[0] for d in docs}) < 2:
        return Model(np.zeros(BUCKETS), -40.0)
    bags = Bags(docs, least)
    x = adam(lambda w: bags.gradient(w, l1), len(bags.buckets) + 1, steps, rate)
    weights = np.zeros(BUCKETS)
    weights[bags.buckets] = x[:-1]
    return Model(weights, float(x[-1] + BIAS))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, only: Column | None = None) -> Model:
    """Fit on up to ``per_class`` documents of each label; ``only`` restricts the doc_ids that labels are learnt from."""
    sample = labelled_sample(documents, labels, "toxic", per_class, only)
    rows = sample.mapInArrow(_bags, "doc_id long, y int, weight double, sizes binary, features binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit_bags([(r.y, r.weight, np.frombuffer(r.sizes, np.int32), np.frombuffer(r.features, np.int32)) for r in rows])


def score(documents: DataFrame, model: Model, sentence_threshold: float = SENTENCE_THRESHOLD) -> DataFrame:
    """One row per document row: score and offending sentences (``SCHEMA``, character offsets)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, found = [], []
            for text in batch.column("text").to_pylist():
                spans, p = m.sentences(text)
                scores.append(noisy_or(p))
                found.append([{"start": spans[i][0], "length": spans[i][1], "score": float(p[i])}
                              for i in np.flatnonzero(p >= sentence_threshold)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found, pa.list_(
                pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())])))], names=["doc_id", "score", "sentences"])

    return id_text(documents).mapInArrow(run, SCHEMA)


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``, all their columns kept."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for s in batches:
            yield pd.Series([noisy_or(m.sentences(t)[1]) for t in s], dtype=float)

    return documents.where(of(F.col("text").cast("string")) < threshold)
