"""Quality rules with a hashed n-gram logistic regression.

A text is described by the shares of its hashed words and of its hashed
character trigrams (over its UTF-8 bytes, case kept).  A logistic regression on
these shares is fitted to a bounded sample of the labelled quality rows
(``PER_CLASS`` of each label, of each document its ``FEATURES`` most frequent features), its scores are calibrated to probabilities on
rows it was not fitted to (Platt scaling), and every document is scored in Arrow
batches.  A document is kept if it passes the base rules and its probability of
good quality reaches the fixed ``THRESHOLD``.

Defined results: a NULL text counts as empty: no words, base rules failed, not
kept; texts of any length are read whole; repeated rows each get their row;
without labelled rows of both classes the probability is 1 (the base rules alone
decide); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, id_text, rows_of
from .training import adam, labelled_sample, segment_sums, sigmoid

PER_CLASS = 1500
FEATURES = 1 << 13  # of a sampled document, its most frequent ones: at most 8 bytes each go to the driver
BUCKETS = 1 << 16  # for words, and as many for trigrams
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_CACHE = 1 << 19
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_KEEP_STARTS = bytes(range(0x80, 0xC0)) + SPACES.encode()  # UTF-8 continuation bytes and white space: no code point of a word

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "quality double")


def repeat_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    if len(ids) < 4:
        return 0
    if ids.max() < 1 << 21:  # three numbers fit into one
        grams = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        order = np.argsort(grams)
        same = np.diff(grams[order]) == 0
    else:
        grams = np.stack((ids[:-2], ids[1:-1], ids[2:]))
        order = np.lexsort(grams)
        same = (np.diff(grams[:, order]) == 0).all(axis=0)
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(ids), bool)
    at = order[twice]
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def base_counts(text: bytes | None, ids: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text whose words have the numbers ``ids``."""
    if not text:
        return 0, 0, 0, 0
    lines = [x for x in text.split(b"\n") if x.strip()] if b"\n" in text else []
    return (len(text.translate(None, _KEEP_STARTS)), len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeat_words(ids))


class Words:
    """Numbers and hash buckets of words, per worker; restarts when it has grown too large (numbers stay within one slice)."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.bucket: list[int] = []

    def of(self, w: list[bytes]) -> np.ndarray:
        number, bucket = self.number, self.bucket
        out = []
        for x in w:
            n = number.get(x)
            if n is None:
                n = number[x] = len(bucket)
                bucket.append(xxhash.xxh32_intdigest(x) % BUCKETS)
            out.append(n)
        return np.array(out, np.int64)

    def trim(self) -> None:
        if len(self.bucket) > _CACHE:
            self.number, self.bucket = {}, []


def trigrams(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)
    return (h >> 16).astype(np.int64) + BUCKETS


@dataclass
class Model:
    weights: np.ndarray  # per share of a bucket; words first, then trigrams
    bias: float
    slope: float
    offset: float

    def probability(self, word_mean: float, trigram_mean: float) -> float:
        return float(sigmoid(np.array(self.slope * (word_mean + trigram_mean + self.bias) + self.offset)))


CONSTANT = Model(np.zeros(2 * BUCKETS), 0.0, 0.0, 40.0)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, share, words = [], [], Words()
        for text in batch.column("text").to_pylist():
            raw = text.encode()
            w = words.of(raw.split())
            b = np.array(words.bucket, np.int64)[w] if len(w) else w
            t = trigrams(raw)
            i, n = np.unique(np.concatenate((b, t)), return_counts=True)
            top = np.sort(np.argsort(-n, kind="stable")[:FEATURES])
            i, n = i[top], n[top]
            index.append(i.astype(np.int32).tobytes())
            share.append((n / np.where(i < BUCKETS, max(1, len(b)), max(1, len(t)))).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), batch.column("weight"),
                                          pa.array(index, pa.binary()), pa.array(share, pa.binary())],
                                         names=["doc_id", "y", "weight", "index", "share"])


def fit(rows: list[tuple[int, float, np.ndarray, np.ndarray]], steps: int = 120, rate: float = 0.05, l2: float = 1e-4) -> Model:
    """Logistic regression on four fifths of the rows (label, weight, buckets, shares), Platt scaling on the last fifth.

    Rows of both classes are fitted, however few.
    """
    if len({r[0] for r in rows}) < 2:
        return CONSTANT
    y = np.array([r[0] for r in rows], float)
    weight = np.array([r[1] for r in rows])
    n = np.array([len(r[2]) for r in rows])
    row_of, starts = np.repeat(np.arange(len(rows)), n), np.cumsum(n) - n
    local, at = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
    share = np.concatenate([r[3] for r in rows]).astype(float)
    mean = np.bincount(at, weights=share) / len(rows)
    scale = 1 / np.sqrt(mean + 1e-5)  # rare buckets count for as much as frequent ones
    value = share * scale[at]
    fold = np.arange(len(rows)) % 5 == 4
    if len({*y[fold]}) < 2 or len({*y[~fold]}) < 2:  # a part without one of the classes says nothing: both steps take all rows
        fold[:] = True
    both = fold.all()
    use = np.where(fold & ~both, 0, weight)
    use = use / use.sum()

    def logits(x: np.ndarray) -> np.ndarray:
        return segment_sums(x[:-1][at] * value, starts) + x[-1]

    def gradient(x: np.ndarray) -> np.ndarray:
        g = use * (sigmoid(logits(x)) - y)
        return np.append(np.bincount(at, weights=g[row_of] * value, minlength=len(local)) + l2 * x[:-1], g.sum())

    x = adam(gradient, len(local) + 1, steps, rate)
    z = logits(x)[fold]
    yf, wf = y[fold], weight[fold] / weight[fold].sum()
    # Platt's targets keep the scaling finite where the classes separate.
    n1, n0 = (yf == 1).sum(), (yf == 0).sum()
    target = np.where(yf == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(float(z.std()), 1e-9)

    def platt(s: np.ndarray) -> np.ndarray:
        g = wf * (sigmoid(s[0] * z / spread + s[1]) - target)
        return np.array([(g * z / spread).sum(), g.sum()])

    slope, offset = adam(platt, 2, 500, 0.05)
    weights = np.zeros(2 * BUCKETS)
    weights[local] = x[:-1] * scale
    return Model(weights, float(x[-1]), float(slope / spread), float(offset))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, only=None) -> Model:
    """Fit on up to ``per_class`` labelled documents of each class."""
    sample = labelled_sample(documents, labels, "quality", per_class, only)
    rows = sample.mapInArrow(_shares, "doc_id long, y int, weight double, index binary, share binary").collect()
    rows.sort(key=lambda r: xxhash.xxh64_intdigest(str(r.doc_id)))
    return fit([(r.y, r.weight, np.frombuffer(r["index"], np.int32), np.frombuffer(r.share, np.float32)) for r in rows])


def describe(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document row: the base counts and the calibrated probability of good quality (``SCHEMA``)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, words = shared.value, Words()
        for ids, texts in rows_of(batches):
            words.trim()
            numbers = [words.of(t.split()) if t else np.zeros(0, np.int64) for t in texts]
            word_weight = m.weights[:BUCKETS][np.array(words.bucket, np.int64)] if words.bucket else np.zeros(0)
            out = []
            for doc_id, text, n in zip(ids, texts, numbers):
                t = trigrams(text or b"")
                p = m.probability(word_weight[n].mean() if len(n) else 0.0, m.weights[t].mean() if len(t) else 0.0)
                out.append((doc_id, len(n), *base_counts(text, n), p))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(),) * 6 + (pa.float64(),))],
                                             names=[c.split()[0] for c in SCHEMA.split(", ")])

    return id_text(documents).mapInArrow(run, SCHEMA)


def judge(described: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds base_failed and kept to the rows of ``describe``."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return described.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= threshold))
