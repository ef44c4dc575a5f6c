"""Benchmark decontamination with suffix arrays of the training documents.

Every task cuts its documents into shards of a bounded number of words and
builds the suffix array of each shard: the starts of all suffixes that can match
at all, sorted by their words.  Words of no test item match nothing, so a suffix
is kept if its next words, up to the shortest window, all occur in the test
items; this drops no match.  Every test suffix is then binary-searched in the
array.  The interval found gives all its verbatim occurrences of a window's
length; occurrences on one diagonal join to the longest match of the item at
that place.  Nothing is shuffled: a document's answer is complete in its task.

The test items travel as broadcast blocks.  Items are read block by block, each
bounded by ``block_bytes`` of text, so neither the driver nor a task ever holds
more than one decoded block.

Defined results: a NULL or wordless text has no words and no hits; an item that
is NULL or wordless matches nothing; an item with a NULL id is hit but not
listed; repeated rows each get their row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, rows_of

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20

# A-Z to a-z; what is neither a digit, a letter nor beyond ASCII becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = ("doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start:long,length:long>>, "
          "matches array<struct<item_id:long,item_word:long,doc_word:long,n_words:long>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
    ("matches", pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "item_word", "doc_word", "n_words")])))])


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def _keys(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The next ``depth`` codes from each start as fixed-width bytes that sort as the code sequences do."""
    at = starts[:, None] + np.arange(depth)
    taken = codes[np.minimum(at, len(codes) - 1)]
    taken[at >= len(codes)] = 0
    return np.ascontiguousarray(taken.astype(">u4")).view(f"S{4 * depth}").ravel()


def build_block(items: list[tuple[int | None, bytes | None]], window: int = WINDOW) -> dict:
    """Test items as arrays: vocabulary, and per length the distinct windows with all their places."""
    classes: dict[tuple[bytes, ...], set] = {}
    for item_id, text in items:
        w = tuple(words(text))
        if w:
            classes.setdefault(w, set()).add(item_id)
    vocab: dict[bytes, int] = {}
    places: dict[int, list[tuple[int, int]]] = {}
    codes = []
    for k, w in enumerate(classes):
        c = np.array([vocab.setdefault(x, len(vocab) + 1) for x in w], dtype=np.uint32)
        size = min(window, len(w))
        places.setdefault(size, []).extend((k, p) for p in range(len(w) - size + 1))
        codes.append(c)
    base = np.cumsum([0] + [len(c) for c in codes])
    flat = np.concatenate(codes) if codes else np.zeros(1, np.uint32)
    windows = {}
    for size, at in places.items():
        cls, off = (np.array(x, dtype=np.int64) for x in zip(*at))
        keys, inverse = np.unique(_keys(flat, base[cls] + off, size), return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        windows[size] = (keys, np.searchsorted(inverse[order], np.arange(len(keys) + 1)), cls[order], off[order])
    return {"vocab": vocab, "windows": windows, "ids": [sorted(i for i in s if i is not None) for s in classes.values()]}


@lru_cache(maxsize=1)
def _decoded(packed: bytes) -> dict:
    return pickle.loads(zlib.decompress(packed))


def search_shard(shard: list[list[bytes]], block: dict) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int, int]]]:
    """Search every test suffix in the suffix array of ``shard`` (documents as word lists).

    Returns the first word of each document in the shard's word sequence (one
    separator after each document), a hit flag per word, and the longest match
    of each (document, item class): (document, class, item word, document word, words).
    """
    get = block["vocab"].get
    lengths = np.array([len(w) + 1 for w in shard], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    codes = np.zeros(int(lengths.sum()), np.uint32)
    for s, w in zip(starts.tolist(), shard):
        codes[s:s + len(w)] = np.fromiter(map(get, w, repeat(0)), np.uint32, len(w))
    hit = np.zeros(len(codes), bool)
    if not block["windows"]:
        return starts, hit, []
    gaps = np.flatnonzero(codes == 0)
    known = np.flatnonzero(codes)
    run = gaps[np.searchsorted(gaps, known)] - known  # known words from here on; a separator ends every document
    kept = known[run >= min(block["windows"])]
    depth = max(block["windows"])
    keys = _keys(codes, kept, depth)
    order = np.argsort(keys, kind="stable")
    array, keys = kept[order], keys[order]
    found = []
    for size, (tests, csr, cls, off) in block["windows"].items():
        pad = 4 * (depth - size)
        raw = tests.view("u1").reshape(len(tests), 4 * size)
        low, high = (np.ascontiguousarray(np.pad(raw, ((0, 0), (0, pad)), constant_values=v)).view(keys.dtype).ravel()
                     for v in (0, 255))
        lo, hi = np.searchsorted(keys, low, "left"), np.searchsorted(keys, high, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(tests)), n)
        pos = array[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        mark = np.zeros(len(codes) + 1, np.int64)
        np.add.at(mark, pos, 1)
        np.add.at(mark, np.minimum(pos + size, len(codes)), -1)
        hit |= np.cumsum(mark)[:-1] > 0
        m = csr[which + 1] - csr[which]
        t = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(csr[which], m)
        found.append((cls[t], off[t], np.repeat(pos, m), np.full(len(t), size)))
    c, o, q, size = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((q, q - o, c))
    c, o, q, size = c[by], o[by], q[by], size[by]
    first = np.ones(len(c), bool)
    first[1:] = (c[1:] != c[:-1]) | (q[1:] - o[1:] != q[:-1] - o[:-1]) | (q[1:] != q[:-1] + 1)
    head = np.flatnonzero(first)
    length = np.diff(np.append(head, len(c))) + size[head] - 1
    doc = np.searchsorted(starts, q[head], "right") - 1
    by = np.lexsort((q[head], -length, c[head], doc))
    d, k = doc[by], c[head][by]
    best = by[np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))] if len(by) else by
    return starts, hit, list(zip(doc[best].tolist(), c[head][best].tolist(), o[head][best].tolist(),
                                 (q[head][best] - starts[doc[best]]).tolist(), length[best].tolist()))


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


def _shard_rows(ids: list, shard: list[list[bytes]], blocks: list) -> pa.RecordBatch:
    hits, items, matches = None, [set() for _ in ids], [[] for _ in ids]
    starts = np.zeros(0, np.int64)
    for packed in blocks:
        block = _decoded(packed.value)
        starts, hit, best = search_shard(shard, block)
        hits = hit if hits is None else hits | hit
        for doc, cls, item_word, doc_word, n in best:
            own = block["ids"][cls]
            items[doc].update(own)
            matches[doc] += [{"item_id": i, "item_word": item_word, "doc_word": doc_word, "n_words": n} for i in own]
    spans = [_runs(hits[s:s + len(w)]) for s, w in zip(starts.tolist(), shard)]
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(
        (ids, [len(w) for w in shard], [sum(r["length"] for r in s) for s in spans],
         [sorted(i) for i in items], spans, matches), _ARROW)], schema=_ARROW)


def _broadcast_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    blocks = []
    for b in range(n):  # each about block_bytes of text, or one item
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        block = build_block([(r[0], r[1].encode() if r[1] is not None else None) for r in part], window)
        blocks.append(benchmark.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(block), 1)))
    return blocks


def _shards(slices: Iterator[tuple[list, list[bytes | None]]], shard_words: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids, shard, size = [], [], 0
    for some_ids, texts in slices:
        for doc_id, text in zip(some_ids, texts):
            w = words(text)
            ids.append(doc_id)
            shard.append(w)
            size += len(w) + 1
            if size >= shard_words:
                yield ids, shard
                ids, shard, size = [], [], 0
    if ids:
        yield ids, shard


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: its words, hit words, items found, hit spans and longest matches (``SCHEMA``)."""
    blocks = _broadcast_blocks(benchmark, window, block_bytes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, shard in _shards(rows_of(batches), shard_words):
            yield _shard_rows(ids, shard, blocks)

    return id_text(documents).mapInArrow(search, SCHEMA)


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows without any test window, all their columns kept; no shuffle, so rows that share an id are judged alone."""
    blocks = _broadcast_blocks(benchmark, window, block_bytes)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            raw = [t.encode() if t is not None else None for t in texts]
            for ids, shard in _shards(iter([(raw, raw)]), shard_words):
                hit = np.zeros(len(shard), bool)
                for packed in blocks:
                    starts, flags, _ = search_shard(shard, _decoded(packed.value))
                    hit |= np.logical_or.reduceat(flags, starts) if len(flags) else False
                out.append(~hit)
            yield pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return documents.where(clean(F.col("text").cast("string")))
