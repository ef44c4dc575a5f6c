"""Repeated passages by sparse suffix arrays.

A full suffix array of the corpus would hold every word position.  Here a text
keeps only the suffixes that start at minimisers: in every window of
``min_words`` words, the position of the smallest hash of ``seed`` consecutive
words.  Two occurrences of a passage of ``min_words`` words keep the suffix at
the same place of it, so nothing is missed, and about one position in twenty is
kept.

The kept suffixes of all texts are sorted by their first ``seed`` words and then
by their surroundings: a range-partitioned sort over all columns, so that a very
common passage spreads over as many tasks as its rows need.  Each row is compared with
its neighbours; the first and last row of every task are compared across tasks
afterwards.  A suffix that shares its seed with a neighbour may lie in a repeated
passage and is extended to the left and right:

- if a neighbour's words agree from ``min_words - seed`` words before the seed to as
  many after it, every window that belongs to the suffix is repeated;
- the other suffixes of such a seed are at the ends of matches: each of their windows is
  hashed, and the windows' hashes are sorted and compared with their neighbours in the
  same way.

Repeated windows that overlap join to maximal passages.  A word is in a result
passage exactly if a window of ``min_words`` words around it occurs a second time, in
another text or in the same one.

Words are separated by ASCII white space and compared as they are.  Defined
results: NULL, empty and shorter texts have no passage; repeated rows are copies
of each other; a text may contain its own repeats; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text, stored, utf8

MIN_WORDS = 50
SEED = 12
CHUNK_WORDS = 1 << 19
SALTS = 8
_CACHE = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15)
_POSITION = np.uint64((1 << 24) - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        v = self[word] = xxhash.xxh64_intdigest(word) | 1  # 0 stands for "beyond the text"
        return v


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_hash(h: np.ndarray, starts: np.ndarray | slice, size: int, n: int | None = None) -> np.ndarray:
    """Hash of the ``size`` words from each start (all starts 0 .. n - 1 if n is given)."""
    if n is not None:
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * _P + h[j:j + n]
    else:
        out = np.zeros(len(starts), np.uint64)
        for j in range(size):
            out = out * _P + h[starts + j]
    return _mix(out)


def _laid_out(texts: list[list[bytes]], hashes: _Hashes, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the texts one after another, ``pad`` zeros around each; start and length of each."""
    if len(hashes) > _CACHE:
        hashes.clear()
    lengths = np.array([len(w) for w in texts], np.int64)
    starts = np.cumsum(lengths + pad) - lengths
    h = np.zeros(int(lengths.sum()) + pad * (len(texts) + 1), np.uint64)
    get = hashes.__getitem__
    for s, w in zip(starts.tolist(), texts):
        h[s:s + len(w)] = np.fromiter(map(get, w), np.uint64, len(w))
    return h, starts, lengths


def minimisers(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray, min_words: int, seed: int):
    """(text, position, first window, windows, key) of every kept suffix.

    The windows of a suffix are the ``min_words``-word windows whose smallest seed hash it holds.
    """
    span = min_words - seed + 1
    n = len(h) - seed + 1
    grams = _window_hash(h, slice(None), seed, n)
    # High bits order by hash, low bits by place: the leftmost of equal seeds in a window.
    low = (_mix(grams + np.uint64(1)) & ~_POSITION) | (np.arange(n, dtype=np.uint64) & _POSITION)
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    text = np.repeat(np.arange(len(starts)), np.maximum(lengths - min_words + 1, 0))
    counts = np.maximum(lengths - min_words + 1, 0)
    first = np.repeat(starts, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.int64(int(_POSITION) + 1)
    at = (low[first] & _POSITION).astype(np.int64)
    at = first + (at - first) % base  # the layout may be longer than the place bits
    head = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]))) if len(at) else np.zeros(0, np.int64)
    return text[head], at[head], first[head], np.diff(np.append(head, len(at))), grams[at[head]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _chunks(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...]) -> Iterator[tuple[dict[str, list], list[list[bytes]]]]:
    columns, texts, size = {c: [] for c in extra}, [], 0
    for batch in batches:
        for row in zip(utf8(batch.column("text")), *(batch.column(c).to_pylist() for c in extra)):
            w = row[0].split() if row[0] else []
            texts.append(w)
            for c, v in zip(extra, row[1:]):
                columns[c].append(v)
            size += len(w)
            if size >= CHUNK_WORDS:
                yield columns, texts
                columns, texts, size = {c: [] for c in extra}, [], 0
    if texts:
        yield columns, texts


def suffixes(documents: DataFrame, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Kept suffixes: uid (of id and text), doc_id, first window, number of windows, key (seed), ctx (surroundings)."""
    around = min_words - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for columns, texts in _chunks(batches, ("uid", "doc_id")):
            h, starts, lengths = _laid_out(texts, hashes, around)
            text, at, first, n, key = minimisers(h, starts, lengths, min_words, seed)
            ctx = _window_hash(h, at - around, min_words + around)
            uid = pa.array(columns["uid"], pa.int64()).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [uid, pa.array(columns["doc_id"], pa.int64()).take(pa.array(text)), pa.array((first - starts[text]).astype(np.int32)),
                 pa.array(n.astype(np.int32)), _signed(key), _signed(ctx)], names=["uid", "doc_id", "first", "n", "key", "ctx"])

    return _texts(documents).mapInArrow(run, "uid long, doc_id long, first int, n int, key long, ctx long")


def _texts(documents: DataFrame) -> DataFrame:
    return id_text(documents).select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")


def repeated_neighbours(rows: DataFrame, name: str) -> DataFrame:
    """The rows (uid, doc_id, first, n, key, ctx) whose key occurs again, with same_ctx (their ctx occurs again) and the
    doc_id of a neighbour: sorted over all tasks, compared row by row."""
    order = ["key", "ctx", "doc_id", "uid", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def compared(table: pa.Table, before, last: bool) -> pa.Table:
            """Flags of all rows of ``table`` but, unless ``last``, the last one; ``before``: the row before."""
            key, ctx = table.column("key").to_numpy(), table.column("ctx").to_numpy()
            doc, known = table.column("doc_id").fill_null(0).to_numpy(), table.column("doc_id").is_valid().to_numpy()
            same_key, same_ctx = key[1:] == key[:-1], (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1])
            first = before is not None and before[0] == key[0]
            k_prev = np.append(first, same_key)
            c_prev = np.append(first and before[1] == ctx[0], same_ctx)
            k_next, c_next = np.append(same_key, False), np.append(same_ctx, False)
            use_prev = c_prev | (k_prev & ~c_next)
            prev = np.append(before[2] if before is not None else 0, doc[:-1])
            prev_known = np.append(before is not None and before[3], known[:-1])
            other = np.where(use_prev, prev, np.append(doc[1:], 0))
            other_known = np.where(use_prev, prev_known, np.append(known[1:], False)) & (k_prev | k_next)
            edge = np.zeros(len(key), bool)
            edge[0] = before is None
            edge[-1] |= last
            out = table.append_column("same_ctx", pa.array(c_prev | c_next)).append_column("edge", pa.array(edge))
            out = out.append_column("other_doc_id", pa.array(other, pa.int64(), mask=~other_known))
            keep = k_prev | k_next | edge
            keep[-1] &= last
            return out.append_column("same_key", pa.array(k_prev | k_next)).filter(pa.array(keep))

        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            yield from compared(table, before, False).to_batches()
            if table.num_rows > 1:
                key, ctx, doc = (table.column(c)[table.num_rows - 2].as_py() for c in ("key", "ctx", "doc_id"))
                before = (key, ctx, doc or 0, doc is not None)
            held = table.slice(table.num_rows - 1)
        if held is not None:
            yield from compared(held, before, True).to_batches()

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", same_ctx boolean, edge boolean, other_doc_id long, same_key boolean"
    flagged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, out), name)
    # The first and the last row of each task, compared with those of the other tasks: at most two rows a task.
    edges = flagged.where("edge")
    by_key = edges.groupBy("key").agg(F.count("*").alias("_kn"), F.min("doc_id").alias("_kd")).withColumnRenamed("key", "_k")
    by_ctx = edges.groupBy("key", "ctx").agg(F.count("*").alias("_cn"), F.min("doc_id").alias("_cd")).select(
        F.col("key").alias("_ck"), F.col("ctx").alias("_cc"), "_cn", "_cd")
    met = edges.join(by_key, F.col("key") == F.col("_k")).join(by_ctx, (F.col("key") == F.col("_ck")) & (F.col("ctx") == F.col("_cc")))
    columns = [*rows.columns, "same_ctx", "other_doc_id"]
    met = met.where("same_key OR _kn > 1").withColumn("same_ctx", F.col("same_ctx") | (F.col("_cn") > 1)).withColumn(
        "other_doc_id", F.coalesce("other_doc_id", F.when(F.col("_cn") > 1, F.col("_cd")), "_kd")).select(*columns)
    return flagged.where("NOT edge AND same_key").select(*columns).unionByName(met)


def window_hashes(documents: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """One row per window of the ``wanted`` suffixes (uid, runs of (first, n)): uid, doc_id, first, n = 1, key (window hash), ctx = 0.

    Equal rows (repeated documents) ask for a window once; each of their texts gives it.
    """
    by_text = wanted.groupBy("uid").agg(F.flatten(F.collect_list("runs")).alias("runs"))  # at most a text's windows
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for columns, texts in _chunks(batches, ("uid", "doc_id", "runs")):
            h, starts, lengths = _laid_out(texts, hashes, 0)
            if not len(h):
                continue
            text = np.concatenate([np.full(len(r), i) for i, r in enumerate(columns["runs"])])
            first = np.array([x["first"] for r in columns["runs"] for x in r], np.int64)
            n = np.array([x["n"] for r in columns["runs"] for x in r], np.int64)
            at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            text = np.repeat(text, n)
            key = _window_hash(h, starts[text] + at, min_words)
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns["uid"], pa.int64()).take(take), pa.array(columns["doc_id"], pa.int64()).take(take),
                 pa.array(at.astype(np.int32)), pa.array(np.ones(len(at), np.int32)), _signed(key), pa.array(np.zeros(len(at), np.int64))],
                names=["uid", "doc_id", "first", "n", "key", "ctx"])

    joined = _texts(documents).join(by_text.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid")).drop("_uid")
    return joined.mapInArrow(run, "uid long, doc_id long, first int, n int, key long, ctx long")


def repeated_passages(documents: DataFrame, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per maximal repeated passage of each document: doc_id, start_word, n_words, other_doc_id (a text that
    shares a part of it; the document itself if only that repeats it)."""
    kept = stored(suffixes(documents, min_words, seed), "suffix-kept")
    same = stored(repeated_neighbours(kept, "suffix-sorted"), "suffix-same")
    # A text may hold one seed thousands of times and a third of the texts may share it: a row per text and seed, salted.
    ends = same.where("NOT same_ctx").select(F.col("key").alias("_key")).distinct().withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by_seed = same.groupBy("uid", "key").agg(F.collect_set(F.struct("first", "n")).alias("runs"))
    salt = F.pmod("uid", F.lit(SALTS))
    wanted = by_seed.join(ends, (F.col("key") == F.col("_key")) & (salt == F.col("_salt")), "left_semi")
    windows = window_hashes(documents, wanted, min_words)
    again = repeated_neighbours(windows, "suffix-windows")
    runs = same.where("same_ctx").unionByName(again.withColumn("same_ctx", F.lit(True))).select(
        "uid", "doc_id", F.col("first").alias("a"), (F.col("first") + F.col("n") - 1 + min_words).alias("b"), "other_doc_id")
    by_text = W.partitionBy("uid", "doc_id").orderBy("a", "b")  # a text's own runs
    before = F.max("b").over(by_text.rowsBetween(W.unboundedPreceding, -1))
    islands = runs.withColumn("new", F.when(F.col("a") <= before, 0).otherwise(1)).withColumn("island", F.sum("new").over(by_text))
    other = F.coalesce(F.min(F.when(~F.col("other_doc_id").eqNullSafe(F.col("doc_id")), F.col("other_doc_id"))), F.min("other_doc_id"))
    return islands.groupBy("uid", "doc_id", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"), other.alias("other_doc_id")).select(
        "doc_id", F.col("a").cast("long").alias("start_word"), (F.col("b") - F.col("a")).cast("long").alias("n_words"), "other_doc_id")
