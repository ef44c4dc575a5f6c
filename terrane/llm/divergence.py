"""Source divergence audit over a vocabulary held in minimal acyclic transducers.

1. Terms of whole texts are counted by document in each task, and the counts summed; a
   language keeps the terms in at least ``min_documents`` of its documents.
2. The kept terms are range-sorted and cut into bounded shards; each becomes a minimal
   acyclic transducer from terms to lexicographic ordinals (``automata``).
3. The texts are streamed through the transducers once more: all terms of a slice of text
   advance at once, and the ordinals they end with are counted by source.  Transducers are
   broadcast in blocks of bounded bytes, each with one pass over the texts.
4. Two reports compare the smoothed rates p = 1 + floor(SCALE * (count + 1) / (N + V)) by
   floor((p - q)^2 / q): every source with each other source of its language, summed over all
   kept terms; and every source's terms with the language itself, the ``top`` largest.
   Ties go by ordinal, which is the terms' byte order.

A pair's sum runs over blocks of consecutive ordinals and of at most about ``SOURCES``
sources a side, so no task holds a whole language; terms met in neither source are not
listed.  All arithmetic is on integers; counts too large for 64 bits go by Python's.

Defined results: NULL text, lang and source are ''; texts without terms still make their
source occur; a language without kept terms has pairs of value 0 and no terms; long texts
are read whole; every repeated row counts as a document of its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import automata
from .common import stored

SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
TOP = 200
CHUNK = 4096  # ordinals of a block of terms
SOURCES = 64  # sources of a block, on average
_FLUSH = 1 << 20  # counts that a task holds before it hands them on
_SLICE = 4 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_INSIDE = np.zeros(256, bool)
_INSIDE[97:123] = _INSIDE[128:] = True


def texts(documents: DataFrame) -> DataFrame:
    """lang, source and text as strings, NULLs as ''."""
    return documents.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _slices(batch: pa.RecordBatch, limit: int = _SLICE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row ranges of about ``limit`` text bytes with their lower-cased texts."""
    column = batch.column("text").cast(pa.binary())
    size = np.concatenate([[0], np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in column])])
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(size, size[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start), [(t or b"").translate(_LOWER) for t in column.slice(start, stop - start).to_pylist()]
        start = stop


def document_counts(documents: DataFrame) -> DataFrame:
    """(lang, term, n) with the number of documents of each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def flushed():
            for lang, found in held.items():
                terms = [t.decode("utf-8", "replace") for t in found]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.string()),
                                                  pa.array(list(found.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for batch in batches:
            for part, lowered in _slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), lowered):
                    held[lang].update(set(_TERM.findall(text)))
                if sum(map(len, held.values())) > _FLUSH:
                    yield from flushed()
        yield from flushed()

    return texts(documents).select("lang", "text").mapInArrow(count, "lang string, term string, n long").groupBy(
        "lang", "term").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1)
def _block(shared) -> automata.Block:
    return automata.Block(shared.value)


def recount(documents: DataFrame, shards: list[tuple]) -> DataFrame:
    """(lang, source, ordinal, count) of the terms that the transducers of one block accept."""
    shared = documents.sparkSession.sparkContext.broadcast(shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _block(shared)
        groups: dict[tuple[str, str], int] = {}
        codes, numbers, held = [], [], 0

        def flushed():
            found, inverse = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate(numbers)).astype(np.int64)
            which = pa.array(found >> 40)
            langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([langs.take(which), sources.take(which), pa.array(found & ((1 << 40) - 1)), pa.array(n)],
                                             ["lang", "source", "ordinal", "count"])

        for batch in batches:
            for part, lowered in _slices(batch):
                names = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
                for lang in {g[0] for g in names} & block.keys.keys():
                    rows = [i for i, g in enumerate(names) if g[0] == lang]
                    data = np.frombuffer(b"\0".join(lowered[i] for i in rows) + b"\0", np.uint8)
                    inside = _INSIDE[data]
                    edges = np.flatnonzero(np.diff(inside, prepend=False))
                    start, end = edges[::2], edges[1::2]
                    lengths = np.array([len(lowered[i]) + 1 for i in rows])
                    group = np.array([groups.setdefault(names[i], len(groups)) for i in rows], np.int64)
                    row = np.searchsorted(np.cumsum(lengths), start, "right")
                    for automaton, index, _, total in block.accepted(lang, data, start, end):
                        code, n = np.unique((group[row[index]] << 40) | (automaton.offset + total), return_counts=True)
                        codes.append(code)
                        numbers.append(n)
                        held += len(code)
                if held > _FLUSH or len(groups) > _FLUSH:
                    if codes:
                        yield from flushed()
                    codes, numbers, held = [], [], 0
                    groups.clear()
        if codes:
            yield from flushed()

    return texts(documents).mapInArrow(count, "lang string, source string, ordinal long, count long")


def _rate(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (n + v)) as long, exact for any count."""
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"),
                                       (n + v).cast("decimal(20,0)"))).cast("long")


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(counts: DataFrame, groups: DataFrame, chunk: int, sources: int) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of different sources of a language.

    ``groups``: lang, source, n, v.  A count goes to the blocks of its ordinals and of the pairs of
    source blocks that its source belongs to; every source takes part in every block of its own.
    """
    per_lang = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / sources)).cast("int").alias("nb"))
    side = F.pmod(F.xxhash64("source"), F.col("nb")).cast("int")
    everyone = groups.join(per_lang, "lang").withColumn("side", side)
    spread = lambda df: df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    head = everyone.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.lit(0).cast("long"), F.floor((F.col("v") - 1) / chunk)))))
    head = spread(head).select("lang", "chunk", "side", "other", "source", "n", "v", F.lit(None).cast("long").alias("ordinal"),
                               F.lit(None).cast("long").alias("count"))
    body = spread(counts.join(per_lang, "lang").withColumn("side", side)).select(
        "lang", F.floor(F.col("ordinal") / chunk).cast("long").alias("chunk"), "side", "other", "source",
        F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("v"), "ordinal", "count")
    rows = head.unionByName(body).withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))

    def sums(key, table):
        of_chunk = key[1].as_py()
        is_head = table.column("n").is_valid().to_numpy()
        names = np.array(table.column("source").to_pylist(), object)
        listed = names[is_head]
        place = {s: i for i, s in enumerate(listed)}
        n = table.column("n").filter(pa.array(is_head)).to_pylist()
        v = table.column("v").filter(pa.array(is_head)).to_pylist()
        blocks = table.column("side").to_numpy()[is_head]
        width = max(0, min(chunk, (v[0] if v else 0) - of_chunk * chunk))
        held = table.filter(pa.array(~is_head))
        big = (max(held.column("count").to_pylist(), default=0) + 1) * SCALE >= 1 << 63
        rate = np.zeros((len(listed), width), object if big else np.int64)
        row = np.array([place[s] for s in names[~is_head]], np.int64)
        rate[row, held.column("ordinal").to_numpy() - of_chunk * chunk] = held.column("count").to_numpy()
        total = np.array([a + b for a, b in zip(n, v)], object if big else np.int64).reshape(-1, 1)
        if width:
            rate = (1 + SCALE * (rate + 1) // total).astype(np.int64)
        a, b, value = [], [], []
        low, high = key[2].as_py(), key[3].as_py()
        for i, s in enumerate(listed):
            against = np.flatnonzero(blocks == (high if blocks[i] == low else low))
            against = against[against != i]
            d = rate[i] - rate[against]
            a += [s] * len(against)
            b += listed[against].tolist()
            value += (d * d // rate[against]).sum(axis=1, dtype=np.int64).tolist()
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "source": pa.array(a, pa.string()),
                         "item": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})

    found = rows.groupBy("lang", "chunk", "low", "high").applyInArrow(sums, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(df: DataFrame, by: Column, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), by)
    out = df.withColumn("rank", F.row_number().over(order))
    return out if top is None else out.where(F.col("rank") <= top)


def audit(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, chunk: int = CHUNK, sources: int = SOURCES,
          shard_bytes: int = automata.SHARD_BYTES, block_bytes: int = automata.BLOCK_BYTES) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank; see the module."""
    kept = stored(document_counts(documents).where(F.col("n") >= min_documents).select("lang", "term"), "kept-terms")
    terms = automata.numbered(kept, "lang", "term", shard_bytes)
    shards = automata.automata(terms, "lang", "term", automata.transducer)
    counted = None
    for block in automata.blocks(shards, "lang", block_bytes):
        rows = recount(documents, block)
        counted = rows if counted is None else counted.unionByName(rows)
    if counted is None:
        counted = documents.sparkSession.createDataFrame([], "lang string, source string, ordinal long, count long")
    counts = stored(counted.groupBy("lang", "source", "ordinal").agg(F.sum("count").alias("count")), "term-counts")

    seen = texts(documents).select("lang", "source").distinct()
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = stored(seen.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")), "groups")

    pairs = _ranked(_pair_sums(counts, groups, chunk, sources), F.col("item")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("count").alias("whole"))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("all_n"))
    rated = counts.join(whole, ["lang", "ordinal"]).join(groups, ["lang", "source"]).join(langs, "lang").select(
        "lang", "source", "ordinal", _rate(F.col("count"), F.col("n"), F.col("v")).alias("p"),
        _rate(F.col("whole"), F.col("all_n"), F.col("v")).alias("q"))
    best = _ranked(rated.where("p > q").select("lang", "source", "ordinal", _excess(F.col("p"), F.col("q")).alias("value")),
                   F.col("ordinal"), top)
    listed = best.join(terms.select("lang", "ordinal", F.col("term").alias("item")), ["lang", "ordinal"])
    return pairs.unionByName(listed.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
