"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link if they differ in at most ``max_bits`` bits.  Cut
into ``max_bits // 2 + 1`` segments, at least one segment of a linked pair
differs in at most one bit.  Each distinct fingerprint is therefore indexed
under every segment with every single bit of it left out (64 one-wildcard
variants in all): two segments at most one bit apart share such a variant.
An equality join on the variant finds the candidates, a bit count verifies them.

Copies collapse to one fingerprint before the index is built.  Inside a variant's
group only the edges of a spanning forest are written, never all pairs: each
group is searched breadth first against what is still unreached, so a group of m
near copies gives at most m - 1 edges and the same components.  Groups above
``group_limit`` are dealt out as pairs of blocks (each member meets each other
member in one task), so no task holds an unbounded group and no link is lost.

Components come from alternating large-star and small-star steps on the edges,
each step a written table.

Defined results: NULL, empty and wordless texts have fingerprint zero and link
like any other; repeated rows each get their row; a NULL doc_id takes part but
never names a component unless the whole component has no id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_text, stored

SHINGLE = 4
MAX_BITS = 4
GROUP_LIMIT = 4096
SEED = 42
_U64 = (1 << 64) - 1


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of ``size`` words (all words if there are fewer), repeats included."""
    w = text.lower().split()  # ASCII letters and ASCII white space only, as these are bytes
    if not w:
        return []
    joined, hash64 = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= size:
        return [hash64(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    return [hash64(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def fingerprints(texts: list[bytes | None], size: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text: a bit is set if more than half of its shingle hashes set it."""
    out = np.zeros(len(texts), np.uint64)
    hashes, rows, counts = [], [], []

    def close() -> None:
        if hashes:
            bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
            n = np.array(counts)
            ones = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int32)
            packed = np.packbits(ones * 2 > n[:, None], axis=1)
            out[np.array(rows)] = packed.view(">u8").ravel()
            hashes.clear(), rows.clear(), counts.clear()

    for i, text in enumerate(texts):
        h = shingle_hashes(text, size) if text else []
        if h:
            hashes.extend(h)
            rows.append(i)
            counts.append(len(h))
            if len(hashes) > 200_000:
                close()
    close()
    return out


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """Signed 64-bit fingerprint of a text column, in Arrow batches."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(fingerprints([t.encode() if t else None for t in s], size).view(np.int64))

    return of(text.cast("string"))


def segments(max_bits: int = MAX_BITS) -> list[range]:
    """Bit ranges such that one of them differs by at most one bit if at most ``max_bits`` bits differ."""
    k = max_bits // 2 + 1
    cut = [64 * i // k for i in range(k + 1)]
    return [range(a, b) for a, b in zip(cut, cut[1:])]


def _bit(i: int) -> int:
    return (1 << i) - (1 << 64 if i == 63 else 0)


def _mask(bits: range, but: int | None = None) -> int:
    m = sum(1 << b for b in bits if b != but)
    return m - (1 << 64) if m >> 63 else m


def variants(fp: Column, max_bits: int = MAX_BITS) -> Column:
    """Array of (bit left out, segment without it) for every segment and each of its bits."""
    return F.array(*[F.struct(F.lit(b).alias("bit"), fp.bitwiseAND(F.lit(_mask(seg, b)).cast("long")).alias("part"))
                     for seg in segments(max_bits) for b in seg])


def spanning_edges(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the link graph of distinct fingerprints, by breadth-first search."""
    rest, a, b = fps, [], []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached = []
            for i in range(0, len(front), 128):
                if not len(rest):
                    break
                part = front[i:i + 128]
                near = np.bitwise_count(part[:, None] ^ rest[None, :]) <= max_bits
                got = near.any(axis=0)
                if got.any():
                    a.append(part[near[:, got].argmax(axis=0)])
                    b.append(rest[got])
                    reached.append(rest[got])
                    rest = rest[~got]
            front = np.concatenate(reached) if reached else front[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def _edges_of_groups(max_bits: int):
    """mapInArrow body over rows (g, fp) sorted by g: verified spanning edges of each group."""
    small = 8

    def edges(g: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        size = np.diff(np.append(head, len(g)))
        a, b = [], []
        own = np.repeat(size, size)
        for d in range(1, small):
            i = np.flatnonzero((g[d:] == g[:-d]) & (own[d:] <= small))
            near = np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits
            a.append(fp[i[near]])
            b.append(fp[i[near] + d])
        for h, n in zip(head[size > small].tolist(), size[size > small].tolist()):
            x, y = spanning_edges(np.unique(fp[h:h + n]), max_bits)
            a.append(x)
            b.append(y)
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.zeros(0, np.int64), np.zeros(0, np.uint64))

        def out(g, fp):
            a, b = edges(g, fp)
            differ = a != b
            lo, hi = np.minimum(a, b)[differ].view(np.int64), np.maximum(a, b)[differ].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], names=["a", "b"])

        for batch in batches:
            g = np.concatenate((kept[0], batch.column("g").to_numpy()))
            fp = np.concatenate((kept[1], batch.column("fp").to_numpy().view(np.uint64)))
            if not len(g):
                continue
            last = int(np.searchsorted(g, g[-1], "left"))  # the last group may go on in the next batch
            if last:
                yield out(g[:last], fp[:last])
            kept = (g[last:], fp[last:])
        if len(kept[0]):
            yield out(*kept)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of ``fps`` (column fp) that keep every component connected."""
    key = F.xxhash64("v.bit", "v.part")
    index = fps.select("fp", F.explode(variants(F.col("fp"), max_bits)).alias("v")).select(key.alias("key"), "fp")
    # A variant's group is as large as its two segment values: counting three segments instead of 64 variants finds the large ones.
    segs = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(s[0]).alias("seg"),
                                                         F.col("fp").bitwiseAND(F.lit(_mask(s)).cast("long")).alias("value"))
                                                for s in segments(max_bits)])).alias("s"))
    hot = segs.groupBy("s.seg", "s.value").count().where(F.col("count") * 2 > group_limit)
    around = F.coalesce(*[F.when(F.col("seg") == s[0], F.array(*[F.struct(F.lit(b).alias("bit"), F.col("value").bitwiseAND(
        F.lit(_mask(s, b)).cast("long")).alias("part")) for b in s])) for s in segments(max_bits)])
    # Two segment values share a variant at most, and the rarer one holds up to half the limit.
    hot = hot.select("count", F.explode(around).alias("v")).groupBy(key.alias("key")).agg(
        (F.sum("count") + F.lit(group_limit // 2)).alias("n")).select(
        "key", F.ceil(F.col("n") * 2 / group_limit).cast("int").alias("blocks"))
    dealt = index.join(hot, "key", "left")
    block = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks").isNull(), F.array(F.col("key"))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.xxhash64("key", F.least(block, j), F.greatest(block, j))))
    groups = dealt.select(F.explode(pairs).alias("g"), "fp")
    sorted_groups = groups.repartition(F.col("g")).sortWithinPartitions("g")
    return sorted_groups.mapInArrow(_edges_of_groups(max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): alternating large-star and small-star until nothing changes."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "simhash-edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(low, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(low, F.col("a") == F.col("n"))
        now = stored(small.select("a", F.col("m").alias("b")).unionByName(
            small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(),
            "simhash-stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def classes(prints: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(fp, component_id, root) of every distinct fingerprint of ``prints`` (doc_id, fp).

    ``root`` is a fingerprint of the class and tells classes apart that have the same component_id.
    """
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    roots = components(links(nodes.select("fp"), max_bits, group_limit))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(names, "root").select("fp", "component_id", "root")


def _classified(documents: DataFrame, size: int, max_bits: int, group_limit: int) -> DataFrame:
    """One row per document row: doc_id, fp, component_id, root."""
    prints = stored(id_text(documents).select("doc_id", fingerprint(F.col("text"), size).alias("fp")), "simhash-docs")
    found = classes(prints, max_bits, group_limit).withColumnRenamed("fp", "_fp")
    return prints.join(found, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id", "root")


def near_duplicates(documents: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS,
                    group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document row: doc_id, fp (signed fingerprint), component_id (smallest doc_id reachable)."""
    return _classified(documents, size, max_bits, group_limit).select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_class(documents: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS,
                  group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Documents with one row left of each class: the row of its smallest doc_id, all columns kept.

    Rows that repeat that doc_id within the class count as its copies: one stays.
    A class whose rows all lack an id keeps one row.
    """
    found = _classified(documents, size, max_bits, group_limit)
    name = free_name(documents, "_kept_id")
    own_id = documents["doc_id"].cast("long")
    names_class = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(names_class).alias("names")).where("names").select(
        F.col("doc_id").alias(name), "n")
    kept = stored(kept, "simhash-kept")
    columns = documents.columns
    n = free_name(documents, "_kept_rows")
    # Both sides grow with the documents: a shuffled merge join at every size.
    joined = documents.join(kept.withColumnRenamed("n", n).hint("merge"), own_id == F.col(name), "inner")
    several, nameless = kept.where("n > 1").take(1), kept.where(F.col(name).isNull()).take(1)
    if not several and not nameless:
        return joined.select(*[documents[c] for c in columns])
    # Ids that are repeated or missing don't tell rows apart: of each class that such an id names, the rows of one fingerprint do.
    again = joined.where(F.col(n) > 1).select(*[documents[c] for c in columns], name)
    if nameless:
        again = again.unionByName(documents.where(own_id.isNull()).withColumn(name, F.lit(None).cast("long")))
    fp = free_name(documents, "_kept_fp")
    again = again.withColumn(fp, fingerprint(F.col("text"), size)).dropDuplicates([name, fp])
    by = found.where(names_class).groupBy("root", F.col("doc_id").alias(fp + "i")).agg(F.min("fp").alias(fp + "f")).drop("root")
    again = again.join(by, (F.col(fp) == F.col(fp + "f")) & F.col(name).eqNullSafe(F.col(fp + "i")))
    return joined.where(F.col(n) == 1).select(*[documents[c] for c in columns]).unionByName(again.select(*columns))
