"""Join helpers: broadcast only behind a size check, lookups with defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast on an explicit check (rows).  Above it the join is
# left to a shuffle join, which AQE may still turn into a broadcast at run time
# from measured stage sizes (spark.sql.adaptive.autoBroadcastJoinThreshold).
DEFAULT_BROADCAST_ROWS = 1_000_000


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only if it holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a LIMIT job), so it is cheap for
    seeds and small dimension tables.
    """
    if max_rows is None:
        from ..session import setting
        max_rows = setting(df.sparkSession, "broadcastRows", DEFAULT_BROADCAST_ROWS)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match each other (``<=>``); keys kept once."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])


def lookup(df: DataFrame, seed: DataFrame, on: str | Sequence[str],
           defaults: Mapping[str, Column] | None = None, max_rows: int | None = None,
           checked: bool = True) -> DataFrame:
    """Left join to a reference table; unmatched attributes take ``defaults``."""
    right = checked_broadcast(seed, max_rows) if checked else seed
    out = df.join(right, on, "left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out


BLOOM_BITS = 1 << 23  # one megabyte
BLOOM_HASHES = 1  # a condition in a scan computes the key anew for every use, which costs more than what more bits keep out


def _bloom_places(key_hash: Column, bits: int, hashes: int) -> list[Column]:
    """Places of a key from the two halves of its hash."""
    low = key_hash.bitwiseAND(F.lit(0xFFFFFFFF))
    return [F.pmod(low + i * F.shiftright(key_hash, 32) if i else low, F.lit(bits)) for i in range(hashes)]


def may_be_among(cols: Sequence[Column], keys: DataFrame, key_cols: Sequence[str], bits: int = BLOOM_BITS,
                 hashes: int = BLOOM_HASHES) -> Column:
    """Whether ``cols`` may be a row of ``keys``: a Bloom filter of bounded size, as a condition for a scan.

    False only for rows that are not among the keys (NULLs are values like others); an exact join must
    follow.  The bits are aggregated word by word and reach the scan as one scalar subquery, so rows that
    can't match never leave the task that reads them.  More keys than the bits can tell apart only let
    more rows pass.
    """
    hashed = keys.select(F.xxhash64(*key_cols).alias("h"))
    words = hashed.select(F.explode(F.array(*_bloom_places(F.col("h"), bits, hashes))).alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("b"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w")).join(words, "w", "left")
    filled = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).alias("b")))),
                                   lambda x: x["b"]).alias("bits")).scalar()
    cond = None
    for p in _bloom_places(F.xxhash64(*cols), bits, hashes):
        word, bit = F.get(filled, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")
        one = F.call_function("shiftright", word, bit).bitwiseAND(F.lit(1)) == 1
        cond = one if cond is None else cond & one
    return cond
