"""K-d tree partitioning into shards of near-equal bytes.

Starting from all rows, every node is split at the weighted median (by bytes) of
its widest metadata dimension, until each leaf has its share.  A level handles
all its nodes at once and needs three aggregations that combine before the
shuffle: the extent of each dimension per node, a histogram of the chosen
dimension, and a histogram of a row hash inside the histogram bin that holds the
median.  Rows of that bin (for instance all rows of one hot source) are ordered
by the hash, so equal values are split as finely as the median asks and no group
is moved as a whole.  Nothing but one row per node and bin is ever gathered.

Every level uses a hash of its own, so a value of any weight is spread over as many
leaves as its bytes ask for.  The median divides a node's bytes by the leaves of its two
sides, so any number of leaves works; ``leaves_for`` gives the number for a target size.

Defined results: a NULL text has size 1 and crc32 0; a NULL in a dimension lies
at its low end; repeated rows are separate rows; a long text counts by its bytes and is
never cut; an empty table gives no rows; columns other than the dimensions are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

BINS = 4096


def text_position(c: Column) -> Column:
    """An order-preserving number of a text: its first six UTF-8 bytes."""
    return F.conv(F.substring(F.rpad(F.hex(c.cast("string").cast("binary")), 12, "0"), 1, 12), 16, 10).cast("double")


def points(documents: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """Skinny rows: doc_id, size, text_crc32, the dimensions as doubles d0.., and a hash unique to the row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.coalesce(c.cast("double"), F.lit(None).cast("double")).alias(f"d{i}") for i, c in enumerate(dimensions.values())],
        F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("tie", F.xxhash64("doc_id", "text_crc32", "row")).drop("row")


def leaves_for(total_bytes: int, target_bytes: int) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))


def _crossing(histogram: DataFrame, bin_col: str, need: Column) -> DataFrame:
    """Per node the first bin at which the running weight reaches ``need``, and the weight before it."""
    w = W.partitionBy("node").orderBy(bin_col)
    run = histogram.withColumn("until", F.sum("w").over(w))
    return run.where(F.col("until") >= need).groupBy("node").agg(F.min(F.struct(bin_col, (F.col("until") - F.col("w")).alias("before"))).alias("x"))


def _split(rows: DataFrame, dims: int, extents: list[float], level: int) -> DataFrame:
    """One level: every node with more than one leaf is divided in two.

    Each level orders ties by a hash of its own, so what an earlier level has cut is cut as finely again.
    """
    tie = F.pmod(F.xxhash64("tie", F.lit(level)), F.lit(BINS)).cast("int")
    stats = rows.where("quota > 1").groupBy("node", "quota").agg(
        F.sum("size").alias("total"), *[f(f"d{i}").alias(f"{n}{i}") for i in range(dims) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    widths = F.array(*[F.coalesce((F.col(f"hi{i}") - F.col(f"lo{i}")) / F.lit(extents[i] or 1.0), F.lit(0.0)) for i in range(dims)])
    pick = F.array_position(widths, F.array_max(widths)).cast("int") - 1
    # One row per node: bounded by the number of leaves.
    cut = stats.withColumn("dim", pick).select(
        "node", F.col("quota").alias("leaves"), "dim", F.get(F.array(*[F.col(f"lo{i}") for i in range(dims)]), F.col("dim")).alias("lo"),
        F.get(F.array(*[F.col(f"hi{i}") for i in range(dims)]), F.col("dim")).alias("hi"),
        (F.col("total") * F.floor(F.col("quota") / 2) / F.col("quota")).alias("need"))
    cut = stored(cut, "kd-cut")
    at = F.get(F.array(*[F.col(f"d{i}") for i in range(dims)]), F.col("dim"))
    place = F.when(F.col("hi") > F.col("lo"), F.floor((at - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)).otherwise(F.lit(0))
    placed = rows.join(F.broadcast(cut), "node").withColumn("bin", F.coalesce(F.least(place, F.lit(BINS - 1)), F.lit(-1)).cast("int")).withColumn(
        "tie_bin", tie)
    first = _crossing(placed.groupBy("node", "need", "bin").agg(F.sum("size").alias("w")), "bin", F.col("need")).select(
        "node", F.col("x.bin").alias("cut_bin"), F.col("x.before").alias("before"))
    first = stored(first, "kd-bin")
    inside = placed.join(F.broadcast(first), "node").where("bin = cut_bin")
    rest = F.col("need") - F.col("before")
    ties = inside.groupBy("node", "need", "before", "tie_bin").agg(F.sum("size").alias("w"))
    second = _crossing(ties.withColumn("need", rest), "tie_bin", F.col("need")).select(
        "node", F.col("x.tie_bin").alias("cut_tie"), F.col("x.before").alias("tie_before"))
    mine = ties.join(second, "node").where("tie_bin = cut_tie").select(
        "node", "cut_tie", (F.col("tie_before") + F.col("w") - rest <= rest - F.col("tie_before")).alias("last_left"))
    final = stored(first.join(mine, "node").select("node", "cut_bin", "cut_tie", "last_left"), "kd-final")
    both = rows.join(F.broadcast(cut.select("node", "leaves", "dim", "lo", "hi")), "node", "left").join(F.broadcast(final), "node", "left")
    bin_now = F.coalesce(F.least(place, F.lit(BINS - 1)), F.lit(-1))
    right = (bin_now > F.col("cut_bin")) | ((bin_now == F.col("cut_bin")) & (
        (tie > F.col("cut_tie")) | ((tie == F.col("cut_tie")) & ~F.col("last_left"))))
    left_leaves = F.floor(F.col("quota") / 2).cast("int")
    split = F.col("leaves").isNotNull()
    return both.select(*[c for c in rows.columns if c not in ("node", "quota")],
                       F.when(split & right, F.col("node") + left_leaves).otherwise(F.col("node")).cast("int").alias("node"),
                       F.when(split & right, F.col("quota") - left_leaves).when(split, left_leaves).otherwise(F.col("quota")).cast("int").alias("quota"))


def kd_tree(rows: DataFrame, dims: int, leaves: int) -> DataFrame:
    """``rows`` of ``points`` with the leaf (0 .. leaves - 1) of each as column node."""
    now = stored(rows.withColumn("node", F.lit(0)).withColumn("quota", F.lit(leaves)), "kd-level")
    bounds = now.agg(*[(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"e{i}") for i in range(dims)]).first()
    for level in range(math.ceil(math.log2(leaves)) if leaves > 1 else 0):
        now = stored(_split(now, dims, [float(x or 0.0) for x in bounds], level), "kd-level")
    return now.drop("quota")


def with_slots(rows: DataFrame, shard: str, order: str, parts: int | None = None) -> DataFrame:
    """``rows`` with a gapless slot from 0 in each shard.

    Rows are numbered inside parts and shifted by the rows of the parts before.  There are about as
    many parts as a part has rows (the square root of all), so a task sorts neither a whole shard nor
    more than that many sizes of parts.
    """
    parts = parts or max(1, math.ceil(math.sqrt(rows.count())))
    part = rows.withColumn("part", F.pmod(F.xxhash64(order), F.lit(parts)))
    sizes = part.groupBy(shard, "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(W.partitionBy(shard).orderBy("part")) - F.col("n")).drop("n")
    numbered = part.withColumn("inside", F.row_number().over(W.partitionBy(shard, "part").orderBy(order)) - 1)
    return numbered.join(before, [shard, "part"]).withColumn("slot", (F.col("before") + F.col("inside")).cast("long")).drop(
        "part", "before", "inside")


def shard_documents(documents: DataFrame, dimensions: dict[str, Column], leaves: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document row."""
    placed = kd_tree(points(documents, dimensions), len(dimensions), leaves)
    return with_slots(placed.withColumnRenamed("node", "shard"), "shard", "tie").select("doc_id", "size", "text_crc32", "shard", "slot")
