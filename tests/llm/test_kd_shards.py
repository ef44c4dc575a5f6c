import random
import zlib

from pyspark.sql import functions as F

from terrane.llm import kd_shards
from terrane.llm.queries import op6_kd_shards


def write(spark, tmp_path, docs):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, shard string").write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_shards_are_near_equal_and_gapless(spark, tmp_path):
    rnd = random.Random(6)
    docs = [(i, "é" * rnd.randrange(400), rnd.choice(["en", "de", None]), "src0" if rnd.random() < 0.4 else f"src{rnd.randrange(12)}", "x")
            for i in range(4000)]
    docs += [(5, "same row", "en", "src0", "x")] * 300 + [(None, None, None, None, None), (4001, "", "", "", "")]
    rows = op6_kd_shards(spark, write(spark, tmp_path, docs)).collect()
    assert len(rows) == len(docs)
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    total = sum(r["size"] for r in rows)
    for s in range(16):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 16) < 0.05 * total / 16
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_splits_follow_the_widest_dimension(spark):
    rows = spark.createDataFrame([(i, i % 10, "t") for i in range(1000)], "doc_id long, kind long, text string")
    points = kd_shards.points(rows, {"doc_id": F.col("doc_id"), "kind": F.col("kind")})
    leaves = kd_shards.kd_tree(points, 2, 4).groupBy("node").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                                                                 F.count("*").alias("n"), F.sum("size").alias("w")).collect()
    # Both dimensions are as wide at the root; the first one is cut, then each half is widest in the other one.
    assert len(leaves) == 4 and all(abs(r.w - 500) < 50 for r in leaves)
    assert {r.a < 500 for r in leaves} == {True, False}


def test_any_number_of_leaves_and_one_hot_value(spark):
    rows = spark.createDataFrame([(1, "same", 1.0)] * 700, "doc_id long, text string, x double")
    got = kd_shards.kd_tree(kd_shards.points(rows, {"x": F.col("x")}), 1, 7).groupBy("node").count().collect()
    assert sorted(r.node for r in got) == list(range(7)) and all(abs(r["count"] - 100) <= 2 for r in got)
    assert kd_shards.leaves_for(1000, 300) == 4 and kd_shards.leaves_for(0, 300) == 1


def test_small_and_empty_tables(spark, tmp_path):
    assert op6_kd_shards(spark, write(spark, tmp_path / "a", [(1, "t", "en", "s", "x"), (2, None, None, None, None)])).count() == 2
    assert op6_kd_shards(spark, write(spark, tmp_path / "b", [])).count() == 0


def test_one_value_fills_every_leaf(spark):
    """More leaves than bins of one level: each level cuts the value by a hash of its own."""
    from unittest import mock
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit(1.0).alias("x"))
    with mock.patch.object(kd_shards, "BINS", 16):
        got = kd_shards.kd_tree(kd_shards.points(rows, {"x": F.col("x")}), 1, 64).groupBy("node").count().collect()
    assert sorted(r.node for r in got) == list(range(64)) and max(r["count"] for r in got) < 4 * 4000 / 64


def brute_tree(points, leaves, extents, bins):
    """In memory: (leaf -> ids) of weighted median splits along the widest dimension, cut at a bin's border or within it by ids' ties."""
    if leaves == 1:
        return [points]
    dims = range(len(extents))
    lo, hi = [min(p[1][d] for p in points) for d in dims], [max(p[1][d] for p in points) for d in dims]
    widths = [(hi[d] - lo[d]) / (extents[d] or 1.0) for d in dims]
    d = widths.index(max(widths))
    need = sum(p[2] for p in points) * (leaves // 2) / leaves
    place = lambda p: min(int((p[1][d] - lo[d]) / (hi[d] - lo[d]) * bins), bins - 1) if hi[d] > lo[d] else 0
    run, sides = 0, ([], [])
    for b in sorted({place(p) for p in points}):
        own = [p for p in points if place(p) == b]
        weight = sum(p[2] for p in own)
        if run + weight < need:
            sides[0].extend(own)
        elif run >= need:
            sides[1].extend(own)
        else:
            assert len(own) == 1  # the fixture has no ties inside a bin
            sides[0 if run + weight - need <= need - run else 1].extend(own)
        run += weight
    return brute_tree(sides[0], leaves // 2, extents, bins) + brute_tree(sides[1], leaves - leaves // 2, extents, bins)


def test_against_a_tree_in_memory(spark):
    rnd = random.Random(3)
    xs, ys = rnd.sample(range(2000), 300), rnd.sample(range(2000), 300)
    docs = [(i, "t" * rnd.randrange(30), float(x), float(y) / 3) for i, (x, y) in enumerate(zip(xs, ys))]
    rows = spark.createDataFrame(docs, "doc_id long, text string, x double, y double")
    got = kd_shards.kd_tree(kd_shards.points(rows, {"x": F.col("x"), "y": F.col("y")}), 2, 7).collect()
    points = [(i, (x, y), len(t) + 1) for i, t, x, y in docs]
    extents = [max(p[1][d] for p in points) - min(p[1][d] for p in points) for d in (0, 1)]
    want = brute_tree(points, 7, extents, kd_shards.BINS)
    assert [sorted(r.doc_id for r in got if r.node == leaf) for leaf in range(7)] == [sorted(p[0] for p in part) for part in want]
