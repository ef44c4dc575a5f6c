"""Quality checks, high-water mark, keyed upsert and versioned tables."""

import datetime as dt

from pyspark.sql import functions as F

from terrane.operators.quality import Check, run_checks, summarize
from terrane.operators.upsert import (
    current_version, incremental_load, newer_than_target, read_partitions, upsert, upsert_table, vacuum,
)
from terrane.session import scratch_dir


def _df(spark, rows):
    return spark.createDataFrame(rows, "id string, d date, v int")


def test_checks_and_summary(spark):
    t = {"t": spark.createDataFrame([("a", 1), ("a", None), (None, 3), ("b", 0)], "k string, x int")}
    checks = [Check("t", "k", "unique"), Check("t", "k", "not_null", "warn"), Check("t", "x", "not_null"),
              Check("t", "x", "not_null", where="k = 'b'")]
    rep = {(r.column_name, r.test, r.severity, r.failures, r.status) for r in run_checks(t, checks).collect()}
    assert ("k", "unique", "error", 1, "fail") in rep
    assert ("k", "not_null", "warn", 1, "warn") in rep
    assert ("x", "not_null", "error", 1, "fail") in rep
    s = summarize(run_checks(t, checks)).collect()[0]
    assert (s.pass_count, s.warn_count, s.fail_count, s.total_count) == (1, 1, 2, 4)


def test_high_water_mark_is_strict(spark):
    target = _df(spark, [("a", dt.date(2021, 1, 10), 1)])
    new = _df(spark, [("o", dt.date(2021, 1, 9), 1), ("e", dt.date(2021, 1, 10), 1), ("n", dt.date(2021, 1, 11), 1),
                      ("z", None, 1)])
    assert {r.id for r in newer_than_target(new, target, "d").collect()} == {"n"}
    assert {r.id for r in newer_than_target(new, target, "d", lookback_days=1).collect()} == {"o", "e", "n"}
    empty = target.filter("false")
    assert newer_than_target(new, empty, "d").count() == 4
    assert newer_than_target(new, empty, "d", load_all_if_empty=False).count() == 0


def test_upsert_replaces_matched_and_inserts_new(spark):
    target = _df(spark, [("a", None, 1), ("b", None, 1)])
    upd = _df(spark, [("b", None, 2), ("c", None, 3)])
    assert sorted((r.id, r.v) for r in upsert(target, upd, "id").collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_versioned_upsert_is_idempotent(spark):
    root = scratch_dir(spark, "t-upsert")
    base = _df(spark, [("a", dt.date(2021, 1, 1), 1), ("b", dt.date(2021, 1, 2), 1)])
    upsert_table(base, root, "id")
    upd = _df(spark, [("b", dt.date(2021, 1, 2), 5), ("c", dt.date(2021, 1, 3), 1)])
    first = sorted(tuple(r) for r in upsert_table(upd, root, "id").collect())
    second = sorted(tuple(r) for r in upsert_table(upd, root, "id").collect())
    assert first == second and len(first) == 3
    assert current_version(spark, root) == 3


def _files(root):
    import glob
    import os

    from terrane.operators.upsert import _manifest
    from terrane.session import local_path
    return {v: sorted(glob.glob(os.path.join(local_path(root), f, "*.parquet"))) for v, f in _manifest(root)["parts"].items()}


def test_an_upsert_rewrites_only_the_buckets_of_its_keys(spark):
    root = scratch_dir(spark, "t-buckets")
    rows = [(f"k{i}", dt.date(2021, 1, 1), i) for i in range(300)]
    upsert_table(_df(spark, rows), root, "id", buckets=16)
    before = _files(root)
    assert len(before) == 16
    upd = _df(spark, [("k7", dt.date(2022, 1, 1), -7), ("new", dt.date(2022, 1, 1), 1), (None, None, 0)])
    touched = {str(r[0]) for r in upd.select(F.pmod(F.xxhash64("id"), F.lit(16))).collect()}
    out = {r.id: r.v for r in upsert_table(upd, root, "id", buckets=4).collect()}  # the table's own number of buckets counts
    assert out == {f"k{i}": i for i in range(300)} | {"k7": -7, "new": 1, None: 0}
    after = _files(root)
    assert {v for v in after if after[v] != before[v]} == touched and len(touched) < 4
    gone = vacuum(root)
    assert len(gone) == len(touched) and _files(root) == after and vacuum(root) == []
    assert read_partitions(spark, root).count() == 302


def test_two_writers_of_one_version_do_not_lose_a_commit(spark):
    import pytest

    from terrane.operators.upsert import _commit
    root = scratch_dir(spark, "t-race")
    upsert_table(_df(spark, [("a", None, 1)]), root, "id")
    with pytest.raises(FileExistsError):
        _commit(root, 1, "{}")
    assert [r.id for r in read_partitions(spark, root).collect()] == ["a"]


def test_bloom_filter_passes_every_key_and_few_others(spark):
    from terrane.operators.joins import may_be_among
    keys = spark.createDataFrame([(f"k{i}", None if i % 5 == 0 else i) for i in range(2000)], "a string, b int")
    rows = spark.createDataFrame([(f"k{i}", None if i % 5 == 0 else i) for i in range(20_000)], "a string, b int")
    own = [F.col("a"), F.col("b")]
    passed = rows.where(may_be_among(own, keys, ["a", "b"])).collect()
    met = {(r.a, r.b) for r in passed}
    assert {(r.a, r.b) for r in keys.collect()} <= met and len(met) < 2100
    tight = rows.where(may_be_among(own, keys, ["a", "b"], bits=256)).count()  # a full filter only lets more pass
    assert tight > 15_000
    assert rows.where(may_be_among(own, keys.limit(0), ["a", "b"])).count() == 0


def test_incremental_load_only_adds_newer(spark):
    root = scratch_dir(spark, "t-incr")
    incremental_load(_df(spark, [("a", dt.date(2021, 1, 5), 1)]), root, "id", "d")
    batch = _df(spark, [("old", dt.date(2021, 1, 1), 1), ("eq", dt.date(2021, 1, 5), 1), ("new", dt.date(2021, 1, 6), 1)])
    out = incremental_load(batch, root, "id", "d")
    assert {r.id for r in out.collect()} == {"a", "new"}
    assert read_partitions(spark, root).filter(F.col("id") == "new").count() == 1


def test_merge_partitions_rewrites_only_touched_months(spark):
    import glob
    import os

    from terrane.operators.upsert import merge_partitions, read_partitions
    from terrane.session import local_path
    path = scratch_dir(spark, "t-merge")
    rows = [("a", dt.date(2021, 1, 5), 1), ("b", dt.date(2021, 2, 5), 1)]
    df = _df(spark, rows).withColumn("m", F.trunc("d", "month"))
    merge_partitions(df, path, "id", "m")
    jan = sorted(glob.glob(os.path.join(local_path(path), "data", "*", "__part=2021-01-01", "*.parquet")))
    before = [os.path.getmtime(f) for f in jan]
    upd = _df(spark, [("b", dt.date(2021, 2, 5), 9), ("c", dt.date(2021, 2, 7), 1)]).withColumn("m", F.trunc("d", "month"))
    out = merge_partitions(upd, path, "id", "m")
    assert sorted((r.id, r.v) for r in out.collect()) == [("a", 1), ("b", 9), ("c", 1)]
    assert sorted(glob.glob(os.path.join(local_path(path), "data", "*", "__part=2021-01-01", "*.parquet"))) == jan and jan
    assert [os.path.getmtime(f) for f in jan] == before
    none = _df(spark, [("d", None, 4)]).withColumn("m", F.trunc("d", "month"))
    merge_partitions(none, path, "id", "m")
    assert sorted((r.id, r.v) for r in read_partitions(spark, path).collect()) == [("a", 1), ("b", 9), ("c", 1), ("d", 4)]


def test_an_unreadable_file_stops_the_merge_and_leaves_the_table(spark):
    import glob
    import os

    import pytest

    from terrane.operators.upsert import current_version, merge_partitions, read_partitions
    from terrane.session import local_path
    path = scratch_dir(spark, "t-broken")
    df = _df(spark, [(f"k{i}", dt.date(2021, 1 + i % 3, 5), i) for i in range(9)]).withColumn("m", F.trunc("d", "month"))
    merge_partitions(df, path, "id", "m")
    broken = glob.glob(os.path.join(local_path(path), "data", "*", "__part=2021-02-01", "*.parquet"))[0]
    good = open(broken, "rb").read()
    with open(broken, "wb") as f:
        f.write(b"no parquet")
    upd = _df(spark, [("k1", dt.date(2021, 2, 5), 100)]).withColumn("m", F.trunc("d", "month"))
    with pytest.raises(Exception):
        merge_partitions(upd, path, "id", "m")
    assert current_version(spark, path) == 1
    with open(broken, "wb") as f:
        f.write(good)
    for crc in glob.glob(os.path.join(os.path.dirname(broken), ".*.crc")):
        os.remove(crc)
    assert read_partitions(spark, path).count() == 9
    assert merge_partitions(upd, path, "id", "m").count() == 9


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from terrane import session

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Context(master), self

        def get(self, name, default=None):
            return default

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError):
            session.checkpoint_root(Session(master))
    for master in ("local", "local[4]", "local[*]"):
        assert session.checkpoint_root(Session(master))


def test_unplannable_check_is_an_error_row(spark):
    t = {"t": spark.createDataFrame([("a", 1)], "k string, x int")}
    checks = [Check("t", "k", "not_null"), Check("t", "missing", "not_null"), Check("t", "nope", "unique"),
              Check("gone", "k", "not_null")]
    rep = {(r.table_name, r.column_name, r.test): r.status for r in run_checks(t, checks).collect()}
    assert rep == {("t", "k", "not_null"): "pass", ("t", "missing", "not_null"): "error",
                   ("t", "nope", "unique"): "error", ("gone", "k", "not_null"): "error"}
    s = summarize(run_checks(t, checks)).collect()[0]
    assert (s.pass_count, s.warn_count, s.fail_count, s.total_count) == (1, 0, 0, 4)


def test_scratch_folders_of_a_scope_are_removed(spark):
    import os

    from terrane.session import local_path, scratch_scope
    with scratch_scope() as made:
        gone, kept = scratch_dir(spark, "t-gone"), scratch_dir(spark, "t-kept")
        spark.range(3).write.parquet(gone)
        spark.read.parquet(gone).write.parquet(kept)
        made.remove(kept)
    assert not os.path.exists(local_path(gone)) and spark.read.parquet(kept).count() == 3


def test_derived_columns_are_not_shuffled_to_their_partition(spark):
    from terrane.operators.upsert import merge_partitions
    path = scratch_dir(spark, "t-derived")
    df = spark.createDataFrame([("0a", 1, 10), ("ff", 2, 20), ("1b", 2, None)], "id string, m int, v int").withColumn("w", F.col("v") * 2)
    lean = {"carried": {"__id": F.unhex("id")}, "derived": {"id": F.lower(F.hex("__id")), "w": F.col("v") * 2}}
    merge_partitions(df, path, "id", "m", **lean)
    upd = spark.createDataFrame([("ff", 2, 21), ("2c", 3, 30)], "id string, m int, v int").withColumn("w", F.col("v") * 2)
    out = merge_partitions(upd, path, "id", "m", **lean)
    assert out.columns == ["id", "m", "v", "w"]
    assert sorted(map(tuple, out.collect())) == [("0a", 1, 10, 20), ("1b", 2, None, None), ("2c", 3, 30, 60), ("ff", 2, 21, 42)]


def test_buckets_in_several_parts_are_merged_by_one_shuffle_of_each_side(spark):
    import glob
    import os

    from terrane.session import local_path
    root = scratch_dir(spark, "t-parts")
    spark.conf.set("terrane.taskRows", "10")
    try:
        upsert_table(_df(spark, [(f"k{i}", None, i) for i in range(300)] + [(None, None, 7)]), root, "id", buckets=3)
        out = upsert_table(_df(spark, [(f"k{i}", None, -i) for i in range(200, 400)] + [(None, None, 8)]), root, "id")
        got = sorted(((r.id, r.v) for r in out.collect()), key=str)
        assert got == sorted([(f"k{i}", i if i < 200 else -i) for i in range(400)] + [(None, 7), (None, 8)], key=str)
        # A batch of which a failed run left the staged rows.
        left = os.path.join(local_path(root), "_stage", "9-gone")
        os.makedirs(left)
        open(os.path.join(left, "part-0.parquet"), "wb").close()
        assert "_stage/9-gone" in vacuum(root) and not os.path.exists(left)
        assert len(glob.glob(os.path.join(local_path(root), "data", "*", "__part=*", "*.parquet"))) > 3  # a bucket is written by several tasks
    finally:
        spark.conf.unset("terrane.taskRows")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_merges_shuffle_their_rows_once(spark, monkeypatch):
    from terrane.operators import upsert as U
    from terrane.session import scratch_dir

    written, write = [], U._write_folders
    monkeypatch.setattr(U, "_write_folders", lambda df, path: (written.append(_exchanges(df)), write(df, path)))
    lean = {"carried": {"__id": F.substring("id", 2, 9)}, "derived": {"id": F.concat(F.lit("k"), "__id")}}
    spark.conf.set("terrane.taskRows", "40")
    try:
        root = scratch_dir(spark, "once-upsert")
        schema = "id string, g string, v int, m string"
        rows = [(f"k{i}", None if i % 5 == 0 else f"g{i % 5}", i, [None, "2021-01-01", "2021-02-01"][i % 3]) for i in range(300)]
        U.upsert_table(spark.createDataFrame(rows, schema), root, "id", buckets=3, **lean)
        new = [(f"k{i}", "g1", -i, "2021-02-01") for i in range(200, 400)]
        out = U.upsert_table(spark.createDataFrame(new, schema), root, "id", **lean)
        assert sorted(map(str, out.collect())) == sorted(str(r) for r in spark.createDataFrame(rows[:200] + new, schema).collect())
        root = scratch_dir(spark, "once-groups")
        U.merge_partitions(spark.createDataFrame(rows, schema), root, "id", "m", **lean)
        new = [("k0", "g2", -1, "2021-03-01"), ("x", None, -2, None)]
        gone = spark.createDataFrame([(None,), ("g3",), ("other",)], "g string")
        out = U.merge_partitions(spark.createDataFrame(new, schema), root, "id", "m", gone, **lean)
        want = [r for r in rows if r[1] not in (None, "g3")] + [("k0", "g2", -1, "2021-03-01"), ("k", None, -2, None)]  # ids are made anew
        assert sorted(map(str, out.collect())) == sorted(str(r) for r in spark.createDataFrame(want, schema).collect())
    finally:
        spark.conf.unset("terrane.taskRows")
    assert written[1] == written[3] == 1


def test_steps_of_an_incremental_build_free_their_shuffles(spark, src_df, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from terrane.plans import silver
    from terrane.session import FREED, scratch_dir
    from tests.conftest import raw_row

    def src(days):
        return src_df([raw_row(identifiant_document=str(i % 7), no_disposition="1", type_local="Maison", surface_reelle_bati="80",
                               valeur_fonciere=str(20000 + i), date_mutation=f"2021-{1 + i % 3:02d}-{1 + i % days:02d}") for i in range(60)])

    freed, write, own = [], DataFrameWriter.parquet, spark.conf.get(FREED, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (freed.append(spark.conf.get(FREED)), write(self, *a, **b))[1])
    root = scratch_dir(spark, "freed")
    silver.incremental_build(src(9), root, already_staged=True)
    out = silver.incremental_build(src(20), root, already_staged=True, lookback_days=30)
    assert len(freed) >= 5 and set(freed) == {"true"} and spark.conf.get(FREED, None) == own
    assert out.select("mutation_id").distinct().count() == out.count() > 0
