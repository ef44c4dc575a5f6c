"""Incremental loads on plain parquet: high-water mark, keyed upsert, versioned tables.

A table is a folder of immutable versions ``<root>/v=<n>/`` plus a commit log
``<root>/_versions/`` holding one small marker file per committed version.  The
marker is written only after Spark has committed the version's files, so a
failed or retried write leaves the log untouched and readers keep seeing the
last committed version; a write never touches the version being read, so a job
can read version n and write n+1 in one plan.  The log is metadata: it is
listed and written on the driver through ``pyarrow.fs`` (local, HDFS, S3, GCS),
without Spark jobs.

A table for keyed upserts is laid out in buckets of a hash of its key (``upsert_table``),
or by a column that the key determines (``merge_partitions``): one folder per bucket or
value, and one marker that lists the folders in force.  A batch reads and rewrites only the
folders its keys belong to; all others keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import TASK_ROWS, freed_shuffles, remove_scratch, setting, task_count
from .joins import null_safe_join

BUCKETS = 64  # of a new table for keyed upserts


def newer_than_target(df: DataFrame, target: DataFrame, col: str, lookback_days: int = 0,
                      load_all_if_empty: bool = True) -> DataFrame:
    """Rows of ``df`` strictly after the target's high-water mark ``max(col)``.

    The mark is a scalar subquery kept inside the plan (computed once).  With
    ``lookback_days`` the window reopens that many days before the mark (late
    rows are then re-upserted by key).  An empty target gives a NULL mark: with
    ``load_all_if_empty`` every row loads, otherwise none does.  Rows with a NULL
    ``col`` never pass on an incremental run.
    """
    mark = target.select(F.max(col)).scalar()
    if lookback_days:
        mark = F.date_sub(mark, lookback_days)
        cond = F.col(col) >= mark
    else:
        cond = F.col(col) > mark
    if load_all_if_empty:
        cond = cond | mark.isNull()
    return df.filter(cond)


def upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Matched key -> the update's row, unmatched update -> inserted, rest kept.

    ``updates`` must hold one row per key.  The anti join lets AQE broadcast the
    update keys when the batch is small and shuffle otherwise.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def _log_path(root: str) -> str:
    return root.rstrip("/") + "/_versions"


def _log_fs(root: str):
    from ..sources.archive import _fs
    return _fs(_log_path(root))


def current_version(spark: SparkSession, root: str) -> int | None:
    """Last committed version number, or None for a new table (a listing of the log)."""
    from pyarrow import fs as pafs
    fs, path = _log_fs(root)
    infos = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    versions = [int(i.base_name.split(".")[0]) for i in infos
                if i.type == pafs.FileType.File and i.base_name.endswith(".commit")]
    return max(versions) if versions else None


def _commit(root: str, version: int, content: str) -> None:
    """Write the marker of ``version``; fails if another run has committed that number meanwhile."""
    from pyarrow import fs as pafs
    fs, log = _log_fs(root)
    fs.create_dir(log, recursive=True)
    marker = f"{log}/{version:020d}.commit"
    if isinstance(fs, pafs.LocalFileSystem):
        with open(marker, "x", encoding="utf-8") as out:  # exclusive where the file system can do it
            out.write(content)
        return
    if fs.get_file_info(marker).type != pafs.FileType.NotFound:
        raise FileExistsError(f"version {version} of {root} was committed by another run")
    with fs.open_output_stream(marker) as out:
        out.write(content.encode("utf-8"))


def read_table(spark: SparkSession, root: str) -> DataFrame:
    v = current_version(spark, root)
    if v is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v={v}")


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version, then commit it to the log."""
    spark = df.sparkSession
    v = (current_version(spark, root) or 0) + 1
    path = version_path(root, v)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _commit(root, v, path)
    return v


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def full_refresh(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Recompute and replace: a new version holding exactly ``df``; returns it re-read."""
    v = write_version(df, root, partition_by)
    return df.sparkSession.read.parquet(version_path(root, v))


def upsert_table(updates: DataFrame, root: str, key: str | Sequence[str], buckets: int = BUCKETS,
                 carried: dict[str, Column] | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """Merge ``updates`` (one row per key) into the bucketed table at ``root`` (created if absent) by ``key``.

    The number of buckets is fixed when the table is created.  Only the buckets of the batch's
    keys are read and rewritten.  There old and new rows are shuffled once, by bucket and part of a
    bucket, and are merged and written by the same tasks; no row of another bucket is shuffled.
    ``carried`` and ``derived``: see ``merge_partitions``.
    """
    manifest = _manifest(root)
    n = buckets if manifest is None else manifest["buckets"]
    keys = [key] if isinstance(key, str) else list(key)
    return merge_partitions(updates, root, keys, F.pmod(F.xxhash64(*keys), F.lit(n)), extra={"buckets": n}, even=True,
                            carried=carried, derived=derived)


def incremental_load(candidates: DataFrame, root: str, key: str | Sequence[str], mark_col: str,
                     lookback_days: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """High-water-mark filter against the current bucketed table, then keyed upsert."""
    spark = candidates.sparkSession
    if current_version(spark, root) is not None:
        candidates = newer_than_target(candidates, read_partitions(spark, root), mark_col, lookback_days)
    return upsert_table(candidates, root, key, buckets)


def vacuum(root: str) -> list[str]:
    """Remove the folders under ``root`` that the last commit doesn't name; returns them.

    For tables of ``upsert_table`` and ``merge_partitions``, when no reader of an older version and no
    other writer is at work.
    """
    from pyarrow import fs as pafs

    from ..sources.archive import _fs
    manifest = _manifest(root)
    if manifest is None:
        return []
    used = set(manifest["parts"].values())
    fs, base = _fs(root.rstrip("/"))
    gone = []
    for top in ("data", "_stage"):
        for info in fs.get_file_info(pafs.FileSelector(f"{base}/{top}", allow_not_found=True, recursive=True)):
            name = info.path[len(base):].lstrip("/")
            if info.type == pafs.FileType.Directory and name.count("/") == (1 if top == "_stage" else 2) and name not in used:
                fs.delete_dir(info.path)
                gone.append(name)
    return sorted(gone)


PART = "__part"  # folder column of a partitioned table: the partition value as text


def _manifest(root: str) -> dict | None:
    """Schema and the folder of every partition value in the last committed version; None for a new table.

    Only a missing or empty log means a new table; every other error is raised.
    """
    from pyarrow import fs as pafs
    fs, log = _log_fs(root)
    infos = fs.get_file_info(pafs.FileSelector(log, allow_not_found=True))
    names = sorted(i.base_name for i in infos if i.type == pafs.FileType.File and i.base_name.endswith(".commit"))
    if not names:
        return None
    with fs.open_input_stream(f"{log}/{names[-1]}") as f:
        return json.loads(f.read())


def _folders(root: str, folder: str) -> dict[str, str]:
    """Partition value -> folder (relative to ``root``) of what one write has left under ``folder``."""
    from ..sources.archive import _fs
    from pyarrow import fs as pafs
    fs, path = _fs(f"{root.rstrip('/')}/{folder}")
    infos = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return {unquote(i.base_name.split("=", 1)[1]): f"{folder}/{i.base_name}" for i in infos
            if i.type == pafs.FileType.Directory and i.base_name.startswith(PART + "=")}


def read_partitions(spark: SparkSession, root: str, values: Sequence[str] | None = None) -> DataFrame:
    """The committed rows of a partitioned table, or of some of its partition values."""
    manifest = _manifest(root)
    if manifest is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return _read_parts(spark, root, manifest, values)


def _read_parts(spark: SparkSession, root: str, manifest: dict, values: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    paths = [f"{root.rstrip('/')}/{manifest['parts'][v]}" for v in (manifest["parts"] if values is None else values)
             if v in manifest["parts"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_partitions(updates: DataFrame, root: str, key: str | Sequence[str], partition_col: str | Column,
                     delete_keys: DataFrame | None = None, extra: dict | None = None, even: bool = False,
                     carried: dict[str, Column] | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """Keyed upsert into a partitioned parquet table, rewriting only the touched partitions.

    The key must determine ``partition_col``, a column or an expression (a matching row always
    lives in the same partition), e.g. a month derived from a date that is part of the key's hash.
    ``extra`` is kept in the commits.  ``even`` says that the values are a hash of the key, so that their parts
    are of one size.  ``derived`` columns are not shuffled but computed again from the others and from ``carried`` ones.
    ``delete_keys`` replaces whole groups instead: every stored row whose columns match one
    of its rows (NULLs match) is removed, wherever it lies, before the updates go in.

    The batch is computed and written once, the touched partitions are merged into a new
    folder (with ``even`` or ``delete_keys`` by one shuffle of their rows), and one marker commits the new list of folders: readers see all of the merge or
    nothing of it, and a failed run leaves the table as it was.  The driver sees only
    the partition values.
    """
    spark = updates.sparkSession
    manifest = _manifest(root)
    base, version = root.rstrip("/"), (current_version(spark, root) or 0) + 1
    attempt = uuid.uuid4().hex[:12]  # a failed run's folders are never read
    staged, merged = f"_stage/{version}-{attempt}", f"data/{version}-{attempt}"
    columns = updates.columns if manifest is None else [f["name"] for f in manifest["schema"]["fields"]]
    if manifest is None:
        _write_parts(updates.select(*columns), partition_col, f"{base}/{merged}", carried, derived)
        manifest = {"schema": updates.schema.jsonValue(), "parts": _folders(root, merged)} | (extra or {})
    else:
        ready = updates.select(*columns, _part(partition_col))
        with freed_shuffles(spark):
            ready.write.option("compression", "zstd").parquet(f"{base}/{staged}")
        rows = spark.read.schema(StructType.fromJson(manifest["schema"]).add(PART, "string")).parquet(f"{base}/{staged}")
        touched = {_folder_value(r[0]) for r in rows.select(PART).distinct().collect()}
        current = _read_parts(spark, root, manifest)
        if delete_keys is not None:
            # The groups to remove with the partitions they lie in, so that old rows meet them where they are written.
            hit = null_safe_join(current.select(*delete_keys.columns, _part(partition_col)), delete_keys, delete_keys.columns, "left_semi").distinct()
            with freed_shuffles(spark):
                hit.write.option("compression", "zstd").parquet(f"{base}/{staged}-gone")
            gone = spark.read.schema(hit.schema).parquet(f"{base}/{staged}-gone")
            touched |= {_folder_value(r[0]) for r in gone.select(PART).distinct().collect()}
        if not touched:
            return current
        old = _read_parts(spark, root, manifest, sorted(touched))
        if delete_keys is not None:
            _replace_groups(old.select("*", _part(partition_col)), rows, gone, f"{base}/{merged}", carried, derived)
        elif even:
            _upsert_evenly(old.select("*", _part(partition_col)), rows, key, f"{base}/{merged}", carried, derived)
        else:
            value = F.coalesce(F.nullif(F.col(PART), F.lit("")), F.lit(_folder_value(None)))
            rivals = rows.where(value.isin(sorted(touched & set(manifest["parts"])))).drop(PART)  # the others meet no old row
            keys = [key] if isinstance(key, str) else list(key)
            kept = old.join(rivals.select(*keys), keys, "left_anti")
            _write_parts(kept.unionByName(rows.drop(PART)), partition_col, f"{base}/{merged}", carried, derived)
        parts = {v: f for v, f in manifest["parts"].items() if v not in touched}
        manifest = manifest | {"parts": parts | _folders(root, merged)}
    _commit(root, version, json.dumps(manifest))
    remove_scratch(f"{base}/{staged}")
    remove_scratch(f"{base}/{staged}-gone")
    return _read_parts(spark, root, manifest)


def _part(partition_col: str | Column) -> Column:
    value = F.col(partition_col) if isinstance(partition_col, str) else partition_col
    return value.cast("string").alias(PART)


def _folder_value(value: str | None) -> str:
    """A partition value as its folder is named."""
    return value or "__HIVE_DEFAULT_PARTITION__"


_OLD, _NEW, _GONE = 0, 1, 2  # rows of a merge


def _upsert_evenly(old: DataFrame, rows: DataFrame, key: str | Sequence[str], path: str,
                   carried: dict[str, Column] | None = None, derived: dict[str, Column] | None = None) -> None:
    """Old rows without those whose key is among the new ones, and the new ones, written to one folder per ``PART`` value.

    Both go through one shuffle by the value and a part of it; a window over the key needs no other one,
    which a join would (it takes only what is shuffled by all of its keys).
    """
    keys = [key] if isinstance(key, str) else list(key)
    tasks = task_count(old.sparkSession, old.count() + rows.count())  # the footers tell
    parts = F.lit(-(-tasks[0] // max(1, rows.select(PART).distinct().count())) if tasks else 1)
    both = [df.select("*", _sub(keys, parts), F.lit(kind).alias("__kind")) for df, kind in ((old, _OLD), (rows, _NEW))]
    dealt = _dealt(both[0].unionByName(both[1]), tasks, carried, derived)
    met = dealt.withColumn("__met", F.max("__kind").over(Window.partitionBy(PART, "__sub", *keys)))
    lone = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))  # NULL keys match none
    out = met.where((F.col("__kind") == _NEW) | (F.col("__met") == _OLD) | lone)
    _write_folders(out.drop("__sub", "__kind", "__met"), path)


def _replace_groups(old: DataFrame, rows: DataFrame, gone: DataFrame, path: str,
                    carried: dict[str, Column] | None = None, derived: dict[str, Column] | None = None) -> None:
    """Old rows without those of the groups in ``gone`` (columns of the group and ``PART``; NULLs match), and the new ones.

    All go through one shuffle, by value and part of it, as in ``_upsert_evenly``.  A value has parts by its number of rows.
    """
    groups = [c for c in gone.columns if c != PART]
    value = F.coalesce(F.col(PART), F.lit(_folder_value(None)))
    sizes = {r[0]: r[1] for r in old.select(PART).unionByName(rows.select(PART)).groupBy(value).count().collect()}
    most = max(1, setting(old.sparkSession, "taskRows", TASK_ROWS))
    tasks = task_count(old.sparkSession, sum(sizes.values()))
    # Twice as many parts as full tasks, so that those which fall to one task differ less.
    split = F.create_map(*[F.lit(x) for v, n in sizes.items() for x in (v, -(-2 * n // most))])
    sub = _sub(groups, F.coalesce(F.try_element_at(split, value), F.lit(1)))
    both = [df.select("*", sub, F.lit(kind).alias("__kind")) for df, kind in ((old, _OLD), (rows, _NEW))]
    marks = gone.select(PART, sub, F.struct(*groups).alias("__group"), F.lit(_GONE).alias("__kind"))
    dealt = _dealt(both[0].unionByName(both[1]).unionByName(marks, allowMissingColumns=True), tasks, carried, derived)
    named = [f"__g{i}" for i in range(len(groups))]
    own = [F.when(F.col("__kind") == _GONE, F.col("__group").getField(c)).otherwise(F.col(c)).alias(n) for c, n in zip(groups, named)]
    met = dealt.select("*", *own).withColumn("__met", F.max("__kind").over(Window.partitionBy(PART, "__sub", *named)))
    out = met.where((F.col("__kind") == _NEW) | (F.col("__kind") == _OLD) & (F.col("__met") != _GONE))
    _write_folders(out.select(*old.columns), path)


def _sub(keys: Sequence[str], parts: Column) -> Column:
    """The part of its ``PART`` value that a key lies in."""
    return F.pmod(F.hash(*keys), parts).alias("__sub")  # another hash than the one of buckets, so that their parts are even


def _dealt(df: DataFrame, tasks: Sequence[int], carried: dict[str, Column] | None, derived: dict[str, Column] | None) -> DataFrame:
    """``df`` shuffled by ``PART`` and ``__sub``; ``carried`` and ``derived``: see ``merge_partitions``."""
    derived = derived or {}
    lean = df.select(*[c for c in df.columns if c not in derived], *[c.alias(n) for n, c in (carried or {}).items()])
    return lean.repartition(*tasks, PART, "__sub").select(*[derived[c].alias(c) if c in derived else F.col(c) for c in df.columns])


def _write_folders(df: DataFrame, path: str) -> None:
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(PART).parquet(path)


def _write_parts(df: DataFrame, partition_col: str | Column, path: str, carried: dict[str, Column] | None = None,
                 derived: dict[str, Column] | None = None) -> None:
    """Rows clustered by partition value and written to one folder each (few, full files).

    ``REBALANCE`` lets AQE split a value that is too large for one task and merge small
    ones, so a hot month never lands whole in one writer.
    """
    out, derived = df.select("*", _part(partition_col)), derived or {}
    lean = out.select(*[c for c in out.columns if c not in derived], *[c.alias(n) for n, c in (carried or {}).items()])
    whole = lean.hint("rebalance", PART).select(*[derived[c].alias(c) if c in derived else F.col(c) for c in out.columns])
    _write_folders(whole, path)
