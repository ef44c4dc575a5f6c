"""Zip archives: extract members on executors, one task per archive.

Only the file listing goes through Spark rows (``binaryFile`` with the content
column pruned); each task opens its archive through ``pyarrow.fs`` (local,
HDFS, S3, GCS) and streams the wanted members to the output folder in chunks, so
memory stays flat whatever the archive size.  A member is written under a hidden
name of its own attempt, checked (CRC and size) and then renamed, so a landed file
is always whole; members already landed are skipped.  Two members that would land
under one name are refused before anything is written.  Everything downstream reads
splittable text.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

EXTRACT_SCHEMA = StructType([
    StructField("archive", StringType()),
    StructField("member", StringType()),
    StructField("name", StringType()),
    StructField("path", StringType()),
    StructField("bytes", LongType()),
])
LOG_DIR = "_extract_log"
CHUNK = 8 << 20


def _fs(uri: str):
    """(filesystem, path) for a Spark file URI; ``file:`` paths map to the local disk."""
    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _members(zf, member_suffix: str):
    return [i for i in zf.infolist() if not i.is_dir() and i.filename.endswith(member_suffix)]


def _batches(out_dir: str, member_suffix: str, extract: bool):
    """Rows of ``EXTRACT_SCHEMA`` for each wanted member; with ``extract`` the member is landed first."""
    def run(batches):
        import zipfile
        out_fs, out_root = _fs(out_dir)
        if extract:
            out_fs.create_dir(out_root, recursive=True)
        for pdf in batches:
            rows = []
            for uri in pdf["path"]:
                in_fs, in_path = _fs(uri)
                with in_fs.open_input_file(in_path) as raw, zipfile.ZipFile(raw) as zf:
                    for info in _members(zf, member_suffix):
                        name = posixpath.basename(info.filename)
                        target = posixpath.join(out_root, name)
                        if extract:
                            _land(zf, info, out_fs, target)
                        rows.append((uri, info.filename, name, target, info.file_size))
            yield pd.DataFrame(rows, columns=[f.name for f in EXTRACT_SCHEMA.fields])
    return run


def _land(zf, info, out_fs, target: str) -> None:
    """Write one member under its final name, or leave nothing; a landed file is not written again."""
    from pyarrow import fs as pafs
    if out_fs.get_file_info(target).type == pafs.FileType.File:
        return
    attempt = posixpath.join(posixpath.dirname(target), f"_attempt-{uuid.uuid4().hex}")
    try:
        size = 0
        with zf.open(info) as src, out_fs.open_output_stream(attempt) as dst:
            while True:
                block = src.read(CHUNK)  # reading to the end checks the CRC
                if not block:
                    break
                dst.write(block)
                size += len(block)
        if size != info.file_size:
            raise OSError(f"{info.filename}: {size} of {info.file_size} bytes")
        out_fs.move(attempt, target)
    except BaseException:
        if out_fs.get_file_info(attempt).type == pafs.FileType.File:
            out_fs.delete_file(attempt)
        raise


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """File listing (path, length, file) of one or several folders or files, without reading contents.

    ``file`` is the path as ``_metadata.file_path`` of any reader spells it.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path if isinstance(path, str) else list(path)).select("path", "length", F.col("_metadata.file_path").alias("file"))


def extraction_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """What has landed in ``out_dir`` so far: one row per member (``EXTRACT_SCHEMA``), none if nothing has."""
    from pyarrow import fs as pafs
    log_dir = out_dir.rstrip("/") + "/" + LOG_DIR
    fs, path = _fs(log_dir)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], EXTRACT_SCHEMA)
    return spark.read.schema(EXTRACT_SCHEMA).json(log_dir)


def extract_archives(spark: SparkSession, path: str, out_dir: str, member_suffix: str = ".txt",
                     archive_glob: str = "*.zip", archives: DataFrame | None = None) -> DataFrame:
    """Land the ``member_suffix`` members of every archive under ``path`` in ``out_dir``.

    ``archives`` (a DataFrame with a ``path`` column) restricts the work to some
    archives, e.g. those a manifest diff marked pending.  Returns the extraction
    log of the folder (archive, member, name, path, bytes), to which this run's
    members are added once they have all landed.  Raises ``ValueError`` if two members,
    of this run or of an earlier one, would land under the same name.
    """
    listing = (archives if archives is not None else list_files(spark, path, archive_glob)).select("path")
    n = max(1, listing.count())  # number of archives: about one task each
    work = listing.repartition(n)
    logged = extraction_log(spark, out_dir)
    wanted = work.mapInPandas(_batches(out_dir, member_suffix, False), EXTRACT_SCHEMA)
    leaf = F.element_at(F.split("archive", "/"), -1)
    owner = F.concat_ws("|", leaf, "member")
    clashes = wanted.unionByName(logged).groupBy("name").agg(F.count_distinct(owner).alias("n"), F.min(owner).alias("a"),
                                                             F.max(owner).alias("b")).filter(F.col("n") > 1)
    found = clashes.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("name", "a", "b")).alias("first")).collect()[0]
    if found.n:
        raise ValueError(f"{found.n} names would be landed by several members, e.g. {found.first.name}: "
                         f"{found.first.a} and {found.first.b}")
    done = work.mapInPandas(_batches(out_dir, member_suffix, True), EXTRACT_SCHEMA)
    done.join(logged.select("name"), "name", "left_anti").select(*[f.name for f in EXTRACT_SCHEMA.fields]).write.mode(
        "append").json(out_dir.rstrip("/") + "/" + LOG_DIR)
    return extraction_log(spark, out_dir)


def archive_scan(spark: SparkSession, path: str, out_dir: str, member_suffix: str = ".txt") -> DataFrame:
    """Lines of the extracted members, with their source file."""
    extract_archives(spark, path, out_dir, member_suffix)
    return (spark.read.option("pathGlobFilter", f"*{member_suffix}").text(out_dir)
            .select(F.col("_metadata.file_name").alias("member"), F.col("value").alias("line")))


def landing_check(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """One row per landed ``suffix`` file: name, bytes, lines."""
    files = list_files(spark, path, f"*{suffix}").select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    lines = (spark.read.option("pathGlobFilter", f"*{suffix}").text(path)
             .groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("lines")))
    return files.join(lines, "name", "left").select("name", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"))


def require_landed(spark: SparkSession, path: str, suffix: str = ".txt") -> int:
    """Raise when nothing is landed; returns the file count."""
    n = list_files(spark, path, f"*{suffix}").count()
    if n == 0:
        raise FileNotFoundError(f"no {suffix} file under {path}")
    return n
