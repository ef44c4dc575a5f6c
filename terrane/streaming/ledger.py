"""Exactly-once file loading with Structured Streaming.

The file stream source remembers, in its checkpoint, every file it has handed
out, so a file is loaded once; a rerun with nothing new finishes at once.  Each
micro-batch carries only file paths (``binaryFile`` with the content pruned);
``foreachBatch`` reads those files by column name and overwrites the batch's
own output folder, so a retried batch rewrites the same rows (idempotent).

The load history has a row per file: rows loaded, rows refused and status.  The counts are
observed on the rows while they are written, so they cost no second scan: a frequent-items
sketch of (file, loaded or refused), exact as long as it can hold every one, and it is sized
for a batch's files.  A batch's history overwrites itself as its rows do.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from ..sources.delimited import accepted, checked_lines
from ..sources.archive import _fs

BATCH_DIR = "batch_id"
HISTORY_SCHEMA = "file string, status string, rows_loaded long, rows_rejected long"
_COUNTERS = 1 << 17  # of the sketch; it is exact for up to three quarters of them
MAX_FILES = 10_000  # of a batch: four counters each leave the sketch half empty
BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


def load_new_files(spark: SparkSession, src_dir: str, table_dir: str, checkpoint_dir: str,
                   columns: Sequence[str], glob: str = "*.txt", sep: str = "|",
                   max_files_per_batch: int = 1000, history_dir: str | None = None) -> int:
    """Load every not-yet-loaded ``glob`` file under ``src_dir`` into ``table_dir``.

    ``availableNow`` drains everything present at start in micro-batches of at
    most ``max_files_per_batch`` files, so the driver never holds more than one
    batch's file list.  Lines that can't be loaded are left out (``checked_lines`` names them); with
    ``history_dir`` each file's counts are kept there (``read_history``).  Returns the number of files
    loaded by this run (0 when nothing new was there).
    """
    if max_files_per_batch > MAX_FILES:
        raise ValueError(f"at most {MAX_FILES} files a batch")
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files_per_batch).load(src_dir).select("path"))

    loaded = [0]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # at most max_files_per_batch
        if not paths:
            return
        loaded[0] += len(paths)
        seen = Observation()
        kind = F.when(F.col("_skip"), "skipped").when(F.col("_reason").isNull(), "loaded").otherwise("rejected")
        lines = checked_lines(spark, paths, columns, sep=sep).observe(
            seen, F.call_function("approx_top_k", F.concat_ws("\n", kind, "_file"), F.lit(4 * MAX_FILES), F.lit(_COUNTERS)).alias("top"))
        accepted(lines).write.mode("overwrite").parquet(f"{table_dir.rstrip('/')}/{BATCH_DIR}={batch_id}")
        if history_dir:
            _history(spark, seen.get["top"], paths).write.mode("overwrite").parquet(f"{history_dir.rstrip('/')}/{BATCH_DIR}={batch_id}")

    q = (files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return loaded[0]


def _history(spark: SparkSession, counted: list, paths: list[str]) -> DataFrame:
    """One row per file of a batch from its observed counts; a file of which nothing was counted is empty."""
    counts: dict[str, dict[str, int]] = {_fs(p)[1]: {} for p in paths}
    for item, n in counted:
        kind, file = item.split("\n", 1)
        counts.setdefault(_fs(unquote(file))[1], {})[kind] = n
    rows = []
    for file, n in counts.items():
        good, bad = n.get("loaded", 0), n.get("rejected", 0)
        status = "empty" if not good + bad else "loaded" if not bad else "partially_loaded" if good else "load_failed"
        rows.append((file, status, good, bad))
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def read_history(spark: SparkSession, history_dir: str) -> DataFrame:
    """Every loaded file with its batch, status and counts."""
    return spark.read.schema(HISTORY_SCHEMA + f", {BATCH_DIR} long").parquet(history_dir)


def read_loaded(spark: SparkSession, table_dir: str, columns: Sequence[str]) -> DataFrame:
    """Every loaded row (the batch column is dropped)."""
    return spark.read.parquet(table_dir).select(*[F.col(f"`{c}`") for c in columns])
