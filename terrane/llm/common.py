"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freed_shuffles, scratch_dir

# Space, tab, line feed, vertical tab, form feed, carriage return: what bytes.split() splits at.
SPACES = "\x20\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """``df`` written once into the shared checkpoint folder and read back, and the folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage at a table that every executor can read again, so a lost
    executor costs its own tasks only.
    """
    return written(df, name, compression)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on; extra columns never reach it."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[tuple[list, list[bytes | None]]]:
    """(ids, texts as bytes) in slices of about ``limit`` text bytes, so memory follows the slice, not the batch."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        size = np.cumsum([0] + [len(t) if t else 0 for t in utf8(texts)]) if batch.num_rows else np.zeros(1)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(size, size[start] + limit, "right")) - 1)
            yield ids.slice(start, stop - start).to_pylist(), utf8(texts.slice(start, stop - start))
            start = stop
