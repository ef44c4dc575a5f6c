"""Delimited text files bound to a fixed all-string schema by column name.

Files can disagree on column order, case, extra and missing columns.  Their header
lines are read on executors, one small read per file; the driver sees the distinct ones
(the layouts) only.  Columns are matched to the target names case-insensitively, missing
ones become NULL and extra ones are dropped.  Short rows are padded with NULL and long rows
cut (PERMISSIVE), values are trimmed and null tokens map to NULL.

Two readers give the same rows:

- files of one layout (the usual case) go through Spark's CSV reader, which parses the
  columns in use only;
- ``checked_lines`` reads the raw lines of files of any layouts in one scan, binds each
  line's fields by the header of its own file and says why a line can't be loaded:
  ``invalid_utf8``, or ``open_quote`` if a quoted field doesn't end in its line.  Files of
  mixed layouts, and loads that account for every line, use it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import null_if_token
from ..operators.joins import checked_broadcast
from .archive import _fs, list_files

MAX_HEADER = 1 << 20  # bytes read to find a file's first line
HEADER_SCHEMA = StructType([StructField("path", StringType()), StructField("file", StringType()), StructField("header", StringType())])
INVALID_UTF8, OPEN_QUOTE = "invalid_utf8", "open_quote"


def _read_headers(encoding: str):
    def run(batches):
        for pdf in batches:
            out = []
            for uri, file in zip(pdf["path"], pdf["file"]):
                fs, p = _fs(uri)
                with fs.open_input_stream(p) as f:
                    head = b""
                    while b"\n" not in head:
                        if len(head) > MAX_HEADER:
                            raise ValueError(f"{uri}: no line end in its first {MAX_HEADER} bytes")
                        block = f.read(1 << 16)
                        if not block:
                            break
                        head += block
                line = head.split(b"\n", 1)[0].rstrip(b"\r").decode(encoding, "replace").lstrip("\ufeff")
                out.append((uri, file, line))
            yield pd.DataFrame(out, columns=["path", "file", "header"])
    return run


def _split_header(header: str, sep: str, quote: str) -> list[str]:
    import csv
    return [h.strip() for h in next(csv.reader([header], delimiter=sep, quotechar=quote))]


def file_headers(spark: SparkSession, paths: Sequence[str] | str, glob: str | None = None,
                 encoding: str = "utf-8") -> DataFrame:
    """(path, file as Spark's file metadata names it, header line) of every file, read on executors."""
    return list_files(spark, paths, glob).select("path", "file").mapInPandas(_read_headers(encoding), HEADER_SCHEMA)


def read_by_header(spark: SparkSession, files: Sequence[str], header: list[str], columns: Sequence[str],
                   sep: str = "|", quote: str = '"', encoding: str = "UTF-8",
                   null_tokens: Sequence[str] = ("", "NULL", "null"), glob: str | None = None) -> DataFrame:
    """Read files (or folders of files) sharing one header; project onto ``columns`` by case-insensitive name."""
    names = [f"__c{i}" for i in range(len(header))]
    schema = StructType([StructField(n, StringType(), True) for n in names])
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    df = (reader.schema(schema)
          .option("header", True).option("sep", sep).option("quote", quote).option("escape", quote)
          .option("encoding", encoding).option("mode", "PERMISSIVE").option("enforceSchema", True)
          .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
          .csv(list(files)))
    by_name: dict[str, str] = {}
    for n, h in zip(names, header):
        by_name.setdefault(h.lower(), n)
    cols = []
    for c in columns:
        src = by_name.get(c.lower())
        v = null_if_token(F.col(src), null_tokens) if src else F.lit(None).cast("string")
        cols.append(v.alias(c))
    return df.select(*cols)


def delimited_scan(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str], sep: str = "|",
                   quote: str = '"', glob: str | None = None, encoding: str = "UTF-8",
                   null_tokens: Sequence[str] = ("", "NULL", "null")) -> DataFrame:
    """All rows of the delimited files under ``paths``, bound to ``columns`` by name; no line is refused."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    headers = _headers(spark, roots, glob, encoding)
    layouts = _layouts(headers)
    if len(layouts) == 1:
        return read_by_header(spark, roots, _split_header(layouts[0], sep, quote), columns, sep, quote, encoding, null_tokens, glob)
    lines = _bound_lines(spark, roots, headers, layouts, columns, sep, quote, glob, encoding, null_tokens)
    return lines.where("NOT _skip").select(*[F.col(f"`{c}`") for c in columns])


def _headers(spark: SparkSession, roots: Sequence[str], glob: str | None, encoding: str) -> DataFrame:
    """The header lines, written once."""
    from ..session import scratch_dir
    seen = scratch_dir(spark, "headers")
    file_headers(spark, roots, glob, encoding).write.parquet(seen)
    return spark.read.schema(HEADER_SCHEMA).parquet(seen)


def _layouts(headers: DataFrame) -> list[str]:
    return [r.header for r in headers.select("header").distinct().orderBy("header").collect()]


def _bound_lines(spark: SparkSession, roots: Sequence[str], headers: DataFrame, layouts: Sequence[str], columns: Sequence[str], sep: str,
                 quote: str, glob: str | None, encoding: str, null_tokens: Sequence[str]) -> DataFrame:
    """``columns`` of every line, with ``_file``, ``_block``, ``_row``, ``_skip``, ``_reason`` and ``_raw``.

    A file's layout is found by the hash of its name: a few bytes a file, broadcast behind a check of their
    size.  Headers (lines that equal their file's) and blank lines are to be skipped.  ``_row`` counts up along
    a block (a split) of a file.
    """
    split = [_split_header(h, sep, quote) for h in layouts]
    width = max([len(h) for h in split], default=1)
    places = []
    for i, header in enumerate(split):
        at: dict[str, int] = {}
        for n, h in enumerate(header):
            at.setdefault(h.lower(), n)
        places.append((i, layouts[i], [at.get(c.lower()) for c in columns]))
    layout = spark.createDataFrame(places, "_layout int, header string, _at array<int>")  # as many rows as layouts
    named = headers.join(F.broadcast(layout.select("_layout", "header")), "header").select(F.xxhash64("file").alias("_hash"), "_layout")
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    raw = F.col("value") if encoding.upper().replace("-", "") == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = reader.text(list(roots)).select(
        raw.alias("_raw"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    lines = lines.withColumn("_hash", F.xxhash64("_file")).join(checked_broadcast(named), "_hash").join(F.broadcast(layout), "_layout")
    # Most lines need no more than a split: no quote, no control character (which the parser trims), no mark, whole UTF-8.
    lines = lines.withColumn("_valid", F.is_valid_utf8("_raw"))
    lines = lines.withColumn("_text", F.when(F.col("_valid") & ~F.startswith("_raw", F.lit("\ufeff")), F.col("_raw")).otherwise(
        F.regexp_replace("_raw", "^\ufeff", "")))
    quoted = F.contains("_text", F.lit(quote))
    plain = F.col("_valid") & ~quoted & ~F.rlike("_text", F.lit("[\\x00-\\x1f]")) if "" in null_tokens else F.lit(False)
    skip = (F.rtrim("_text") == F.rtrim("header")) | (F.trim("_text") == "")
    fields = [f"f{i}" for i in range(width)]
    parsed = F.from_csv("_text", ", ".join(f"{f} string" for f in fields), {
        "sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    # Lambdas keep the generated code of wide rows small: a method beyond the JIT compiler's limit runs many times slower.
    parts = F.get(F.transform(F.array(parsed), lambda r: F.array(*[r[f] for f in fields])), F.lit(0))
    lines = lines.withColumn("_values", F.when(plain, F.split("_text", re.escape(sep), -1)).otherwise(parts))
    lines = lines.withColumn("_cells", F.transform("_at", lambda at: null_if_token(F.get(F.col("_values"), at), null_tokens)))
    # Quotes that open and close fields, and doubled ones inside them, come in pairs.
    odd = quoted & (F.length(F.regexp_replace("_text", f"[^{quote}]", "")) % 2 == 1)
    reason = F.when(skip, None).when(~F.col("_valid"), INVALID_UTF8).when(odd, OPEN_QUOTE)
    values = [F.get("_cells", F.lit(i)).alias(c) for i, c in enumerate(columns)]
    return lines.select("_file", "_block", "_row", skip.alias("_skip"), reason.alias("_reason"), "_raw", *values)


def checked_lines(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str], sep: str = "|", quote: str = '"',
                  glob: str | None = None, encoding: str = "UTF-8", null_tokens: Sequence[str] = ("", "NULL", "null")) -> DataFrame:
    """Every line under ``paths``, bound to ``columns``: to be skipped, or refused for a ``_reason``, or to be loaded."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    headers = _headers(spark, roots, glob, encoding)
    return _bound_lines(spark, roots, headers, _layouts(headers), columns, sep, quote, glob, encoding, null_tokens)


def accepted(lines: DataFrame) -> DataFrame:
    """The rows of ``checked_lines`` that are to be loaded."""
    return lines.where("NOT _skip AND _reason IS NULL").drop("_file", "_block", "_row", "_skip", "_reason", "_raw")


def rejected(lines: DataFrame) -> DataFrame:
    """(file, line, reason, raw) of the lines of ``checked_lines`` that can't be loaded; the header is line 1.

    A line's number is its place in its block plus the lines of the blocks before.  Blocks, not lines, are
    put in order, so no task orders a file.
    """
    blocks = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    bad = lines.where("_reason IS NOT NULL").join(before, ["_file", "_block"])
    return bad.select(F.col("_file").alias("file"), (F.col("_row") - F.col("_first") + 1 + F.col("_before")).alias("line"),
                      F.col("_reason").alias("reason"), F.col("_raw").alias("raw"))


def line_counts(lines: DataFrame) -> DataFrame:
    """(file, lines, loaded, rejected) of ``checked_lines``, without headers and blank lines."""
    data = lines.where("NOT _skip")
    return data.groupBy(F.col("_file").alias("file")).agg(
        F.count("*").alias("lines"), F.count_if(F.col("_reason").isNull()).alias("loaded"), F.count("_reason").alias("rejected"))
