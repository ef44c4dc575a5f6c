"""Queries for the sources: files, archives, the load ledger, seeds and manifests.

Every input is written by Spark from the benchmark tables into the session's
shared scratch folder (``spark.checkpoint.dir``), then read back through the
loaders, so the work grows with the tables.
"""

from __future__ import annotations

import posixpath

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import domain as D
from ..operators.joins import lookup
from ..session import remove_scratch, scratch_dir
from ..sources.archive import _fs, archive_scan, extract_archives, landing_check, list_files
from ..sources.delimited import checked_lines, delimited_scan, rejected
from ..sources.manifest import manifest_diff, manifest_filter, manifest_summary, read_catalog
from ..sources.seed import read_seed
from ..streaming.ledger import load_new_files, read_history, read_loaded
from . import oracle as O
from .queries import bronze_of, silver_of
from .tables import BRONZE_SQL, SEED_SQL, load, seed_from_tables

COLS = D.BRONZE_COLUMNS


def _q(c: str):
    return F.col(f"`{c}`")


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None,
                    compression: str = "none") -> None:
    """Pipe-delimited files with a header line, NULL as an empty field: as many files as the input has splits."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(by)
    writer.option("header", True).option("sep", "|").option("quote", '"').option("escape", '"').option("compression", compression).csv(path)


def _disposition(n: int):
    return _q("No disposition") == F.lit(str(n))


# ------------------------------------------------------------------ files
def q_delimited_scan(spark, sf_dir):
    path = scratch_dir(spark, "bronze-files")
    write_delimited(bronze_of(spark, sf_dir), path)
    return delimited_scan(spark, path, COLS, glob="*.csv")


def q_match_by_name(spark, sf_dir):
    """Even dispositions in files with reversed, upper-cased columns, one extra, one missing."""
    b = bronze_of(spark, sf_dir)
    even = (_q("No disposition").cast("int") % 2) == 0
    path = scratch_dir(spark, "bronze-mixed")
    write_delimited(b.filter(~even), path + "/a")
    other = [c for c in reversed(COLS) if c != "Surface terrain"]
    write_delimited(b.filter(even).select(*[_q(c).alias(c.upper()) for c in other],
                                          F.lit("x").alias("Colonne en plus")), path + "/b")
    return delimited_scan(spark, [path + "/a", path + "/b"], COLS, glob="*.csv")


def _ragged_lines(b: DataFrame) -> DataFrame:
    """One text line per row: disposition 1 short by 3 fields, 2 long by 2, 4 with a quoted pipe."""
    fields = []
    for c in COLS:
        v = F.coalesce(_q(c), F.lit(""))
        if c == "Commune":
            v = F.when(_disposition(4) & _q(c).isNotNull(), F.concat(F.lit('"'), _q(c), F.lit(' | quai"'))).otherwise(v)
        fields.append(v)
    full = F.concat_ws("|", *fields)
    short = F.concat_ws("|", *fields[:-3])
    long = F.concat_ws("|", *fields, F.lit("x"), F.lit("y"))
    line = F.when(_disposition(1), short).when(_disposition(2), long).otherwise(full)
    return b.select(line.alias("|".join(COLS)))


def q_tolerant_load(spark, sf_dir):
    path = scratch_dir(spark, "bronze-ragged")
    # A single text column named after the header line; no quoting, no other separator.
    (_ragged_lines(bronze_of(spark, sf_dir)).write.mode("overwrite")
     .option("header", True).option("sep", "\t").option("quote", "").csv(path))
    return delimited_scan(spark, path, COLS, glob="*.csv")


def _bad_lines(b: DataFrame) -> DataFrame:
    """(part, document, text) of one raw line per row; disposition 3 has bytes that are no UTF-8, 5 a quote that stays open."""
    line = F.concat_ws("|", *[F.coalesce(_q(c), F.lit("")) for c in COLS])
    spoilt = _q("Identifiant de document").cast("int") % 7 == 0
    line = (F.when(_disposition(3) & spoilt, F.concat(line, F.lit("caf"), F.unhex(F.lit("E9FF")).cast("string")))
            .when(_disposition(5) & spoilt, F.concat(line, F.lit('"x'))).otherwise(line))
    return b.select(_q("No disposition").alias("part"), _q("Identifiant de document").cast("int").alias("document"), line.alias("text"))


def _join_pieces(staged: str, path: str):
    """One file a folder of ``staged`` under ``path``: its pieces one behind the other, in the order of their names."""
    def run(batches):
        import uuid

        from pyarrow import fs as pafs
        for pdf in batches:
            made = []
            for folder in pdf["folder"]:
                in_fs, at = _fs(posixpath.join(staged, folder))
                pieces = sorted(i.path for i in in_fs.get_file_info(pafs.FileSelector(at))
                                if i.type == pafs.FileType.File and i.base_name.startswith("part-"))
                out_fs, to = _fs(posixpath.join(path, folder))
                out_fs.create_dir(to, recursive=True)
                name = f"lines-{uuid.uuid4().hex}.txt"
                with out_fs.open_output_stream(f"{to}/_{name}") as out:
                    for piece in pieces:
                        with in_fs.open_input_stream(piece) as src:  # decompressed by its suffix
                            while block := src.read(8 << 20):
                                out.write(block)
                out_fs.move(f"{to}/_{name}", f"{to}/{name}")
                made.append(f"{to}/{name}")
            yield pd.DataFrame({"file": made})
    return run


def _write_bad_lines(spark, sf_dir, path: str, only=None) -> None:
    """A file per disposition, headed by its columns, its lines by document.

    The lines are put in order in ranges of (disposition, document), so no task orders a file; a task then only copies.
    """
    lines = _bad_lines(bronze_of(spark, sf_dir))
    lines = lines if only is None else lines.where(only)
    heads = lines.select("part", F.lit(-1).alias("document"), F.lit("|".join(COLS)).alias("text")).distinct()
    rows = lines.unionByName(heads).repartitionByRange("part", "document").sortWithinPartitions("part", "document")
    staged = scratch_dir(spark, "bad-line-pieces")
    rows.select("part", "text").write.partitionBy("part").option("compression", "gzip").text(staged)
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    folders = [r.folder for r in list_files(spark, staged, "*.txt.gz").select(folder).distinct().collect()]  # one per disposition
    if not folders:
        return
    work = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders))
    work.mapInPandas(_join_pieces(staged, path), "file string").write.json(scratch_dir(spark, "bad-line-log"))
    remove_scratch(staged)


_PART = r"/part=([0-9]+)/"


def q_load_rejects(spark, sf_dir):
    """The refused lines of files with injected bad lines: disposition, line number in its file, reason."""
    path = scratch_dir(spark, "bronze-bad")
    _write_bad_lines(spark, sf_dir, path)
    found = rejected(checked_lines(spark, path, COLS, glob="*.txt"))
    return found.select(F.regexp_extract("file", _PART, 1).alias("part"), "line", "reason")


def q_load_history(spark, sf_dir):
    """The load history after two drops of such files, with a rerun that finds nothing new in between."""
    src, table, ckpt, log = (scratch_dir(spark, n) for n in ("history-src", "history-table", "history-ckpt", "history-log"))
    first = F.col("part").cast("int") <= 4
    for only in (first, None, ~first):
        if only is not None:
            _write_bad_lines(spark, sf_dir, src, only)
        load_new_files(spark, src, table, ckpt, COLS, history_dir=log)
    loaded = read_history(spark, log)
    return loaded.select(F.regexp_extract("file", _PART, 1).alias("part"), "status", "rows_loaded", "rows_rejected")


# ------------------------------------------------------------------ archives
ZIP_SCHEMA = StructType([StructField("archive", StringType())])


def _zip_parts(out_dir: str):
    def run(batches):
        import zipfile
        out_fs, out_root = _fs(out_dir)
        out_fs.create_dir(out_root, recursive=True)
        for pdf in batches:
            made = []
            for uri in pdf["path"]:
                in_fs, in_path = _fs(uri)
                part = posixpath.basename(posixpath.dirname(in_path)).split("=")[-1]
                stem = part + "-" + posixpath.basename(in_path).split(".")[0]
                target = posixpath.join(out_root, f"{D.ARCHIVE_TOKEN}-{stem}.txt.zip")
                with out_fs.open_output_stream(target) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zf:
                    with in_fs.open_input_stream(in_path) as src, zf.open(f"ValeursFoncieres-{stem}.txt", "w") as dst:
                        while True:
                            block = src.read(8 << 20)
                            if not block:
                                break
                            dst.write(block)
                    zf.writestr("notice.pdf", b"%PDF-1.4 notice")
                made.append(target)
            yield pd.DataFrame({"archive": made})
    return run


def _make_archives(spark, sf_dir) -> tuple[str, str]:
    """An archive for each text file of the raw lines; the files are written by disposition."""
    files = scratch_dir(spark, "bronze-text")
    zips = scratch_dir(spark, "archives")
    write_delimited(bronze_of(spark, sf_dir).withColumn("part", _q("No disposition")), files, by="part", compression="gzip")
    parts = list_files(spark, [files], "*.csv.gz").select("path")
    parts.repartition(max(1, parts.count())).mapInPandas(_zip_parts(zips), ZIP_SCHEMA).write.mode("overwrite") \
        .json(zips.rstrip("/") + "/_zip_log")
    remove_scratch(files)
    return zips, scratch_dir(spark, "landed")


def q_archive_scan(spark, sf_dir):
    zips, landed = _make_archives(spark, sf_dir)
    extract_archives(spark, zips, landed, ".txt")
    return delimited_scan(spark, landed, COLS, glob="*.txt")


def q_archive_lines(spark, sf_dir):
    """Every text line extracted from the archives, without the header line of each."""
    zips, landed = _make_archives(spark, sf_dir)
    return archive_scan(spark, zips, landed, ".txt").select("line").filter(F.col("line") != "|".join(COLS))


def q_landing_check(spark, sf_dir):
    """Rows landed per disposition, from the counts of every landed file (a header line each)."""
    zips, landed = _make_archives(spark, sf_dir)
    extract_archives(spark, zips, landed, ".txt")
    part = F.regexp_extract("name", "^ValeursFoncieres-([0-9]+)-", 1).alias("part")
    return landing_check(spark, landed, ".txt").groupBy(part).agg((F.sum("lines") - F.count(F.lit(1))).alias("landed_rows"))


# ------------------------------------------------------------------ ledger
def q_load_ledger(spark, sf_dir):
    """Two drops, a rerun with nothing new, a third drop: every row loaded once."""
    b = bronze_of(spark, sf_dir)
    src, table, ckpt = (scratch_dir(spark, n) for n in ("ledger-src", "ledger-table", "ledger-ckpt"))
    disp = _q("No disposition").cast("int")
    write_delimited(b.filter(disp <= 3), src, mode="append")
    write_delimited(b.filter(disp.between(4, 5)), src, mode="append")
    load_new_files(spark, src, table, ckpt, COLS, glob="*.csv")
    load_new_files(spark, src, table, ckpt, COLS, glob="*.csv")  # nothing new
    write_delimited(b.filter((disp >= 6) | disp.isNull()), src, mode="append")
    load_new_files(spark, src, table, ckpt, COLS, glob="*.csv")
    return read_loaded(spark, table, COLS)


# ------------------------------------------------------------------ seed
def q_seed_lookup(spark, sf_dir):
    path = scratch_dir(spark, "seed")
    seed_from_tables(spark, sf_dir).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    seed = read_seed(spark, path)
    deps = silver_of(spark, sf_dir).select(F.coalesce("code_departement", F.lit("XX")).alias("code_departement")).distinct()
    dep = F.col("code_departement")
    return lookup(deps, seed, "code_departement", {
        "nom_departement": F.concat(F.lit(D.DEPARTMENT_NAME_PREFIX), dep),
        "region": F.lit(D.REGION_DEFAULT),
    })


# ------------------------------------------------------------------ manifests
def _item_url(pages: DataFrame):
    pid = F.col("page_id")
    year = (F.lit(2015) + pid % 11).cast("string")
    base = F.regexp_replace("url", "[?#].*$", "")
    tok = D.ARCHIVE_TOKEN
    leaf = (F.when(pid % 4 == 0, F.concat(F.lit(f"{tok}-"), year, F.lit(".txt.zip")))
            .when(pid % 4 == 1, F.concat(F.lit("ValeursFoncieres-"), year, F.lit(".zip")))
            .when(pid % 4 == 2, F.concat(F.lit("notice-"), pid.cast("string"), F.lit(".pdf")))
            .otherwise(F.concat(F.lit(f"{tok}-"), pid.cast("string"), F.lit(".zip"))))
    return F.concat(base, F.lit("/"), leaf)


def _catalog(spark, sf_dir) -> DataFrame:
    """Catalog JSON documents of ten resources each, written then read back."""
    p = load(spark, sf_dir, "pages")
    pages = p.select("page_id", _item_url(p).alias("u"))
    docs = pages.groupBy((F.col("page_id") / 10).cast("long").alias("doc")).agg(
        F.collect_list(F.struct(F.col("u").alias("url"))).alias("resources"))  # 10 per document
    path = scratch_dir(spark, "catalog")
    docs.select("resources").write.mode("overwrite").json(path)
    return read_catalog(spark, path, multi_line=False)


def _items(spark, sf_dir):
    return manifest_filter(_catalog(spark, sf_dir), ".zip", D.ARCHIVE_TOKEN)


def _landed(spark, sf_dir, mode: str) -> DataFrame:
    items = _items(spark, sf_dir)
    yr = F.regexp_extract("name", r"20\d{2}", 0)
    h = F.length("url") % 3
    if mode == "casefold":
        return items.filter(h == 0).select(F.upper(F.expr("substring(name, 1, length(name) - 4)")).alias("name"))
    if mode == "exact":
        return items.filter(h == 0).select(F.when(F.length("name") % 2 == 0, F.col("name"))
                                           .otherwise(F.upper("name")).alias("name"))
    return items.filter((h == 0) & (yr != "")).select(F.concat(F.lit("ValeursFoncieres-"), yr, F.lit(".txt")).alias("name"))


def q_manifest_filter(spark, sf_dir):
    return _items(spark, sf_dir)


def _diff(mode):
    return lambda spark, sf_dir: manifest_diff(_items(spark, sf_dir), _landed(spark, sf_dir, mode), mode)


def q_manifest_summary(spark, sf_dir):
    return manifest_summary(manifest_diff(_items(spark, sf_dir), _landed(spark, sf_dir, "casefold"), "casefold"))


QUERIES = {
    "delimited_scan": q_delimited_scan,
    "match_by_name": q_match_by_name,
    "tolerant_load": q_tolerant_load,
    "load_rejects": q_load_rejects,
    "load_history": q_load_history,
    "archive_scan": q_archive_scan,
    "archive_lines": q_archive_lines,
    "landing_check": q_landing_check,
    "load_ledger": q_load_ledger,
    "seed_lookup": q_seed_lookup,
    "manifest_filter": q_manifest_filter,
    "manifest_diff": _diff("casefold"),
    "manifest_diff_exact": _diff("exact"),
    "manifest_diff_year": _diff("year"),
    "manifest_summary": q_manifest_summary,
}

# ------------------------------------------------------------------ oracle SQL
_all = ", ".join(f'"{c}"' for c in COLS)


def _bronze_with(replace: dict[str, str]) -> str:
    cols = ", ".join((f'{replace[c]} AS "{c}"' if c in replace else f'"{c}"') for c in COLS)
    return f"WITH bronze AS (\n{BRONZE_SQL}\n)\nSELECT {cols} FROM bronze"


_ITEM_URL = ("regexp_replace(url, '[?#].*$', '') || '/' || CASE WHEN page_id % 4 = 0 THEN '" + D.ARCHIVE_TOKEN + "-' || "
             "CAST(2015 + page_id % 11 AS VARCHAR) || '.txt.zip' WHEN page_id % 4 = 1 THEN 'ValeursFoncieres-' || "
             "CAST(2015 + page_id % 11 AS VARCHAR) || '.zip' WHEN page_id % 4 = 2 THEN 'notice-' || "
             "CAST(page_id AS VARCHAR) || '.pdf' ELSE '" + D.ARCHIVE_TOKEN + "-' || CAST(page_id AS VARCHAR) || '.zip' END")
ITEMS_SQL = (f"SELECT url, string_split(url, '/')[-1] AS name FROM (SELECT {_ITEM_URL} AS url FROM pages) p "
             "WHERE url LIKE '%.zip' AND url LIKE '%" + D.ARCHIVE_TOKEN + "%'")
_YEAR = "NULLIF(regexp_extract(name, '20[0-9]{2}', 0), '')"
LANDED_SQL = {
    "casefold": "SELECT upper(substring(name, 1, length(name) - 4)) AS name FROM items WHERE length(url) % 3 = 0",
    "exact": ("SELECT CASE WHEN length(name) % 2 = 0 THEN name ELSE upper(name) END AS name FROM items "
              "WHERE length(url) % 3 = 0"),
    "year": (f"SELECT 'ValeursFoncieres-' || {_YEAR} || '.txt' AS name FROM items "
             f"WHERE length(url) % 3 = 0 AND {_YEAR} IS NOT NULL"),
}
KEY_SQL = {
    "casefold": ("lower(substring(i.name, 1, length(i.name) - 4))", "SELECT DISTINCT lower(name) AS k FROM landed"),
    "exact": ("i.name", "SELECT DISTINCT name AS k FROM landed"),
    "year": (_YEAR.replace("name", "i.name"),
             "SELECT DISTINCT k FROM (SELECT unnest(list_filter(list_transform(generate_series(1, greatest(length(name) - 3, 1)), "
             "lambda j: substring(name, CAST(j AS INTEGER), 4)), lambda s: regexp_matches(s, '^20[0-9]{2}$'))) AS k FROM landed) w"),
}


def _diff_sql(mode: str) -> str:
    ikey, keys = KEY_SQL[mode]
    return (f"WITH items AS ({ITEMS_SQL}), landed AS ({LANDED_SQL[mode]}), keys AS ({keys}) "
            f"SELECT i.url, i.name, CASE WHEN k.k IS NOT NULL THEN 'skipped' ELSE 'pending' END AS status "
            f"FROM items i LEFT JOIN keys k ON {ikey} = k.k")


_SPOILT = 'CAST("Identifiant de document" AS INTEGER) % 7 = 0 AND "No disposition" IN (\'3\', \'5\')'
_BAD_LINES = f"""WITH bronze AS (
{BRONZE_SQL}
), lines AS (SELECT "No disposition" AS part, {_SPOILT} AS bad,
             1 + row_number() OVER (PARTITION BY "No disposition" ORDER BY CAST("Identifiant de document" AS INTEGER)) AS line FROM bronze)
"""
_LINE = "concat_ws('|', " + ", ".join(f"COALESCE(\"{c}\", '')" for c in COLS) + ")"

SQL = {
    "archive_lines": f"WITH bronze AS (\n{BRONZE_SQL}\n)\nSELECT {_LINE} AS line FROM bronze",
    "landing_check": (f"WITH bronze AS (\n{BRONZE_SQL}\n)\nSELECT \"No disposition\" AS part, COUNT(*) AS landed_rows FROM bronze "
                      "GROUP BY 1"),
    "delimited_scan": _bronze_with({}),
    "match_by_name": _bronze_with({"Surface terrain": "CASE WHEN CAST(\"No disposition\" AS INTEGER) % 2 = 0 "
                                                      "THEN NULL ELSE \"Surface terrain\" END"}),
    "tolerant_load": _bronze_with({
        **{c: "CASE WHEN \"No disposition\" = '1' THEN NULL ELSE \"" + c + "\" END" for c in COLS[-3:]},
        "Commune": "CASE WHEN \"No disposition\" = '4' THEN \"Commune\" || ' | quai' ELSE \"Commune\" END"}),
    "load_rejects": _BAD_LINES + "SELECT part, line, CASE part WHEN '3' THEN 'invalid_utf8' ELSE 'open_quote' END AS reason FROM lines WHERE bad",
    "load_history": _BAD_LINES + ("SELECT part, CASE WHEN count(*) FILTER (bad) > 0 THEN 'partially_loaded' ELSE 'loaded' END AS status, "
                                  "count(*) FILTER (NOT bad) AS rows_loaded, count(*) FILTER (bad) AS rows_rejected FROM lines GROUP BY part"),
    "archive_scan": _bronze_with({}),
    "load_ledger": _bronze_with({}),
    "seed_lookup": O.with_ctes(
        "SELECT d.code_departement, COALESCE(s.nom_departement, 'Département ' || d.code_departement) AS nom_departement, "
        "COALESCE(s.region, 'Inconnue') AS region FROM (SELECT DISTINCT COALESCE(code_departement, 'XX') AS "
        "code_departement FROM silver) d LEFT JOIN seed s ON d.code_departement = s.code_departement",
        [("seed", SEED_SQL)]),
    "manifest_filter": ITEMS_SQL,
    "manifest_diff": _diff_sql("casefold"),
    "manifest_diff_exact": _diff_sql("exact"),
    "manifest_diff_year": _diff_sql("year"),
    "manifest_summary": (f"WITH d AS ({_diff_sql('casefold')}) SELECT status, COUNT(*) AS files FROM d GROUP BY status "
                         "UNION ALL SELECT 'total' AS status, COUNT(*) AS files FROM d"),
}
