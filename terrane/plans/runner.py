"""Build the whole property model into versioned tables, layer by layer.

Each layer is written, then read back by the next one (silver -> dimensions
and fact -> aggregates), so no job recomputes an upstream layer and a lost
executor only costs a re-read.  Tables are independent within a layer and are
submitted from a small thread pool so their jobs share the cluster.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import union_all
from ..operators.upsert import full_refresh
from . import gold, star

GOLD = {
    "gold_kpis": gold.global_kpis,
    "evolution_annuelle": gold.yoy_change,
    "prix_moyen_commune": gold.avg_median_by_group,
    "prix_m2_commune": gold.avg_ratio_by_group,
    "prix_par_departement": gold.region_benchmark,
    "volume_mensuel": gold.volume_by_month,
    "repartition_types": gold.type_distribution,
    "surface_vs_prix": gold.price_by_bin,
    "top_communes": gold.top_communes,
}


def _write_all(tables: dict[str, DataFrame], root: str, threads: int) -> dict[str, DataFrame]:
    def one(item):
        name, df = item
        return name, full_refresh(df, f"{root.rstrip('/')}/{name}")
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return dict(pool.map(one, tables.items()))


def build_model(spark: SparkSession, silver: DataFrame, seed: DataFrame, calendar: DataFrame, root: str,
                threads: int = 4) -> dict[str, DataFrame]:
    """Write silver, gold, dimensions, fact and aggregates under ``root``; returns them re-read."""
    out = {"silver_mutation_f": full_refresh(silver, f"{root.rstrip('/')}/silver_mutation_f")}
    s = out["silver_mutation_f"]
    layer1 = {name: fn(s) for name, fn in GOLD.items()}
    layer1.update({
        "dim_date": calendar,
        "dim_geography": star.dim_geography(s, seed),
        "dim_type_bien": star.dim_type(s),
        "dim_nature_mutation": star.dim_nature(s),
        "fact_mutations": star.fact(s),
    })
    out.update(_write_all(layer1, root, threads))
    f, g, cal = out["fact_mutations"], out["dim_geography"], out["dim_date"]
    layer2 = {
        "agg_annuel_type_bien": star.agg_year(f, cal),
        "agg_mensuel_type_bien": star.agg_month(f, cal),
        "agg_departement_type_bien": star.agg_region_year(f, g, cal),
        "agg_commune_type_bien": star.agg_geo_year(f, g, cal),
    }
    out.update(_write_all(layer2, root, threads))
    return out


# The pre-aggregated tables that a dashboard imports; the fact table and silver stay behind.
BI_TABLES = [*GOLD, "dim_date", "dim_geography", "dim_type_bien", "dim_nature_mutation", "agg_annuel_type_bien",
             "agg_mensuel_type_bien", "agg_departement_type_bien", "agg_commune_type_bien"]


def export_bi(tables: dict[str, DataFrame], out_dir: str, names: list[str] | None = None) -> DataFrame:
    """Write the tables that a dashboard imports to ``out_dir``; one row per table: table_name, row_count, bytes.

    Each is a folder of few, full parquet files; nothing passes through the driver.
    """
    base = out_dir.rstrip("/")
    report = []
    for name in names or BI_TABLES:
        spark = tables[name].sparkSession
        path = f"{base}/{name}"
        tables[name].hint("rebalance").write.mode("overwrite").parquet(path)
        written = spark.read.schema(tables[name].schema).parquet(path)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        report.append(written.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")).join(
            files.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")), "table_name"))
    return union_all(report)


def run_refresh(spark: SparkSession, archive_dir: str, root: str, seed: DataFrame, calendar: DataFrame,
                threads: int = 4) -> DataFrame:
    """One refresh of the whole model, in the order of the source's monthly run.

    1. unzip the ``.txt`` members of archives not landed yet (manifest diff on the
       case-folded names, one task per archive) and check that something is landed;
    2. load each landed file once into the raw table (streaming ledger, by name);
    3. incremental silver: rank keys with new rows, merge rows past the mark into
       the month-partitioned silver table;
    4. rebuild gold, dimensions, fact and aggregates layer by layer;
    5. run the declared data tests, write their report and summary (pass / warn / fail),
       and fail the run if a test of severity error has failed.
    Written beside the tables: what was found and skipped by name (``ingest_items``) and in numbers
    (``ingest_summary``), and the rows loaded and refused of every file (``load_history``).
    Everything lives under ``root`` (a shared folder); rerunning with nothing new
    loads nothing and leaves silver unchanged.
    """
    from .. import domain as D
    from ..operators.quality import Check, raise_on_failure, run_checks, summarize

    from ..sources.archive import extract_archives, extraction_log, list_files, require_landed
    from ..sources.manifest import PENDING, manifest_diff, manifest_summary
    from ..streaming.ledger import load_new_files, read_loaded
    from . import silver as S
    base = root.rstrip("/")
    landed, raw, ledger = f"{base}/landed", f"{base}/raw", f"{base}/_ledger"
    leaf = F.element_at(F.split("path", "/"), -1).alias("name")
    archives = list_files(spark, archive_dir, "*.zip").select("path", leaf)
    already = extraction_log(spark, landed).select("name")
    items = full_refresh(manifest_diff(archives, already, "casefold"), f"{base}/ingest_items")  # the names beside the counts
    full_refresh(manifest_summary(items), f"{base}/ingest_summary")
    pending = items.filter(F.col("status") == PENDING)
    extract_archives(spark, archive_dir, landed, ".txt", archives=pending)
    require_landed(spark, landed, ".txt")
    load_new_files(spark, landed, raw, ledger, D.BRONZE_COLUMNS, glob="*.txt", history_dir=f"{base}/load_history")
    bronze = read_loaded(spark, raw, D.BRONZE_COLUMNS)
    silver_df = S.incremental_build(bronze, f"{base}/silver")
    tables = build_model(spark, silver_df, seed, calendar, f"{base}/model", threads)
    checks = [Check(t, c, test, sev, where) for t, c, test, sev, where in D.DATA_TESTS]
    checks += [Check(t, c, "relationships", "warn", None, pt, pc) for t, c, pt, pc in D.RELATIONSHIP_TESTS]
    report = full_refresh(run_checks(tables, checks), f"{base}/quality_report")
    summary = full_refresh(summarize(report), f"{base}/quality_summary")
    raise_on_failure(report)
    return summary
