"""Property-shaped inputs derived from the benchmark tables.

``bronze_from_tables`` turns every ``lineitem`` row (joined to its ``supplier``)
into one raw all-string property line: the line number is the disposition, the
order the document, the shipping date the sale date, the extended price the
price (decimal comma), the quantity the built surface, the supplier the
commune, its nation the department.  Dirty values (bad numbers and dates, NULL
parts, upper case, other date formats) are injected by fixed rules on the
keys, so the raw table grows with ``lineitem`` and exercises every cleaning
rule.  ``BRONZE_SQL`` is the same derivation for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain as D


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_input(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores.

    A single large parquet row group is one task; the CPU-heavy text derivation
    after it would then run on one core.  With many input files (the normal case
    at scale) the scan already has enough splits and nothing is added.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: leave the scan as it is
        return df
    return df.repartition(cores) if splits < cores else df


def _s(c: Column) -> Column:
    return c.cast("string")


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw property lines (43 string columns, header names) from lineitem x supplier."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    li = spread_input(li)
    sup = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    # supplier grows with the data: plain equi-join, AQE picks the strategy.
    t = li.join(sup, "l_suppkey", "inner")
    k, pk = F.col("l_orderkey"), F.col("l_partkey")
    qty = F.col("l_quantity").cast("int")
    nat2 = F.lpad(_s(F.col("s_nationkey")), 2, "0")
    ptype = pk % 5
    values = {
        "No disposition": _s(F.col("l_linenumber")),
        "Identifiant de document": _s(k),
        "Reference document": _s(pk),
        "Nature mutation": (F.when(k % 37 == 0, F.lit(None))
                            .when(k % 41 == 0, F.lit("Donation"))
                            .when(F.col("l_returnflag") == "N", F.lit("Vente"))
                            .when(F.col("l_returnflag") == "R", F.lit("Vente en l'état futur d'achèvement"))
                            .when(F.col("l_linestatus") == "F", F.lit("ADJUDICATION"))
                            .otherwise(F.lit("Échange"))),
        "Valeur fonciere": (F.when(k % 43 == 0, F.lit("abc"))
                            .when(k % 47 == 0, F.lit("0"))
                            .when(k % 53 == 0, F.lit(None))
                            .otherwise(F.replace(_s(F.col("l_extendedprice").cast("decimal(12,2)")),
                                                 F.lit("."), F.lit(",")))),
        "Code postal": F.when(k % 59 == 0, F.lit(None)).otherwise(
            F.concat(nat2, F.lpad(_s(F.col("l_suppkey") % 1000), 3, "0"))),
        "Commune": F.when(k % 61 == 0, F.lit(None)).otherwise(F.upper(F.col("s_name"))),
        # Every thirteenth supplier lies in a three-digit department that the seed doesn't know.
        "Code departement": (F.when(k % 67 == 0, F.lit(None))
                             .when(F.col("l_suppkey") % 13 == 0, F.concat(F.lit("9"), nat2)).otherwise(nat2)),
        "Type local": (F.when(pk % 11 == 0, F.lit("Terrain à bâtir"))
                       .when(ptype == 0, F.lit("Maison"))
                       .when(ptype == 1, F.lit("Appartement"))
                       .when(ptype == 2, F.when(pk % 2 == 0, F.lit("DÉPENDANCE")).otherwise(F.lit("Dépendance")))
                       .when(ptype == 3, F.lit(D.TYPE_COMMERCIAL.capitalize()))
                       .otherwise(F.lit(None))),
        "Surface reelle bati": (F.when(ptype.isin(2, 4), F.lit(None))
                                .when(F.col("l_linenumber") == 3, F.concat(_s(qty), F.lit(",5")))
                                .otherwise(_s(qty))),
        "Nombre pieces principales": _s(qty % 7),
        "Surface terrain": _s(F.round(F.col("l_tax") * 10000).cast("int")),
        "Date mutation": (F.when(k % 29 == 0, F.lit(None))
                          .when(k % 31 == 0, F.concat(F.lit("31/02/"), _s(F.year("l_shipdate"))))
                          .when(k % 7 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
                          .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))),
    }
    return t.select(*[(values[c] if c in values else F.lit(None)).cast("string").alias(c) for c in D.BRONZE_COLUMNS])


def seed_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department seed: every nation with its region (code, name, region)."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
            .select(F.lpad(_s(F.col("n_nationkey")), 2, "0").alias("code_departement"),
                    F.col("n_name").alias("nom_departement"), F.col("r_name").alias("region")))


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _bronze_sql() -> str:
    vals = {
        "No disposition": "CAST(l_linenumber AS VARCHAR)",
        "Identifiant de document": "CAST(l_orderkey AS VARCHAR)",
        "Reference document": "CAST(l_partkey AS VARCHAR)",
        "Nature mutation": ("CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN 'Donation' "
                            "WHEN l_returnflag = 'N' THEN 'Vente' "
                            "WHEN l_returnflag = 'R' THEN 'Vente en l''état futur d''achèvement' "
                            "WHEN l_linestatus = 'F' THEN 'ADJUDICATION' ELSE 'Échange' END"),
        "Valeur fonciere": ("CASE WHEN l_orderkey % 43 = 0 THEN 'abc' WHEN l_orderkey % 47 = 0 THEN '0' "
                            "WHEN l_orderkey % 53 = 0 THEN NULL "
                            "ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END"),
        "Code postal": ("CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') "
                        "|| lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') END"),
        "Commune": "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE upper(s_name) END",
        "Code departement": ("CASE WHEN l_orderkey % 67 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN '9' || "
                             "lpad(CAST(s_nationkey AS VARCHAR), 2, '0') ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END"),
        "Type local": ("CASE WHEN l_partkey % 11 = 0 THEN 'Terrain à bâtir' WHEN l_partkey % 5 = 0 THEN 'Maison' "
                       "WHEN l_partkey % 5 = 1 THEN 'Appartement' "
                       "WHEN l_partkey % 5 = 2 THEN (CASE WHEN l_partkey % 2 = 0 THEN 'DÉPENDANCE' ELSE 'Dépendance' END) "
                       f"WHEN l_partkey % 5 = 3 THEN {_sql_str(D.TYPE_COMMERCIAL.capitalize())} ELSE NULL END"),
        "Surface reelle bati": ("CASE WHEN l_partkey % 5 IN (2, 4) THEN NULL "
                                "WHEN l_linenumber = 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ',5' "
                                "ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"),
        "Nombre pieces principales": "CAST(CAST(l_quantity AS INTEGER) % 7 AS VARCHAR)",
        "Surface terrain": "CAST(CAST(round(l_tax * 10000) AS INTEGER) AS VARCHAR)",
        "Date mutation": ("CASE WHEN l_orderkey % 29 = 0 THEN NULL "
                          "WHEN l_orderkey % 31 = 0 THEN '31/02/' || CAST(year(l_shipdate) AS VARCHAR) "
                          "WHEN l_orderkey % 7 = 0 THEN strftime(l_shipdate, '%d/%m/%Y') "
                          "ELSE strftime(l_shipdate, '%Y-%m-%d') END"),
    }
    cols = ",\n    ".join(f"CAST({vals.get(c, 'NULL')} AS VARCHAR) AS \"{c}\"" for c in D.BRONZE_COLUMNS)
    return f"SELECT\n    {cols}\nFROM lineitem JOIN supplier ON l_suppkey = s_suppkey"


BRONZE_SQL = _bronze_sql()

SEED_SQL = ("SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code_departement, n_name AS nom_departement, "
            "r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
