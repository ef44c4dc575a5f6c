"""Reference (seed) tables: small CSV files kept as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

SEED_COLUMNS = ("code_departement", "nom_departement", "region")


def read_seed(spark: SparkSession, path: str, columns: Sequence[str] = SEED_COLUMNS, sep: str = ",") -> DataFrame:
    """CSV with a header, every column read as text (codes such as '01' or '2A' stay as is)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))
