"""Declarative data-quality checks -> one result row per check.

All ``not_null`` checks of one table (and scope) are answered by a single
aggregation pass, and so are all its ``relationships`` (an anti join of its distinct
keys); ``unique`` is a grouped count of duplicated values.  Results are a DataFrame (nothing is
collected), with ``failures`` and a status derived from the severity.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import count_if, rows

PASS, WARN, FAIL, ERROR = "pass", "warn", "fail", "error"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str                   # 'not_null' | 'unique' | 'relationships'
    severity: str = "error"     # 'error' | 'warn'
    where: str | None = None    # SQL predicate scoping the rows tested
    to_table: str | None = None  # relationships: parent table
    to_column: str | None = None


RESULT_COLUMNS = ["table_name", "column_name", "test", "severity", "failures", "status"]


def _row(check: Check, failures) -> list:
    return [F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
            F.lit(check.test).alias("test"), F.lit(check.severity).alias("severity"),
            failures.cast("bigint").alias("failures")]


def _scoped(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


def _not_null_part(tables: dict[str, DataFrame], table: str, where: str | None, group: list[Check]) -> DataFrame:
    df = _scoped(tables[table], where)
    agg = df.agg(*[count_if(F.col(c.column).isNull()).alias(f"__f{i}") for i, c in enumerate(group)])
    unpivot = F.explode(F.array(*[F.struct(*_row(c, F.col(f"__f{i}"))) for i, c in enumerate(group)]))
    return agg.select(unpivot.alias("r")).select("r.*")


def _single_part(tables: dict[str, DataFrame], c: Check) -> DataFrame:
    if c.test == "unique":
        df = _scoped(tables[c.table], c.where)
        dup = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(rows().alias("__n"))
               .filter(F.col("__n") > 1))
        return dup.agg(rows().alias("__f")).select(*_row(c, F.col("__f")))
    raise ValueError(f"unknown test {c.test!r}")


def _relationship_part(tables: dict[str, DataFrame], table: str, where: str | None, group: list[Check]) -> DataFrame:
    """All relationship checks of one table (and scope) in one pass over it.

    The rows are first reduced to (check, key) with their number, combined before the
    shuffle, so a key that many rows share is one row in the anti join.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("k")) for i, c in enumerate(group)]))
    child = _scoped(tables[table], where).select(keys.alias("x")).select("x.i", "x.k").filter(F.col("k").isNotNull())
    child = child.groupBy("i", "k").agg(rows().alias("n"))
    parents = union_all([tables[c.to_table].select(F.lit(i).alias("i"), F.col(c.to_column).cast("string").alias("k")).distinct()
                         for i, c in enumerate(group)])
    orphans = child.join(parents, ["i", "k"], "left_anti")
    failures = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(f"__f{i}") for i in range(len(group))])
    unpivot = F.explode(F.array(*[F.struct(*_row(c, F.col(f"__f{i}"))) for i, c in enumerate(group)]))
    return failures.select(unpivot.alias("r")).select("r.*")


def _error_rows(spark, checks: list[Check]) -> DataFrame:
    """Checks that could not be planned (missing table or column): status ``error``."""
    data = [(c.table, c.column, c.test, c.severity, None) for c in checks]
    return spark.createDataFrame(data, "table_name string, column_name string, test string, severity string, "
                                       "failures bigint")


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Evaluate ``checks`` against ``tables``; one row per check.

    A check that cannot be planned (unknown table or column) is reported with
    status ``error`` and NULL failures instead of failing the whole report.
    """
    from pyspark.errors import AnalysisException
    parts: list[DataFrame] = []
    broken: list[Check] = []
    grouped = {"not_null": _not_null_part, "relationships": _relationship_part}
    groups: OrderedDict[tuple[str, str, str | None], list[Check]] = OrderedDict()
    for c in checks:
        if c.test in grouped:
            groups.setdefault((c.test, c.table, c.where), []).append(c)
    for (test, table, where), group in groups.items():
        try:
            parts.append(grouped[test](tables, table, where, group))
        except (AnalysisException, KeyError):
            # Plan the group's checks one by one so only the broken ones are errors.
            for c in group:
                try:
                    parts.append(grouped[test](tables, table, where, [c]))
                except (AnalysisException, KeyError):
                    broken.append(c)
    for c in checks:
        if c.test in grouped:
            continue
        try:
            parts.append(_single_part(tables, c))
        except (AnalysisException, KeyError):
            broken.append(c)
    if broken:
        spark = next(iter(tables.values())).sparkSession
        parts.append(_error_rows(spark, broken))
    out = union_all(parts)
    status = (F.when(F.col("failures").isNull(), F.lit(ERROR)).when(F.col("failures") == 0, F.lit(PASS))
              .when(F.col("severity") == "warn", F.lit(WARN)).otherwise(F.lit(FAIL)))
    return out.withColumn("status", status)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by name as a balanced tree (analysis cost n log n, not n^2)."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def summarize(report: DataFrame) -> DataFrame:
    """One row: pass / warn / fail counts and the total (other statuses count in total only)."""
    s = F.col("status")
    return report.agg(count_if(s == PASS).alias("pass_count"), count_if(s == WARN).alias("warn_count"),
                      count_if(s == FAIL).alias("fail_count"), rows().alias("total_count"))


def raise_on_failure(report: DataFrame) -> None:
    """Fail the run when a check of severity error has failed or could not be run; all of them are named."""
    failed = report.filter((F.col("status") == FAIL) | ((F.col("status") == ERROR) & (F.col("severity") == "error"))).select(
        "table_name", "column_name", "test").collect()  # at most one row per declared check
    if failed:
        raise AssertionError("data-quality checks failed: " + ", ".join(
            f"{r.table_name}.{r.column_name} {r.test}" for r in failed))
