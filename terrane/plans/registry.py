"""All registered queries and their oracle SQL in one place."""

from __future__ import annotations

from . import contract, ops_queries, oracle, source_queries, step_queries
from .queries import QUERIES as _DATASET_QUERIES

QUERIES = {}
QUERIES.update(step_queries.QUERIES)
QUERIES.update(_DATASET_QUERIES)
QUERIES.update(ops_queries.QUERIES)
QUERIES.update(source_queries.QUERIES)

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(step_queries.SQL)
ORACLE_SQL["silver_build"] = oracle.with_ctes("SELECT * FROM silver")
ORACLE_SQL.update(oracle.GOLD)
ORACLE_SQL.update(oracle.STAR)
ORACLE_SQL.update(ops_queries.SQL)
ORACLE_SQL.update(source_queries.SQL)

# Driver boundary: decimals as DOUBLE on both sides (see ``contract``).
QUERIES = {k: contract.spark_side(v) for k, v in QUERIES.items()}
_ORACLE_RAW = ORACLE_SQL


def oracle_statements() -> dict[str, str]:
    return contract.sql_side(_ORACLE_RAW)
