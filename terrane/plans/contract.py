"""Type alignment at the driver boundary.

Inside the library money and surfaces are DECIMAL(38,0) (the source's NUMBER)
and dates are DATE.  Engines hand these to pandas differently (Python
``Decimal`` / ``date`` objects vs float64 / datetime64), so registered queries
and their oracle SQL both expose decimals as DOUBLE (exact for these
magnitudes), dates as ISO ``YYYY-MM-DD`` text and DuckDB's HUGEINT sums as
BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

# Schemas of the benchmark tables (TESTDATA.md), used only to type-check SQL.
TABLE_SCHEMAS = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP, o_orderpriority VARCHAR"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, "
                 "l_linestatus VARCHAR, l_shipdate TIMESTAMP"),
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "pages": "page_id BIGINT, url VARCHAR, html VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding FLOAT[], label INTEGER",
    "benchmark": "item_id BIGINT, text VARCHAR",
    "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
}


def spark_side(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        cols = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, DecimalType):
                c = c.cast("double").alias(f.name)
            elif isinstance(f.dataType, DateType):
                c = c.cast("string").alias(f.name)
            cols.append(c)
        return df.select(*cols)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def sql_side(statements: dict[str, str]) -> dict[str, str]:
    """Wrap each statement so DECIMAL columns come out as DOUBLE and HUGEINT as BIGINT."""
    try:
        import duckdb
    except ImportError:  # pragma: no cover
        return dict(statements)
    con = duckdb.connect()
    for name, cols in TABLE_SCHEMAS.items():
        con.execute(f"CREATE TABLE {name} ({cols})")
    out = {}
    for key, sql in statements.items():
        try:
            described = con.execute(f"DESCRIBE {sql}").fetchall()
        except Exception:  # noqa: BLE001 - keep the statement as written
            out[key] = sql
            continue
        parts, changed = [], False
        for row in described:
            col, typ = row[0], row[1]
            q = '"' + col.replace('"', '""') + '"'
            if typ.startswith("DECIMAL"):
                parts.append(f"CAST({q} AS DOUBLE) AS {q}")
                changed = True
            elif typ == "DATE":
                parts.append(f"CAST({q} AS VARCHAR) AS {q}")
                changed = True
            elif typ == "HUGEINT":
                parts.append(f"CAST({q} AS BIGINT) AS {q}")
                changed = True
            else:
                parts.append(q)
        out[key] = f"SELECT {', '.join(parts)} FROM (\n{sql}\n) AS oracle" if changed else sql
    con.close()
    return out
