"""Projection and filter operators (rename, validity rules)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ColumnOrName, col


def quoted(name: str) -> Column:
    """Column reference for raw names holding spaces, dots or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Project and rename: only the mapped columns survive (column pruning)."""
    return df.select(*[quoted(src).alias(dst) for src, dst in mapping.items()])


def positive_filter(df: DataFrame, c: ColumnOrName) -> DataFrame:
    """Keep rows whose value is present and strictly positive."""
    x = col(c)
    return df.filter(x.isNotNull() & (x > 0))


def category_rule(category: ColumnOrName, rules: Sequence[tuple[Sequence[str], Column]],
                  default: Column) -> Column:
    """Ordered CASE used as a predicate: the first matching category's rule applies.

    A NULL category matches no list and takes ``default``.
    """
    cat = col(category)
    expr = None
    for values, predicate in rules:
        cond = cat.isin(*values)
        expr = F.when(cond, predicate) if expr is None else expr.when(cond, predicate)
    return default if expr is None else expr.otherwise(default)


def validate_by_category(df: DataFrame, category: ColumnOrName,
                         rules: Sequence[tuple[Sequence[str], Column]], default: Column) -> DataFrame:
    """Filter on a per-category rule; a NULL rule result drops the row."""
    return df.filter(category_rule(category, rules, default))


def min_price_min_surface_rules(price: ColumnOrName, surface: ColumnOrName,
                                spec: Sequence[tuple[Sequence[str], float, float | None]]
                                ) -> list[tuple[Sequence[str], Column]]:
    """Rules of the form: price >= p and (surface >= s or surface is NULL)."""
    p, s = col(price), col(surface)
    out = []
    for values, min_price, min_surface in spec:
        pred = p >= F.lit(min_price)
        if min_surface is not None:
            pred = pred & ((s >= F.lit(min_surface)) | s.isNull())
        out.append((values, pred))
    return out
