"""Column-level helpers.  All return JVM-side Column expressions (codegen-able)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the public surrogate-key convention for equal keys.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# Word delimiters of the warehouse INITCAP (whitespace plus these characters).
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
# ---------------------------------------------------------------------------


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: ColumnOrName, tokens: Iterable[str] = ("", "NULL", "null")) -> Column:
    """Trim a text field and map the null tokens to NULL."""
    t = F.trim(col(c))
    return F.when(~t.isin(*tokens), t)


def parse_decimal(c: ColumnOrName, scale: int = 0, precision: int = 38) -> Column:
    """Decimal comma to dot, then a tolerant cast; unparsable text gives NULL.

    With ``scale=0`` the value is rounded half away from zero to a whole number.
    """
    return F.replace(col(c), F.lit(","), F.lit(".")).try_cast(DecimalType(precision, scale))


def parse_int(c: ColumnOrName) -> Column:
    """Decimal-comma text to INT (rounded), NULL when invalid or out of range."""
    return parse_decimal(c, 0).try_cast(IntegerType())


def parse_date(c: ColumnOrName, formats: Sequence[str] = ("yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """First format that parses wins; impossible dates give NULL.

    A format is tried only where the text has its separators: a failed parse costs an exception.
    """
    def tried(f: str) -> Column:
        parsed = F.try_to_date(col(c), f)
        for mark in sorted(set(f) & set("-/.")):
            parsed = F.when(F.contains(col(c).cast("string"), F.lit(mark)), parsed)
        return parsed
    return F.coalesce(*[tried(f) for f in formats])


def initcap_words(c: ColumnOrName, delimiters: str = INITCAP_DELIMITERS) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Words are broken on whitespace and on the delimiter characters, not only on
    spaces as Spark's ``initcap`` does.
    """
    cls = "\\s" + "".join("\\" + ch for ch in delimiters)
    pattern = f"([^{cls}]+|[{cls}]+)"
    tokens = F.regexp_extract_all(F.lower(col(c)), F.lit(pattern), 1)
    return F.array_join(F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)),
                                                                F.substring(t, 2, 1 << 30))), "")


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` in double precision."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct_change(cur: ColumnOrName, prev: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND((cur - prev) / NULLIF(prev, 0) * 100, digits)``."""
    c, p = col(cur).cast("double"), col(prev).cast("double")
    return F.round(F.try_divide(c - p, p) * F.lit(100.0), digits)


def content_hash(cols: Sequence[ColumnOrName], sep: str = "", tail: Sequence[ColumnOrName] = ()) -> Column:
    """MD5 over the text form of ``cols`` (NULL as empty), then ``tail`` as is."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]
    parts += [col(c).cast("string") for c in tail]
    if sep:
        return F.md5(F.concat_ws(sep, *parts))
    return F.md5(F.concat(*parts))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """MD5 key over the text form of ``cols``; NULL parts get a placeholder."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def date_key(c: ColumnOrName) -> Column:
    """Integer ``YYYYMMDD`` of a date (NULL stays NULL)."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(c: ColumnOrName) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(col(c), "month")


def first_match(value: Column, mapping: Sequence[tuple[Sequence[str], str]], otherwise: Column,
                how: str = "isin") -> Column:
    """Ordered CASE: first entry whose values match wins; NULL falls through."""
    expr = None
    for values, label in mapping:
        if how == "isin":
            cond = value.isin(*values)
        else:  # substring search, any of values
            cond = None
            for v in values:
                cond = value.contains(v) if cond is None else (cond | value.contains(v))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return otherwise if expr is None else expr.otherwise(otherwise)
