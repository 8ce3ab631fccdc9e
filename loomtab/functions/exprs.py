"""Column expressions that several operators share. All are built-in functions, inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number(name: str) -> Column:
    """The column as a double; what is no number, and NaN, is null."""
    x = F.col(name).try_cast("double")
    return F.when(~F.isnan(x), x)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def hashed(key: Column | str, seed: str) -> Column:
    """32 bits of md5 of key and seed: the same in any engine, partitioning and run."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(seed)).cast("binary")), 1, 8), 16, 10).cast("long")


def adjusted_skew(c: Column | str) -> Column:
    """Bias-adjusted skewness; null below three values."""
    n = F.count(c)
    return F.when(n > 2, F.sqrt(n * (n - 1.0)) / (n - 2.0) * F.skewness(c))


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson's correlation over rows that have both; null where a side does not vary (the built-in one fails there)."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x).cast("double"), F.when(both, y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def median(c: Column | str, approx: bool = False) -> Column:
    return quantile(c, 0.5, approx)


def quantile(c: Column | str, q: float, approx: bool = False) -> Column:
    """Exact by default: it keeps one entry for each distinct value of a group. approx bounds the memory."""
    c = F.col(c) if isinstance(c, str) else c
    return F.percentile_approx(c, q, 10_000).cast("double") if approx else F.percentile(c, q)


def name_tokens(name: str) -> list[str]:
    """Lower-case words of a column name, cut at anything but letters and digits and at humps."""
    import re

    return [t.lower() for t in re.split(r"[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])", name) if t]


def kind(data_type: T.DataType) -> str:
    """numeric, boolean, datetime or categorical."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "datetime"
    return "categorical"


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    return [f.name for f in df.schema if kind(f.dataType) in kinds]


def long_form(df: DataFrame, names: list[str], keep: list[str] = (), value: str = "value", cast: str = "string") -> DataFrame:
    """(keep..., column, value): one row for each row and column, values cast alike."""
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias(value)) for c in names])).alias("x")
    return df.select(*keep, parts).select(*keep, "x.*")


def agg_columns(df: DataFrame, names: list[str], measures, chunk: int = 6) -> DataFrame:
    """One row for each column: measures(c) gives (name, aggregate) pairs. Columns go in chunks, as very wide aggregates compile badly."""
    out = None
    for a in range(0, len(names), chunk):
        part = names[a : a + chunk]
        row = df.agg(*[F.struct(F.lit(c).alias("column"), *[e.alias(n) for n, e in measures(c)]).alias(f"m{i}") for i, c in enumerate(part)])
        row = row.select(F.explode(F.array(*[f"m{i}" for i in range(len(part))])).alias("x")).select("x.*")
        out = row if out is None else out.unionByName(row)
    return out
