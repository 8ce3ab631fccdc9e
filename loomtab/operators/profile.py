"""Column profiles, warnings and detections. Each is one pass of partial aggregates over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import agg_columns, columns_of, flag, kind, long_form, name_tokens, number, quantile
from loomtab.operators.quantiles import column_quantiles, quantile_columns

# Words of column names that mark identifiers, targets and leaks.
ID_WORDS = ("id", "uuid", "guid", "key", "index", "identifier")
TARGET_WORDS = ("target", "label", "outcome", "response", "class", "y")
LEAK_WORDS = ("future", "post", "outcome", "result", "leak", "prediction", "predicted")


def severity(rate) -> F.Column:
    return F.when(rate == 0, "complete").when(rate < 0.05, "low").when(rate < 0.2, "moderate").when(rate < 0.5, "high").otherwise("critical")


def missing(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """column, missing, rate (4 places), severity."""
    rows = agg_columns(df, names or df.columns, lambda c: [("missing", F.count(F.when(F.col(c).isNull(), 1))), ("n", F.count("*"))], 12)
    rate = F.coalesce(F.try_divide(F.col("missing"), F.col("n")), F.lit(0.0))
    return rows.select("column", "missing", F.round(rate, 4).alias("rate"), severity(rate).alias("severity"))


def numeric(df: DataFrame, names: list[str] | None = None, approx: bool = False) -> DataFrame:
    """column, n, min, max, mean, std (0 for one value), p25, median, p75, zeros, negatives."""
    names = names or columns_of(df, "numeric")
    df = df.select(*[number(c).alias(c) for c in names])
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n long, min double, max double, mean double, std double, p25 double, median double, p75 double, zeros long, negatives long")
    quartiles = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    rows = agg_columns(
        df,
        names,
        lambda c: [
            ("n", F.count(c)),
            ("min", F.min(c)),
            ("max", F.max(c)),
            ("mean", F.avg(c)),
            ("std", F.when(F.count(c) == 1, 0.0).otherwise(F.stddev(c))),
            *([(name, quantile(c, q, True)) for name, q in quartiles.items()] if approx else []),
            ("zeros", F.count_if(F.col(c) == 0)),
            ("negatives", F.count_if(F.col(c) < 0)),
        ],
    )
    return rows if approx else rows.join(column_quantiles(df, names, quartiles), "column")


def top_values(df: DataFrame, names: list[str], k: int = 5) -> DataFrame:
    """column, value, count, nth: the k most frequent values, ties by value. The first of them is the mode."""
    counts = long_form(df, names).filter("value IS NOT NULL").groupBy("column", "value").count()
    nth = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), "value"))
    return counts.withColumn("nth", nth).filter(F.col("nth") <= k)


def distinct_counts(df: DataFrame, names: list[str], approx: bool = False) -> DataFrame:
    """column, n (not null), distinct. Long form: one shuffle of distinct values, no expansion of the aggregate."""
    rows = long_form(df, names)
    if approx:
        return rows.groupBy("column").agg(F.count("value").alias("n"), F.approx_count_distinct("value", 0.01).alias("distinct"))
    return rows.groupBy("column", "value").count().groupBy("column").agg(F.sum(F.when(F.col("value").isNotNull(), F.col("count")).otherwise(0)).alias("n"), F.count("value").alias("distinct"))


def duplicates(df: DataFrame) -> DataFrame:
    """rows, distinct_rows, duplicates: rows beyond the first of each."""
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows")).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def flags(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """column, kind, distinct, id_like, constant, high_cardinality, target_like, leakage_like."""
    names = names or df.columns
    counts = distinct_counts(df, names).join(df.agg(F.count("*").alias("rows")))
    whole = {f.name for f in df.schema if f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")}
    kinds = {f.name: kind(f.dataType) for f in df.schema}

    def named(words) -> F.Column:
        return F.col("column").isin([c for c in names if set(name_tokens(c)) & set(words)])

    is_kind = {k: F.col("column").isin([c for c in names if kinds[c] == k]) for k in ("numeric", "categorical", "datetime", "boolean")}
    all_different = F.col("column").isin([c for c in names if c in whole]) & (F.col("distinct") == F.col("rows"))
    return counts.select(
        "column",
        F.coalesce(*[F.when(test, k) for k, test in is_kind.items()]).alias("kind"),
        "distinct",
        (named(ID_WORDS) | all_different).alias("id_like"),
        (F.col("distinct") <= 1).alias("constant"),
        (is_kind["categorical"] & (F.col("distinct") > 20) & (F.try_divide("distinct", "rows") > 0.5)).alias("high_cardinality"),
        named(TARGET_WORDS).alias("target_like"),
        named(LEAK_WORDS).alias("leakage_like"),
    )


def exclusions(profile: DataFrame, missing_rates: DataFrame, target: str) -> DataFrame:
    """column, reason: why a column is left out, the first that holds; null if it is used."""
    rows = profile.join(missing_rates.select("column", "severity"), "column").filter(F.col("column") != target)
    reason = (
        F.when(F.col("id_like"), "id-like")
        .when(F.col("leakage_like"), "leakage-like")
        .when(F.col("severity") == "critical", "critically missing")
        .when(F.col("constant"), "constant")
        .when(F.col("high_cardinality"), "high-cardinality")
    )
    return rows.select("column", reason.alias("reason"))


def series_summary(df: DataFrame, name: str) -> DataFrame:
    """count, missing, mean, std, min, median, max of one column."""
    x = df.select(number(name).alias("x"))
    return x.agg(
        F.count("x").alias("count"),
        F.count_if(F.col("x").isNull()).alias("missing"),
        F.avg("x").alias("mean"),
        F.stddev("x").alias("std"),
        F.min("x").alias("min"),
        quantile_columns(x, F.col("x"), [0.5])[0].alias("median"),
        F.max("x").alias("max"),
    )


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """label, count, fraction, majority_rate, imbalanced (majority above 0.8)."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("label")).count()
    whole = Window.partitionBy()  # over labels, not rows
    out = counts.withColumns({"fraction": F.col("count") / F.sum("count").over(whole), "majority_rate": F.max("count").over(whole) / F.sum("count").over(whole)})
    return out.withColumn("imbalanced", F.col("majority_rate") > 0.8)


def datetime_columns(df: DataFrame, names: list[str], sample: int | None = 500, threshold: float = 0.6, row_id: str | None = None) -> DataFrame:
    """column, parse_rate, first, last, is_datetime of text columns. sample: rows (by hash of row_id) that are parsed; None: all."""
    if sample and row_id:
        n = df.count()
        df = df if n <= sample else df.filter(F.pmod(F.xxhash64(row_id), F.lit(1_000_000)) < F.lit(2_000_000 * sample // n))
    rows = long_form(df, names).filter("value IS NOT NULL").withColumn("at", F.try_to_timestamp("value"))
    out = rows.groupBy("column").agg(F.avg(flag(F.col("at").isNotNull())).alias("parse_rate"), F.min("at").cast("string").alias("first"), F.max("at").cast("string").alias("last"))
    return out.withColumn("is_datetime", F.col("parse_rate") >= threshold)


def has_time_of_day(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.bool_or((F.hour(name) > 0) | (F.minute(name) > 0) | (F.second(name) > 0)), F.lit(False)).alias("has_time"))


def text_columns(df: DataFrame, names: list[str], tokens: float = 3.0, values: int = 10) -> DataFrame:
    """column, filled, distinct, mean_tokens, is_text: several words on average, many different values."""
    rows = long_form(df, names).withColumn("value", F.trim("value")).filter("value <> ''")
    per = rows.groupBy("column", "value").agg(F.count("*").alias("n")).withColumn("t", F.size(F.split("value", r"\s+")))
    out = per.groupBy("column").agg(F.sum("n").alias("filled"), F.count("*").alias("distinct"), (F.sum(F.col("t") * F.col("n")) / F.sum("n")).alias("mean_tokens"))
    return out.withColumn("is_text", (F.col("mean_tokens") >= tokens) & (F.col("filled") >= values) & (F.col("distinct") >= values))


def table_warnings(df: DataFrame) -> DataFrame:
    """type, column, message: no rows, one column only, columns that an export left without a name, names that occur twice
    (Spark takes no notice of case). Names are read from the schema; rows are looked at until one is found."""
    import re

    rows = []
    if df.isEmpty():
        rows.append(("zero_rows", None, "no rows"))
    if len(df.columns) == 1:
        rows.append(("single_column", None, "one column only: is the separator right?"))
    seen: set[str] = set()
    for c in df.columns:
        if not c.strip() or re.fullmatch(r"Unnamed: \d+|_c\d+", c):
            rows.append(("unnamed_column", c, "a column without a name: an exported index?"))
        if c.lower() in seen:
            rows.append(("duplicate_column", c, "a name that occurs twice"))
        seen.add(c.lower())
    return df.sparkSession.createDataFrame(rows, "type string, column string, message string")
