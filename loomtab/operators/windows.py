"""Order-based operators that never put all rows into one window.

A global order is cut in two: rows are counted by ranges of the order's leading column, prefix sums run over those counts, and
row numbers run inside each range.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtab.operators.quantiles import quantile_columns


def sort_key(df: DataFrame, name: str) -> Column:
    """A double that never falls where the column rises (null where it is null, or where its type has no such number)."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):  # the first six bytes
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):  # no time zone's clock changes come between
        return (F.unix_date(c.cast("date")) * 86_400.0 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double") if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit(None).cast("double")


def numbered(df: DataFrame, order: list[str], name: str = "n", ranges: int = 512) -> DataFrame:
    """Rows with their 0-based place in the order, nulls last. order[0] leads; the rest break its ties.

    Rows fall into ranges of the leading column, between bounds from an approximate quantile sketch (a few hundred numbers on
    the driver); ranges are counted, and row numbers run inside each. Only ties of the leading column can fill a range.
    """
    lead = order[0]
    key = F.coalesce(F.nanvl(sort_key(df, lead), F.lit(float("inf"))), F.lit(float("inf")))
    found = df.agg(F.percentile_approx(sort_key(df, lead), [i / ranges for i in range(1, ranges)], 20 * ranges).alias("b")).first().b
    rows = df.withColumn("__k", key)
    bounds = sorted({x for x in found or [] if math.isfinite(x)})
    if bounds:
        rows = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__k", outputCol="__r", handleInvalid="keep").transform(rows)
    else:
        rows = rows.withColumn("__r", F.lit(0.0))
    rows = rows.withColumn("__r", F.when(F.col(lead).isNull(), len(bounds) + 2).otherwise(F.col("__r").cast("int")))
    counts = rows.groupBy("__r").agg(F.count("*").alias("__c"))
    before = counts.select("__r", (F.sum("__c").over(Window.orderBy("__r")) - F.col("__c")).alias("__b"))  # over ranges
    inside = F.row_number().over(Window.partitionBy("__r").orderBy(*[F.col(c).asc_nulls_last() for c in order])) - 1
    out = rows.withColumn("__i", inside).join(F.broadcast(before), "__r")
    return out.withColumn(name, (F.col("__b") + F.col("__i")).cast("long")).select(*[c for c in df.columns if c != name], name)


def time_tail(df: DataFrame, time: str, row_id: str, share: float = 0.2) -> DataFrame:
    """Rows with held_out: the last share of rows by time, ties by row id; missing times count as earliest."""
    total = df.agg(F.count("*").alias("__n"))
    ranked = numbered(df.withColumn("__t", F.coalesce(F.col(time).cast("timestamp"), F.lit("0001-01-01").cast("timestamp"))), ["__t", row_id], "__k")
    return ranked.join(total).withColumn("held_out", F.col("__k") >= F.col("__n") - F.ceil(F.col("__n") * share)).drop("__k", "__n", "__t")


def ordinals(train: DataFrame, predict: DataFrame, name: str) -> DataFrame:
    """value, ordinal: 0-based place in the sorted union of both sides' values."""
    values = train.select(F.col(name).alias("value")).union(predict.select(F.col(name).alias("value"))).filter("value IS NOT NULL").distinct()
    return values.select("value", (F.row_number().over(Window.orderBy("value")) - 1).alias("ordinal"))  # over distinct values


def latest_periods(df: DataFrame, period: str, share: float = 0.2, least: int = 5) -> DataFrame:
    """The latest share (rounded up) of distinct periods; none if there are fewer than `least`."""
    periods = df.filter(F.col(period).isNotNull()).select(period).distinct()
    ranked = periods.withColumns({"__k": F.row_number().over(Window.orderBy(F.desc(period))), "__n": F.count("*").over(Window.partitionBy())})
    return ranked.filter((F.col("__n") >= least) & (F.col("__k") <= F.ceil(F.col("__n") * share))).select(period)


def quartile_buckets(df: DataFrame, name: str, out: str = "bucket", edges: list[float | None] | None = None) -> DataFrame:
    """Rows with their quartile (1 to 4) by exact edges, right-closed; equal edges merge, so ties stay together. edges: the three
    quartiles, where they are known."""
    x = F.col(name)
    e = quantile_columns(df, x, [0.25, 0.5, 0.75]) if edges is None else [F.lit(v).cast("double") for v in edges]
    bucket = F.when(x <= e[0], 1).when(x <= e[1], 2).when(x <= e[2], 3).when(x.isNotNull(), 4)
    return df.withColumn(out, bucket)


def earlier_splits(df: DataFrame, time: str, row_id: str, cuts: tuple[float, ...] = (0.8, 0.6)) -> DataFrame:
    """Rows with one flag for each cut: is the row in the training part of that earlier split?"""
    total = df.agg(F.count("*").alias("__n"))
    out = numbered(df, [time, row_id], "__k").join(total)
    for c in cuts:
        out = out.withColumn(f"before_{int(c * 100)}", F.col("__k") < F.floor(F.col("__n") * c))
    return out.drop("__k", "__n")
