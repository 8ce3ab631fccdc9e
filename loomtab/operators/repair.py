"""Predictions made fit to hand in: finite, within bounds, consistent with a hierarchy, in the asked order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import number
from loomtab.operators.quantiles import quantile_columns


def sanitize(df: DataFrame, pred: str, train: DataFrame, target: str) -> DataFrame:
    """Non-finite predictions become the train mean."""
    mean = train.agg(F.avg(number(target)).alias("__m"))
    x = number(pred)
    return df.join(mean).withColumn(pred, F.when(x.isNotNull() & (F.abs(x) < float("inf")), x).otherwise(F.col("__m"))).drop("__m")


def clip_bounds(train: DataFrame, target: str) -> DataFrame:
    """low, high: 0 and max(1.5 max, 2 q99) for a target that is never negative; else none."""
    y = number(target)
    one = train.agg(F.min(y).alias("lo"), F.max(y).alias("hi"), quantile_columns(train, y, [0.99])[0].alias("q"))
    return one.select(F.when(F.col("lo") >= 0, 0.0).alias("low"), F.when(F.col("lo") >= 0, F.greatest(1.5 * F.col("hi"), 2 * F.col("q"))).alias("high"))


def clip(df: DataFrame, pred: str, bounds: DataFrame) -> DataFrame:
    out = df.join(bounds.select(F.col("low").alias("__lo"), F.col("high").alias("__hi")))
    return out.withColumn(pred, F.least(F.greatest(F.col(pred), F.col("__lo")), F.coalesce("__hi", F.lit(float("inf"))))).drop("__lo", "__hi")


def clip_share(df: DataFrame, pred: str, bounds: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """share of predictions that sit on a bound."""
    out = df.join(bounds)
    hit = (F.abs(F.col(pred) - F.col("low")) <= tolerance) | (F.abs(F.col(pred) - F.col("high")) <= tolerance)
    return out.agg(F.avg(F.coalesce(hit, F.lit(False)).cast("double")).alias("share"))


def repair_hierarchy(df: DataFrame, keys: list[str], category: str, pred: str) -> DataFrame:
    """df with adjusted: the parent category, the one of largest mean prediction, is raised to its group's largest child."""
    parent = df.groupBy(category).agg(F.avg(pred).alias("m")).agg(F.max_by(category, F.struct("m", category)).alias("__parent"))
    children = df.join(parent).filter(F.col(category) != F.col("__parent")).groupBy(*keys).agg(F.max(pred).alias("__child"))
    out = df.join(parent).alias("l")
    from loomtab.operators.relate import same

    out = out.join(children.alias("r"), same("l", "r", keys), "left").select("l.*", "__child")
    raised = (F.col(category) == F.col("__parent")) & (F.col("__child") > F.col(pred))
    return out.withColumn("adjusted", F.coalesce(raised, F.lit(False))).withColumn(pred, F.when(F.col("adjusted"), F.col("__child")).otherwise(F.col(pred))).drop("__parent", "__child")


def hand_in(sample: DataFrame, predictions: DataFrame, row_id: str, order: str, target: str, whole: bool = False) -> DataFrame:
    """row_id, target in the sample's order; labels as whole numbers."""
    value = F.round(target).cast("long") if whole else F.col(target)
    return sample.select(row_id, order).join(predictions.select(row_id, value.alias(target)), row_id, "left").orderBy(order).select(row_id, target)


def refit_average(frames: list[DataFrame], row_id: str, pred: str) -> DataFrame:
    """Mean of several fits' predictions: one union and one shuffle, not a chain of joins."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [f.select(row_id, pred) for f in frames]).groupBy(row_id).agg(F.avg(pred).alias(pred))


def first_of_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every group by a total order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")
