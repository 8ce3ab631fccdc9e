"""Patterns of the target: distribution, groups, correlations, drift, time coverage, series and autocorrelation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import adjusted_skew, agg_columns, correlation, long_form, number
from loomtab.operators.quantiles import quantile_columns

QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
DATE_PARTS = {"dayofmonth": F.dayofmonth, "hour": F.hour, "weekday": F.weekday, "month": F.month, "week": F.weekofyear}


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """n, mean, std, quantiles, skew (adjusted), kurtosis (excess, population), shares of zeros, and the shape in words."""
    y = df.select(number(target).alias("y"))
    qs = quantile_columns(y, F.col("y"), QUANTILES)
    row = y.agg(
        F.count("y").alias("n"),
        F.avg("y").alias("mean"),
        F.stddev("y").alias("std"),
        *[q.alias(f"q{round(100 * share):02d}") for q, share in zip(qs, QUANTILES, strict=True)],
        adjusted_skew("y").alias("skew"),
        F.kurtosis("y").alias("kurtosis"),
        F.avg((F.col("y") == 0).cast("double")).alias("zero_share"),
        F.avg((F.abs("y") < 1e-6).cast("double")).alias("near_zero_share"),
        (F.min("y") >= 0).alias("non_negative"),
    )
    shape = F.when(F.abs("skew") < 0.5, "symmetric").when(F.col("skew") > 1.5, "strongly right-skewed").when(F.col("skew") > 0, "right-skewed").when(F.col("skew") < -1.5, "strongly left-skewed").otherwise("left-skewed")
    return row.select("n", "mean", "std", *[f"q{round(100 * share):02d}" for share in QUANTILES], "skew", "kurtosis", "zero_share", "near_zero_share", "non_negative", (F.col("skew") > 1.5).alias("right_skewed"), shape.alias("shape"))


def group_levels(df: DataFrame, target: str, names: list[str], least: int = 2, most: int = 48) -> DataFrame:
    """column, level, n, mean, std of the target, for columns whose number of levels is in bounds."""
    rows = long_form(df.withColumn("__y", number(target)), names, ["__y"], "level").filter("level IS NOT NULL AND __y IS NOT NULL")
    levels = rows.groupBy("column", "level").agg(F.count("*").alias("n"), F.avg("__y").alias("mean"), F.stddev("__y").alias("std"))
    k = levels.groupBy("column").agg(F.count("*").alias("__k")).filter(F.col("__k").between(least, most)).select("column")
    return levels.join(F.broadcast(k), "column")  # column names: as many as asked for


def target_by_group(df: DataFrame, target: str, names: list[str], least: int = 2, most: int = 48) -> DataFrame:
    """column, levels, range and std of the levels' means, is_predictive: range above half the target's std."""
    spread = df.agg(F.stddev(number(target)).alias("__s"))
    out = group_levels(df, target, names, least, most).groupBy("column").agg(F.count("*").alias("levels"), (F.max("mean") - F.min("mean")).alias("mean_range"), F.stddev("mean").alias("mean_std"))
    return out.join(spread).withColumn("is_predictive", F.col("mean_range") > 0.5 * F.col("__s")).drop("__s")


def top_groups(df: DataFrame, target: str, names: list[str], k: int = 5, **bounds) -> DataFrame:
    """column, level, n, mean, nth: the k levels of highest mean, ties by level."""
    nth = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("mean"), "level"))
    return group_levels(df, target, names, **bounds).withColumn("nth", nth).filter(F.col("nth") <= k).drop("std")


def correlations(df: DataFrame, target: str, names: list[str], least: int = 10) -> DataFrame:
    """column, n, r: Pearson correlation on complete pairs; only where n and both spreads allow it."""
    df = df.select(number(target).alias("__y"), *[number(c).alias(c) for c in names])

    def measures(c):
        both = F.col(c).isNotNull() & F.col("__y").isNotNull()
        return [("n", F.count_if(both)), ("s", F.stddev(F.when(both, F.col(c)))), ("t", F.stddev(F.when(both, F.col("__y")))), ("r", correlation(c, "__y"))]

    return agg_columns(df, names, measures).filter((F.col("n") >= least) & (F.col("s") > 0) & (F.col("t") > 0)).select("column", "n", "r")


def ranked_correlations(df: DataFrame, target: str, names: list[str], top: int = 10, bottom: int = 5) -> DataFrame:
    """column, r, sign, nth: strongest positive and negative correlations."""
    rows = correlations(df, target, names).withColumn("sign", F.when(F.col("r") >= 0, "positive").otherwise("negative"))
    nth = F.row_number().over(Window.partitionBy("sign").orderBy(F.desc(F.abs("r")), "column"))
    return rows.withColumn("nth", nth).filter(((F.col("sign") == "positive") & (F.col("nth") <= top)) | ((F.col("sign") == "negative") & (F.col("nth") <= bottom))).select("column", "r", "sign", "nth")


def distribution_shift(train: DataFrame, predict: DataFrame, names: list[str], top: int = 10) -> DataFrame:
    """column, z, level: mean difference in train standard deviations, above 1; low, medium above 2, high above 3."""

    def side(df):
        return agg_columns(df.select(*[number(c).alias(c) for c in names]), names, lambda c: [("mean", F.avg(c)), ("std", F.stddev(c))])

    both = side(train).alias("t").join(side(predict).alias("p"), "column")
    z = both.select("column", F.try_divide(F.abs(F.col("t.mean") - F.col("p.mean")), F.when(F.col("t.std") > 0, F.col("t.std"))).alias("z")).filter("z > 1")
    return z.withColumn("level", F.when(F.col("z") > 3, "high").when(F.col("z") > 2, "medium").otherwise("low")).orderBy(F.desc("z"), "column").limit(top)


def high_cardinality(df: DataFrame, names: list[str], ratio: float = 0.5) -> DataFrame:
    from loomtab.operators.profile import distinct_counts

    counts = distinct_counts(df, names).join(df.agg(F.count("*").alias("rows")))
    return counts.select("column", "distinct", (F.col("distinct") / F.col("rows")).alias("ratio"), (F.col("distinct") / F.col("rows") > ratio).alias("id_risk"))


def target_components(df: DataFrame, target: str, names: list[str]) -> DataFrame:
    """column, r, tier, mean_share, additive: train-only columns that may be parts of the target."""
    df = df.select(number(target).alias("__y"), *[number(c).alias(c) for c in names])
    rows = agg_columns(df, names, lambda c: [("r", correlation(c, "__y")), ("mean_share", F.avg(F.try_divide(F.col(c), F.when(F.col("__y") != 0, F.col("__y")))))])
    size = F.abs("r")
    tier = F.when(size >= 0.8, "strong").when(size >= 0.5, "medium").when(size >= 0.3, "weak").otherwise("none")
    return rows.select("column", "r", tier.alias("tier"), "mean_share", ((F.col("mean_share") > 0) & (F.col("mean_share") < 1.01)).alias("additive"))


def interaction_scan(df: DataFrame, target: str, times: list[str], levels: list[str], top: int = 3, rows: int = 4, points: int = 2) -> DataFrame:
    """time, column, strength (largest less smallest range over levels), spread (of level means): the top pairs."""
    y = df.withColumn("__y", number(target)).filter("__y IS NOT NULL")
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("time"), F.lit(c).alias("column"), F.col(t).cast("string").alias("at"), F.col(c).cast("string").alias("level")) for t in times for c in levels])).alias("x")
    cells = y.select("__y", pairs).groupBy("x.time", "x.column", "x.level", "x.at").agg(F.count("*").alias("n"), F.avg("__y").alias("m"))
    per = cells.filter("level IS NOT NULL AND at IS NOT NULL").groupBy("time", "column", "level").agg(F.sum("n").alias("n"), F.count("*").alias("k"), (F.max("m") - F.min("m")).alias("range"), F.avg("m").alias("mean"))
    per = per.filter((F.col("n") >= rows) & (F.col("k") >= points))
    out = per.groupBy("time", "column").agg(F.count("*").alias("levels"), (F.max("range") - F.min("range")).alias("strength"), (F.max("mean") - F.min("mean")).alias("spread"))
    return out.filter("levels >= 2").orderBy(F.desc("strength"), "time", "column").limit(top)


def time_coverage(train: DataFrame, predict: DataFrame, time: str) -> DataFrame:
    """Bounds and distinct times of both sides, times in both, is predict strictly later, steps to forecast."""
    t = train.select(F.col(time).alias("t"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    p = predict.select(F.col(time).alias("t"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    per = t.unionByName(p).filter("t IS NOT NULL").groupBy("t").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    one = per.agg(
        F.min(F.when(F.col("a") == 1, F.col("t"))).alias("train_first"),
        F.max(F.when(F.col("a") == 1, F.col("t"))).alias("train_last"),
        F.sum("a").alias("train_steps"),
        F.min(F.when(F.col("b") == 1, F.col("t"))).alias("predict_first"),
        F.max(F.when(F.col("b") == 1, F.col("t"))).alias("predict_last"),
        F.sum("b").alias("predict_steps"),
        F.sum(F.col("a") * F.col("b")).alias("shared_steps"),
    )
    later = F.col("predict_first") > F.col("train_last")
    return one.withColumns({"predict_later": later, "horizon": F.when(later, F.col("predict_steps")).otherwise(0)})


def within_period(train: DataFrame, predict: DataFrame, time: str) -> DataFrame:
    """part, bounds of both sides, splits: do the sides use separate values of a date part, train the lower ones?"""
    parts = F.explode(F.array(*[F.struct(F.lit(n).alias("part"), f(time).alias("v")) for n, f in DATE_PARTS.items()])).alias("x")
    t = train.select(parts).select("x.*").filter("v IS NOT NULL").groupBy("part", "v").agg(F.lit(1).alias("a"))
    p = predict.select(parts).select("x.*").filter("v IS NOT NULL").groupBy("part", "v").agg(F.lit(1).alias("b"))
    out = t.join(p, ["part", "v"], "full").groupBy("part").agg(
        F.max(F.when(F.col("a") == 1, F.col("v"))).alias("train_max"),
        F.min(F.when(F.col("b") == 1, F.col("v"))).alias("predict_min"),
        F.count("a").alias("train_values"),
        F.count("b").alias("predict_values"),
    )
    return out.withColumn("splits", F.coalesce((F.col("train_max") < F.col("predict_min")) & (F.col("train_values") >= 2) & (F.col("predict_values") >= 2), F.lit(False)))


def series_shape(df: DataFrame, keys: list[str], period: str) -> DataFrame:
    """periods, rows_per_period, groups, and the shortest, median and longest series."""
    cells = df.groupBy(*keys, period).agg(F.count("*").alias("n"))
    lens = cells.groupBy(*keys).agg(F.count(period).alias("len"))
    whole = cells.groupBy(period).agg(F.sum("n").alias("n")).agg(F.count(period).alias("periods"), F.avg("n").alias("rows_per_period"))
    # A line for each length that occurs; its median is one of the whole column only in name.
    by_length = lens.groupBy("len").agg(F.count("*").alias("n"))
    return whole.join(by_length.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("groups"), F.min("len").alias("shortest"), F.percentile("len", 0.5, F.col("n")).alias("median"), F.max("len").alias("longest")))


def autocorrelation(df: DataFrame, keys: list[str], rank: str, target: str, lags: tuple[int, ...] = (1, 3, 6, 12)) -> DataFrame:
    """lag, groups, mean: correlation of each series with itself, averaged over series.

    rank is the period's number, so a self-join on rank - lag equals filling the gaps of a series, without making them.
    One row for each series and period is expected; of several the one of smallest target counts.
    """
    rows = df.groupBy(*keys, F.col(rank).alias("k")).agg(F.min(number(target)).alias("y")).filter("y IS NOT NULL AND k IS NOT NULL")
    per = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.stddev("y").alias("s"), (F.max("k") - F.min("k") + 1).alias("span")).filter("n >= 4 AND s > 0")
    shifted = rows.select(*keys, F.explode(F.array(*map(F.lit, lags))).alias("lag"), "k", F.col("y").alias("x")).withColumn("k", F.col("k") + F.col("lag"))
    pairs = shifted.join(rows, [*keys, "k"]).groupBy(*keys, "lag").agg(correlation("x", "y").alias("r"))
    good = pairs.join(per, keys).filter("span > lag + 2").filter(F.col("r").isNotNull() & ~F.isnan("r"))
    return good.groupBy("lag").agg(F.count("*").alias("groups"), F.avg("r").alias("mean")).withColumn("strong", F.col("mean") >= 0.2)


def lag_advice(coverage: DataFrame, lags: DataFrame, shape: DataFrame) -> DataFrame:
    """advice, shortest_lag, horizon, experimental: how lag features could be used."""
    strong = lags.filter("strong").agg(F.min("lag").alias("shortest_lag"), F.max("lag").alias("longest_lag"))
    one = coverage.select("predict_later", "horizon").join(strong).join(shape.select("shortest"))
    advice = (
        F.when(F.col("shortest_lag").isNull(), "static")
        .when(~F.col("predict_later"), "unavailable")
        .when((F.col("horizon") > 0) & (F.col("horizon") <= F.col("shortest_lag")), "direct")
        .otherwise("recursive")
    )
    return one.select(advice.alias("advice"), "shortest_lag", "horizon", F.coalesce(F.col("shortest") < 3 * F.col("longest_lag"), F.lit(False)).alias("experimental"))


def validation_advice(within: DataFrame, coverage: DataFrame, distribution: DataFrame, shift: DataFrame) -> DataFrame:
    """scheme, skewed, drifting: which holdout mirrors the task."""
    one = within.agg(F.coalesce(F.bool_or("splits"), F.lit(False)).alias("w")).join(coverage.select("predict_later")).join(distribution.select("right_skewed")).join(shift.agg(F.count("*").alias("d")))
    return one.select(F.when(F.col("w"), "within-period").when(F.col("predict_later"), "time").otherwise("random").alias("scheme"), F.col("right_skewed").alias("skewed"), (F.col("d") > 0).alias("drifting"))
