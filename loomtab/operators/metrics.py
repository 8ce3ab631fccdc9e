"""Scores of predictions: errors, block averages, confusion, exact AUC and curves, residuals, stability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import correlation
from loomtab.operators.quantiles import exact_quantiles, quantile_columns
from loomtab.operators.windows import quartile_buckets


def block_mae(df: DataFrame, y: str, pred: str, block: str | None) -> DataFrame:
    """score: mean over blocks of the block's mean absolute error; null is a block; without blocks plain MAE."""
    error = F.abs(F.col(y) - F.col(pred))
    if block is None:
        return df.agg(F.avg(error).alias("score"))
    return df.groupBy(block).agg(F.avg(error).alias("e")).agg(F.avg("e").alias("score"))


def regression(df: DataFrame, y: str, pred: str) -> DataFrame:
    """n, mae, rmse, r2, mape (only of positive targets), heavy_tail (RMSE over twice MAE), worse_than_mean."""
    d = df.select(F.col(y).cast("double").alias("y"), F.col(pred).cast("double").alias("p")).filter("y IS NOT NULL AND p IS NOT NULL")
    e = F.col("y") - F.col("p")
    one = d.agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.try_divide(F.sum(e * e), F.var_pop("y") * F.count("*"))).alias("r2"), F.when(F.min("y") > 0, F.avg(F.try_divide(F.abs(e), F.col("y")))).alias("mape"))
    return one.withColumns({"heavy_tail": F.col("rmse") > 2 * F.col("mae"), "worse_than_mean": F.col("r2") < 0})


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """actual, predicted, n, share of the actual class."""
    counts = df.groupBy(F.col(y).cast("string").alias("actual"), F.col(pred).cast("string").alias("predicted")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("actual")))  # over cells


def classification(df: DataFrame, y: str, pred: str) -> DataFrame:
    """accuracy, weighted precision, recall and f1, macro f1, balanced accuracy: arithmetic on the confusion table."""
    cells = confusion(df, y, pred)
    a = cells.select(F.col("actual").alias("c"), "n", F.lit(0).cast("long").alias("m"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"))
    p = cells.select(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("n"), F.col("n").alias("m"), F.lit(0).cast("long").alias("tp"))
    per = a.unionByName(p).groupBy("c").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("tp").alias("tp"))
    per = per.select("n", "tp", F.coalesce(F.try_divide("tp", "m"), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide("tp", "n"), F.lit(0.0)).alias("recall"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    total = F.sum("n")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("n")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("n")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("n")) / total).alias("f1"),
        F.avg("f1").alias("f1_macro"),
        F.avg(F.when(F.col("n") > 0, F.col("recall"))).alias("balanced_accuracy"),
    )


def thresholds(df: DataFrame, positive: F.Column, score: str) -> DataFrame:
    """score, pos, neg: counts of both classes at each distinct score. Its size is that of the distinct scores."""
    rows = df.select(F.col(score).alias("score"), F.coalesce(positive, F.lit(False)).cast("long").alias("p")).filter("score IS NOT NULL")
    return rows.groupBy("score").agg(F.sum("p").alias("pos"), (F.count("*") - F.sum("p")).alias("neg"))


def _running(counts: DataFrame, slots: int = 4096) -> DataFrame:
    """counts with tp and fp: sums from the highest score down, in two steps over score ranges so that no task holds all."""
    ends = counts.agg(F.min("score").alias("__lo"), F.max("score").alias("__hi"))
    slot = F.least(F.lit(slots - 1), F.coalesce(F.floor(F.try_divide((F.col("score") - F.col("__lo")) * slots, F.col("__hi") - F.col("__lo"))), F.lit(0)))
    rows = counts.join(ends).withColumn("__s", slot).drop("__lo", "__hi")
    per = rows.groupBy("__s").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    down = Window.orderBy(F.desc("__s"))  # over at most `slots` ranges
    base = per.select("__s", (F.sum("__p").over(down) - F.col("__p")).alias("__bp"), (F.sum("__n").over(down) - F.col("__n")).alias("__bn"))
    inside = Window.partitionBy("__s").orderBy(F.desc("score"))
    out = rows.join(F.broadcast(base), "__s").withColumns({"tp": F.sum("pos").over(inside) + F.col("__bp"), "fp": F.sum("neg").over(inside) + F.col("__bn")})
    return out.drop("__s", "__bp", "__bn")


def auc_by(counts: DataFrame, by: str, slots: int = 4096) -> DataFrame:
    """by, auc of many scores at once, exact with ties. counts: (by, score, pos, neg), a line for each distinct score; null
    with one class only. Sums run over slots of each score's range, then inside a slot, so no task holds a whole score."""
    ends = counts.groupBy(by).agg(F.min("score").alias("__lo"), F.max("score").alias("__hi"))
    rows = counts.join(F.broadcast(ends), by)
    slot = F.least(F.lit(slots - 1), F.coalesce(F.floor(F.try_divide((F.col("score") - F.col("__lo")) * slots, F.col("__hi") - F.col("__lo"))), F.lit(0)))
    rows = rows.withColumn("__s", slot).drop("__lo", "__hi")
    per = rows.groupBy(by, "__s").agg(F.sum("neg").alias("__n"))
    base = per.select(by, "__s", (F.sum("__n").over(Window.partitionBy(by).orderBy("__s")) - F.col("__n")).alias("__b"))
    below = F.sum("neg").over(Window.partitionBy(by, "__s").orderBy("score")) - F.col("neg") + F.col("__b")
    rows = rows.join(base, [by, "__s"]).withColumn("__below", below)
    ordered = F.sum(F.col("pos") * F.col("__below") + 0.5 * F.col("pos") * F.col("neg"))
    return rows.groupBy(by).agg(F.try_divide(ordered.cast("double"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def roc_auc(df: DataFrame, positive: F.Column, score: str) -> DataFrame:
    """auc, exact with ties: pairs ordered right and half of those tied, over all pairs; null with one class only."""
    run = _running(thresholds(df, positive, score))
    ordered = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + 0.5 * F.col("neg") * F.col("pos"))
    return run.agg(F.try_divide(ordered.cast("double"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def roc_curve(df: DataFrame, positive: F.Column, score: str) -> DataFrame:
    """score, fpr, tpr at each distinct threshold."""
    run = _running(thresholds(df, positive, score))
    total = run.agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    return run.join(total).select("score", F.try_divide("fp", "__n").alias("fpr"), F.try_divide("tp", "__p").alias("tpr"))


def pr_curve(df: DataFrame, positive: F.Column, score: str) -> DataFrame:
    """score, precision, recall and this threshold's term of average precision."""
    run = _running(thresholds(df, positive, score))
    total = run.agg(F.sum("pos").alias("__p"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return run.join(total).select("score", precision.alias("precision"), F.try_divide("tp", "__p").alias("recall"), (precision * F.try_divide("pos", "__p")).alias("ap_term"))


def log_loss(df: DataFrame, positive: F.Column, p: str, eps: float = 1e-15) -> DataFrame:
    chance = F.when(positive, F.col(p)).otherwise(1 - F.col(p))
    return df.agg(F.avg(-F.log(F.greatest(F.least(chance, F.lit(1 - eps)), F.lit(eps)))).alias("log_loss"))


def residual_summary(df: DataFrame, y: str, pred: str) -> DataFrame:
    r = F.col(y) - F.col(pred)
    p5, p95 = quantile_columns(df, r, [0.05, 0.95])
    return df.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.min(r).alias("min"), p5.alias("p5"), p95.alias("p95"), F.max(r).alias("max"))


def residual_quartiles(df: DataFrame, y: str, pred: str) -> DataFrame:
    """by (predicted or true), bucket, n, mean, mean_abs residual. Worked out when it is called: ten rows at most."""
    r = df.select(F.col(y).alias("y"), F.col(pred).alias("p"), (F.col(y) - F.col(pred)).alias("r")).persist()
    try:
        edges, out = exact_quantiles(r, ["p", "y"], [0.25, 0.5, 0.75]), r
        for c in ("p", "y"):
            out = quartile_buckets(out, c, f"{c}_bucket", edges[c])
        sides = F.array(*[F.struct(F.lit(n).alias("by"), F.col(f"{c}_bucket").alias("bucket")) for c, n in (("p", "predicted"), ("y", "true"))])
        per = out.select("r", F.explode(sides).alias("x")).groupBy("x.by", "x.bucket").agg(F.count("*").alias("n"), F.avg("r").alias("mean"), F.avg(F.abs("r")).alias("mean_abs"))
        return df.sparkSession.createDataFrame(per.collect(), per.schema)
    finally:
        r.unpersist()


def residual_bias(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Top quartile of the target: shares under and over, mean residual, direction; and corr(pred, |residual|)."""
    d = df.select(F.col(y).alias("y"), F.col(pred).alias("p"), (F.col(y) - F.col(pred)).alias("r"))
    edge = d.agg(quantile_columns(d, F.col("y"), [0.75])[0].alias("q3"), correlation("p", F.abs("r")).alias("spread_corr"))
    top = d.join(edge).filter(F.col("y") >= F.col("q3"))
    one = top.agg(F.count("*").alias("n"), F.avg((F.col("r") > 0).cast("double")).alias("under"), F.avg((F.col("r") < 0).cast("double")).alias("over"), F.avg("r").alias("mean"), F.first("q3").alias("q3"), F.first("spread_corr").alias("spread_corr"))
    return one.withColumn("direction", F.when(F.abs("mean") < 0.01 * F.abs("q3"), "negligible").when(F.col("mean") > 0, "under").otherwise("over"))


def prediction_quantiles(sides: dict[str, DataFrame], name: str) -> DataFrame:
    """side, p5, p25, p50, p75, p95, and the median's ratio to the first side's."""
    names = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    rows = [(side, *exact_quantiles(d, [name], list(names.values()))[name]) for side, d in sides.items()]
    table = next(iter(sides.values())).sparkSession.createDataFrame(rows, "side string, " + ", ".join(f"{n} double" for n in names))
    return table.withColumn("median_ratio", F.try_divide(F.col("p50"), F.lit(rows[0][3]).cast("double")))


def fold_stability(df: DataFrame, fold: str, y: str, pred: str) -> DataFrame:
    """folds, mean, std, relative_std of per-fold MAE, and the verdict."""
    per = df.groupBy(fold).agg(F.avg(F.abs(F.col(y) - F.col(pred))).alias("s"))
    one = per.agg(F.count("*").alias("folds"), F.avg("s").alias("mean"), F.stddev_pop("s").alias("std")).withColumn("relative_std", F.try_divide(F.col("std"), F.abs("mean")))
    return one.withColumn("verdict", F.when(F.col("relative_std") < 0.15, "stable").when(F.col("relative_std") < 0.3, "moderate").otherwise("unstable"))


def compare(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """metric, baseline, candidate, delta of two one-row metric tables."""
    names = [c for c in baseline.columns if c in candidate.columns and dict(baseline.dtypes)[c] in ("double", "bigint")]
    x = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"b.{c}").cast("double").alias("baseline"), F.col(f"c.{c}").cast("double").alias("candidate")) for c in names])).alias("x")
    return baseline.alias("b").join(candidate.alias("c")).select(x).select("x.*", (F.col("x.candidate") - F.col("x.baseline")).alias("delta"))


def class_shares(train: DataFrame, predicted: DataFrame, target: str, pred: str) -> DataFrame:
    """label, base_rate, predicted_rate, ratio, odd: predicted shares against train's."""
    t = train.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("label")).agg(F.count("*").alias("n"))
    p = predicted.groupBy(F.col(pred).cast("string").alias("label")).agg(F.count("*").alias("m"))
    all_t, all_p = t.agg(F.sum("n").alias("tn")), p.agg(F.sum("m").alias("tm"))
    out = t.join(p, "label", "left").join(all_t).join(all_p).select("label", (F.col("n") / F.col("tn")).alias("base_rate"), (F.coalesce("m", F.lit(0)) / F.col("tm")).alias("predicted_rate"))
    return out.withColumn("ratio", F.col("predicted_rate") / F.col("base_rate")).withColumn("odd", ~F.col("ratio").between(0.6, 1.66))


def best_candidate(scores: DataFrame, greater: bool = False, eps: float = 1e-9) -> DataFrame:
    """candidate, score: the best by direction; an earlier candidate keeps its place unless beaten by more than eps."""
    key = F.struct((-F.col("score") if greater else F.col("score")).alias("s"), "ord")
    best = scores.agg(F.min(F.col("score") if not greater else -F.col("score")).alias("__m"))
    near = scores.join(best).filter((-F.col("score") if greater else F.col("score")) <= F.col("__m") + eps)
    return near.agg(F.min_by("candidate", "ord").alias("candidate"), F.min_by("score", "ord").alias("score")) if eps else scores.agg(F.min_by("candidate", key).alias("candidate"), F.min_by("score", key).alias("score"))


def heteroscedasticity(df: DataFrame, y: str, pred: str, least: int = 5) -> DataFrame:
    """n, corr, note: do errors grow with predictions? Correlation of the prediction with the absolute residual: strong above
    one half, moderate above a quarter; null below `least` rows that have both."""
    r = df.select(F.col(pred).cast("double").alias("p"), F.abs(F.col(y) - F.col(pred)).cast("double").alias("e")).filter("p IS NOT NULL AND e IS NOT NULL AND NOT isnan(p) AND NOT isnan(e)")
    one = r.agg(F.count("*").alias("n"), correlation("p", "e").alias("corr")).withColumn("corr", F.when(F.col("n") >= least, F.nanvl("corr", F.lit(None))))
    return one.withColumn("note", F.when(F.col("corr") > 0.5, "strong").when(F.col("corr") > 0.25, "moderate").when(F.col("corr").isNotNull(), "low"))


def prediction_shift(train: DataFrame, final: DataFrame, target: str, pred: str) -> DataFrame:
    """median_ratio, p50_delta, p95_delta of final predictions against the target's own quantiles; null where a side has none."""
    def finite(df: DataFrame, name: str) -> list[float | None]:
        x = F.col(name).try_cast("double")
        return exact_quantiles(df.select(F.when(F.abs(x) < float("inf"), x).alias("v")), ["v"], [0.5, 0.95])["v"]

    (a50, a95), (b50, b95) = finite(train, target), finite(final, pred)
    known = a50 is not None and b50 is not None
    row = (b50 / max(abs(a50), 1e-9), b50 - a50, b95 - a95) if known else (None, None, None)
    return train.sparkSession.createDataFrame([row], "median_ratio double, p50_delta double, p95_delta double")
