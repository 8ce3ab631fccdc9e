"""Group statistics of the target, and their cross-fitted forms: a row never sees its own fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import number
from loomtab.operators.quantiles import exact_quantiles, group_quantiles, quantile_columns
from loomtab.operators.relate import attach_statistics, same

#: The statistics of a group's target, in order.
STATISTICS = ("mean", "median", "std", "min", "max", "q25", "q75", "count")
#: Folds that cross-fitted statistics tell apart.
MOST_FOLDS = 50
_QS = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def statistics(df: DataFrame, keys: list[str], target: str, approx: bool = False) -> DataFrame:
    """keys and mean, median, std (0 if undefined), min, max, q25, q75, count of the target. Quantiles are exact: hot groups are
    cut by value; approx takes them from a sketch in the same aggregate."""
    from loomtab.functions.exprs import quantile

    y = number(target)
    aggs = [F.avg(y).alias("mean"), F.coalesce(F.stddev(y), F.lit(0.0)).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"), F.count(y).alias("count")]
    if approx:
        aggs += [quantile(y, q, True).alias(n) for n, q in _QS.items()]
    elif not keys:
        aggs += [c.alias(n) for n, c in zip(_QS, quantile_columns(df, y, list(_QS.values())), strict=True)]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if keys and not approx:
        own = group_quantiles(df.select(*keys, y.alias("__y")), keys, ["__y"], _QS)
        out = out.alias("l").join(own.alias("r"), same("l", "r", keys), "left").select("l.*", *[f"r.{n}" for n in _QS])
    return out.select(*keys, *STATISTICS)


def apply_statistics(train: DataFrame, df: DataFrame, keys: list[str], target: str) -> DataFrame:
    """df with tgt_<stat>__<keys>; unseen groups take train's whole, with count 0."""
    tail = "__" + "_".join(keys)
    names = ["mean", "median", "std", "min", "max", "q25", "q75", "count"]

    def named(x, base=False):
        return x.select(*([] if base else keys), *[(F.lit(0).cast("long") if base and n == "count" else F.col(n)).alias(f"tgt_{n}{tail}") for n in names])

    return attach_statistics(df, named(statistics(train, keys, target)), keys, named(statistics(train, [], target), True))


def crossfit_moments(df: DataFrame, row_id: str, keys: list[str], target: str, fold: str = "fold") -> DataFrame:
    """row_id, mean, std, count of the target over the row's group outside its fold.

    One shuffle of partial sums by (keys, fold); a fold's training side is the group's total less its own part, so
    neither rows nor folds are replicated. Groups without rows outside take all rows outside the fold, with count 0.
    """
    y = number(target)
    part = df.groupBy(*keys, fold).agg(F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    all_ = part.groupBy(fold).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"f{c}") for c in "nsq"])
    whole = Window.partitionBy()  # over folds
    out_all = all_.select(fold, *[(F.sum(f"f{c}").over(whole) - F.col(f"f{c}")).alias(f"g{c}") for c in "nsq"])
    group = Window.partitionBy(*keys)  # over a group's folds
    outside = part.select(*keys, fold, *[(F.sum(c).over(group) - F.coalesce(F.col(c), F.lit(0))).alias(c) for c in "nsq"]).join(F.broadcast(out_all), fold)
    n, s, q = (F.when(F.col("n") > 0, F.col(c)).otherwise(F.col(f"g{c}")) for c in "nsq")
    variance = F.greatest(F.try_divide(q - s * s / n, n - 1), F.lit(0.0))
    stats = outside.select(*keys, fold, F.try_divide(s, n).alias("mean"), F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("std"), F.coalesce("n", F.lit(0)).alias("count"))
    return df.alias("d").join(stats.alias("s"), same("d", "s", [*keys, fold])).select(f"d.{row_id}", "mean", "std", "count")


def fold_list(df: DataFrame, fold: str) -> list:
    """The folds of df, in order."""
    found = [r[0] for r in df.select(fold).filter(F.col(fold).isNotNull()).distinct().limit(MOST_FOLDS + 1).collect()]
    if len(found) > MOST_FOLDS:
        raise ValueError(f"more than {MOST_FOLDS} folds")
    return sorted(found)


def crossfit_statistics(df: DataFrame, row_id: str, keys: list[str], target: str, fold: str = "fold") -> DataFrame:
    """row_id and all eight statistics of the target over the row's group outside its fold.

    Means, spreads and counts are the group's total less the fold's part, extremes those of the group's other folds, and
    quantiles come from counts of values by fold: no row is repeated. Groups without numbers outside take all rows outside the
    fold, with count 0. Rows without a fold are in every fold's training side and see all others.
    """
    y = number(target)
    d = df.select(row_id, *keys, F.col(fold).alias(fold), y.alias("__y"))
    part = d.groupBy(*keys, fold).agg(F.count("__y").alias("n"), F.sum("__y").alias("s"), F.sum(F.col("__y") * F.col("__y")).alias("q"), F.min("__y").alias("lo"), F.max("__y").alias("hi"))

    def outside(parts: DataFrame, by: list[str]) -> DataFrame:
        """by, fold and the moments and extremes of the other folds' parts: windows over the folds of a group."""
        group = Window.partitionBy(*by)
        ends = {}
        for c, least in (("lo", F.least), ("hi", F.greatest)):
            one = F.min if c == "lo" else F.max
            order = group.orderBy(fold)
            before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
            ends[c] = least(one(c).over(before), one(c).over(after))
        n, s, q = (F.sum(c).over(group) - F.coalesce(F.col(c), F.lit(0)) for c in "nsq")
        out = parts.select(*by, fold, n.alias("n"), s.alias("s"), q.alias("q"), *[e.alias(c) for c, e in ends.items()])
        variance = F.greatest(F.try_divide(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.col("n") - 1), F.lit(0.0))
        held = out.filter("n > 0")
        return held.select(*by, fold, F.try_divide("s", "n").alias("mean"), F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("std"), F.col("lo").alias("min"), F.col("hi").alias("max"), F.col("n").alias("count"))

    views = fold_list(d, fold)
    own = outside(part, keys)
    all_ = outside(part.groupBy(fold).agg(*[F.sum(c).alias(c) for c in "nsq"], F.min("lo").alias("lo"), F.max("hi").alias("hi")), [])

    def with_quantiles(stats: DataFrame, by: list[str]) -> DataFrame:
        # A row without a fold trains all of them: its view is the whole group, under a null fold.
        qs = group_quantiles(d, by, ["__y"], _QS, fold, [*views, None])
        return stats.alias("l").join(qs.alias("r"), same("l", "r", [*by, fold]), "left").select("l.*", *[f"r.{n}" for n in _QS])

    own, all_ = with_quantiles(own, keys), with_quantiles(all_, []).select(fold, *[F.col(n).alias(f"__all_{n}") for n in STATISTICS])
    met = d.alias("d").join(own.alias("s"), same("d", "s", [*keys, fold]), "left").select(f"d.{row_id}", F.col(f"d.{fold}").alias(fold), *[f"s.{n}" for n in STATISTICS])
    met = met.alias("d").join(F.broadcast(all_).alias("s"), same("d", "s", [fold]), "left")  # a row a fold
    return met.select(row_id, *[(F.coalesce(n, F.lit(0)) if n == "count" else F.coalesce(n, f"__all_{n}", F.lit(0.0))).alias(n) for n in STATISTICS])


def crossfit_quantiles(df: DataFrame, row_id: str, keys: list[str], value: str, folds: int, fold: str = "fold", q: float = 0.5) -> DataFrame:
    """row_id, q: a quantile of the row's group outside its fold (0 to folds - 1); then of all rows outside; then 0."""
    d = df.select(row_id, *keys, fold, number(value).alias("__v"))
    views = list(range(folds))
    own = group_quantiles(d, keys, ["__v"], {"own": q}, fold, views)
    rest = group_quantiles(d, [], ["__v"], {"rest": q}, fold, views)
    out = d.alias("d").join(own.alias("s"), same("d", "s", [*keys, fold]), "left").select("d.*", "own").join(F.broadcast(rest.select(fold, "rest")), fold, "left")
    return out.select(row_id, F.coalesce("own", "rest", F.lit(0.0)).alias("q"))


def group_medians(train: DataFrame, group: str, names: list[str], approx: bool = False) -> DataFrame:
    """group and each column's median, with train's median (or 0) where a group has none."""
    from loomtab.functions.exprs import median

    base = exact_quantiles(train, names, [0.5])
    if approx:
        own = train.groupBy(group).agg(*[median(number(c), True).alias(c) for c in names])
    else:
        long = group_quantiles(train, [group], names, {"m": 0.5})
        pivoted = long.groupBy(group).agg(*[F.max(F.when(F.col("column") == c, F.col("m"))).alias(c) for c in names])
        own = train.select(group).distinct().alias("l").join(pivoted.alias("r"), same("l", "r", [group]), "left").select(f"l.{group}", *[F.col(f"r.`{c}`").alias(c) for c in names])
    return own.select(group, *[F.coalesce(F.col(f"`{c}`"), F.lit(base[c][0] or 0.0)).alias(c) for c in names])


def group_mean(train: DataFrame, predict: DataFrame, keys: list[str], target: str, out: str = "pred") -> DataFrame:
    """predict with the mean target of its group in train, or of all train."""
    stats = train.groupBy(*keys).agg(F.avg(number(target)).alias(out))
    return attach_statistics(predict, stats, keys, train.agg(F.avg(number(target)).alias(out)))


def crossfit_mean(df: DataFrame, row_id: str, keys: list[str], target: str, fold: str = "fold") -> DataFrame:
    """row_id, pred: the out-of-fold form of group_mean."""
    return crossfit_moments(df, row_id, keys, target, fold).select(row_id, F.col("mean").alias("pred"))


def group_mode(train: DataFrame, predict: DataFrame, keys: list[str], target: str) -> DataFrame:
    """predict with pred (the group's most frequent label, ties by label) and p (its share), or train's."""
    label = F.col(target).cast("string")
    counts = train.filter(F.col(target).isNotNull()).groupBy(*keys, label.alias("__l")).agg(F.count("*").alias("__n"))
    best = counts.groupBy(*keys).agg(F.min_by(F.struct(F.col("__l").alias("l"), F.col("__n").alias("n")), F.struct(-F.col("__n"), F.col("__l"))).alias("b"), F.sum("__n").alias("t"))
    stats = best.select(*keys, F.col("b.l").alias("pred"), (F.col("b.n") / F.col("t")).alias("p"))
    whole = counts.groupBy("__l").agg(F.sum("__n").alias("__n")).agg(F.min_by(F.struct(F.col("__l").alias("l"), F.col("__n").alias("n")), F.struct(-F.col("__n"), F.col("__l"))).alias("b"), F.sum("__n").alias("t"))
    return attach_statistics(predict, stats, keys, whole.select(F.col("b.l").alias("pred"), (F.col("b.n") / F.col("t")).alias("p")))


def stratified_draws(train: DataFrame, predict: DataFrame, row_id: str, target: str, seed: str = "draw", out: str = "pred") -> DataFrame:
    """predict with a label drawn by train's shares of the classes: the first label whose running share passes a hash of the
    row id, so that reruns and other engines draw alike."""
    from loomtab.functions.exprs import hashed
    from loomtab.operators.scores import class_list

    classes = class_list(train, target)  # bounded: a few hundred labels are no class list
    counts = {r.c: r.n for r in train.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("c")).agg(F.count("*").alias("n")).collect()}
    total, upto, cases = sum(counts.values()), 0, []
    at = hashed(row_id, seed) / F.lit(2.0**32)
    for c in classes:
        upto += counts[c]
        cases.append(F.when(at < F.lit(upto / total), F.lit(c)))
    return predict.withColumn(out, F.coalesce(*cases) if cases else F.lit(None).cast("string"))


def baselines(train: DataFrame, predict: DataFrame, row_id: str, target: str, keys: list[str], regression: bool = True) -> dict[str, DataFrame]:
    """By name, predict with pred: what a model must beat. Numbers: the mean and median of train, the group's mean; classes: the
    most frequent label, draws by the shares of the labels, the group's most frequent."""
    if regression:
        y = number(target)
        mean, (median,) = train.agg(F.avg(y)).first()[0], exact_quantiles(train, [target], [0.5])[target]
        constant = {"global_mean": mean, "global_median": median}
        return {n: predict.withColumn("pred", F.lit(v).cast("double")) for n, v in constant.items()} | {"group_mean": group_mean(train, predict, keys, target)}
    most = group_mode(train.withColumn("__all", F.lit(1)), predict.withColumn("__all", F.lit(1)), ["__all"], target).drop("__all", "p")
    return {"most_frequent": most, "stratified": stratified_draws(train, predict, row_id, target), "group_mode": group_mode(train, predict, keys, target).drop("p")}


def baseline_scores(train: DataFrame, predict: DataFrame, row_id: str, target: str, keys: list[str], metrics: list[str], regression: bool = True) -> DataFrame:
    """baseline, metric, score of every baseline on the rows of predict whose target is known."""
    from functools import reduce

    from loomtab.operators.scores import score_table

    known = predict.filter(F.col(target).isNotNull())
    rows = [score_table(df, m, target, "pred").select(F.lit(n).alias("baseline"), F.lit(m).alias("metric"), F.col("score").cast("double").alias("score")) for n, df in baselines(train, known, row_id, target, keys, regression).items() for m in metrics]
    return reduce(DataFrame.unionByName, rows)
