"""Scores by the name of a metric, and class probabilities as one array over the whole list of classes.

A frame of predictions has a label and `pred`: a value, a label or the chance of the positive class; or `proba`, an array of
chances in the order of the class list. Scores are one-row tables; `scorer` turns a metric's name into a function of a frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtab.operators import metrics
from loomtab.operators.relate import same
from loomtab.operators.task import GREATER

EPS = 1e-15


def class_list(df: DataFrame, target: str, most: int = 1000) -> list[str]:
    """Classes in order; a target of more than `most` of them is no class label."""
    rows = df.select(F.col(target).cast("string").alias("c")).filter("c IS NOT NULL").distinct().orderBy("c").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{target} has more than {most} classes")
    return [r.c for r in rows]


def _place(label: Column, classes: Sequence[str]) -> Column:
    """1-based place of a label in the class list, 0 for a label that is not in it."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, classes)), label.cast("string")), F.lit(0)).cast("int")


def aligned(proba: Column, own: Sequence[str], classes: Sequence[str]) -> Column:
    """Chances of a model that knows the classes `own`, in the order of all classes: 0 for those it has never seen."""
    return F.array(*[F.element_at(proba, own.index(c) + 1) if c in own else F.lit(0.0) for c in classes])


def most_likely(proba: Column, classes: Sequence[str]) -> Column:
    """The class of the largest chance, the first in order among equals."""
    return F.element_at(F.array(*map(F.lit, classes)), F.array_position(proba, F.array_max(proba)).cast("int"))


def class_shares(train: DataFrame, df: DataFrame, keys: Sequence[str], target: str, classes: Sequence[str]) -> DataFrame:
    """df with proba: shares of the classes among train's rows of the same keys, or in all of train."""
    counts = [F.count_if(F.col(target).cast("string") == c).cast("double").alias(f"__n{i}") for i, c in enumerate(classes)]
    names = [f"__n{i}" for i in range(len(classes))]

    def share(prefix: str) -> Column:
        total = sum((F.col(f"{prefix}{n}") for n in names), F.lit(0.0))
        return F.when(total > 0, F.array(*[F.col(f"{prefix}{n}") / total for n in names]))

    whole = train.agg(*counts).select(share("").alias("__whole"))
    groups = train.groupBy(*keys).agg(*counts).select(*keys, share("").alias("__own"))
    out = df.alias("l").join(groups.alias("r"), same("l", "r", list(keys)), "left").select("l.*", "__own").join(F.broadcast(whole))
    return out.withColumn("proba", F.coalesce("__own", "__whole")).drop("__own", "__whole")


def crossfit_class_shares(df: DataFrame, row_id: str, keys: Sequence[str], target: str, classes: Sequence[str], fold: str = "fold") -> DataFrame:
    """row_id, proba: the out-of-fold form: a group's counts less those of the row's own fold; else all rows outside it."""
    names = [f"__n{i}" for i in range(len(classes))]
    part = df.groupBy(*keys, fold).agg(*[F.count_if(F.col(target).cast("string") == c).cast("double").alias(n) for n, c in zip(names, classes, strict=True)])
    group, everything = Window.partitionBy(*keys), Window.partitionBy()  # over a group's folds; over folds
    folds = part.groupBy(fold).agg(*[F.sum(n).alias(n) for n in names])
    folds = folds.select(fold, F.array(*[F.sum(n).over(everything) - F.col(n) for n in names]).alias("__rest"))
    outside = part.select(*keys, fold, F.array(*[F.sum(n).over(group) - F.col(n) for n in names]).alias("__own")).join(F.broadcast(folds), fold)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    counts = F.when(total(F.col("__own")) > 0, F.col("__own")).otherwise(F.col("__rest"))
    shares = outside.withColumn("__c", counts).withColumn("proba", F.transform("__c", lambda x: F.try_divide(x, total(F.col("__c")))))
    shares = shares.select(*keys, fold, "proba")
    return df.alias("d").join(shares.alias("s"), same("d", "s", [*keys, fold])).select(f"d.{row_id}", "s.proba")


def macro_auc(df: DataFrame, y: str, proba: str, classes: Sequence[str]) -> DataFrame:
    """auc: mean over classes of one class against the rest, exact with ties; classes without both sides do not count."""
    each = F.explode(F.transform(F.sequence(F.lit(1), F.lit(len(classes))), lambda i: F.struct(i.alias("class"), F.element_at(F.col(proba), i).alias("score")))).alias("x")
    rows = df.filter(F.col(y).isNotNull()).select(_place(F.col(y), classes).alias("__y"), each).select("x.*", (F.col("x.class") == F.col("__y")).cast("long").alias("p"))
    counts = rows.filter("score IS NOT NULL").groupBy("class", "score").agg(F.sum("p").alias("pos"), (F.count("*") - F.sum("p")).alias("neg"))
    return metrics.auc_by(counts, "class").agg(F.avg("auc").alias("auc"))


def multiclass_log_loss(df: DataFrame, y: str, proba: str, classes: Sequence[str], eps: float = EPS) -> DataFrame:
    """log_loss: mean of minus the logarithm of the true class's chance, which is kept off 0 and 1."""
    place = _place(F.col(y), classes)
    chance = F.when(place > 0, F.element_at(F.col(proba), F.greatest(place, F.lit(1)))).otherwise(0.0)
    return df.filter(F.col(y).isNotNull()).agg(F.avg(-F.log(F.greatest(F.least(chance, F.lit(1 - eps)), F.lit(eps)))).alias("log_loss"))


def score_table(df: DataFrame, metric: str, y: str = "label", pred: str = "pred", *, proba: str | None = None, classes: Sequence[str] = (), positive: object = 1, block: str | None = None) -> DataFrame:
    """score by the name of a metric. proba and classes: for scores of chances over all classes; with two classes pred may be
    the chance of `positive`, and is cut at one half where a metric needs labels."""
    if metric == "block_mae":
        return metrics.block_mae(df, y, pred, block)
    if metric in ("mae", "rmse", "r2", "mape"):
        return metrics.regression(df, y, pred).select(F.col(metric).alias("score"))
    is_positive = F.col(y).cast("string") == str(positive)
    if isinstance(positive, (int, float)):  # 1 and 1.0 are the same label
        is_positive = is_positive | F.coalesce(F.col(y).try_cast("double") == float(positive), F.lit(False))
    if metric in ("roc_auc", "log_loss"):
        if proba:
            return (macro_auc if metric == "roc_auc" else multiclass_log_loss)(df, y, proba, classes).toDF("score")
        return (metrics.roc_auc if metric == "roc_auc" else metrics.log_loss)(df, is_positive, pred).toDF("score")
    if metric in ("accuracy", "f1", "f1_macro", "balanced_accuracy"):
        if proba:
            df = df.withColumn("__p", most_likely(F.col(proba), classes))
        elif dict(df.dtypes)[pred] == "double":  # a chance
            other = df.filter(~is_positive).agg(F.min(F.col(y).cast("string")).alias("__other"))
            df = df.join(F.broadcast(other)).withColumn("__p", F.when(F.col(pred) >= 0.5, F.lit(str(positive))).otherwise(F.coalesce("__other", F.lit("not"))))
        else:
            df = df.withColumn("__p", F.col(pred).cast("string"))
        if metric == "f1" and not proba:
            hit, said, true = F.count_if(is_positive & (F.col("__p") == str(positive))), F.count_if(F.col("__p") == str(positive)), F.count_if(is_positive)
            return df.agg(F.coalesce(F.try_divide(2.0 * hit, said + true), F.lit(0.0)).alias("score"))
        return metrics.classification(df, y, "__p").select(F.col(metric).alias("score"))
    raise ValueError(f"no metric {metric}")


def scorer(metric: str, **options) -> Callable[[DataFrame], float]:
    """The metric as a function of a frame with label and pred (or proba); None where it is undefined."""
    return lambda df: score_table(df, metric, **options).first()[0]


def is_better(metric: str, new: float | None, old: float | None, eps: float = 1e-9) -> bool:
    """Does a score beat another by more than eps, in the metric's direction? Undefined ones beat nothing."""
    if new is None or new != new:
        return False
    if old is None or old != old:
        return True
    return new > old + eps if metric in GREATER else new < old - eps


def top_two(df: DataFrame, ranked: Sequence[tuple[str, float]], metric: str, out: str = "top2", within: float = 0.15, **options) -> tuple[DataFrame, float | None]:
    """df with the mean of the two best candidates, and its score: only if the second is within 15 % of the first and the
    mean beats it; else None. ranked: (column, score), the best first."""
    if len(ranked) < 2 or abs(ranked[1][1] - ranked[0][1]) > within * abs(ranked[0][1]):
        return df, None
    both = df.withColumn(out, (F.col(ranked[0][0]) + F.col(ranked[1][0])) / 2)
    score = score_table(both, metric, pred=out, **options).first()[0]
    return (both, score) if is_better(metric, score, ranked[0][1]) else (df, None)


def mean_chances(frames: Sequence[DataFrame], row_id: str, proba: str = "proba") -> DataFrame:
    """row_id, proba: the mean of several models' chances, class by class: one union and one shuffle."""
    from functools import reduce

    rows = reduce(DataFrame.unionByName, [f.select(row_id, F.posexplode(proba).alias("__i", "__p")) for f in frames])
    per = rows.groupBy(row_id, "__i").agg(F.avg("__p").alias("__p")).groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("__i", "__p"))).alias("__x"))
    return per.select(row_id, F.transform("__x", lambda s: s["__p"]).alias(proba))
