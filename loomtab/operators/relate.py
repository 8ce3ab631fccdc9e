"""Keys and relations between tables: overlaps, joins that cannot fan out, shared rows, period ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of keys of two aliased frames: missing values match each other."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def join_keys(frames: list[DataFrame], row_id: str, target: str, declared: list[str] = (), template: DataFrame | None = None) -> list[str]:
    """Columns that all tables share, without row id and target, and the declared ones that some table has.

    frames: the table of the target first, then covariates; template: the rows to be predicted, as handed out. Where nothing is
    common to all, the template's columns that the table of the target has are the keys."""
    all_ = [*frames, *([template] if template is not None else [])]
    shared = [c for c in frames[0].columns if all(c in f.columns for f in all_[1:]) and c not in (row_id, target)]
    if not shared and template is not None:
        shared = [c for c in template.columns if c in frames[0].columns and c not in (row_id, target)]
    known = {c for f in all_ for c in f.columns} - {row_id, target}
    return shared + [c for c in declared if c in known and c not in shared]


def value_overlap(predict: DataFrame, train: DataFrame, names: list[str]) -> DataFrame:
    """column, values, shared, overlap: share of the predict side's distinct values that train has."""
    from loomtab.functions.exprs import long_form

    p = long_form(predict, names).filter("value IS NOT NULL").distinct()
    t = long_form(train, names).filter("value IS NOT NULL").distinct().withColumn("hit", F.lit(1))
    out = p.join(t, ["column", "value"], "left").groupBy("column").agg(F.count("*").alias("values"), F.count("hit").alias("shared"))
    return out.withColumn("overlap", F.col("shared") / F.col("values"))


def scoring_subset(predict: DataFrame, train: DataFrame, names: list[str]) -> DataFrame:
    """column, predict_values, train_only, rows_in_scope, restricts: is predict's value set a strict subset of train's?

    The widest restriction (most train rows in scope) is the one to use; ties by name.
    """
    from loomtab.functions.exprs import long_form

    p = long_form(predict, names).filter("value IS NOT NULL").distinct().withColumn("p", F.lit(1))
    t = long_form(train, names).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    both = t.join(p, ["column", "value"], "full")
    out = both.groupBy("column").agg(
        F.count("p").alias("predict_values"),
        F.count_if(F.col("p").isNull()).alias("train_only"),
        F.coalesce(F.sum(F.when(F.col("p").isNotNull(), F.col("n"))), F.lit(0)).alias("rows_in_scope"),
        F.count_if(F.col("n").isNull()).alias("predict_only"),
    )
    return out.select("column", "predict_values", "train_only", "rows_in_scope", ((F.col("predict_only") == 0) & (F.col("train_only") > 0)).alias("restricts"))


def group_keys(predict: DataFrame, train: DataFrame, candidates: list[str], least: int = 2, most: int = 2000, overlap: float = 0.5) -> DataFrame:
    """keys (comma-joined), levels: single keys that qualify, and the pair of the two with most levels."""
    from loomtab.operators.profile import distinct_counts

    counts = distinct_counts(train, candidates).select("column", F.col("distinct").alias("levels"))
    fit = counts.join(value_overlap(predict, train, candidates), "column").filter(F.col("levels").between(least, most) & (F.col("overlap") >= overlap)).select("column", "levels")
    ranked = fit.withColumn("nth", F.row_number().over(Window.orderBy(F.desc("levels"), "column")))  # over candidate columns
    top = ranked.filter("nth <= 2")
    pair = top.agg(F.count("*").alias("k"), F.array_join(F.array_sort(F.collect_list("column")), ",").alias("keys"), F.expr("try_divide(1, 1)").alias("one")).filter("k = 2").select("keys", F.lit(None).cast("long").alias("levels"))
    return fit.select(F.col("column").alias("keys"), "levels").unionByName(pair)


def period_rank(periods: DataFrame, token: str, at: str) -> DataFrame:
    """token, rank: chronological rank from 0 of distinct periods, whatever their spelling."""
    distinct = periods.groupBy(token).agg(F.min(at).alias("at"))
    return distinct.select(token, (F.row_number().over(Window.orderBy("at", token)) - 1).alias("rank"))  # over periods, not rows


def column_diff(train: DataFrame, predict: DataFrame) -> DataFrame:
    """column, side (train, predict or both) with the rows of each frame."""
    names = [(c, "both" if c in predict.columns else "train") for c in train.columns] + [(c, "predict") for c in predict.columns if c not in train.columns]
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(s).alias("side")) for c, s in names])).alias("x")
    counts = train.agg(F.count("*").alias("train_rows")).join(predict.agg(F.count("*").alias("predict_rows")))
    return counts.select(sides, "train_rows", "predict_rows").select("x.column", "x.side", "train_rows", "predict_rows")


class FanOut(ValueError):
    """A covariate key is not unique, so a left join would multiply rows."""


def join_covariates(left: DataFrame, right: DataFrame, keys: list[str], suffix: str = "_cov", check: bool = True) -> DataFrame:
    """Left join on null-safe keys; clashing columns of right get the suffix; repeated keys on the right are refused."""
    if check and not right.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise FanOut(f"keys {keys} are not unique on the right side")
    rest = [c for c in right.columns if c not in keys]
    named = right.select(*keys, *[F.col(c).alias(c + suffix if c in left.columns else c) for c in rest])
    added = [c for c in named.columns if c not in keys]
    return left.alias("l").join(named.alias("r"), same("l", "r", keys), "left").select("l.*", *[f"r.{c}" for c in added])


def prediction_rows(predict: DataFrame, covariates: DataFrame | None, keys: list[str], row_id: str, target: str, order: str | None = None) -> tuple[DataFrame, list[str]]:
    """The rows to be predicted with their covariates, and the keys that joined them; a placeholder of the target goes first.

    Keys are the given ones that both sides have, else all columns that both have but row id and target. Where they share none,
    rows are paired by `order` if that is named (it may be the row id), else they stay as they are and no key is told. Keys
    that are not unique among the covariates are refused (FanOut)."""
    rows = predict.drop(target)
    if covariates is None:
        return rows, []
    covariates = covariates.drop(target)
    both = [c for c in rows.columns if c in covariates.columns]
    used = [k for k in keys if k in both] or [c for c in both if c != row_id]
    if used:
        return join_covariates(rows, covariates, used), used
    return (join_by_order(rows, covariates, order), []) if order else (rows, [])


def join_by_order(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Positional join: both sides must name their order; equal row counts are required."""
    if left.count() != right.count():
        raise ValueError("row counts differ")
    from loomtab.operators.windows import numbered

    rest = [c for c in right.columns if c not in left.columns]
    l, r = numbered(left, [order], "__n"), numbered(right, [order], "__n").select("__n", *rest)
    return l.join(r, "__n").drop("__n")


def attach_statistics(df: DataFrame, stats: DataFrame, keys: list[str], fallback: DataFrame) -> DataFrame:
    """Group statistics to rows; unseen groups take the one-row fallback, statistic by statistic."""
    names = [c for c in stats.columns if c not in keys]
    base = fallback.select(*[F.col(c).alias(f"__{c}") for c in names])
    out = df.alias("l").join(stats.alias("r"), same("l", "r", keys), "left").select("l.*", *[f"r.{c}" for c in names]).join(base)
    return out.select(*df.columns, *[F.coalesce(c, f"__{c}").alias(c) for c in names])


def shared_rows(left: DataFrame, right: DataFrame, names: list[str] | None = None) -> DataFrame:
    """left_rows, shared: pairs of equal rows on all common columns, null equal to null."""
    names = names or [c for c in left.columns if c in right.columns]
    a = left.groupBy(*names).agg(F.count("*").alias("n"))
    b = right.groupBy(*names).agg(F.count("*").alias("m"))
    both = a.alias("a").join(b.alias("b"), same("a", "b", names), "left")
    return both.agg(F.sum("n").alias("left_rows"), F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).cast("long").alias("shared"))


def align_oof(frames: dict[str, DataFrame], row_id: str, pred: str) -> DataFrame:
    """Candidates' out-of-fold predictions (numbers, or arrays of chances) side by side, on rows where all are finite: one
    shuffle, by pivot."""
    long = reduce(DataFrame.unionByName, [f.select(row_id, F.lit(k).alias("candidate"), F.col(pred).alias("p")) for k, f in frames.items()])
    wide = long.groupBy(row_id).pivot("candidate", list(frames)).agg(F.first("p"))
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    arrays = {n for n, t in wide.dtypes if t.startswith("array")}
    return wide.filter(reduce(lambda a, b: a & b, [F.coalesce(F.forall(k, finite), F.lit(False)) if k in arrays else finite(F.col(k)) for k in frames]))


def set_relation(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """shared, left_only, right_only distinct values of a column, and whether left is a strict subset."""
    a = left.select(name).distinct().withColumn("a", F.lit(1))
    b = right.select(name).distinct().withColumn("b", F.lit(1))
    both = a.alias("x").join(b.alias("y"), F.col(f"x.{name}").eqNullSafe(F.col(f"y.{name}")), "full")
    out = both.agg(F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("shared"), F.count(F.when(F.col("b").isNull(), 1)).alias("left_only"), F.count(F.when(F.col("a").isNull(), 1)).alias("right_only"))
    return out.withColumn("strict_subset", (F.col("left_only") == 0) & (F.col("right_only") > 0))
