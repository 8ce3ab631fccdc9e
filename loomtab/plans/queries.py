"""Registered queries: each operator over whole tables, with columns named and rounded as its SQL states."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.functions.exprs import hashed
from loomtab.operators import build, checks, encode, features, folds, metrics, models, pattern, profile, quantiles, relate, repair, scores, task, text, trees, windows
from loomtab.plans import panels as P
from loomtab.spec import TableSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def rounded(df: DataFrame, places: int = 4, **other: int) -> DataFrame:
    """Doubles rounded, so that the order of partial sums does not show; other: places by column."""
    return df.select(*[F.round(c, other.get(c, places)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


# ---- profiles


@query
def profile_missing(s, d):
    return profile.missing(P.orders(s, d))


@query
def profile_numeric(s, d):
    return rounded(profile.numeric(P.orders(s, d), ["y", "acctbal", "gappy"]))


@query
def profile_categorical(s, d):
    return profile.top_values(P.orders(s, d), ["priority", "segment", "nation", "status"])


@query
def profile_duplicates(s, d):
    return profile.duplicates(P.table(s, d, "lineitem").select("l_orderkey", "l_linenumber"))


@query
def profile_flags(s, d):
    return profile.flags(P.orders(s, d), ["row_id", "y", "priority", "status", "nation", "gappy"])


@query
def column_exclusions(s, d):
    p = P.orders(s, d).withColumn("gone", F.when(F.col("row_id") % 3 == 0, F.col("acctbal"))).withColumn("same", F.lit("x"))
    names = ["row_id", "y", "priority", "gone", "same"]
    return profile.exclusions(profile.flags(p, names), profile.missing(p, names), "y")


@query
def series_summary(s, d):
    return rounded(profile.series_summary(P.orders(s, d), "gappy"))


@query
def class_distribution(s, d):
    return rounded(profile.class_distribution(P.quality(s, d), "y"), 6)


@query
def metric_advice(s, d):
    o, q = P.orders(s, d), P.quality(s, d)
    rows = {"status": (o, "status"), "y": (o, "y"), "quality": (q, "y"), "late": (o.withColumn("late", (F.col("month") >= "2000-07").cast("int")), "late")}
    return rounded(reduce(DataFrame.unionByName, [task.metric_advice(f, c).withColumn("target", F.lit(k)) for k, (f, c) in rows.items()]), 6)


@query
def datetime_detect(s, d):
    p = P.orders(s, d).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("row_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("n/a").alias("mixed"), "segment")
    return rounded(profile.datetime_columns(p, ["day", "mixed", "segment"], sample=None).select("column", "parse_rate", "is_datetime"), 6)


@query
def time_of_day(s, d):
    a, b = profile.has_time_of_day(P.events(s, d), "ts"), profile.has_time_of_day(P.orders(s, d), "ts")
    return a.select(F.lit("events").alias("panel"), "has_time").unionByName(b.select(F.lit("orders").alias("panel"), "has_time"))


@query
def text_detect(s, d):
    return rounded(profile.text_columns(P.quality(s, d), ["lang", "source", "text"]))


# ---- relations and joins


@query
def value_overlap(s, d):
    t, q = P.orders_split(s, d)
    return rounded(relate.value_overlap(q, t, ["month", "priority", "segment", "nation", "status"]), 6)


@query
def scoring_subset(s, d):
    t, q = P.orders_split(s, d)
    return relate.scoring_subset(q.filter("nation < 'M' AND status <> 'P'"), t, ["nation", "status", "month", "segment"])


@query
def group_keys(s, d):
    t, q = P.orders_split(s, d)
    return relate.group_keys(q, t, ["priority", "segment", "nation", "month"])


@query
def period_rank(s, d):
    return relate.period_rank(P.orders(s, d), "month", "ts")


@query
def column_diff(s, d):
    t, q = P.orders_split(s, d)
    return relate.column_diff(t, q.drop("y", "status").withColumn("extra", F.lit(1)))


@query
def join_train(s, d):
    o = P.table(s, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("k"), F.col("o_totalprice").alias("v"))
    c = P.table(s, d, "customer").filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    extra = s.range(1).select(F.lit(None).cast("long").alias("k"), F.lit(-1.0).alias("v"))
    return relate.join_covariates(o, c.unionByName(extra), ["k"]).groupBy((F.col("k").isNull()).alias("no_key")).agg(F.count("*").alias("n"), F.count("v_cov").alias("matched"), F.round(F.sum("v_cov"), 2).alias("total"))


@query
def join_predict(s, d):
    _, q = P.orders_split(s, d)
    n = P.table(s, d, "nation").select(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region"))
    return relate.join_covariates(q.drop("y"), n, ["nation"]).groupBy("region").agg(F.count("*").alias("n"))


@query
def join_predict_common(s, d):
    """The declared key is in neither table, so all columns that both have join them."""
    _, q = P.orders_split(s, d)
    c = P.table(s, d, "customer").join(P.table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation")).agg(F.count("*").alias("customers"), F.lit(0.0).alias("y"))
    rows, keys = relate.prediction_rows(q.select("row_id", "segment", "nation", "y"), c, ["jurisdiction"], "row_id", "y")
    return rows.groupBy("segment").agg(F.count("*").alias("n"), F.sum("customers").alias("customers"), F.lit(",".join(keys)).alias("keys"))


@query
def join_keys(s, d):
    """Keys of orders, customers and the rows to be predicted: nothing is common to all three, so those of the first and last."""
    t, q = P.orders_split(s, d)
    c = P.table(s, d, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_acctbal").alias("balance"))
    names = relate.join_keys([t, c], "row_id", "y", ["balance", "elsewhere"], template=q.select("row_id", "y", "nation", "segment"))
    return relate.value_overlap(q, t, [n for n in names if n in t.columns]).withColumn("keys", F.lit(",".join(names)))


@query
def join_by_order(s, d):
    c = P.table(s, d, "customer").select(F.col("c_custkey").alias("n"), F.col("c_acctbal").alias("a"))
    k = P.table(s, d, "customer").select((F.col("c_custkey") * 3).alias("n"), F.col("c_mktsegment").alias("seg"))
    return relate.join_by_order(c, k, "n").groupBy("seg").agg(F.count("*").alias("rows"), F.round(F.sum("a"), 2).alias("total"))


@query
def shared_rows(s, d):
    t, q = P.orders_split(s, d)
    return relate.shared_rows(t, q, ["priority", "segment", "nation", "status"])


@query
def set_relation(s, d):
    t, q = P.orders_split(s, d)
    return relate.set_relation(q, t, "month")


@query
def attach_statistics(s, d):
    t, q = P.orders_split(s, d)
    out = encode.apply_statistics(t.filter("nation < 'P'"), q, ["nation"], "y")
    return rounded(out.groupBy("nation").agg(F.count("*").alias("n"), F.max("tgt_mean__nation").alias("mean"), F.max("tgt_std__nation").alias("std"), F.max("tgt_count__nation").alias("seen")))


@query
def align_oof(s, d):
    p = P.orders(s, d)
    a = p.select("row_id", F.col("y").alias("pred"))
    b = p.filter("row_id % 3 <> 0").select("row_id", F.when(F.col("row_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("acctbal")).alias("pred"))
    return rounded(relate.align_oof({"a": a, "b": b}, "row_id", "pred").agg(F.count("*").alias("n"), F.avg("a").alias("a"), F.avg("b").alias("b")))


# ---- features


@query
def time_features(s, d):
    return rounded(features.calendar(P.events(s, d), "ts", True).select("row_id", *[f"ts__{c}" for c in ("year", "month", "month_sin", "month_cos", "day", "weekday", "weekday_sin", "weekend", "quarter", "week", "hour", "hour_sin", "hour_cos")]), 6)


@query
def ordinal_encode(s, d):
    t, q = P.orders_split(s, d)
    return windows.ordinals(t, q, "month")


@query
def interactions(s, d):
    p = features.calendar(P.events(s, d), "ts", True).withColumn("k", F.col("user_id") % 7)
    return rounded(features.interaction_ranks(p, "y", ["ts__hour", "ts__weekday", "ts__day"], ["k", "user_id"]), 6)


@query
def impute_median(s, d):
    t, q = P.orders_split(s, d)
    return rounded(features.median_impute(t, q, ["gappy"]).agg(F.count("gappy").alias("n"), F.avg("gappy").alias("mean"), F.min("gappy").alias("low")))


@query
def impute_mode(s, d):
    t, q = P.orders_split(s, d)
    q = q.withColumn("segment", F.when(F.col("row_id") % 4 != 0, F.col("segment")))
    return features.mode_impute(t, q, ["segment"]).groupBy("segment").agg(F.count("*").alias("n"))


@query
def onehot_levels(s, d):
    return features.level_map(P.events(s, d).withColumn("u", F.col("user_id").cast("string")), "u", 0.0065, 20)


@query
def fold_levels(s, d):
    p = P.events(s, d).withColumn("u", F.col("user_id").cast("string"))
    return features.fold_levels(p, features.level_map(p, "u", 0.0065, 20), "u").groupBy("u").agg(F.count("*").alias("n"))


@query
def tfidf_terms(s, d):
    return rounded(features.term_statistics(P.quality(s, d), "text", "row_id"), 6)


@query
def text_weights(s, d):
    """Vocabulary and idf of the labelled documents, applied to the others: terms and weights of each."""
    p = P.quality(s, d).cache()
    fitted = text.TextProjector(p.filter("y IS NOT NULL"), "text", "row_id", 400)
    w = text.term_weights(p.filter("y IS NULL"), fitted, "row_id")
    return rounded(w.groupBy("row_id").agg(F.count("*").alias("terms"), F.sum("weight").alias("total"), F.max("weight").alias("top")), 6)


@query
def target_transform(s, d):
    a, b = features.transform_choice(P.events(s, d), "y"), features.transform_choice(P.orders(s, d), "y")
    return rounded(a.select(F.lit("events").alias("panel"), "*").unionByName(b.select(F.lit("orders").alias("panel"), "*")), 6)


@query
def transform_round_trip(s, d):
    p = features.inverted(features.transformed(P.events(s, d), "y", "log1p", "z"), "z", "log1p")
    return rounded(p.agg(F.count("*").alias("n"), F.avg("z").alias("mean"), F.max(F.abs(F.col("z") - F.col("y"))).alias("gap")), 6)


@query
def label_codes(s, d):
    return features.label_codes(P.orders(s, d), "priority")


@query
def positive_label(s, d):
    a = features.positive_label(features.label_codes(P.quality(s, d), "y"))
    b = features.positive_label(features.label_codes(P.orders(s, d), "status"))
    return a.select(F.lit("quality").alias("panel"), "label").unionByName(b.select(F.lit("orders").alias("panel"), "label"))


@query
def choose_columns(s, d):
    t, q = P.orders_split(s, d)
    t = t.withColumn("post_value", F.col("y")).withColumn("postal", F.lit(1)).withColumn("only_train", F.lit(1))
    return features.choose_columns(t, q.withColumn("post_value", F.lit(1)).withColumn("postal", F.lit(1)), "y", "row_id")


@query
def in_scope(s, d):
    t, q = P.orders_split(s, d)
    return features.in_scope(t, "nation", q.filter("nation < 'K'").select("nation")).agg(F.count("*").alias("n"), F.round(F.avg("y"), 4).alias("mean"))


# ---- patterns


@query
def target_distribution(s, d):
    return rounded(pattern.target_distribution(P.events(s, d), "y"), 5)


@query
def target_by_group(s, d):
    return rounded(pattern.target_by_group(P.orders(s, d), "y", ["priority", "segment", "nation", "status", "month"]))


@query
def top_groups(s, d):
    return rounded(pattern.top_groups(P.orders(s, d), "y", ["priority", "nation"]))


@query
def time_target_signal(s, d):
    p = features.calendar(P.events(s, d), "ts", True)
    return rounded(pattern.group_levels(p, "y", ["ts__hour", "ts__weekday", "ts__week"], 2, 50))


@query
def feature_corr(s, d):
    p = P.orders(s, d).withColumn("half", F.col("y") / 2 + F.col("acctbal"))
    return rounded(pattern.ranked_correlations(p, "y", ["acctbal", "gappy", "half", "row_id"]), 6)


@query
def distribution_shift(s, d):
    t, q = P.events_split(s, d)
    add = {"late": F.dayofmonth("ts").cast("double"), "flat": F.col("y")}
    return rounded(pattern.distribution_shift(t.withColumns(add), q.withColumns(add), ["late", "flat", "row_id", "user_id"]))


@query
def high_cardinality(s, d):
    return rounded(pattern.high_cardinality(P.orders(s, d), ["row_id", "segment", "month"]), 6)


@query
def target_components(s, d):
    p = P.orders(s, d).withColumns({"part": F.col("y") * 0.4 + F.col("acctbal") * 0.1, "other": F.col("acctbal")})
    return rounded(pattern.target_components(p, "y", ["part", "other"]), 6)


@query
def interaction_scan(s, d):
    p = features.calendar(P.events(s, d), "ts", True).withColumn("k", F.col("user_id") % 5)
    return rounded(pattern.interaction_scan(p, "y", ["ts__hour", "ts__weekday"], ["event_type", "k"]))


@query
def time_coverage(s, d):
    t, q = P.orders_split(s, d)
    return pattern.time_coverage(t, q, "month")


@query
def rank_coverage(s, d):
    p = P.orders(s, d)
    ranks = relate.period_rank(p, "month", "ts")
    t, q = P.orders_split(s, d)
    return pattern.time_coverage(t.join(ranks, "month"), q.join(ranks, "month"), "rank")


@query
def within_period(s, d):
    p = P.events(s, d)
    return pattern.within_period(p.filter(F.dayofmonth("ts") <= 19), p.filter(F.dayofmonth("ts") > 19), "ts")


@query
def series_shape(s, d):
    return rounded(pattern.series_shape(P.shipments(s, d), ["nation", "flag"], "month"))


@query
def autocorrelation(s, d):
    return rounded(pattern.autocorrelation(P.shipments(s, d), ["nation", "flag"], "rank", "y"), 6)


@query
def lag_advice(s, d):
    p = P.shipments(s, d)
    edge = p.agg((F.max("rank") - 12).alias("edge"))
    t, q = p.join(edge).filter("rank <= edge").drop("edge"), p.join(edge).filter("rank > edge").drop("edge")
    return pattern.lag_advice(pattern.time_coverage(t, q, "rank"), pattern.autocorrelation(t, ["nation", "flag"], "rank", "y"), pattern.series_shape(t, ["nation", "flag"], "month"))


@query
def validation_advice(s, d):
    t, q = P.events_split(s, d)
    return pattern.validation_advice(pattern.within_period(t, q, "ts"), pattern.time_coverage(t, q, "ts"), pattern.target_distribution(t, "y"), pattern.distribution_shift(t, q, ["user_id", "row_id"]))


# ---- encoders and folds


@query
def group_target_stats(s, d):
    return rounded(encode.statistics(P.orders(s, d), ["segment", "priority"], "y"))


def _folded(s, d):
    p = P.orders(s, d)
    return p.withColumn("fold", (hashed("row_id", "s") % 5).cast("int"))


@query
def crossfit_target_stats(s, d):
    return rounded(encode.crossfit_moments(_folded(s, d), "row_id", ["segment", "nation"], "y"), 5, std=4)


@query
def crossfit_all_stats(s, d):
    """All eight statistics out of fold, of groups that reach into one fold only among them."""
    p = _folded(s, d).withColumn("rare", F.when(F.col("row_id") % 500 == 3, F.col("row_id").cast("string")).otherwise(F.col("nation")))
    p = p.withColumn("gappy", F.col("gappy") * 0.7310585)  # no mean lies half way between two roundings
    return rounded(encode.crossfit_statistics(p.cache(), "row_id", ["rare", "status"], "gappy"))


@query
def crossfit_group_median(s, d):
    return rounded(encode.crossfit_quantiles(_folded(s, d).cache(), "row_id", ["nation"], "gappy", 5))


@query
def group_medians(s, d):
    return rounded(encode.group_medians(P.orders(s, d).cache(), "nation", ["gappy", "y"]))


@query
def baseline_group_mean(s, d):
    t, q = P.orders_split(s, d)
    return rounded(encode.group_mean(t.filter("nation <> 'PERU'"), q, ["nation", "status"], "y").select("row_id", "pred"))


@query
def baseline_group_mode(s, d):
    t, q = P.orders_split(s, d)
    return rounded(encode.group_mode(t.filter("nation < 'T'"), q, ["nation"], "priority").groupBy("nation", "pred").agg(F.count("*").alias("n"), F.max("p").alias("p")), 6)


@query
def folds_kfold(s, d):
    return folds.kfold(P.orders(s, d), "row_id")


@query
def folds_group(s, d):
    return folds.group_folds(P.orders(s, d), "month")


@query
def folds_grouped_rows(s, d):
    return folds.grouped_kfold(P.orders(s, d), "row_id", "nation").groupBy("fold").agg(F.count("*").alias("n"))


@query
def folds_stratified(s, d):
    return folds.stratified_kfold(P.orders(s, d), "row_id", "status")


@query
def fold_strategies(s, d):
    """Which strategies the orders can bear, with a horizon that is too long for expanding windows, and what is taken instead."""
    p = P.orders(s, d).withColumns({"day": F.dayofmonth("ts"), "rare": F.when(F.col("row_id") % 3 == 0, F.col("status"))})
    return folds.strategies(p, "expanding", period="month", group="nation", part="day", time="ts", label="rare", horizon=100)


@query
def folds_fallback(s, d):
    """Folds by what is taken where one group leaves no folds by groups: days within months."""
    p = P.orders(s, d).withColumns({"day": F.dayofmonth("ts"), "one": F.lit("x")})
    dealt, name, _ = folds.dealt_folds(p, "row_id", "group", group="one", part="day", time="ts")
    return dealt.select("row_id", "fold", "scored", F.lit(name).alias("strategy"))


@query
def folds_expanding(s, d):
    return folds.expanding_blocks(P.orders(s, d), "month", 6)


@query
def holdout_time_tail(s, d):
    return windows.time_tail(P.orders(s, d), "ts", "row_id").select("row_id", "held_out")


@query
def holdout_groups(s, d):
    return folds.holdout_groups(P.orders(s, d), "nation")


@query
def holdout_within_period(s, d):
    return folds.holdout_within_period(P.events(s, d), F.dayofmonth("ts"), 0.3).groupBy("held_out").agg(F.count("*").alias("n"), F.round(F.avg("y"), 4).alias("mean"))


@query
def holdout_latest(s, d):
    return folds.single_holdout(P.orders(s, d), "row_id", "month").groupBy("held_out").agg(F.count("*").alias("n"))


@query
def split_three(s, d):
    return folds.split_three(P.orders(s, d), "row_id").groupBy("part").agg(F.count("*").alias("n"), F.sum("row_id").alias("ids"))


@query
def coarsen_blocks(s, d):
    return folds.coarsen_blocks(P.orders(s, d), "ts")


@query
def earlier_splits(s, d):
    return windows.earlier_splits(P.events(s, d), "ts", "row_id").groupBy("before_80", "before_60").agg(F.count("*").alias("n"), F.sum("row_id").alias("ids"))


# ---- scores, on predictions that both engines can make: out-of-fold group means


def _oof(s, d):
    p = _folded(s, d)
    return p.join(encode.crossfit_mean(p, "row_id", ["segment", "priority"], "y"), "row_id")


def _scored(s, d):
    """Two-class scores with ties: is the status F, judged by the hundreds of the account balance?"""
    return P.orders(s, d).select("row_id", (F.col("status") == "F").alias("pos"), "status", F.round(F.col("acctbal") / 100 + F.when(F.col("status") == "F", 20).otherwise(0), 0).alias("score"))


def _labelled(s, d):
    return P.orders(s, d).select("row_id", "status", F.when(hashed("row_id", "p") % 3 > 0, F.col("status")).otherwise("O").alias("guess"))


@query
def block_mae(s, d):
    return rounded(metrics.block_mae(_oof(s, d), "y", "pred", "month"))


@query
def regression_metrics(s, d):
    return rounded(metrics.regression(_oof(s, d), "y", "pred"))


@query
def confusion_matrix(s, d):
    return rounded(metrics.confusion(_labelled(s, d), "status", "guess"), 6)


@query
def classification_metrics(s, d):
    return rounded(metrics.classification(_labelled(s, d), "status", "guess"), 6)


@query
def roc_auc(s, d):
    return rounded(metrics.roc_auc(_scored(s, d), F.col("pos"), "score"), 6)


@query
def roc_curve(s, d):
    return rounded(metrics.roc_curve(_scored(s, d), F.col("pos"), "score"), 6)


@query
def pr_curve(s, d):
    return rounded(metrics.pr_curve(_scored(s, d), F.col("pos"), "score"), 6)


@query
def log_loss(s, d):
    p = _scored(s, d).withColumn("p", (hashed("row_id", "q") % 1000) / 1000.0)
    return rounded(metrics.log_loss(p, F.col("pos"), "p"), 6)


@query
def residual_summary(s, d):
    return rounded(metrics.residual_summary(_oof(s, d), "y", "pred"))


@query
def residual_quartiles(s, d):
    return rounded(metrics.residual_quartiles(_oof(s, d).withColumn("pred", F.round("pred", 2)), "y", "pred"))


@query
def residual_bias(s, d):
    return rounded(metrics.residual_bias(_oof(s, d), "y", "pred"))


@query
def prediction_quantiles(s, d):
    t, q = P.orders_split(s, d)
    return rounded(metrics.prediction_quantiles({"train": t, "predict": q}, "y"))


@query
def fold_stability(s, d):
    return rounded(metrics.fold_stability(_oof(s, d), "fold", "y", "pred"))


@query
def compare_metrics(s, d):
    o = _oof(s, d)
    mean = o.agg(F.avg("y").alias("m"))
    return rounded(metrics.compare(metrics.regression(o.join(mean), "y", "m"), metrics.regression(o, "y", "pred")))


@query
def class_shares(s, d):
    p = _labelled(s, d)
    return rounded(metrics.class_shares(p, p, "status", "guess"), 6)


@query
def gram_matrix(s, d):
    return rounded(models.gram(_oof(s, d).select(F.col("pred").alias("a"), (F.col("acctbal") * 10).alias("b"), "y"), ["a", "b"], "y").withColumn("value", F.col("value") / 1e9), 4)


def _class_candidates(s, d):
    """Chances of the order's status from other folds' shares by priority and segment, and by nation; label is its code."""
    p = _folded(s, d)
    classes = scores.class_list(p, "status")
    wide = p.select("row_id", (F.array_position(F.array(*map(F.lit, classes)), F.col("status")) - 1).cast("double").alias("label"))
    for name, keys in (("a", ["priority", "segment"]), ("b", ["nation"])):
        wide = wide.join(scores.crossfit_class_shares(p, "row_id", keys, "status", classes).withColumnRenamed("proba", name), "row_id")
    return wide.cache(), models.class_codes(len(classes))


@query
def gram_classes(s, d):
    return rounded(models.gram(_class_candidates(s, d)[0], ["a", "b"], "label"))


@query
def stack_classes(s, d):
    """Two candidates' chances of three classes and their convex stack, judged by f1_macro."""
    wide, codes = _class_candidates(s, d)
    return rounded(models.keep_best(wide, ["a", "b"], "label", "f1_macro", classes=codes), 6)


@query
def baselines(s, d):
    """What a model of the order's value, and one of its status, must beat on later orders."""
    t, q = P.orders_split(s, d)
    t, q = t.cache(), q.cache()
    value = encode.baseline_scores(t, q, "row_id", "y", ["nation", "segment"], ["mae", "rmse"])
    status = encode.baseline_scores(t, q, "row_id", "status", ["nation"], ["accuracy", "f1_macro"], regression=False)
    return rounded(value.unionByName(status), 4)


@query
def target_transforms(s, d):
    """Transforms of the target by name and by order, with gaps and ties, and features that are none."""
    p = P.orders(s, d)
    p = p.withColumns({"y_log": F.col("acctbal"), "steep": F.log("y"), "root": F.when(F.col("row_id") % 7 != 0, F.sqrt("y")), "down": -F.pow("y", F.lit(3.0)), "coarse": F.floor(F.col("y") / 1000)})
    return rounded(checks.target_transforms(p, "y", ["y_log", "steep", "root", "down", "coarse", "acctbal", "gappy"]), 5)


@query
def rank_correlations(s, d):
    p = P.orders(s, d).withColumns({"coarse": F.floor(F.col("acctbal") / 1000), "few": F.length("segment")})
    return rounded(checks.rank_correlations(p, "y", ["coarse", "gappy", "few"]), 6)


@query
def heteroscedasticity(s, d):
    return rounded(metrics.heteroscedasticity(_oof(s, d), "y", "pred"), 6)


@query
def prediction_shift(s, d):
    o = _oof(s, d)
    return rounded(metrics.prediction_shift(o, o, "y", "pred"))


@query
def spread_ranks(s, d):
    """Products of calendar and low-count features, ranked without a target."""
    p = P.orders(s, d).withColumns({"month_no": F.month("ts"), "weekday": F.weekday("ts"), "urgency": F.substring("priority", 1, 1).cast("int"), "digit": F.col("row_id") % 7})
    return rounded(features.ranked_interactions(p, None, ["month_no", "weekday"], ["urgency", "digit"], 3), 6)


@query
def hand_in_types(s, d):
    """Predictions as numbers, as text that are none, and labels of another kind than the sample's."""
    p = P.orders(s, d).select(F.col("y").alias("v"), F.col("status").alias("label"), F.concat(F.lit("~"), F.col("row_id")).alias("odd"))
    parts = [checks.validate_types(p, p, "v"), checks.validate_types(p, p, "odd"), checks.validate_types(p, p.withColumn("label", F.lit(1)), "label", regression=False)]
    return reduce(DataFrame.unionByName, parts)


@query
def keep_best(s, d):
    o = _oof(s, d)
    mean = o.agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("a"), F.avg(F.abs(F.col("y") - F.col("acctbal"))).alias("b"))
    rows = mean.select(F.explode(F.array(F.struct(F.lit("group_mean").alias("candidate"), F.col("a").alias("score"), F.lit(0).alias("ord")), F.struct(F.lit("balance").alias("candidate"), F.col("b").alias("score"), F.lit(1).alias("ord")))).alias("x")).select("x.*")
    return rounded(metrics.best_candidate(rows))


# ---- tasks and checks


@query
def task_infer(s, d):
    a = task.target_facts(P.orders(s, d), "y").select(F.lit("orders.y").alias("what"), "*")
    b = task.target_facts(P.quality(s, d), "y").select(F.lit("quality.y").alias("what"), "*")
    c = task.target_facts(P.orders(s, d), "priority").select(F.lit("orders.priority").alias("what"), "*")
    return a.unionByName(b).unionByName(c)


@query
def candidate_targets(s, d):
    return task.candidate_targets(P.quality(s, d).withColumn("label", F.col("source")), ["y", "lang", "source", "label"])


@query
def value_format(s, d):
    p = P.orders(s, d).withColumn("u", (hashed("row_id", "u") % 100) / 100.0)
    parts = [task.value_format(p, c).select(F.lit(c).alias("column"), "format") for c in ("y", "row_id", "segment", "u")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query
def task_consistency(s, d):
    return task.consistency(P.orders(s, d), "y", "regression", "f1")


@query
def leakage_scan(s, d):
    p = P.orders(s, d)
    p = p.withColumns({"twice": 2 * F.col("y"), "result_code": F.col("acctbal")})
    means = p.groupBy("nation").agg(F.avg("y").alias("nation_profile"))
    p = p.join(means, "nation").cache()
    return rounded(checks.leakage_scan(p, "y", ["twice", "acctbal", "nation_profile", "result_code"], ["nation", "segment"]), 6)


@query
def univariate_strength(s, d):
    p = P.orders(s, d).withColumn("bal", F.round(F.col("acctbal") / 50, 0))
    return rounded(checks.univariate_strength(p, F.col("status") == "F", ["bal", "gappy"]), 6)


@query
def leakage_audit(s, d):
    t, q = P.orders_split(s, d)
    cols = ["priority", "segment", "nation", "status"]
    return checks.leakage_audit(t.select(*cols), q.select(*cols), "y", ["priority", "row_id", "post_code"], scored_on="train")


@query
def schema_check(s, d):
    t, q = P.orders_split(s, d)
    return checks.schema_check(q.drop("y"), "row_id", "y", t)


@query
def prediction_sanity(s, d):
    t, q = P.orders_split(s, d)
    return checks.prediction_sanity(encode.group_mean(t, q, ["nation"], "y"), "pred", t, "y")


@query
def prediction_validate(s, d):
    q = P.orders(s, d).select("row_id", F.col("row_id").alias("ord"), "y")
    bad = q.filter("row_id % 100 <> 3").withColumn("y", F.when(F.col("row_id") % 50 != 7, F.col("y")))
    return checks.validate_table(q, bad, "row_id", "ord", "y")


@query
def worst_verdict(s, d):
    t, q = P.orders_split(s, d)
    return checks.worst(checks.prediction_sanity(encode.group_mean(t, q, ["nation"], "y"), "pred", t, "y").unionByName(checks.schema_check(q, "row_id", "y", t)))


@query
def evaluation_validity(s, d):
    o = _oof(s, d)
    score = o.agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("score"))
    rows = score.select(F.explode(F.array(F.struct(F.lit("baseline_mean").alias("candidate"), F.lit("mae").alias("metric"), F.lit("oof").alias("split"), F.col("score").alias("score")), F.struct(F.lit("other").alias("candidate"), F.lit("f1").alias("metric"), F.lit("train").alias("split"), F.col("score").alias("score")))).alias("x")).select("x.*")
    return checks.evaluation_validity(rows, "regression")


@query
def hierarchy_repair(s, d):
    p = P.shipments(s, d)
    return rounded(repair.repair_hierarchy(p, ["month", "nation"], "flag", "y").select("month", "nation", "flag", "y", "adjusted"), 2)


@query
def clip_predictions(s, d):
    t, q = P.orders_split(s, d)
    b = repair.clip_bounds(t, "y")
    out = repair.clip(q.withColumn("p", F.col("y") * F.when(F.col("row_id") % 10 == 0, -1).when(F.col("row_id") % 10 == 1, 9).otherwise(1)), "p", b)
    return rounded(out.agg(F.avg("p").alias("mean"), F.min("p").alias("low"), F.max("p").alias("high")).join(repair.clip_share(out, "p", b)))


@query
def sanitize_predictions(s, d):
    t, q = P.orders_split(s, d)
    q = q.withColumn("p", F.when(F.col("row_id") % 9 == 0, F.lit(float("inf"))).when(F.col("row_id") % 9 == 1, F.lit(float("nan"))).otherwise(F.col("y")))
    return rounded(repair.sanitize(q, "p", t, "y").agg(F.count("p").alias("n"), F.avg("p").alias("mean")))


@query
def refit_average(s, d):
    o = _oof(s, d)
    frames = [o.select("row_id", (F.col("pred") * k).alias("pred")) for k in (1, 2, 3)]
    return rounded(repair.refit_average(frames, "row_id", "pred"), 2)


# ---- quantiles, classes by chances, features


@query
def exact_quantiles(s, d):
    """Two rounds of slots at least: few rows are put in order at once."""
    p = P.orders(s, d).select("y", "acctbal", "gappy")
    return rounded(quantiles.column_quantiles(p, p.columns, {"q01": 0.01, "q37": 0.37, "q50": 0.5, "q99": 0.99}, slots=64, ordered=500))


@query
def numbered_rows(s, d):
    """Places in a global order with many ties of its leading column."""
    p = P.orders(s, d).select("row_id", "priority", F.to_date("ts").alias("day"))
    by_day = windows.numbered(p, ["day", "row_id"], "by_day", 64)
    return windows.numbered(by_day, ["priority", "day", "row_id"], "by_priority", 64).select("row_id", "by_day", "by_priority")


@query
def class_scores(s, d):
    """Chances of three classes from other folds' shares of the group: one-vs-rest AUC, log loss, and scores of the likeliest."""
    p = P.orders(s, d).withColumn("fold", (hashed("row_id", "s") % 5).cast("int"))
    classes = scores.class_list(p, "status")
    p = p.join(scores.crossfit_class_shares(p, "row_id", ["priority"], "status", classes), "row_id")
    names = ("roc_auc", "log_loss", "accuracy", "f1_macro", "balanced_accuracy")
    one = [scores.score_table(p, m, "status", proba="proba", classes=classes).select(F.lit(m).alias("metric"), "score") for m in names]
    return rounded(reduce(DataFrame.unionByName, one), 6)


@query
def class_chances(s, d):
    t, q = P.orders_split(s, d)
    classes = scores.class_list(t, "status")
    out = scores.class_shares(t, q, ["nation", "segment"], "status", classes)
    return rounded(out.select("row_id", scores.most_likely(F.col("proba"), classes).alias("label"), *[F.element_at("proba", i + 1).alias(f"p_{c}") for i, c in enumerate(classes)]), 6)


@query
def scores_by_metric(s, d):
    o = _oof(s, d)
    one = [scores.score_table(o, m, "y", "pred", block="month").select(F.lit(m).alias("metric"), "score") for m in ("mae", "rmse", "r2", "block_mae")]
    return rounded(reduce(DataFrame.unionByName, one))


@query
def lag_features(s, d):
    return rounded(features.lags(P.shipments(s, d), ["nation", "flag"], "rank", "y", (1, 12)).select("month", "nation", "flag", "y_lag1", "y_lag12"), 2)


@query
def text_target_corr(s, d):
    p = features.target_codes(P.orders(s, d), "priority", "code")
    return rounded(pattern.correlations(p, "code", ["y", "acctbal"], 5), 6)


@query
def prepared_features(s, d):
    """What is fitted to the training side, applied to the rows to predict: medians by group, group statistics, levels."""
    t, q = P.orders_split(s, d)
    kinds = build.Kinds(("gappy", "acctbal"), ("priority", "nation"), "nation", ("segment",))
    out, _ = build.Fitted(t, kinds, target="y", rare=0.05).table(q)
    rare = F.col("`nation=__rare__`").cast("int")
    return rounded(out.select("row_id", "gappy", "acctbal", F.col("tgt_mean__segment").alias("segment_mean"), F.col("tgt_count__segment").alias("segment_count"), F.col("`priority=1-URGENT`").cast("int").alias("urgent"), rare.alias("rare_nation")), 3)


@query
def build_features(s, d):
    """Which columns become features of what kind, and why others do not."""
    t, q = P.orders_split(s, d)
    t = t.withColumns({"outcome_code": F.col("acctbal"), "same": F.lit("x"), "few": (F.col("row_id") % 4).cast("int")})
    q = q.withColumns({"outcome_code": F.col("acctbal"), "same": F.lit("x"), "few": (F.col("row_id") % 4).cast("int")})
    made = build.build_features(t, q, TableSpec("row_id", "y", ("priority", "month"), "ts"), interactions=2)
    rows = [(c, "dropped", r) for c, r in made.dropped.items()] + [(c, "number", None) for c in made.kinds.numbers if "_x_" not in c] + [(c, "category", None) for c in made.kinds.categories]
    ends = made.predict.agg(*[F.count(c).alias(c) for c in made.kinds.numbers if "_x_" not in c]).first()
    return s.createDataFrame([(c, role, why, ends[c] if role == "number" else None) for c, role, why in rows], "column string, role string, reason string, filled long")


@query
def class_sanity(s, d):
    t, q = P.orders_split(s, d)
    return checks.class_sanity(encode.group_mode(t, q, ["nation"], "status"), "pred", t, "status")


@query
def leakage_risk(s, d):
    t, q = P.orders_split(s, d)
    t = t.withColumn("copy", F.col("y") * 2)
    cols = ["priority", "acctbal", "copy", "y"]
    return checks.risk(checks.leakage_audit(t.select(*cols), q.withColumn("copy", F.col("y")).select(*cols), "y", ["priority", "acctbal", "copy"], strength=0.98))


@query
def holdout_matches(s, d):
    p = P.orders(s, d)
    pred = p.select("row_id", F.when(F.col("row_id") % 3 == 0, F.col("y")).otherwise(0.0).alias("p"))
    return rounded(checks.holdout_matches(pred, p, "row_id", "p", "y"), 6)


@query
def output_consistency(s, d):
    p = P.orders(s, d)
    return task.output_consistency("binary", p, "y").unionByName(task.output_consistency("multiclass", p, "status")).unionByName(task.output_consistency("regression", p, "priority"))


@query
def first_of_group(s, d):
    return repair.first_of_group(P.orders(s, d).select("nation", "segment", "ts", "row_id"), ["nation", "segment"], ["ts", "row_id"]).select("nation", "segment", "row_id")


@query
def hand_in(s, d):
    t, q = P.orders_split(s, d)
    given = encode.group_mean(t, q.filter("row_id % 11 <> 0"), ["nation"], "y").select("row_id", F.col("pred").alias("y"))
    return repair.hand_in(q.select("row_id", F.col("row_id").alias("ord")), given, "row_id", "ord", "y", True)


@query
def folds_scored(s, d):
    p = P.orders(s, d)
    return folds.make_folds(p, "row_id", "kfold", scored=p.filter("priority = '1-URGENT'"), k=4)


# ---- models: compared by score, no SQL twin


def _model_frame(s, d):
    p = features.calendar(P.shipments(s, d).withColumn("at", F.to_date(F.concat("month", F.lit("-01")))), "at")
    p = p.withColumns({"row_id": F.concat_ws("|", "month", "nation", "flag"), "label": F.col("y"), "k": F.col("rank").cast("double")})
    p = features.lags(p, ["nation", "flag"], "rank", "y", (1, 12))
    # A missing period is 0 with a flag, so no series and no month drops out.
    lags = {f"lag{n}": F.coalesce(f"y_lag{n}", F.lit(0.0)) for n in (1, 12)} | {f"no_lag{n}": F.col(f"y_lag{n}").isNull().cast("double") for n in (1, 12)}
    names = ["k", "at__month_sin", "at__month_cos", *lags]
    p = models.prepared(p.withColumns(lags).select("row_id", "label", "month", "flag", "nation", *names), names, ["flag"])
    return p.cache()


def _linear(_t=None):
    return models.ridge(1.0, 1000, 100.0)


def _forest(_t=None):
    return models.forest(trees=20)


def _gbt(_t=None):
    return models.boosted(rounds=15, step=0.2)


@query
def oof_linear(s, d):
    p = _model_frame(s, d)
    return rounded(models.out_of_fold(p, folds.expanding_folds(p, "row_id", "month", 6, 3).cache(), "row_id", _linear))


@query
def oof_forest(s, d):
    p = _model_frame(s, d)
    return rounded(models.out_of_fold(p, folds.kfold(p, "row_id", 3).cache(), "row_id", _forest))


@query
def oof_gbt(s, d):
    p = _model_frame(s, d)
    return rounded(models.out_of_fold(p, folds.kfold(p, "row_id", 3).cache(), "row_id", _gbt))


@query
def stack_blend(s, d):
    p = _model_frame(s, d)
    f = folds.kfold(p, "row_id", 3).cache()
    oof = {"linear": models.out_of_fold(p, f, "row_id", _linear), "forest": models.out_of_fold(p, f, "row_id", _forest)}
    wide = relate.align_oof(oof, "row_id", "pred").join(p.select("row_id", "label"), "row_id").cache()
    return rounded(models.keep_best(wide, ["linear", "forest"], "label"))


@query
def tune_random(s, d):
    p = _model_frame(s, d)
    f = folds.kfold(p, "row_id", 2).cache()
    best, score = models.tune(p, f, "row_id", lambda **c: models.forest(**c), {"trees": [5, 10], "leaf": [1, 4]}, models.mae, draws=3)
    return p.agg(F.count("*").alias("rows")).select("rows", *[F.lit(v).alias(k) for k, v in sorted(best.items())], F.lit(round(score, 4)).alias("score"))


@query
def isotonic(s, d):
    p = P.events(s, d).select("row_id", "y", (F.col("y") * 2 + F.col("user_id") / 50).alias("pred"))
    out, used = models.isotonic(p, p, "y", "pred")
    return rounded(out.select("row_id", "pred", F.lit(used).alias("used")))


@query
def ablation(s, d):
    p = _model_frame(s, d).drop("features")
    p = p.withColumn("noise", (hashed("row_id", "n") % 1000) / 1000.0)
    rows = models.ablation(p, folds.kfold(p, "row_id", 2).cache(), "row_id", {"lags": ["lag1", "lag12", "no_lag1", "no_lag12"], "season": ["at__month_sin", "at__month_cos"], "noise": ["noise"]}, lambda _t: models.ridge(), models.mae)
    return s.createDataFrame(rows, "group string, score double, change double, decision string")


def _tree_frame(s, d):
    """Orders with their status as a class and four features, one of them with gaps."""
    label = F.when(F.col("status") == "F", 0.0).when(F.col("status") == "O", 1.0).otherwise(2.0)
    x = [F.month("ts"), F.substring("priority", 1, 1), F.floor(F.col("gappy") / 2500), F.year("ts")]
    return P.orders(s, d).select("row_id", label.alias("label"), F.array(*[c.cast("double") for c in x]).alias("features"))


def _class_shares(out, *names):
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    return rounded(out.select(*names, *[p[k].alias(f"p{k}") for k in range(3)]), 6)


@query
def hist_boosting_round(s, d):
    """A round of boosting for three classes, two levels deep, over all orders: everybody's chances after it."""
    p = _tree_frame(s, d)
    return _class_shares(trees.HistBoosting(3, rounds=1, step=1.0, depth=2).fit(p).transform(p), "row_id")


@query
def oof_hist_boosting(s, d):
    """Chances from trees that were grown on the other folds."""
    p = _tree_frame(s, d)
    f = folds.kfold(p, "row_id", 3).cache()
    out = models.out_of_fold(p, f, "row_id", lambda _t: trees.HistBoosting(3, rounds=4, step=0.1, depth=3), classes=3)
    return rounded(out.select("row_id", "fold", *[F.col("proba")[k].alias(f"p{k}") for k in range(3)]), 6)


@query
def extra_trees_stumps(s, d):
    """Eight extremely randomised trees of one level over all orders: everybody's class shares."""
    p = _tree_frame(s, d)
    return _class_shares(trees.ExtraTrees(3, trees=8, depth=1, leaf=2, tries=2, seed=7).fit(p).transform(p), "row_id")


@query
def text_svd(s, d):
    return rounded(features.text_svd(P.texts(s, d), "text", "row_id", 100, 8).select("row_id", *[F.abs(f"svd{j:02d}").alias(f"svd{j:02d}") for j in range(2)]))


def flagship(s, d):
    """How well does each group's own history predict a month it has not seen?

    Order values joined with customers; months held out in whole; mean by segment and priority of the other folds'
    months, with the overall mean for unseen groups; mean absolute error averaged over months.
    """
    p = P.orders(s, d)
    dealt = folds.grouped_kfold(p, "row_id", "month")
    p = p.join(dealt, "row_id")
    pred = encode.crossfit_mean(p, "row_id", ["segment", "priority"], "y")
    return rounded(p.join(pred, "row_id").groupBy("month", "fold").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae")), 2)


QUERIES["group_history"] = flagship
