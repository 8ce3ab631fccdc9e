"""Leakage, scores, tasks and metrics on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from loomtab.operators import checks, features, metrics, models, pattern, profile, task


@pytest.fixture(scope="module")
def panel(spark):
    dice = random.Random(1)
    rows = [(i, f"g{i % 20}", (i % 20) + dice.gauss(0, 1), dice.gauss(0, 1)) for i in range(600)]
    return spark.createDataFrame(rows, "row_id int, g string, y double, benign_noise double").cache()


def test_clean_features_pass_and_transforms_are_caught(panel):
    assert checks.leakage_scan(panel, "y", ["benign_noise"], ["g"]).count() == 0
    found = checks.leakage_scan(panel.withColumn("twice", 2 * F.col("y")), "y", ["twice", "benign_noise"], ["g"]).collect()
    assert [r.column for r in found] == ["twice"]


def test_a_disguised_group_mean_is_caught_below_any_correlation_limit(spark):
    dice = random.Random(2)
    df = spark.createDataFrame([(f"r{i % 40}", (i % 40) * 0.2 + dice.gauss(0, 5)) for i in range(1200)], "region string, y double")
    df = df.join(df.groupBy("region").agg(F.avg("y").alias("region_profile"), F.avg(F.length("region") * 1.0).alias("plain")), "region")
    assert abs(df.select(F.corr("y", "region_profile")).first()[0]) < 0.98
    found = checks.leakage_scan(df, "y", ["region_profile", "plain"], ["region"]).collect()
    assert [r.column for r in found] == ["region_profile"]


def test_outcome_words_match_whole_words(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "row_id int, postal_code int, post_value int, y int")
    got = {r.column: r.reason for r in features.choose_columns(df, df, "y", "row_id").collect()}
    assert got["postal_code"] is None and got["post_value"] and got["y"] == "target" and got["row_id"] == "row id"


def test_auc_is_exact_with_ties(spark):
    dice = random.Random(3)
    rows = [(dice.random() < 0.4, round(dice.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "pos boolean, s double")
    pairs = [(a > b) + 0.5 * (a == b) for p, a in rows if p for q, b in rows if not q]
    assert metrics.roc_auc(df, F.col("pos"), "s").first().auc == pytest.approx(sum(pairs) / len(pairs))
    assert metrics.roc_auc(df.filter("pos"), F.col("pos"), "s").first().auc is None


def test_block_mae_counts_blocks_alike_and_keeps_the_null_block(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", 1.0, 0.0), ("b", 3.0, 0.0), (None, 5.0, 0.0)], "b string, y double, p double")
    assert metrics.block_mae(df, "y", "p", "b").first().score == pytest.approx(3.0)


def test_best_candidate_needs_a_strict_gain(spark):
    scores = spark.createDataFrame([("floor", 1.0, 0), ("same", 1.0 - 1e-12, 1), ("worse", 2.0, 2)], "candidate string, score double, ord int")
    assert metrics.best_candidate(scores).first().candidate == "floor"
    assert metrics.best_candidate(scores, greater=True).first().candidate == "worse"


def test_task_kinds(spark):
    def kind(values, t):
        return task.target_facts(spark.createDataFrame([(v,) for v in values], f"y {t}"), "y").first().kind

    assert kind([0, 1, None, 1], "int") == "binary"
    assert kind([1, 2, 3], "int") == "multiclass"
    assert kind([0.5, 1.0, 2.0], "double") == "regression"
    assert kind(list(range(40)), "int") == "regression"
    assert kind(["a", "b", "c"], "string") == "multiclass"


def test_resolve_task_keeps_to_the_data(spark):
    df = spark.createDataFrame([(float(i) / 3,) for i in range(40)], "y double")
    assert task.resolve_task(df, "y", stated="binary").kind == "regression"
    assert task.resolve_task(df, "y", metric="f1", block="b").metric == "block_mae"


def test_imbalance_is_flagged(spark):
    df = spark.createDataFrame([(int(i < 10),) for i in range(100)], "y int")
    assert all(r.imbalanced and r.majority_rate == 0.9 for r in profile.class_distribution(df, "y").collect())


def test_rare_levels_fold_and_unseen_ones_too(spark):
    df = spark.createDataFrame([("A",)] * 300 + [("B",)] * 200 + [(f"s{i}",) for i in range(100)], "c string")
    levels = features.level_map(df, "c")
    assert {r.level for r in levels.collect()} == {"A", "B", "__rare__"}
    new = spark.createDataFrame([("A",), ("zzz",), (None,)], "c string")
    assert sorted(str(r.c) for r in features.fold_levels(new, levels, "c").collect()) == ["A", "None", "__rare__"]


def test_interaction_signal_ranks_first(spark):
    dice = random.Random(4)
    rows = [(h := dice.randrange(24), *[dice.randrange(3) for _ in range(8)], s := dice.randrange(2), 4 * h * s + dice.gauss(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "t__hour int, " + ", ".join(f"lc{i} int" for i in range(8)) + ", lc_signal int, y double")
    got = [r.pair for r in features.interaction_ranks(df, "y", ["t__hour"], [f"lc{i}" for i in range(8)] + ["lc_signal"]).collect()]
    assert len(got) == 6 and got[0] == "t__hour_x_lc_signal"


def test_weekend_and_null_times(spark):
    df = spark.createDataFrame([("2023-01-07",), ("2023-01-02",), (None,)], "s string").select(F.to_date("s").alias("d"))
    assert [r.d__weekend for r in features.calendar(df, "d").orderBy("d").collect()] == [None, 0, 1]


def test_autocorrelation_skips_gaps(spark):
    values = [1.0, 3.0, 2.0, 5.0, 4.0, 6.0, 8.0, 7.0]
    rows = [("a", k, v) for k, v in enumerate(values) if k != 3]
    got = pattern.autocorrelation(spark.createDataFrame(rows, "g string, k int, y double"), ["g"], "k", "y", (1,)).first()
    import numpy as np

    kept = dict((k, v) for _, k, v in rows)
    pairs = [(kept[k], kept[k + 1]) for k in kept if k + 1 in kept]
    assert got["mean"] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1])


def test_out_of_fold_covers_each_row_once(spark, panel):
    df = models.prepared(panel.withColumn("label", F.col("y")), ["benign_noise"], ["g"]).select("row_id", "label", "features")
    from loomtab.operators import folds

    f = folds.kfold(df, "row_id", 3)
    oof = models.out_of_fold(df, f, "row_id", lambda t: models.ridge(1.0, t.count()))
    assert oof.count() == 600 and oof.select("row_id").distinct().count() == 600
    assert models.mae(oof) < 2


def test_isotonic_only_mends_predictions_far_too_high(spark):
    df = spark.createDataFrame([(float(i), float(3 * i)) for i in range(1, 200)], "y double, pred double")
    out, used = models.isotonic(df, df, "y", "pred")
    assert used and out.agg(F.max(F.abs(F.col("y") - F.col("pred")))).first()[0] < 1e-6
    assert not models.isotonic(df.withColumn("pred", F.col("y")), df, "y", "pred")[1]


def test_transforms_of_the_target(spark):
    """By name in any spelling, by order with gaps and ties; nothing clean, constant or empty."""
    import math

    rows = [(i, float(i % 37 + 1), math.log(i % 37 + 1), None if i % 3 else -((i % 37) ** 3.0), float(i * 7919 % 101), 1.0, None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, price double, logged double, fallen double, other double, same double, none double").withColumns({"sqrtPrice": F.lit(1.0), "price_z": F.lit("x"), "priced": F.lit(2.0)})
    got = {r.column: (r.reason.split()[0], r.value) for r in checks.target_transforms(df, "price", [c for c in df.columns if c != "id"]).collect()}
    assert got == {"sqrtPrice": ("named", None), "price_z": ("named", None), "logged": ("rises", 1.0), "fallen": ("rises", -1.0)}
    assert {r.column for r in checks.leakage_scan(df, "price", ["logged", "other"], [], transforms=True).collect()} == {"logged"}
    assert checks.target_transforms(df.limit(0), "price", ["logged"]).count() == 0


def test_rank_correlation_against_plain_ranks(spark):
    import numpy as np
    import pandas as pd

    dice = np.random.default_rng(3)
    x = dice.integers(0, 9, 700).astype(float)
    y = x + dice.normal(0, 5, 700)
    x[:50] = np.nan
    got = checks.rank_correlations(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "y", ["x"]).first().rho
    p = pd.DataFrame({"x": x, "y": y}).dropna()
    assert abs(got - p.x.rank().corr(p.y.rank())) < 1e-12


def test_baselines_of_odd_tables(spark):
    """Draws follow the shares, reruns agree; no known labels, one class, unseen groups."""
    from loomtab.operators import encode, task

    train = spark.createDataFrame([(i, "abc"[min(2, i % 10 // 4)], "g") for i in range(1000)] + [(2000, None, "g")], "i long, c string, g string")
    drawn = [r.pred for r in encode.stratified_draws(train, train.withColumn("i", F.col("i") + 5000), "i", "c").orderBy("i").collect()]
    assert drawn == [r.pred for r in encode.stratified_draws(train.repartition(3), train.withColumn("i", F.col("i") + 5000), "i", "c").orderBy("i").collect()]
    assert abs(drawn.count("a") / len(drawn) - 0.4) < 0.06 and abs(drawn.count("c") / len(drawn) - 0.2) < 0.06
    none = train.filter("c IS NULL")
    assert {r.pred for r in encode.stratified_draws(none, train, "i", "c").collect()} == {None}
    rows = encode.baseline_scores(train, train.withColumn("g", F.lit("new")), "i", "c", ["g"], ["accuracy"], regression=False).collect()
    assert {r.baseline for r in rows} == {"most_frequent", "stratified", "group_mode"} and {r.score for r in rows if r.baseline != "stratified"} == {0.4}
    many = spark.range(1500).select(F.concat(F.lit("k"), "id").alias("c"))
    with pytest.raises(ValueError):
        task.resolve_task(many, "c")


def test_warnings_about_tables(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Unnamed: 0` int, a int, _c7 int, b int")
    twice = df.select("a", F.col("b").alias("A"), "b")
    assert {(r.type, r.column) for r in profile.table_warnings(df).collect()} == {("unnamed_column", "Unnamed: 0"), ("unnamed_column", "_c7")}
    assert {(r.type, r.column) for r in profile.table_warnings(twice).collect()} == {("duplicate_column", "A")}
    assert {r.type for r in profile.table_warnings(df.select("a").limit(0)).collect()} == {"zero_rows", "single_column"}


def test_errors_that_grow_and_shifts(spark):
    df = spark.createDataFrame([(float(i), float(i) * (1.5 if i % 2 else 0.5)) for i in range(1, 60)] + [(1.0, None), (None, 2.0)], "y double, p double")
    got = metrics.heteroscedasticity(df, "y", "p").first()
    assert got.n == 59 and got.corr > 0.5 and got.note == "strong"
    few = metrics.heteroscedasticity(df.limit(3), "y", "p").first()
    assert few["corr"] is None and few.note is None
    flat = metrics.heteroscedasticity(df.withColumn("p", F.col("y")), "y", "p").first()
    assert flat["corr"] is None or abs(flat["corr"]) < 1
    assert metrics.prediction_shift(df, df.withColumn("p", F.col("y") + 3), "y", "p").first().p95_delta == 3.0
    assert metrics.prediction_shift(df.limit(0), df, "y", "p").first().p50_delta is None


def test_types_of_predictions(spark):
    numbers, words = spark.createDataFrame([("1.5",), (None,)], "t string"), spark.createDataFrame([("x",), ("2",)], "t string")
    assert checks.validate_types(numbers, numbers, "t").first().status == "pass"
    bad = checks.validate_types(numbers, words, "t").first()
    assert (bad.status, bad.value) == ("fail", "1")
    assert checks.validate_types(words, words, "t", regression=False).first().status == "pass"
    assert checks.validate_types(words, words.withColumn("t", F.lit(True)), "t", regression=False).first().status == "fail"
    assert checks.validate_types(words.limit(0), words.withColumn("t", F.lit(True)), "t", regression=False).first().status == "pass"
    assert checks.validate_types(words, words, "gone").first().status == "fail"


def test_products_without_a_target(spark):
    df = spark.createDataFrame([(i, i % 3, 7, 1.0) for i in range(30)], "a int, b int, same int, y double")
    by_spread = [r.pair for r in features.ranked_interactions(df, "y", ["a"], ["b", "same"]).collect()]  # the target never varies
    assert by_spread == ["a_x_b", "a_x_same"] and features.ranked_interactions(df, None, ["a"], ["b"], 1).count() == 1
    assert features.ranked_interactions(df.withColumn("y", F.col("a") * F.col("b")), "y", ["a"], ["b"]).first().r > 0.99


def test_columns_that_do_not_vary_do_not_stop_a_scan(spark):
    df = spark.createDataFrame([(i, 1.0, float(i), None, f"g{i % 2}", 0 if i % 2 else 3) for i in range(40)], "k int, same double, y double, none double, g string, b int")
    got = {r.column: r.r for r in pattern.correlations(df, "y", ["same", "k", "none"], 2).collect()}
    assert got.get("same") is None and abs(got["k"] - 1) < 1e-12
    assert {r.pair for r in features.interaction_ranks(df.withColumn("zero", F.lit(0)), "y", ["k"], ["b", "zero"]).collect()} == {"k_x_b"}
    assert {r.column for r in checks.leakage_scan(df, "y", ["same", "k", "none"], ["g"]).collect()} == {"k"}
    assert metrics.residual_bias(df.withColumn("p", F.lit(3.0)), "y", "p").first()["spread_corr"] is None
