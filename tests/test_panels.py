"""Single operators on small frames: panels, group statistics, folds, text, keys, hierarchies."""

import random

import pytest
from pyspark.sql import functions as F

from loomtab.operators import encode, folds, models, profile, relate, repair, task, windows


def test_group_statistics_and_unseen_fallback(spark):
    train = spark.createDataFrame([("a", 10.0), ("a", 12.0), ("b", 20.0), ("b", 22.0), ("c", 30.0)], "g string, y double")
    new = spark.createDataFrame([("a",), ("b",), ("zzz",)], "g string")
    got = {r.g: (r.tgt_mean__g, r.tgt_count__g) for r in encode.apply_statistics(train, new, ["g"], "y").collect()}
    assert got == {"a": (11.0, 2), "b": (21.0, 2), "zzz": (pytest.approx(18.8), 0)}


def test_crossfit_never_sees_its_own_fold(spark):
    df = spark.createDataFrame([(i, "a", float(i), 0 if i < 5 else 1) for i in range(10)], "row_id int, g string, y double, fold int")
    got = {r.row_id: r["mean"] for r in encode.crossfit_moments(df, "row_id", ["g"], "y").collect()}
    assert got[7] == pytest.approx(2.0) and got[2] == pytest.approx(7.0)


def test_crossfit_quantile_of_the_rest(spark):
    df = spark.createDataFrame([(i, "a", float(i), i % 2) for i in range(6)], "row_id int, g string, y double, fold int")
    got = {r.row_id: r.q for r in encode.crossfit_quantiles(df, "row_id", ["g"], "y", 2).collect()}
    assert got[0] == 3.0 and got[1] == 2.0


def test_grouped_folds_are_disjoint_and_balanced(spark):
    df = spark.createDataFrame([(i, f"g{i % 10}") for i in range(50)], "row_id int, g string")
    rows = folds.grouped_kfold(df, "row_id", "g", 5).join(df, "row_id").collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r.g, set()).add(r.fold)
    assert len(rows) == 50 and all(len(f) == 1 for f in by_group.values())
    assert {sum(r.fold == k for r in rows) for k in range(5)} == {10}


def test_group_folds_keep_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "row_id int, g string")
    assert folds.grouped_kfold(df, "row_id", "g", 2).count() == 3


def test_last_two_of_ten_integer_periods_are_held_out(spark):
    df = spark.createDataFrame([(p,) for p in range(1, 11) for _ in range(20)], "period int")
    assert sorted(r.period for r in windows.latest_periods(df, "period").collect()) == [9, 10]


def test_every_other_day_coarsens_to_whole_periods(spark):
    df = spark.range(180).select(F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") * 2).cast("int")).alias("d"))
    assert [r.unit for r in folds.coarsen_blocks(df, "d").filter("chosen").collect()] == ["month"]


def test_free_text_is_told_from_categories(spark):
    df = spark.createDataFrame([(f"the quick brown fox number {i} jumps over it", "ab"[i % 2]) for i in range(20)], "txt string, cat string")
    assert {r.column: r.is_text for r in profile.text_columns(df, ["txt", "cat"]).collect()} == {"txt": True, "cat": False}


def test_disjoint_period_is_no_group_key(spark):
    train = spark.createDataFrame([(f"t{i % 10}", f"j{i % 3}", i) for i in range(30)], "period string, jur string, t int")
    predict = spark.createDataFrame([(f"p{i % 2}", f"j{i % 3}", i) for i in range(6)], "period string, jur string, t int")
    assert [r["keys"] for r in relate.group_keys(predict, train, ["period", "jur"]).collect()] == ["jur"]


def test_joins_match_nulls_and_refuse_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "v int, k string")
    right = spark.createDataFrame([("a", 5), (None, 6)], "k string, v int")
    assert {(r.v, r.v_cov) for r in relate.join_covariates(left, right, ["k"]).collect()} == {(1, 5), (2, 6)}
    with pytest.raises(relate.FanOut):
        relate.join_covariates(left, right.union(right), ["k"])


def test_convex_stack_beats_its_best_member(spark):
    dice = random.Random(0)
    rows = [(y, y + dice.gauss(0, 1), y + dice.gauss(0, 1.4), y + dice.gauss(0, 6)) for y in (dice.uniform(0, 10) for _ in range(200))]
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    w = models.stack_weights(df, ["a", "b", "c"], "y")
    assert sum(w.values()) == pytest.approx(1) and min(w.values()) >= 0 and w["a"] > w["c"]
    table = {r.candidate: (r.score, r.kept) for r in models.keep_best(df, ["a", "b", "c"], "y").collect()}
    assert table["stack"][0] < table["a"][0] and table["stack"][1]


def test_hierarchy_parent_is_raised_to_its_largest_child(spark):
    rows = [("p1", "all", 2.0), ("p1", "x", 5.0), ("p1", "y", 1.0), ("p2", "all", 10.0), ("p2", "x", 3.0), ("p2", "y", 4.0)]
    out = repair.repair_hierarchy(spark.createDataFrame(rows, "period string, cat string, p double"), ["period"], "cat", "p").collect()
    assert [(r.period, r.p) for r in out if r.adjusted] == [("p1", 5.0)]


def test_numbering_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(100)], "row_id int, t int")
    a, b = (sorted((r.row_id, r.n) for r in windows.numbered(df.repartition(k), ["t", "row_id"]).collect()) for k in (1, 13))
    assert a == b and sorted(n for _, n in a) == list(range(100))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "row_id int, g string, y double, fold int")
    assert encode.crossfit_moments(df, "row_id", ["g"], "y").count() == 0
    assert folds.stratified_kfold(df, "row_id", "g").count() == 0
    assert profile.duplicates(df).first().duplicates == 0
    assert profile.missing(df).count() == 4


def test_strategies_fall_back_with_reasons(spark):
    """Each strategy where its column bears it; labels too rare or too many; nothing at all in an empty table."""
    rows = [(i, f"p{i % 9}", "ab"[i % 2], i % 4, "xy"[i > 57]) for i in range(60)]
    df = spark.createDataFrame(rows, "i long, p string, g string, d int, c string")

    def told(df, wanted, **options):
        return {r.strategy: (r.feasible, r.reason, r.folds, r.chosen) for r in folds.strategies(df, wanted, **options).collect()}

    got = told(df, "stratified", period="p", group="g", part="d", label="c", horizon=4)
    assert got["expanding"] == (True, None, 2, True) and got["group_holdout"] == (False, "fewer than three groups", None, False)
    assert got["stratified"] == (False, "a label with fewer rows than folds", None, False) and got["time_tail"][1] == "no column for it"
    assert got["kfold"] == (True, None, 5, False) and got["within_period"] == (True, None, 1, False)
    assert told(df, "stratified", label="g", k=3)["stratified"] == (True, None, 3, True)
    assert told(df, "stratified", label="i", most_labels=20)["stratified"][1] == "too many labels"
    assert told(df, "kfold")["kfold"][3] and not any(r[0] or r[3] for r in told(df.limit(0), "kfold", group="g", label="c").values())
    dealt, name, _ = folds.dealt_folds(df, "i", "group_holdout", group="p", period="p")
    assert name == "group_holdout" and {r.fold for r in dealt.collect()} == {0, -1} and dealt.count() == 60
    dealt, name, _ = folds.dealt_folds(df, "i", "stratified", label="c", scored=df.filter("i < 10"))
    assert name == "kfold" and dealt.filter("scored").count() == 10
    with pytest.raises(ValueError, match="no strategy fits"):
        folds.dealt_folds(df.limit(0), "i", "group", group="g")
    with pytest.raises(ValueError):
        folds.strategies(df, "guess")


def test_keys_fall_back_to_what_target_and_template_share(spark):
    target = spark.createDataFrame([], "row_id int, day string, area string, y double")
    weather = spark.createDataFrame([], "day string, rain double")
    offices = spark.createDataFrame([], "office string, staff int")
    template = spark.createDataFrame([], "row_id int, area string, day string, y double")
    assert relate.join_keys([target, weather], "row_id", "y", template=template) == ["day"]
    assert relate.join_keys([target, offices], "row_id", "y", template=template) == ["area", "day"]
    assert relate.join_keys([target, offices], "row_id", "y", ["staff", "y", "nowhere"], template) == ["area", "day", "staff"]
    assert relate.join_keys([target, offices], "row_id", "y") == []


def test_prediction_rows_by_given_common_and_no_keys(spark):
    new = spark.createDataFrame([(1, "a", "u", 0.0), (2, None, "u", 0.0), (3, "b", "w", 0.0)], "row_id int, g string, h string, y double")
    cov = spark.createDataFrame([("a", 5, 9.0), (None, 6, 9.0)], "g string, v int, y double")
    rows, keys = relate.prediction_rows(new, cov, ["h", "g"], "row_id", "y")
    assert keys == ["g"] and rows.columns == ["row_id", "g", "h", "v"] and {(r.row_id, r.v) for r in rows.collect()} == {(1, 5), (2, 6), (3, None)}
    rows, keys = relate.prediction_rows(new, cov, ["elsewhere"], "row_id", "y")
    assert keys == ["g"] and rows.count() == 3
    with pytest.raises(relate.FanOut):
        relate.prediction_rows(new, cov.union(cov), [], "row_id", "y")
    apart = spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "row_id int, v int")
    rows, keys = relate.prediction_rows(new, apart, [], "row_id", "y")
    assert keys == [] and rows.columns == ["row_id", "g", "h"]
    rows, keys = relate.prediction_rows(new, apart, [], "row_id", "y", order="row_id")
    assert keys == [] and {(r.row_id, r.v) for r in rows.collect()} == {(1, 7), (2, 8), (3, 9)}
    assert relate.prediction_rows(new, None, ["g"], "row_id", "y")[0].columns == ["row_id", "g", "h"]


def test_metric_advice(spark):
    df = spark.createDataFrame([(i, int(i < 90), i % 3, i / 7, None) for i in range(100)], "i int, y int, k int, x double, e int")
    got = {c: tuple(task.metric_advice(df, c).first()) for c in ("y", "k", "x", "e")}
    assert got["y"][:3] == ("binary", 0.9, True) and got["y"][4] and got["y"][3].startswith("roc_auc,")
    assert got["k"][:3] == ("multiclass", 0.34, False) and got["k"][4] is None
    assert got["x"] == ("regression", None, False, "rmse,mae,r2", None) and got["e"][1:] == (None, False, None, None)
