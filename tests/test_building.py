"""Quantiles, orders, feature building, scores by metric and model search: small tables, known answers."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.operators import build, checks, encode, features, folds, models, quantiles, relate, repair, scores, task, text, windows
from loomtab.spec import TableSpec


@pytest.mark.parametrize("seed", range(6))
def test_exact_quantiles_of_odd_columns(spark, seed):
    dice = random.Random(seed)
    kinds = [lambda: dice.gauss(0, 1), lambda: dice.choice([1.0, 2.0]), lambda: 10 ** dice.uniform(-300, 300), lambda: dice.choice([1e300, -1e300, 0.5, None, float("nan")]), lambda: float(dice.randrange(40)), lambda: dice.choice([float("inf"), -float("inf"), 3.0, 4.0])]
    rows = [tuple(k() for k in kinds) for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(kinds))))
    qs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = quantiles.exact_quantiles(df, df.columns, qs, slots=8, ordered=20)
    for i, c in enumerate(df.columns):
        values = np.sort([r[i] for r in rows if r[i] is not None and not math.isnan(r[i])])
        for q, x in zip(qs, got[c]):
            at = (len(values) - 1) * q
            lo, hi = values[math.floor(at)], values[math.ceil(at)]
            want = lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi
            assert x == want or math.isnan(x) and math.isnan(want)


def test_quantiles_of_empty_and_single_columns(spark):
    df = spark.createDataFrame([(None, 5.0)], "a double, b double")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.1, 0.9]) == {"a": [None, None], "b": [5.0, 5.0]}
    assert quantiles.exact_quantiles(df.limit(0), ["b"], [0.5]) == {"b": [None]}


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "timestamp", "date", "int", "double"])
def test_numbered_agrees_with_sorting(spark, kind):
    dice = random.Random(kind)
    make = {"string": lambda: "".join(dice.choice("abÄz") for _ in range(dice.randint(0, 8))), "timestamp_ntz": lambda: datetime.datetime(2020, 3, dice.randint(28, 30), dice.randint(0, 23), dice.randint(0, 59)), "date": lambda: datetime.date(2020, 1, dice.randint(1, 9)), "int": lambda: dice.randint(-5, 5), "double": lambda: dice.choice([dice.gauss(0, 1), float("inf"), -1.5])}
    make["timestamp"] = make["timestamp_ntz"]
    rows = [(None if dice.random() < 0.1 else make[kind](), i) for i in range(400)]
    df = spark.createDataFrame(rows, f"k {kind}, i long").repartition(3)
    order = sorted(range(400), key=lambda i: (rows[i][0] is None, (rows[i][0].encode() if kind == "string" else rows[i][0]) if rows[i][0] is not None else 0, i))
    got = {r.i: r.n for r in windows.numbered(df, ["k", "i"], "n", 16).collect()}
    assert got == {i: n for n, i in enumerate(order)}
    assert windows.numbered(df.limit(0), ["k", "i"]).count() == 0


def test_no_window_over_all_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("i"), F.expr("timestamp_seconds(id)").alias("t"))
    plan = windows.time_tail(df, "t", "i")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan  # over ranges; and each window over rows has a partition
    assert all("[__r" in line or "__r#" in line for line in plan.split("\n") if "row_number()" in line)


def test_scores_by_metric(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.6), (0, 0.6), (1, 0.4)], "label int, pred double")
    got = {m: scores.scorer(m)(df) for m in ("roc_auc", "log_loss", "accuracy", "f1", "mae", "rmse")}
    assert got["roc_auc"] == pytest.approx(4.5 / 6) and got["accuracy"] == pytest.approx(0.6) and got["f1"] == pytest.approx(2 / 3)
    assert got["log_loss"] == pytest.approx(-np.mean(np.log([0.9, 0.8, 0.6, 0.4, 0.4])))
    assert scores.is_better("mae", 1.0, 2.0) and not scores.is_better("roc_auc", 0.5, 0.6) and not scores.is_better("mae", None, 1.0)
    with pytest.raises(ValueError):
        scores.score_table(df, "nonsense")


def test_chances_over_the_full_class_list(spark):
    df = spark.createDataFrame([("a", [0.2, 0.8])], "label string, p array<double>")
    assert df.select(scores.aligned(F.col("p"), ["a", "c"], ["a", "b", "c"]).alias("x")).first().x == [0.2, 0.0, 0.8]
    assert df.select(scores.most_likely(F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2)), ["a", "b", "c"])).first()[0] == "a"
    two = [spark.createDataFrame([(1, [a, 1 - a])], "i int, proba array<double>") for a in (0.2, 0.6)]
    assert scores.mean_chances(two, "i").first().proba == pytest.approx([0.4, 0.6])
    wide = spark.createDataFrame([(1.0, 0.0, 2.2), (2.0, 3.1, 1.0)], "label double, a double, b double")
    _, score = scores.top_two(wide, [("a", 1.05), ("b", 1.1)], "mae")
    assert score == pytest.approx(0.075)
    assert scores.top_two(wide, [("a", 1.0), ("b", 2.0)], "mae")[1] is None


def test_sanity_of_scores_and_formats():
    say = {r[2]: r[1] for r in checks.score_sanity("accuracy", 0.9, baseline=0.5, cv=0.7, clipped=0.2, matches_truth=1.0)}
    assert say == {"out-of-fold too good": "warn", "clipped share": "warn", "holdout equals truth": "fail", "lift over baseline": "pass"}
    assert {r[2]: r[1] for r in checks.score_sanity("mae", 3.0, baseline=2.0, corr=0.5)} == {"out-of-fold too good": "pass", "lift over baseline": "warn"}
    assert (task.forced_kind("binary", "float"), task.forced_kind("regression", "int"), task.forced_kind("regression", "string")) == ("regression", None, "multiclass")


@pytest.fixture(scope="module")
def panel(spark):
    dice = random.Random(2)
    rows = []
    for i in range(240):
        g, day = dice.choice("abc"), datetime.date(2021, 1, 1) + datetime.timedelta(days=i)
        x = dice.gauss(0, 1)
        rows.append((i, str(day), g, x if i % 9 else None, dice.randint(0, 3), 10.0 + 3 * x + "abc".index(g) * 4 + dice.gauss(0, 0.3)))
    return spark.createDataFrame(rows, "row_id long, day string, g string, x double, k int, y double").cache()


def test_build_features_and_preparation(spark, panel):
    train, predict = panel.filter("row_id < 200"), panel.filter("row_id >= 200").drop("y", "k")
    spec = TableSpec("row_id", "y", ("g", "day"), "day")
    assert build.time_sources(train, spec)[0] == "day" and "y" not in build.time_sources(train, spec)
    assert build.unshared_keys(predict, train, ["g", "day"]) == ["day"]
    made = build.build_features(train, predict, spec, interactions=2)
    assert made.dropped["day"] == "values that predict does not share" and made.dropped["y"] == "target" and made.dropped["k"] == "absent from predict"
    assert "day__month" in made.kinds.numbers and made.kinds.categories == ("g",) and made.kinds.keys == ("g",)
    fitted = build.Fitted(made.train, made.kinds, standardise=True, target="y")
    table, names = fitted.table(made.predict)
    assert table.filter("x IS NULL").count() == 0 and {"tgt_mean__g", "g=a", "g=__rare__"} <= set(names)
    assert fitted.transform(made.predict).select("features").first().features.size == len(names)
    means = fitted.table(made.train)[0].agg(F.avg("x"), F.stddev_pop("x")).first()
    assert means[0] == pytest.approx(0, abs=1e-9) and means[1] == pytest.approx(1)
    only = build.Fitted(train.filter("g <> 'c'"), build.Kinds((), ("g",)), target="y").table(train)[0]
    assert only.filter("`g=__rare__` = 1").select("g").distinct().collect()[0].g == "c"


def test_preparation_sees_training_rows_only(spark, panel):
    df = panel.withColumn("label", F.col("y"))
    seen = []
    prepare = build.preparer(build.Kinds(("x",), ("g",), "g"), custom=lambda t, v: (seen.append((t.count(), v.count())) or t, v))
    oof = models.out_of_fold(df, folds.kfold(df, "row_id", 3).cache(), "row_id", lambda t: models.ridge(1.0, 200, 4.0), prepare)
    assert len(seen) == 3 and all(a + b == 240 for a, b in seen)
    assert oof.count() == 240 and models.mae(oof) < 1.5


def test_search_by_metric(spark, panel):
    df = panel.withColumn("label", F.exp(F.col("y") / 4)).fillna(0.0, ["x"])
    df = models.prepared(df, ["x", "k"], ["g"]).cache()
    train, predict = df.filter("row_id % 4 > 0"), df.filter("row_id % 4 = 0")
    assert list(models.variants(train, {"ridge": models.ridge})) == ["log1p_ridge", "ridge"]
    f = folds.kfold(train, "row_id", 2).cache()

    def broken(t):
        raise RuntimeError("no such family")

    families = {"ridge": lambda t, alpha=1.0: models.ridge(alpha, 180, 20.0), "broken": broken}
    out, table = models.fit_best(train, predict, f, "row_id", families, "rmse", spaces={"ridge": {"alpha": [0.1, 1.0]}}, skewed=True, clipped=True, calibrated=True)
    rows = {r.candidate: r for r in table.collect()}
    assert out.count() == predict.count() and sum(r.kept for r in rows.values()) == 1
    assert rows["log1p_ridge"].score < rows["ridge"].score and "no such family" in rows["broken"].error
    final, told = models.specialists(train, predict, f, "row_id", {"flat": lambda t: models.ridge(1e9, 180, 20.0)}, {"linear": {"elastic": lambda t: models.elastic_net(0.01, 0.2, 20.0)}}, "mae")
    assert [t[0] for t in told] == ["floor", "linear"] and told[1][1] < told[0][1] and told[1][2] and final.count() == predict.count()


def test_two_classes_end_to_end(spark, panel):
    df = panel.withColumn("c", (F.col("y") > 14).cast("int")).drop("y")
    out, table, score = models.one_table(df, "row_id", "c", ["x", "g"], {"logistic": lambda t: models.logistic(1.0, 150)}, "roc_auc", k=2)
    assert table.filter("kept").count() == 1 and score.first()[0] > 0.9 and out.filter("pred BETWEEN 0 AND 1").count() == out.count()
    oof = df.select("row_id", F.col("c").cast("double").alias("label"), (F.col("x") * 3).alias("raw")).fillna(0.0)
    assert models.sigmoid(oof, oof, "label", "raw").filter("p > 0 AND p < 1").count() == 240


def test_chances_of_classes_a_fold_has_not_seen(spark, panel):
    df = models.prepared(panel.fillna(0.0, ["x"]).withColumn("label", F.when(F.col("g") == "c", 2.0).otherwise((F.col("x") > 0).cast("double"))), ["x", "k"]).cache()
    f = df.select("row_id", F.when(F.col("g") == "c", 0).otherwise(1).alias("fold"))  # fold 0 holds all of class 2
    oof = models.out_of_fold(df, f, "row_id", lambda t: models.logistic(1.0, 100), classes=3)
    assert oof.filter("fold = 0").filter("size(proba) = 3 AND proba[2] = 0").count() == f.filter("fold = 0").count()
    tree = models.out_of_fold(df, folds.kfold(df, "row_id", 2).cache(), "row_id", lambda t: models.forest(False, trees=3), classes=3)
    assert tree.select(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x).alias("s")).filter("abs(s - 1) < 1e-6").count() == 240


def test_refits_and_small_operators(spark, panel):
    df = models.prepared(panel.fillna(0.0, ["x"]).withColumn("label", F.col("y")), ["x", "k"]).cache()
    mean = models.final_fit(df, df, "row_id", lambda seed: models.full_sample_forest(trees=3, seed=seed), seeds=(1, 2))
    assert mean.count() == 240 and mean.agg(F.avg("pred")).first()[0] == pytest.approx(df.agg(F.avg("label")).first()[0], rel=0.1)
    assert relate.join_keys([panel.select("row_id", "g", "k"), panel.select("row_id", "g", "y")], "row_id", "y", ["k"]) == ["g", "k"]
    wide = spark.createDataFrame([(1.0, 2.0, 3.0)], "a_x_b double, c double, d_x_e double")
    ranks = spark.createDataFrame([("a_x_b_x_c", 1.0), ("c_x_d_x_e", 0.5)], "pair string, r double")
    assert features.add_interactions(wide, ranks).select("a_x_b_x_c", "c_x_d_x_e").first() == (2.0, 6.0)
    assert folds.block_values(panel, "g") == ("g", None) and folds.block_values(panel, "row_id") is None
    assert folds.block_values(panel, "day") == ("day", "day") or folds.block_values(panel, "day")[1] in ("week", "month")
    assert folds.target_ready(panel, "y").count() == 240
    with pytest.raises(ValueError):
        folds.target_ready(panel.limit(3), "y")
    labels = spark.createDataFrame([("no",), ("Yes",), ("zz",)], "label string")
    assert features.positive_label(labels).first()[0] == "Yes" and features.positive_label(labels, ("no",)).first()[0] == "no"
    first = repair.first_of_group(panel, ["g"], ["row_id"]).select("g", "row_id").toPandas()
    assert dict(zip(first.g, first.row_id)) == panel.toPandas().groupby("g").row_id.min().to_dict()


def test_value_strength_and_ablation_by_metric(spark, panel):
    strong = {r.column: r.strength for r in checks.value_strength(panel, "y", ["x", "k"]).collect()}
    assert strong["x"] > 0.5 > strong["k"]
    two = {r.column: r.strength for r in checks.value_strength(panel.withColumn("c", F.col("y") > 14), "c", ["x", "k"]).collect()}
    assert two["x"] > 0.6 and 0.5 <= two["k"] < 0.65
    df = panel.fillna(0.0, ["x"]).withColumn("label", F.col("y"))
    rows = models.ablation(df, folds.kfold(df, "row_id", 2).cache(), "row_id", {"x": ["x"], "k": ["k"]}, lambda t: models.ridge(1.0, 100, 4.0), scores.scorer("r2"), metric="r2", only=["x"])
    assert [(r[0], r[3]) for r in rows] == [("x", "keep")] and rows[0][2] < -0.1


def brute_quantile(values, q):
    values = sorted(values)
    if not values:
        return None
    at = (len(values) - 1) * q
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    return lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi


@pytest.mark.parametrize("hot, slots", [(1_000_000, 256), (30, 8), (0, 4)])
def test_group_quantiles_in_small_groups_and_hot_ones(spark, hot, slots):
    """Null keys, ties, missing numbers, a group that holds a third of all rows; whole groups and all but one fold."""
    dice = random.Random(hot)
    rows = [(dice.choice(["hot", "hot", "a", "b", None, dice.choice("cdefgh")]), dice.randrange(3), dice.choice([None, 1.0, 2.0, dice.gauss(0, 9)]), dice.uniform(0, 1)) for _ in range(700)]
    rows += [("alone", 1, 5.0, 6.0), ("missing", 1, None, 2.0)]
    df = spark.createDataFrame(rows, "g string, fold int, x double, y double")
    qs = {"low": 0.1, "mid": 0.5, "top": 1.0}
    got = {(r.g, r.column): (r.low, r.mid, r.top) for r in quantiles.group_quantiles(df, ["g"], ["x", "y"], qs, hot=hot, slots=slots).collect()}
    want = {(g, c): tuple(brute_quantile([r[i] for r in rows if r[0] == g and r[i] is not None], q) for q in qs.values()) for g in {r[0] for r in rows} for i, c in ((2, "x"), (3, "y"))}
    assert got == {k: v for k, v in want.items() if v[0] is not None}
    got = {(r.g, r.column, r.fold): (r.low, r.mid, r.top) for r in quantiles.group_quantiles(df, ["g"], ["x"], qs, "fold", [0, 1, 2], hot=hot, slots=slots).collect()}
    want = {(g, "x", f): tuple(brute_quantile([r[2] for r in rows if r[0] == g and r[1] != f and r[2] is not None], q) for q in qs.values()) for g in {r[0] for r in rows} for f in range(3)}
    assert got == {k: v for k, v in want.items() if k[0] != "missing"}
    assert quantiles.group_quantiles(df.limit(0), ["g"], ["x"], qs, hot=hot, slots=slots).count() == 0


def test_crossfit_statistics_of_odd_rows(spark):
    """Groups in one fold only, rows without a fold or a number, null keys, against plain sums."""
    dice = random.Random(8)
    rows = [(i, dice.choice(["a", "b", None, f"own{i}"]), dice.choice([0, 1, 2, None]), dice.choice([None, dice.gauss(5, 2), 3.0])) for i in range(300)]
    got = {r.i: r for r in encode.crossfit_statistics(spark.createDataFrame(rows, "i long, g string, fold int, y double"), "i", ["g"], "y").collect()}
    assert len(got) == 300
    for i, g, f, _ in rows:
        own = [r[3] for r in rows if r[1] == g and r[3] is not None and (r[2] != f if f is not None else r[2] is not None)]
        every = [r[3] for r in rows if r[3] is not None and (r[2] != f if f is not None else r[2] is not None)]
        y, r = own or every, got[i]
        assert r["count"] == len(own) and (r["min"], r["max"]) == (min(y), max(y))
        assert np.allclose([r["mean"], r["std"]], [np.mean(y), np.std(y, ddof=1) if len(y) > 1 else 0.0], atol=1e-7)
        if f is not None:
            assert np.allclose([r["q25"], r["median"], r["q75"]], [brute_quantile(y, q) for q in (0.25, 0.5, 0.75)])


def test_large_columns_are_narrowed_in_rounds(spark):
    dice = np.random.default_rng(3)
    v = np.concatenate([dice.lognormal(0, 8, 3000), np.full(500, 2.0), [np.inf, -np.inf]])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    qs = [0.001, 0.3, 0.5, 0.999]
    assert quantiles.exact_quantiles(df, ["v"], qs, slots=16, ordered=40)["v"] == [brute_quantile(v.tolist(), q) for q in qs]


def _texts(n=240):
    dice = random.Random(6)
    themes = [["ship", "harbour", "sail", "sea"], ["oven", "bread", "flour", "yeast"], ["court", "judge", "law", "trial"]]
    rows = []
    for i in range(n):
        words = [dice.choice(themes[i % 3]) for _ in range(dice.randint(3, 12))] + [dice.choice(["the", "and", "of"]) for _ in range(4)]
        rows.append((i, float(i % 3), None if i % 50 == 49 else " ".join(words), dice.gauss(0, 1), f"id{i}"))
    return rows


def test_text_directions_span_the_leading_space(spark):
    """Against the singular vectors of numpy, on the training rows' own weights; other rows only take what was learnt."""
    rows = _texts()
    df = spark.createDataFrame(rows, "row_id long, label double, words string, x double, code string").repartition(3)
    p = text.TextProjector(df, "words", "row_id", terms=60, k=4, passes=8)
    full = np.zeros((len(rows), len(p.place)))
    for i, r in enumerate(rows):
        at, w = p.weights(r[2].lower().split() if r[2] else None)
        full[i, at] = w
    assert np.allclose(np.linalg.norm(full, axis=1)[[i for i, r in enumerate(rows) if r[2]]], 1)
    v = np.linalg.svd(full)[2][:3].T
    assert np.linalg.norm(v - p.directions @ (p.directions.T @ v)) < 1e-3  # the leading directions lie in the found space
    got = p.transform(df).orderBy("row_id").collect()
    assert np.allclose([[r[n] for n in p.names()] for r in got], full @ p.directions) and got[49]["words__svd00"] == 0
    strange = spark.createDataFrame([(1, "quantum foam"), (2, None)], "row_id long, words string")
    assert all(r[n] == 0 for r in p.transform(strange).collect() for n in p.names())
    assert text.term_weights(strange, p, "row_id").count() == 0
    none = text.TextProjector(df.limit(0), "words", "row_id", k=3)
    assert none.transform(df).select(none.names()).distinct().count() == 1


def test_fitted_takes_texts(spark):
    """Text becomes directions inside a fold, is found by build_features, and tells the classes apart."""
    df = spark.createDataFrame(_texts(), "row_id long, label double, words string, x double, code string").cache()
    train, test = df.filter("row_id % 3 > 0 OR row_id % 4 > 0"), df.filter("row_id % 3 = 0 AND row_id % 4 = 0")
    made = build.build_features(train, test, TableSpec("row_id", "label"), interactions=0)
    assert made.kinds.texts == ("words",) and "words" not in made.kinds.categories and "code" in made.dropped
    fitted = build.Fitted(train, build.Kinds(numbers=("x",), texts=("words",)), row_id="row_id", directions=3)
    out, names = fitted.table(test)
    assert names == ["x", "words__svd00", "words__svd01", "words__svd02"] and out.count() == test.count()
    prepare = build.preparer(build.Kinds(numbers=("x",), texts=("words",)), row_id="row_id", directions=3)
    oof = models.out_of_fold(df, folds.kfold(df, "row_id", 2), "row_id", lambda t: models.logistic(100.0, 120), prepare, classes=3)
    assert oof.filter("pred = label").count() > 0.85 * 240


def test_training_rows_do_not_see_their_own_target(spark):
    """A key that no two rows share tells nothing of a training row, and groups' means leave the row's own fold out."""
    df = spark.createDataFrame([(i, float(i % 2), f"k{i}", 1.0) for i in range(100)], "row_id long, label double, k string, x double")
    train, _ = build.preparer(build.Kinds(("x",), keys=("k",)), row_id="row_id")(df, df)
    first = {float(r.features[1]) for r in train.collect()}
    assert len(first) <= 5 and not first & {0.0, 1.0}  # means of all other folds
    seen, _ = build.preparer(build.Kinds(("x",), keys=("k",)))(df, df)
    assert {float(r.features[1]) for r in seen.collect()} == {0.0, 1.0}
