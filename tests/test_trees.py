"""Boosting on histograms and extremely randomised trees: against brute force, against MLlib, and on hard rows."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loomtab.operators import folds, models, scores, trees
from loomtab.plans import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "row_id long, label double, features array<double>"


def table(n=1200, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[rng.random((n, 4)) < 0.05] = np.nan
    z = np.nan_to_num(x)
    return x, z[:, 0] * 2 + np.where(z[:, 1] > 0.3, 2, -1) * z[:, 2]


def frame(spark, x, y):
    return spark.createDataFrame([(i, float(v), [None if a != a else float(a) for a in r]) for i, (v, r) in enumerate(zip(y, x, strict=True))], SCHEMA)


def test_a_boosting_split_is_the_best_of_all(spark):
    """The first split of a regression against every split of every feature, missing values on either side."""
    x, y = table(300)
    x = np.round(x, 1)
    model = trees.HistBoosting(rounds=1, step=1.0, depth=1, leaf=5, bins=200).fit(frame(spark, x, y))
    g, best = y.mean() - y, None
    for f in range(4):
        for cut in np.unique(x[:, f][~np.isnan(x[:, f])]):
            for missing_left in (False, True):
                left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= cut)
                if min(left.sum(), (~left).sum()) >= 5:
                    gain = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum()
                    best = max(best or (0,), (gain, left.tolist()))
    out = model.transform(frame(spark, x, y)).orderBy("row_id").collect()
    want = np.where(best[1], y[best[1]].mean(), y[~np.array(best[1])].mean())
    assert np.allclose([r.prediction for r in out], want)


@pytest.mark.parametrize("classes", [0, 2, 3])
def test_both_kinds_learn(spark, classes):
    x, s = table()
    y = s if not classes else (s > 0).astype(float) if classes == 2 else np.digitize(s, [-1, 1]).astype(float)
    d = frame(spark, x, y).cache()
    train, test = d.filter("row_id % 4 > 0"), d.filter("row_id % 4 = 0")
    for maker in (trees.HistBoosting(classes, rounds=11, step=0.3, depth=3), trees.ExtraTrees(classes, trees=18, depth=7, tries=3)):
        model = maker.fit(train)
        got = model.transform(test).toPandas()
        if classes:
            assert (got.prediction == got.label).mean() > (0.8 if classes == 2 else 0.7)
            assert np.allclose([sum(p) for p in got.probability], 1) and model.numClasses == classes
        else:
            assert 1 - ((got.prediction - got.label) ** 2).mean() / got.label.var() > 0.55
    d.unpersist()


def test_histograms_beat_the_boosting_at_hand(spark):
    """Log loss out of fold on the orders of class_scores, two classes and three."""
    p = queries._tree_frame(spark, SF).withColumn("features", F.transform("features", lambda v: F.coalesce(v, F.lit(-9.0))))
    p = p.cache()
    f = folds.kfold(p, "row_id", 2).cache()
    for classes in (2, 3):
        d = p if classes == 3 else p.withColumn("label", (F.col("label") > 0).cast("double"))
        wide = VectorAssembler(inputCols=[f"x{i}" for i in range(4)], outputCol="features").transform(d.select("row_id", "label", *[F.col("features")[i].alias(f"x{i}") for i in range(4)]))
        loss = []
        for frame_, make in ((d, lambda _t, k=classes: trees.HistBoosting(k, rounds=5, step=0.1, depth=3)), (wide, lambda _t, k=classes: models.boosted(False, rounds=5, step=0.1, depth=3, classes=k))):
            out = models.out_of_fold(frame_, f, "row_id", make, classes=classes).withColumn("y", F.col("label").cast("int").cast("string"))
            loss.append(scores.multiclass_log_loss(out, "y", "proba", [str(k) for k in range(classes)]).first()[0])
        assert loss[0] < loss[1]
    p.unpersist()


def test_hard_rows(spark):
    """No rows, one row, no labels, equal labels, constant and missing features, vectors, columns of other names."""
    empty = spark.createDataFrame([], SCHEMA)
    same = spark.createDataFrame([(i, 4.0, [1.0, None]) for i in range(60)] + [(99, None, [7.0, 7.0])], SCHEMA)
    for maker in (trees.HistBoosting(rounds=2), trees.ExtraTrees(trees=2)):
        assert maker.fit(empty).transform(empty).count() == 0
        assert {r.prediction for r in maker.fit(same).transform(same).collect()} == {4.0}
    ones = spark.createDataFrame([(i, float(i % 2), [float(i % 2), float("nan")]) for i in range(200)], SCHEMA).withColumn("prediction_", F.lit("x")).withColumn("k", F.lit(1))
    for maker in (trees.HistBoosting(2, rounds=3, step=0.5), trees.ExtraTrees(2, trees=3, tries=2)):
        out = maker.fit(ones).transform(ones)
        assert out.filter("prediction = label").count() == 200 and out.columns == [*ones.columns, "probability", "prediction"]
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.range(100).select((F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("a"), (F.col("id") % 2).alias("b")))
    out = trees.HistBoosting(2, rounds=1, step=1.0).fit(v).transform(v)
    assert dict(out.dtypes)["features"] == "vector" and out.filter(vector_to_array("probability")[1].between(0, 1)).count() == 100
    assert trees.HistBoosting(3, rounds=1).fit(ones).transform(ones).filter(vector_to_array("probability")[2] > 1e-3).count() == 0  # a class without rows


def test_draws_are_even_and_nodes_try_different_features():
    values = [trees.draw(7, t, n, f) for t in range(20) for n in range(10) for f in range(10)]
    assert 0.45 < sum(values) / len(values) < 0.55 and 0 <= min(values) and max(values) < 1
    assert len({tuple(trees.tried(7, t, 0, 9, 3)) for t in range(50)}) > 30


def test_extra_tree_cuts_lie_between_a_nodes_extremes(spark):
    x, y = table(200)
    model = trees.ExtraTrees(trees=3, depth=4, tries=2, leaf=2).fit(frame(spark, x, y))
    missing = np.isnan(x)
    for tree in model.trees:
        at = tree.places(x, missing)
        assert np.bincount(at)[np.bincount(at) > 0].min() >= 2
        for node in set(at.tolist()):
            assert math.isclose(tree.value[node][0], y[at == node].mean(), abs_tol=1e-9)
    assert len({tuple(t.cut) for t in model.trees}) == 3


@pytest.fixture(scope="module")
def three(spark):
    x, z = table(600, 5)
    y = np.digitize(z, [-1, 1])
    rows = [(i, "abc"[k], float(k), *[float(v) for v in np.nan_to_num(r)], "fg"[i % 2]) for i, (k, r) in enumerate(zip(y, x, strict=True))]
    return spark.createDataFrame(rows, "row_id long, c string, label double, x0 double, x1 double, x2 double, x3 double, g string").cache()


def test_search_over_three_classes(spark, three):
    """Chances are stacked class by class, and judged by the likeliest class at the end."""
    d = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(three)
    train, test = d.filter("row_id % 4 > 0").cache(), d.filter("row_id % 4 = 0").cache()
    f = folds.kfold(train, "row_id", 2).cache()
    families = {"hist": lambda t, rounds=4: trees.HistBoosting(3, rounds=rounds, step=0.3, depth=3), "logistic": lambda t: models.logistic(10.0, 450), "broken": lambda t: None}
    out, told = models.fit_best(train, test, f, "row_id", families, "f1_macro", classes=3)
    names = {r.candidate: r for r in told.collect()}
    assert set(names) == {"hist", "logistic", "stack", "broken"} and names["broken"].error and sum(r.kept for r in names.values()) == 1
    got = out.join(test.select("row_id", "label"), "row_id").collect()
    assert len(got) == 150 and np.mean([r.pred == r.label for r in got]) > 0.6
    assert all(abs(sum(r.proba) - 1) < 1e-6 and r.pred == float(np.argmax(r.proba)) for r in got)
    out, told = models.specialists(train, test, f, "row_id", {"flat": lambda t: models.logistic(1e-6, 450)}, {"trees": {"hist": families["hist"]}}, "log_loss", classes=3)
    assert [s for s, _, _ in told] == ["floor", "trees"] and told[1][1] < told[0][1] and told[1][2]
    assert out.columns == ["row_id", "proba", "pred"]
    with pytest.raises(ValueError):
        models.fit_best(train, test, f, "row_id", families, "f1_macro", classes=3, clipped=True)


def test_one_table_with_labels_of_three_classes(spark, three):
    out, told, score = models.one_table(three.drop("label"), "row_id", "c", ["x0", "x1", "x2", "g"], {"logistic": lambda t: models.logistic(10.0, 400)}, "accuracy", k=2)
    assert {r.pred for r in out.collect()} <= set("abc") and len(out.first().proba) == 3
    assert score.first()[0] > 0.5 and told.filter("kept").count() == 1


def test_weights_of_chances_are_convex_and_mend_a_bad_candidate(spark):
    dice = np.random.default_rng(2)
    rows = []
    for i in range(200):
        k = int(dice.integers(3))
        good, bad = dice.dirichlet(np.eye(3)[k] * 6 + 1), dice.dirichlet(np.ones(3))
        rows.append((i, float(k), good.tolist(), bad.tolist()))
    d = spark.createDataFrame(rows, "row_id long, label double, good array<double>, bad array<double>")
    w = models.stack_weights(d, ["good", "bad"], "label")
    assert abs(sum(w.values()) - 1) < 1e-9 and min(w.values()) >= 0 and w["good"] > 0.8
    g = {(r.a, r.b): r.value for r in models.gram(d, ["good", "bad"], "label").collect()}
    a, b, y = (np.array([r[i] for r in rows]) for i in (2, 3, 1))
    assert np.isclose(g["good", "bad"], (a * b).sum()) and np.isclose(g["bad", "target"], b[np.arange(200), y.astype(int)].sum())
    both = models.stacked(d, {"good": 0.25, "bad": 0.75}).orderBy("row_id").collect()
    assert np.allclose([r.stack for r in both], 0.25 * a + 0.75 * b)
