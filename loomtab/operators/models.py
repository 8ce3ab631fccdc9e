"""Candidate models on shared folds: out-of-fold predictions, tuning, convex stacking, calibration, ablation.

Models are pyspark.ml estimators; the driver only composes, and solves systems as small as the number of candidates.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.operators.quantiles import exact_quantiles


def prepared(df: DataFrame, numbers: list[str], categories: list[str] = ()) -> DataFrame:
    """df with `features` assembled; numbers must be imputed and categories folded beforehand."""
    stages: list = []
    if categories:
        codes = [f"__c_{c}" for c in categories]
        stages += [StringIndexer(inputCols=list(categories), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=codes, outputCols=[f"{c}_1" for c in codes])]
    stages.append(VectorAssembler(inputCols=[*numbers, *[f"__c_{c}_1" for c in categories]], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(df).transform(df).drop(*[x for c in categories for x in (f"__c_{c}", f"__c_{c}_1")])


def ridge(alpha: float = 1.0, n: int = 1, y_std: float = 1.0) -> Estimator:
    """Ridge with the penalty alpha of the usual closed form: Spark scales by rows and by the label's spread."""
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(labelCol="label", regParam=alpha * y_std / max(n, 1), elasticNetParam=0.0, standardization=False)


def elastic_net(alpha: float = 0.001, l1: float = 0.2, y_std: float = 1.0) -> Estimator:
    from pyspark.ml.regression import LinearRegression

    lam = alpha * l1 + alpha * (1 - l1) * y_std
    return LinearRegression(labelCol="label", regParam=lam, elasticNetParam=alpha * l1 / lam, standardization=False)


def logistic(c: float = 1.0, n: int = 1) -> Estimator:
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(labelCol="label", regParam=1.0 / (c * max(n, 1)))


def forest(regression: bool = True, trees: int = 150, leaf: int = 2, seed: int = 7) -> Estimator:
    from pyspark.ml import classification, regression as reg

    cls = reg.RandomForestRegressor if regression else classification.RandomForestClassifier
    return cls(labelCol="label", numTrees=trees, minInstancesPerNode=leaf, maxDepth=8, seed=seed)


def full_sample_forest(trees: int = 200, seed: int = 7) -> Estimator:
    """Trees on all rows with a square root of the features at each split: the nearest Spark has to extra trees."""
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(labelCol="label", numTrees=trees, minInstancesPerNode=2, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=8, seed=seed)


def boosted(regression: bool = True, rounds: int = 100, step: float = 0.05, depth: int = 4, sample: float = 0.85, seed: int = 7, classes: int = 2) -> Estimator:
    from pyspark.ml import classification, regression as reg

    if regression:
        return reg.GBTRegressor(labelCol="label", maxIter=rounds, stepSize=step, maxDepth=depth, subsamplingRate=sample, seed=seed)
    one = classification.GBTClassifier(labelCol="label", maxIter=rounds, stepSize=step, maxDepth=depth, subsamplingRate=sample, seed=seed)
    return one if classes == 2 else classification.OneVsRest(classifier=one, labelCol="label")


def with_pred(model, df: DataFrame, classes: int = 0) -> DataFrame:
    """df with pred: the prediction, or the chance of class 1 of two. With `classes` also proba: chances of all classes by
    code, 0 for those the model has never seen."""
    out = model.transform(df)
    binary = "probability" in out.columns and getattr(model, "numClasses", 2) == 2
    if classes:
        p = vector_to_array("probability") if "probability" in out.columns else F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == F.col("prediction").cast("int")).cast("double"))
        out = out.withColumn("__p", p).withColumn("proba", F.transform(F.sequence(F.lit(1), F.lit(classes)), lambda i: F.coalesce(F.try_element_at("__p", i), F.lit(0.0)))).drop("__p")
    return out.withColumn("pred", vector_to_array("probability")[1] if binary else F.col("prediction"))


def out_of_fold(
    df: DataFrame,
    folds: DataFrame,
    row_id: str,
    make: Callable[[DataFrame], Estimator],
    prepare: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    transform: str = "none",
    classes: int = 0,
) -> DataFrame:
    """row_id, fold, label, pred (and proba with `classes`) on held-out rows. df: (row_id, label, features...), cached by the
    caller.

    prepare(train, valid) fits what must only see the fold's training rows (encodings, imputation). transform: the label is
    learnt as its log1p or sqrt, and predictions are turned back.
    """
    from loomtab.operators.features import inverted, transformed

    parts = []
    marks = [c for c in ("rank", "scored") if c in folds.columns]
    dealt = df.join(folds.select(row_id, F.col("fold").alias("__fold"), *[F.col(c).alias(f"__{c}") for c in marks]), row_id)
    starts = {r.fold: r.start for r in folds.filter("fold >= 0").groupBy("fold").agg(F.min("rank" if "rank" in marks else F.lit(0)).alias("start")).collect()}
    for fold in sorted(starts):  # a handful of folds
        earlier = F.col("__rank") < starts[fold] if "rank" in marks else F.col("__fold") != fold
        train, valid = dealt.filter(earlier).select(*df.columns), dealt.filter((F.col("__fold") == fold) & (F.col("__scored") if "scored" in marks else F.lit(True))).select(*df.columns)
        if prepare:
            train, valid = prepare(train, valid)
        learnt = transformed(train, "label", transform, "label")
        out = inverted(with_pred(make(learnt).fit(learnt), valid, classes), "pred", transform)
        parts.append(out.select(row_id, F.lit(fold).alias("fold"), "label", "pred", *["proba"] * bool(classes)))
    return reduce(DataFrame.unionByName, parts)


def variants(df: DataFrame, families: dict[str, Callable[[DataFrame], Estimator]], target: str = "label") -> dict[str, tuple[Callable[[DataFrame], Estimator], str]]:
    """(maker, transform) by name: each family, and before it its variant on the transform that the target's skew asks for."""
    from loomtab.operators.features import transform_choice

    how = transform_choice(df, target).first().transform
    skewed = {f"{how}_{n}": (make, how) for n, make in families.items()} if how != "none" else {}
    return skewed | {n: (make, "none") for n, make in families.items()}


def _arrays(df: DataFrame, names: list[str]) -> bool:
    """Are the candidates arrays of chances?"""
    return dict(df.dtypes)[names[0]].startswith("array")


def gram(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """a, b, value: inner products of candidates' predictions and of each with the target; one aggregate. Candidates that are
    arrays of chances are multiplied class by class and summed, the target (a class's code) being 1 at its own class."""
    pairs = [(a, b) for i, a in enumerate(names) for b in [*names[i:], target]]

    def product(a: str, b: str):
        if not _arrays(df, names):
            return F.col(a) * F.col(b)
        if b == target:
            return F.element_at(F.col(a), F.col(b).cast("int") + 1)
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)

    one = df.agg(*[F.sum(product(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit("target" if b == target else b).alias("b"), F.col(f"p{i}").alias("value")) for i, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def nnls(g: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Weights w >= 0 that minimise w'gw - 2c'w, by trying supports from large to small: k is a handful."""
    from itertools import combinations

    k, best, found = len(c), 0.0, np.zeros(len(c))
    for size in range(1, k + 1):
        for support in map(list, combinations(range(k), size)):
            w = np.linalg.lstsq(g[np.ix_(support, support)], c[support], rcond=None)[0]
            value = w @ g[np.ix_(support, support)] @ w - 2 * c[support] @ w
            if (w >= 0).all() and value < best - 1e-12:
                best, found = value, np.zeros(k)
                found[support] = w
    return found


def stack_weights(df: DataFrame, names: list[str], target: str) -> dict[str, float]:
    """Convex weights of candidates from their Gram matrix; equal ones where the solve fails. At most 12 candidates."""
    if len(names) > 12:
        raise ValueError("stack the best few candidates")
    cells = {(r.a, r.b): r.value or 0.0 for r in gram(df, names, target).collect()}
    g = np.array([[cells.get((a, b), cells.get((b, a))) for b in names] for a in names], float)
    w = nnls(g, np.array([cells[a, "target"] for a in names], float))
    w = w / w.sum() if w.sum() > 0 else np.full(len(names), 1 / len(names))
    return dict(zip(names, w.tolist(), strict=True))


def stacked(df: DataFrame, weights: dict[str, float], out: str = "stack") -> DataFrame:
    """df with the weighted sum of candidates: numbers, or arrays of chances class by class."""
    if not _arrays(df, list(weights)):
        return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(n) * w for n, w in weights.items()]))

    def scaled(n: str, w: float):
        return F.transform(n, lambda x: x * w)

    parts = [scaled(n, w) for n, w in weights.items()]
    return df.withColumn(out, reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts))


def keep_best(df: DataFrame, names: list[str], target: str, metric: str = "mae", **options) -> DataFrame:
    """candidate, score, kept: singles and their convex stack by a metric; the stack must beat the best single strictly.
    Chances over several classes take `classes`, the labels of the codes in the target."""
    from loomtab.operators.metrics import best_candidate
    from loomtab.operators.scores import GREATER, score_table

    wide = stacked(df, stack_weights(df, names, target))
    how = (lambda n: {"proba": n, **options}) if _arrays(df, names) else (lambda n: {"pred": n, **options})
    scores = [score_table(wide, metric, target, **how(n)).select(F.lit(n).alias("candidate"), F.col("score").cast("double").alias("score"), F.lit(i).alias("ord")) for i, n in enumerate([*names, "stack"])]
    rows = reduce(DataFrame.unionByName, scores)
    best = best_candidate(rows, metric in GREATER).select(F.col("candidate").alias("best"))
    return rows.join(best, how="cross").select("candidate", "score", (F.col("candidate") == F.col("best")).alias("kept"))


def tune(df: DataFrame, folds: DataFrame, row_id: str, family: Callable[..., Estimator], space: dict[str, list], score: Callable[[DataFrame], float], draws: int = 6, patience: int = 3, seed: int = 3, metric: str = "mae", **options) -> tuple[dict, float]:
    """Best of seeded random draws by a score in its metric's direction; stops after `patience` draws without gain."""
    from loomtab.operators.scores import is_better

    dice, best, at, idle = random.Random(seed), None, None, 0
    for _ in range(draws):
        choice = {k: dice.choice(v) for k, v in space.items()}
        s = score(out_of_fold(df, folds, row_id, lambda _t, c=choice: family(**c), **options))
        best, at, idle = (choice, s, 0) if is_better(metric, s, at) else (best, at, idle + 1)
        if idle >= patience:
            break
    return best or {}, at


def isotonic(oof: DataFrame, df: DataFrame, target: str, pred: str) -> tuple[DataFrame, bool]:
    """df with predictions bent by an isotonic fit on out-of-fold rows, if their median is far too high and this mends it."""
    from pyspark.ml.regression import IsotonicRegression

    medians = exact_quantiles(oof, [pred, target], [0.5])
    (p,), (y,) = medians[pred], medians[target]
    if oof.count() < 50 or not y or p / y <= 1.5:
        return df, False
    model = IsotonicRegression(featuresCol=pred, labelCol=target, predictionCol="__iso").fit(oof.select(pred, target))
    (new,) = exact_quantiles(model.transform(oof.select(pred)), ["__iso"], [0.5])["__iso"]
    if not 0.5 <= new / y <= 1.5:
        return df, False
    return model.transform(df).withColumn(pred, F.col("__iso")).drop("__iso"), True


def sigmoid(oof: DataFrame, df: DataFrame, label: str, raw: str) -> DataFrame:
    """df with p: a raw score as a probability, by a one-feature logistic fit on out-of-fold rows."""
    asm = VectorAssembler(inputCols=[raw], outputCol="__x")
    model = logistic(1.0, 1_000_000).setFeaturesCol("__x").setLabelCol(label).fit(asm.transform(oof))
    return model.transform(asm.transform(df)).withColumn("p", vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")


def ablation(df: DataFrame, folds: DataFrame, row_id: str, groups: dict[str, list[str]], make: Callable[[DataFrame], Estimator], score: Callable[[DataFrame], float], gain: float = 0.01, metric: str = "mae", only: list[str] | None = None) -> list[tuple[str, float, float, str]]:
    """(group, score without it, change, decision): prune where leaving the group out betters the score by more than `gain`
    of the score with all. only: the groups to try, as new ones in a later round."""
    from loomtab.operators.scores import GREATER

    names = [c for g in groups.values() for c in g]

    def run(columns: list[str]) -> float:
        return score(out_of_fold(VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(df), folds, row_id, make))

    base, sign = run(names), 1 if metric in GREATER else -1
    out = []
    for group, columns in groups.items():
        if only is not None and group not in only:
            continue
        rest = [c for c in names if c not in columns]
        s = run(rest) if rest else -sign * float("inf")
        out.append((group, s, s - base, "prune" if sign * (s - base) > gain * abs(base) else "keep"))
    return out


def mae(oof: DataFrame) -> float:
    return oof.agg(F.avg(F.abs(F.col("label") - F.col("pred")))).first()[0]


def final_fit(df: DataFrame, predict: DataFrame, row_id: str, make: Callable[[int], Estimator], seeds: tuple[int, ...] = (1, 2)) -> DataFrame:
    """row_id, pred: mean prediction of refits on all rows with several seeds."""
    from loomtab.operators.repair import refit_average

    return refit_average([with_pred(make(s).fit(df), predict) for s in seeds], row_id, "pred")


def fit_best(
    train: DataFrame,
    predict: DataFrame,
    folds: DataFrame,
    row_id: str,
    families: dict[str, Callable[..., Estimator]],
    metric: str = "mae",
    spaces: dict[str, dict[str, list]] | None = None,
    skewed: bool = False,
    clipped: bool = False,
    calibrated: bool = False,
    prepare: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    classes: int = 0,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(row_id, pred) of the best candidate or stack, and the table of scores. Frames: (row_id, label, features).

    classes: the label is a code from 0 to classes - 1; candidates are judged and stacked by their chances of all classes, and
    pred is the likeliest code, taken once at the end, with proba beside it.

    spaces: settings to try for families that take them by name (make(train, **settings)); skewed: also learn the label's
    logarithm or root where its skew asks for it; clipped: predictions stay in the target's bounds; calibrated: an isotonic
    bend where the median is far too high. A candidate that fails is left out, with its error in the table.
    """
    from loomtab.operators import repair
    from loomtab.operators.relate import align_oof
    from loomtab.operators.scores import scorer

    if classes and (skewed or clipped or calibrated):
        raise ValueError("transforms, bounds and bends are for numbers")
    value = "proba" if classes else "pred"
    options |= {"classes": class_codes(classes)} if classes else {}
    score = scorer(metric, **options, **({"proba": "proba"} if classes else {}))
    for name, space in (spaces or {}).items():
        best, _ = tune(train, folds, row_id, lambda n=name, **c: families[n](train, **c), space, score, metric=metric, prepare=prepare, classes=classes)
        families = families | {name: lambda t, n=families[name], b=best: n(t, **b)}
    made = variants(train, families) if skewed else {n: (make, "none") for n, make in families.items()}
    oof, failed = {}, []
    for name, (make, how) in made.items():
        try:
            oof[name] = out_of_fold(train, folds, row_id, make, prepare, how, classes).cache()
            oof[name].count()
        except Exception as error:  # noqa: BLE001 - one family that fails must not end the search
            oof.pop(name, None)
            failed.append((name, str(error).splitlines()[0][:200]))
    if not oof:
        raise ValueError(f"all candidates failed: {failed}")
    wide = align_oof(oof, row_id, value).join(train.select(row_id, "label"), row_id).cache()
    table = keep_best(wide, list(oof), "label", metric, **options).cache()
    if (found := table.filter("kept").first()) is None:
        raise ValueError(f"{metric} is undefined for every candidate")
    best = found.candidate
    weights = {n: w for n, w in (stack_weights(wide, list(oof), "label") if best == "stack" else {best: 1.0}).items() if w > 0}
    fits = []
    for name in weights:
        make, how = made[name]
        fits.append(_refit(train, predict, row_id, make, how, prepare, classes).withColumnRenamed(value, name))
    out = stacked(reduce(lambda a, b: a.join(b, row_id), fits), weights, value).select(row_id, value)
    out = with_likeliest(out) if classes else out
    if calibrated:
        out, _ = isotonic(stacked(wide, weights, "pred").select("label", "pred"), out, "label", "pred")
    if clipped:
        out = repair.clip(out, "pred", repair.clip_bounds(train, "label"))
    table = table.withColumn("error", F.lit(None).cast("string"))
    if failed:
        table = table.unionByName(train.sparkSession.createDataFrame([(n, None, False, e) for n, e in failed], "candidate string, score double, kept boolean, error string"))
    for frame in (*oof.values(), wide):
        frame.unpersist()
    return out, table


def class_codes(classes: int) -> list[str]:
    """Codes of classes as scores read them."""
    return [str(float(k)) for k in range(classes)]


def with_likeliest(df: DataFrame) -> DataFrame:
    """df with pred: the code of the largest chance in proba, the first among equals."""
    return df.withColumn("pred", (F.array_position("proba", F.array_max("proba")) - 1).cast("double"))


def _refit(train: DataFrame, predict: DataFrame, row_id: str, make, how: str, prepare, classes: int = 0) -> DataFrame:
    from loomtab.operators.features import inverted, transformed

    if prepare:
        train, predict = prepare(train, predict)
    learnt = transformed(train, "label", how, "label")
    out = with_pred(make(learnt).fit(learnt), predict, classes)
    return out.select(row_id, "proba") if classes else inverted(out, "pred", how).select(row_id, "pred")


def specialists(train: DataFrame, predict: DataFrame, folds: DataFrame, row_id: str, floor: dict[str, Callable], groups: dict[str, dict[str, Callable]], metric: str = "mae", classes: int = 0, **options) -> tuple[DataFrame, list[tuple[str, float, bool]]]:
    """(row_id, pred) and (stage, score, taken): a floor of plain models first; each group of families after it must beat what
    stands strictly, alone or in a convex stack with it. classes: as in fit_best."""
    from loomtab.operators.scores import is_better, scorer

    value = "proba" if classes else "pred"
    options |= {"classes": class_codes(classes), "proba": "proba"} if classes else {}
    score, told = scorer(metric, **options), []
    makers = {n: m for part in (floor, *groups.values()) for n, m in part.items()}
    oof = {n: out_of_fold(train, folds, row_id, m, classes=classes).select(row_id, "label", F.col(value).alias(n)).cache() for n, m in makers.items()}

    def judged(names: list[str]) -> tuple[dict[str, float], float]:
        wide = reduce(lambda a, b: a.join(b.drop("label"), row_id), [oof[n] for n in names])
        weights = stack_weights(wide, names, "label") if len(names) > 1 else {names[0]: 1.0}
        return {n: w for n, w in weights.items() if w > 0}, score(stacked(wide, weights, value))

    best, at = {}, None
    for stage, names in (("floor", list(floor)), *((g, list(f)) for g, f in groups.items())):
        found = [judged([n]) for n in names]
        if len(names) > 1 or best:
            found.append(judged([*dict.fromkeys([*best, *names])]))
        taken = False
        for weights, s in found:
            if is_better(metric, s, at):
                best, at, taken = weights, s, True
        told.append((stage, at, taken))
    for frame in oof.values():
        frame.unpersist()
    fits = [_refit(train, predict, row_id, makers[n], "none", None, classes).withColumnRenamed(value, n) for n in best]
    out = stacked(reduce(lambda a, b: a.join(b, row_id), fits), best, value).select(row_id, value)
    return with_likeliest(out) if classes else out, told


def one_table(df: DataFrame, row_id: str, target: str, features: list[str], families: dict[str, Callable[..., Estimator]], metric: str | None = None, shares: tuple[float, float] = (0.7, 0.15), k: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Predictions of the test part, candidates' scores, and the test score of the best: one table split, preprocessed inside
    every fold, searched and judged on rows that no choice has seen. The target is a number, a label of two classes (0, 1), or
    a label of several classes; then pred is a label and proba has the chances in the order of the labels."""
    from loomtab.operators import build
    from loomtab.operators.folds import kfold, split_three
    from loomtab.operators.scores import class_list, score_table
    from loomtab.operators.task import resolve_task

    task = resolve_task(df, target, metric=metric)
    metric, known = metric or task.metric, df.filter(F.col(target).isNotNull())
    numeric = known.filter(F.col(target).try_cast("double").isNull()).isEmpty()
    labels = class_list(df, target) if task.kind == "multiclass" or task.kind == "binary" and not numeric else []
    label = (F.array_position(F.array(*map(F.lit, labels)), F.col(target).cast("string")) - 1) if labels else F.col(target)
    parts = known.withColumn("label", label.cast("double")).join(split_three(df, row_id, shares), row_id)
    seen, test = parts.filter("part <> 'test'"), parts.filter("part = 'test'")
    kinds = build.column_kinds(seen, test, features)
    out, table = fit_best(seen, test, kfold(seen, row_id, k), row_id, families, metric, prepare=build.preparer(kinds), classes=len(labels))
    scored = out.join(test.select(row_id, "label"), row_id)
    if not labels:
        return out, table, score_table(scored, metric)
    named = out.withColumn("pred", F.element_at(F.array(*map(F.lit, labels)), F.col("pred").cast("int") + 1))
    return named, table, score_table(scored, metric, proba="proba", classes=class_codes(len(labels)))
