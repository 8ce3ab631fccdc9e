"""Checks that give verdict rows: stage, status (pass, warn, fail), reason, column, value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import kind, long_form, name_tokens, number
from loomtab.operators.quantiles import exact_quantiles, group_quantiles
from loomtab.operators.profile import ID_WORDS, LEAK_WORDS

COLUMNS = ("stage", "status", "reason", "column", "value")


def _rows(df: DataFrame, stage: str, *structs) -> DataFrame:
    return df.select(F.explode(F.array(*structs)).alias("x")).select(F.lit(stage).alias("stage"), "x.*").filter("status IS NOT NULL")


def _row(status, reason: str, column, value) -> F.Column:
    column = F.lit(column) if isinstance(column, str) else column
    return F.struct(status.cast("string").alias("status"), F.lit(reason).alias("reason"), column.alias("column"), value.cast("string").alias("value"))


#: What a transform of the target is called beside the target's own name.
TRANSFORMS = ("log", "log1p", "log10", "sqrt", "boxcox", "scaled", "norm", "std", "z", "rank", "expm1", "diff", "pct", "resid")
#: Rank correlation of a feature that rises or falls with the target throughout.
MONOTONE = 0.9999


def transform_names(target: str) -> set[str]:
    """Names of the target and of its usual transforms, in lower case, cut as name_tokens cuts."""
    own = "_".join(name_tokens(target))
    return {own} | {f"{own}_{t}" for t in TRANSFORMS} | {f"{t}_{own}" for t in TRANSFORMS}


def rank_correlations(df: DataFrame, target: str, names: list[str]) -> DataFrame:
    """column, rho: Spearman's correlation of each feature with the target, average ranks for ties, over the rows that have both.

    Values of a column are counted, placed by ranges between the bounds of a sketch, and ranked inside their range by running
    sums over distinct values; rows then meet their ranks. No task sees a whole column."""
    long = long_form(df.select(number(target).alias("__y"), *[number(c).alias(c) for c in names]), names, ["__y"], "x", "double").filter("x IS NOT NULL AND __y IS NOT NULL")
    pairs = long.groupBy("column", "x", F.col("__y").alias("y")).agg(F.count("*").alias("n"))

    def ranks(v: str) -> DataFrame:
        per = pairs.groupBy("column", v).agg(F.sum("n").alias("c"))
        bounds = per.groupBy("column").agg(F.percentile_approx(v, [i / 256 for i in range(1, 256)], 2560).alias("b"))  # over distinct values: a line a column
        per = per.join(F.broadcast(bounds), "column").withColumn("s", F.size(F.filter("b", lambda b: b < F.col(v)))).drop("b")
        sums = per.groupBy("column", "s").agg(F.sum("c").alias("t"))
        before = sums.select("column", "s", (F.sum("t").over(Window.partitionBy("column").orderBy("s")) - F.col("t")).alias("before"))  # over ranges
        upto = F.sum("c").over(Window.partitionBy("column", "s").orderBy(v))
        return per.withColumn("u", upto).join(before, ["column", "s"]).select("column", v, (F.col("before") + F.col("u") - (F.col("c") - 1) / 2).alias(f"r{v}"))

    met = pairs.join(ranks("x"), ["column", "x"]).join(ranks("y"), ["column", "y"])
    n, sx, sy = (F.sum(e).alias(a) for a, e in (("n", F.col("n")), ("sx", F.col("n") * F.col("rx")), ("sy", F.col("n") * F.col("ry"))))
    mean = met.groupBy("column").agg(n, sx, sy).select("column", (F.col("sx") / F.col("n")).alias("mx"), (F.col("sy") / F.col("n")).alias("my"))
    d = met.join(F.broadcast(mean), "column").withColumns({"dx": F.col("rx") - F.col("mx"), "dy": F.col("ry") - F.col("my")})
    sums = d.groupBy("column").agg(*[F.sum(F.col("n") * e).alias(a) for a, e in (("xy", F.col("dx") * F.col("dy")), ("xx", F.col("dx") * F.col("dx")), ("yy", F.col("dy") * F.col("dy")))], F.sum("n").alias("n"))
    return sums.filter("n > 2").select("column", F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"))


def target_transforms(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """column, reason, value: features that are the target in another shape, by name, or as they rise or fall with it throughout."""
    named = [c for c in features if c != target and "_".join(name_tokens(c)) in transform_names(target)]
    by_name = df.sparkSession.createDataFrame([(c, "named as a transform of the target", None) for c in named], "column string, reason string, value double")
    numeric = [c for c in features if c not in (target, *named) and kind(df.schema[c].dataType) == "numeric"]
    if not numeric:
        return by_name
    strong = rank_correlations(df, target, numeric).filter(F.abs("rho") >= MONOTONE)
    return by_name.unionByName(strong.select("column", F.lit("rises or falls with the target throughout").alias("reason"), F.round("rho", 6).alias("value")))


def leakage_scan(df: DataFrame, target: str, features: list[str], keys: list[str], limit: float = 0.98, tolerance: float = 1e-3, transforms: bool = False) -> DataFrame:
    """column, reason, value: features that give the target away. transforms: also its transforms (see target_transforms).

    By name; by correlation; or by being, to a thousandth of the target's spread, the mean or median of the target by
    a key. For each key one shuffle of (feature, key level) cells replaces a join back to rows: a feature equals a group
    statistic if its extremes in every group lie close to it.
    """
    named = [c for c in features if c == target or set(name_tokens(c)) & set(LEAK_WORDS) and c not in keys]
    spark = df.sparkSession
    by_name = spark.createDataFrame([(c, "named as an outcome", None) for c in named], "column string, reason string, value double")
    numeric = [c for c in features if dict(df.dtypes)[c] not in ("string", "boolean") and not dict(df.dtypes)[c].startswith(("timestamp", "date"))]
    from loomtab.operators.pattern import correlations

    out = [by_name]
    if numeric:
        out.append(correlations(df, target, numeric, 5).filter(F.abs("r") >= limit).select("column", F.lit("correlates with the target").alias("reason"), F.round("r", 6).alias("value")))
        spread = df.agg(F.stddev(number(target)).alias("s"))
        for key in keys:
            groups = df.groupBy(key).agg(F.count(number(target)).alias("n"), F.avg(number(target)).alias("mean"), *[f(number(c)).alias(f"{p}{c}") for c in numeric for p, f in (("lo_", F.min), ("hi_", F.max))])
            medians = group_quantiles(df.select(F.col(key).alias("__key"), number(target).alias("__y")), ["__key"], ["__y"], {"median": 0.5})
            groups = groups.join(medians, groups[key].eqNullSafe(medians["__key"]), "left")
            cells = groups.select(key, "n", "mean", "median", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in numeric])).alias("x")).select("n", "mean", "median", "x.*")
            gap = {s: F.max(F.greatest(F.abs(F.col("lo") - F.col(s)), F.abs(F.col("hi") - F.col(s)))).alias(f"g_{s}") for s in ("mean", "median")}
            worst = cells.filter("lo IS NOT NULL").groupBy("column").agg(F.sum("n").alias("n"), F.count("*").alias("k"), *gap.values()).join(spread)
            hit = worst.filter((F.col("n") >= 10) & (F.col("k") > 1) & (F.least("g_mean", "g_median") <= tolerance * F.col("s")))
            out.append(hit.select("column", F.lit(f"equals the target's mean or median by {key}").alias("reason"), F.round(F.least("g_mean", "g_median"), 6).alias("value")))
    if transforms:
        out.append(target_transforms(df, target, features))
    return reduce(DataFrame.unionByName, out)


def univariate_strength(df: DataFrame, positive: F.Column, names: list[str]) -> DataFrame:
    """column, strength: max(AUC, 1 - AUC) of each number alone, exact with ties, for all columns in one shuffle."""
    from loomtab.operators.metrics import auc_by

    d = df.withColumn("__p", F.coalesce(positive, F.lit(False)).cast("long"))
    rows = long_form(d.select("__p", *[number(c).alias(c) for c in names]), names, ["__p"], "v", "double").filter("v IS NOT NULL")
    per = rows.groupBy("column", "v").agg(F.sum("__p").alias("pos"), (F.count("*") - F.sum("__p")).alias("neg"))
    auc = auc_by(per.withColumnRenamed("v", "score"), "column")
    return auc.select("column", F.greatest("auc", 1 - F.col("auc")).alias("strength"))


def value_strength(df: DataFrame, target: str, names: list[str]) -> DataFrame:
    """column, strength: how far a number alone tells the target: AUC both ways for two classes, else abs(correlation)."""
    from loomtab.operators.pattern import correlations

    two = [r[0] for r in df.select(F.col(target).cast("string")).filter(F.col(target).isNotNull()).distinct().limit(3).collect()]
    if len(two) == 2:
        return univariate_strength(df.filter(F.col(target).isNotNull()), F.col(target).cast("string") == max(two), names)
    return correlations(df, target, names, 5).select("column", F.abs("r").alias("strength"))


def leakage_audit(train: DataFrame, test: DataFrame, target: str, features: list[str], fitted_on: str = "train", fitted_before_split: bool = False, scored_on: str = "test", selected_on: str = "train", strength: float | None = None) -> DataFrame:
    """Verdict rows of the audit: names, ids, order of fitting, selection, rows shared by the splits; with `strength` also
    numbers that alone tell the target that well (0.98 is usual). `risk` rolls the rows up."""
    from loomtab.operators.relate import shared_rows

    spark = train.sparkSession
    named = [(c, "target among features") for c in features if c == target] + [(c, "id-like feature") for c in features if set(name_tokens(c)) & set(ID_WORDS)] + [(c, "post-outcome name") for c in features if set(name_tokens(c)) & set(LEAK_WORDS)]
    stated = [("fail", "preprocessing fitted before the split", "", "")] * fitted_before_split + [("fail", "fitted on more than train", "", fitted_on)] * (fitted_on != "train") + [("fail", "features selected outside train", "", selected_on)] * (selected_on != "train") + [("warn", "scores not of the test split", "", scored_on)] * (scored_on != "test")
    rows = [("leakage", "fail" if r == "target among features" else "warn", r, c, "") for c, r in named] + [("leakage", *s) for s in stated]
    shared = shared_rows(train, test)
    from_rows = _rows(shared, "leakage", _row(F.when(F.col("shared") > 0, "fail").otherwise("pass"), "rows shared by the splits", "", F.col("shared")))
    out = spark.createDataFrame(rows, "stage string, status string, reason string, column string, value string").unionByName(from_rows) if rows else from_rows
    numeric = [c for c in features if c != target and c in train.columns and kind(train.schema[c].dataType) == "numeric"]
    if strength is not None and numeric:
        strong = value_strength(train, target, numeric).filter(F.col("strength") > strength)
        out = out.unionByName(strong.select(F.lit("leakage").alias("stage"), F.lit("fail").alias("status"), F.lit("one number tells the target").alias("reason"), "column", F.round("strength", 4).cast("string").alias("value")))
    return out


def risk(audit: DataFrame) -> DataFrame:
    """risk, fails, warns of an audit: high with a failure, medium with a warning, else low."""
    one = audit.agg(F.count_if(F.col("status") == "fail").alias("fails"), F.count_if(F.col("status") == "warn").alias("warns"))
    return one.select(F.when(F.col("fails") > 0, "high").when(F.col("warns") > 0, "medium").otherwise("low").alias("risk"), "fails", "warns")


def schema_check(df: DataFrame, row_id: str, target: str, train: DataFrame) -> DataFrame:
    """Are the tables filled and the roles present?"""
    has = [("row id in predict", row_id in df.columns, row_id), ("row id in train", row_id in train.columns, row_id), ("target in train", target in train.columns, target)]
    counts = df.agg(F.count("*").alias("n"))
    return _rows(counts, "schema", _row(F.when(F.col("n") > 0, "pass").otherwise("fail"), "predict has rows", "", F.col("n")), *[_row(F.lit("pass" if ok else "fail"), reason, c, F.lit(ok)) for reason, ok, c in has])


def prediction_sanity(pred: DataFrame, p: str, train: DataFrame, target: str) -> DataFrame:
    """Non-finite, near-constant or shifted predictions against the target; see class_sanity for labels and score_sanity for
    what scores say."""
    x, y = number(p), number(target)
    (pm,), (tm,) = exact_quantiles(pred, [p], [0.5])[p], exact_quantiles(train, [target], [0.5])[target]
    a = pred.agg(F.count("*").alias("n"), F.count_if(x.isNull() | (F.abs(x) == float("inf"))).alias("bad"), F.stddev(x).alias("ps")).withColumn("pm", F.lit(pm).cast("double"))
    b = train.agg(F.stddev(y).alias("ts")).withColumn("tm", F.lit(tm).cast("double"))
    one = a.join(b).withColumns({"ratio": F.try_divide("ps", "ts"), "shift": F.try_divide("pm", "tm")})
    return _rows(
        one,
        "sanity",
        _row(F.when(F.col("bad") > 0, "fail").otherwise("pass"), "finite predictions", p, F.col("bad")),
        _row(F.when(F.col("ratio") < 0.01, "fail").otherwise("pass"), "spread of predictions", p, F.round("ratio", 4)),
        _row(F.when((F.col("shift") > 3) | (F.col("shift") < 1 / 3), "warn").otherwise("pass"), "median of predictions", p, F.round("shift", 4)),
    )


def class_sanity(pred: DataFrame, p: str, train: DataFrame, target: str) -> DataFrame:
    """Predicted labels: missing ones, one class only where train has several, shares far from train's."""
    from loomtab.operators.metrics import class_shares

    one = pred.agg(F.count_if(F.col(p).isNull()).alias("bad"), F.count_distinct(F.col(p).cast("string")).alias("k"))
    one = one.join(train.agg(F.count_distinct(F.col(target).cast("string")).alias("tk")))
    whole = _rows(
        one,
        "sanity",
        _row(F.when(F.col("bad") > 0, "fail").otherwise("pass"), "labels given", p, F.col("bad")),
        _row(F.when((F.col("k") <= 1) & (F.col("tk") > 1), "fail").otherwise("pass"), "more than one class", p, F.col("k")),
    )
    shares = class_shares(train, pred, target, p)
    odd = shares.select(F.lit("sanity").alias("stage"), F.when(F.col("odd"), "warn").otherwise("pass").alias("status"), F.lit("share of a class").alias("reason"), F.col("label").alias("column"), F.round("ratio", 4).cast("string").alias("value"))
    return whole.unionByName(odd)


def score_sanity(metric: str, oof: float, baseline: float | None = None, cv: float | None = None, corr: float | None = None, clipped: float | None = None, matches_truth: float | None = None) -> list[tuple[str, str, str, str, str]]:
    """Verdict rows of figures: out-of-fold too good (correlation over 0.95, accuracy over the folds' by 0.10), clipped share
    over 0.10 or 0.30, a holdout that equals the truth, no lift over the baseline. What is not given is not judged."""
    from loomtab.operators.scores import is_better

    rows = []

    def say(status: str, reason: str, value: float) -> None:
        rows.append(("sanity", status, reason, metric, f"{value:.4f}"))

    if corr is not None:
        say("warn" if corr > 0.95 else "pass", "out-of-fold too good", corr)
    elif cv is not None and metric == "accuracy":
        say("warn" if oof > cv + 0.1 else "pass", "out-of-fold too good", oof - cv)
    if clipped is not None:
        say("fail" if clipped > 0.3 else "warn" if clipped > 0.1 else "pass", "clipped share", clipped)
    if matches_truth is not None:
        say("fail" if matches_truth >= 1 else "pass", "holdout equals truth", matches_truth)
    if baseline is not None:
        say("pass" if is_better(metric, oof, baseline) else "warn", "lift over baseline", oof)
    return rows


def holdout_matches(pred: DataFrame, truth: DataFrame, row_id: str, p: str, target: str, tolerance: float = 1e-12) -> DataFrame:
    """n, share of held-out rows whose prediction is the truth itself."""
    both = pred.select(row_id, F.col(p).alias("p")).join(truth.select(row_id, F.col(target).alias("t")), row_id).filter("t IS NOT NULL")
    near = F.coalesce(F.abs(F.col("p").try_cast("double") - F.col("t").try_cast("double")) <= tolerance, F.col("p").cast("string") == F.col("t").cast("string"), F.lit(False))
    return both.agg(F.count("*").alias("n"), F.avg(near.cast("double")).alias("share"))


def validate_table(sample: DataFrame, table: DataFrame, row_id: str, order: str, target: str, labels: DataFrame | None = None) -> DataFrame:
    """Does the handed-in table (row_id, order, target) match the sample: rows, ids in order, nulls, finite values, labels?"""
    s, t = sample.select(F.col(row_id).alias("i"), F.col(order).alias("o")), table.select(F.col(row_id).alias("j"), F.col(order).alias("o"), F.col(target).alias("v"))
    both = s.join(t, "o", "full")
    one = both.agg(
        F.count("i").alias("asked"),
        F.count("j").alias("given"),
        F.count_if(~F.col("i").eqNullSafe(F.col("j"))).alias("misplaced"),
        F.count_if(F.col("j").isNotNull() & F.col("v").isNull()).alias("nulls"),
        F.count_if(F.coalesce(F.abs(F.col("v").try_cast("double")) == float("inf"), F.lit(False)) | F.coalesce(F.isnan(F.col("v").try_cast("double")), F.lit(False))).alias("infinite"),
    )
    checks = [("row count", F.col("asked") == F.col("given"), F.col("given")), ("ids in order", F.col("misplaced") == 0, F.col("misplaced")), ("no nulls", F.col("nulls") == 0, F.col("nulls")), ("finite", F.col("infinite") == 0, F.col("infinite"))]
    out = _rows(one, "hand-in", *[_row(F.when(ok, "pass").otherwise("fail"), reason, target, v) for reason, ok, v in checks])
    if labels is not None:
        strange = t.select(F.col("v").cast("string").alias("label")).filter("label IS NOT NULL").join(labels.select("label"), "label", "left_anti").agg(F.count("*").alias("n"))
        out = out.unionByName(_rows(strange, "hand-in", _row(F.when(F.col("n") == 0, "pass").otherwise("fail"), "known labels", target, F.col("n"))))
    return out


def validate_types(sample: DataFrame, table: DataFrame, target: str, regression: bool = True) -> DataFrame:
    """Are the handed-in predictions of the type that is asked for? Numbers must be readable as numbers; labels must be of the
    sample's kind (text, numbers, flags) where the sample has any."""
    if target not in table.columns:
        return table.sparkSession.createDataFrame([("hand-in", "fail", "type of predictions", target, "absent")], ", ".join(f"{c} string" for c in COLUMNS))
    if regression:
        bad = table.agg(F.count_if(F.col(target).isNotNull() & F.col(target).cast("string").try_cast("double").isNull()).alias("n"))
        return _rows(bad, "hand-in", _row(F.when(F.col("n") == 0, "pass").otherwise("fail"), "type of predictions", target, F.col("n")))
    asked = kind(sample.schema[target].dataType) if target in sample.columns else None
    known = asked is not None and not sample.filter(F.col(target).isNotNull()).isEmpty()
    given = kind(table.schema[target].dataType)
    return table.sparkSession.createDataFrame([("hand-in", "fail" if known and given != asked else "pass", "type of predictions", target, given)], ", ".join(f"{c} string" for c in COLUMNS))


def evaluation_validity(metrics: DataFrame, kind: str) -> DataFrame:
    """metrics (candidate, metric, split, score): only held-out scores, a baseline among them, metrics that fit the task."""
    from loomtab.operators.task import METRICS

    one = metrics.agg(F.count_if(~F.col("split").isin("oof", "test", "validation")).alias("seen"), F.count_if(F.col("candidate").startswith("baseline")).alias("base"), F.count_if(~F.col("metric").isin(*METRICS[kind])).alias("odd"))
    return _rows(one, "evaluation", *[_row(F.when(ok, "pass").otherwise("fail"), r, "", v) for r, ok, v in (("held-out scores only", F.col("seen") == 0, F.col("seen")), ("has a baseline", F.col("base") > 0, F.col("base")), ("metrics fit the task", F.col("odd") == 0, F.col("odd")))])


def worst(verdicts: DataFrame) -> DataFrame:
    """stage, status: the worst verdict of each stage."""
    rank = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    return verdicts.groupBy("stage").agg(F.max(rank).alias("r")).select("stage", F.element_at(F.array(F.lit("pass"), F.lit("warn"), F.lit("fail")), F.col("r") + 1).alias("status"))
