"""What is to be predicted: inferred from data, checked against statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.functions.exprs import number
from loomtab.spec import TaskSpec

# Our choice: metrics that fit each kind of task, the default first.
METRICS = {"regression": ("mae", "rmse", "r2", "mape", "block_mae"), "binary": ("roc_auc", "accuracy", "f1", "log_loss", "balanced_accuracy"), "multiclass": ("accuracy", "f1_macro", "log_loss", "balanced_accuracy", "roc_auc")}
GREATER = {"r2", "roc_auc", "accuracy", "f1", "f1_macro", "balanced_accuracy"}


def target_facts(df: DataFrame, target: str) -> DataFrame:
    """n, distinct, numeric, integer_like, kind: two levels are binary, whole numbers of at most 20 levels multiclass."""
    y = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("s")).agg(F.count("*").alias("n"), F.first(number(target)).alias("x"))
    one = y.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("distinct"), F.coalesce(F.bool_and(F.col("x").isNotNull()), F.lit(False)).alias("numeric"), F.coalesce(F.bool_and(F.coalesce(F.col("x") % 1 == 0, F.lit(False))), F.lit(False)).alias("integer_like"))
    kind = F.when(F.col("distinct") == 2, "binary").when(~F.col("numeric"), "multiclass").when(F.col("integer_like") & (F.col("distinct") <= 20), "multiclass").otherwise("regression")
    return one.withColumn("kind", kind)


#: Metrics to report for each kind of task, the first one leading.
REPORTED = {"binary": ("roc_auc", "f1_weighted", "accuracy", "confusion_matrix"), "multiclass": ("f1_weighted", "f1_macro", "accuracy", "confusion_matrix"), "regression": ("rmse", "mae", "r2")}


def metric_advice(df: DataFrame, target: str, imbalance: float = 0.8) -> DataFrame:
    """kind, majority_rate, imbalanced, metrics, advice of a target, in one row.

    Of classes, a majority above `imbalance` is told, as accuracy says little then; numbers have no majority. A target
    without a value has no metrics."""
    kind = F.col("kind")
    largest = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("s")).agg(F.count("*").alias("c")).agg(F.max("c").alias("c"))
    facts = target_facts(df, target).join(largest)  # of one row each
    facts = facts.withColumn("majority_rate", F.when(kind != "regression", F.try_divide("c", "n")))
    metrics = F.when(F.col("n") > 0, F.create_map(*[F.lit(x) for k, v in REPORTED.items() for x in (k, ",".join(v))])[kind])
    out = facts.select("kind", "majority_rate", F.coalesce(F.col("majority_rate") > imbalance, F.lit(False)).alias("imbalanced"), metrics.alias("metrics"))
    return out.withColumn("advice", F.when(F.col("imbalanced"), "one class dominates; prefer roc_auc to accuracy"))


def candidate_targets(df: DataFrame, names: list[str]) -> DataFrame:
    """column, distinct: columns with a target's name, or with exactly two levels."""
    from loomtab.functions.exprs import name_tokens
    from loomtab.operators.profile import TARGET_WORDS, distinct_counts

    named = [c for c in names if set(name_tokens(c)) & set(TARGET_WORDS)]
    return distinct_counts(df, names).filter((F.col("distinct") == 2) | F.col("column").isin(named)).select("column", "distinct")


def value_format(df: DataFrame, name: str) -> DataFrame:
    """format of a column of sample predictions: prob01, int, float, string or unknown."""
    x = number(name)
    one = df.agg(F.count(name).alias("n"), F.count(x).alias("k"), F.bool_and(x % 1 == 0).alias("whole"), F.bool_and((x >= 0) & (x <= 1)).alias("unit"))
    return one.select(F.when(F.col("n") == 0, "unknown").when(F.col("k") < F.col("n"), "string").when(F.col("whole"), "int").when(F.col("unit"), "prob01").otherwise("float").alias("format"))


def _labels(df: DataFrame, target: str) -> list[str]:
    from loomtab.operators.scores import class_list

    return class_list(df, target)  # raises where there are too many for classes


def resolve_task(df: DataFrame, target: str, stated: str | None = None, metric: str | None = None, forced: str | None = None, block: str | None = None) -> TaskSpec:
    """The task: forced kind, else the stated one if the data allow it, else what the data say; metric that fits it."""
    facts = target_facts(df, target).first()
    feasible = {"regression": facts.numeric, "binary": facts.distinct == 2, "multiclass": facts.distinct >= 2}
    kind = forced or (stated if stated and feasible[stated] else facts.kind)
    if kind == "multiclass" and metric == "f1":
        metric = "f1_macro"
    if metric not in METRICS[kind]:
        metric = "block_mae" if block and kind == "regression" else METRICS[kind][0]
    labels = () if kind == "regression" else tuple(_labels(df, target))
    return TaskSpec(kind, metric, metric in GREATER, "value" if kind == "regression" else "probability" if metric in ("roc_auc", "log_loss") else "label", labels)


def forced_kind(kind: str, output: str) -> str | None:
    """The kind that the format of the output asks for where the stated one does not fit it: None where it does."""
    fits = {"regression": ("int", "float", "prob01", "unknown"), "binary": ("prob01", "int", "string", "unknown"), "multiclass": ("int", "string", "unknown")}
    if output in fits[kind]:
        return None
    return {"string": "multiclass", "prob01": "binary"}.get(output, "regression")


def output_consistency(kind: str, sample: DataFrame, name: str) -> DataFrame:
    """stage, status, reason, column, value: does the format of the sample's predictions fit the kind? value: the kind to take."""
    cases = F.coalesce(*[F.when(F.col("format") == f, F.lit(forced_kind(kind, f))) for f in ("prob01", "int", "float", "string", "unknown")])
    one = value_format(sample, name).withColumn("forced", cases)
    return one.select(F.lit("task").alias("stage"), F.when(F.col("forced").isNull(), "pass").otherwise("fail").alias("status"), F.lit("output against kind").alias("reason"), F.lit(name).alias("column"), F.coalesce("forced", F.lit(kind)).alias("value"))


def consistency(df: DataFrame, target: str, stated_kind: str, stated_metric: str) -> DataFrame:
    """stage, status, reason, column, value: does what is stated fit the data?"""
    facts = target_facts(df, target)
    rows = F.explode(
        F.array(
            F.struct(F.when(F.col("kind") == stated_kind, "pass").otherwise("fail").alias("status"), F.lit("kind against data").alias("reason"), F.lit(target).alias("column"), F.col("kind").alias("value")),
            F.struct(F.lit("pass" if stated_metric in METRICS[stated_kind] else "fail").alias("status"), F.lit("metric against kind").alias("reason"), F.lit(target).alias("column"), F.lit(stated_metric).alias("value")),
        )
    ).alias("x")
    return facts.select(F.lit("task").alias("stage"), rows).select("stage", "x.*")
