"""Results out, and back: predictions, folds, out-of-fold tables, verdicts. Spark's writers commit whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_predictions(df: DataFrame, path: str) -> None:
    """csv or parquet by suffix."""
    if path.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_folds(folds: DataFrame, path: str) -> None:
    folds.write.mode("overwrite").parquet(path)


def load_folds(spark: SparkSession, path: str, df: DataFrame, row_id: str) -> DataFrame:
    """Folds of the rows that df still has."""
    return spark.read.parquet(path).join(df.select(row_id), row_id, "left_semi")


def write_oof(oof: DataFrame, path: str) -> None:
    """row_id and pred; null where a row is not scored."""
    out = oof.withColumn("pred", F.when(F.col("scored"), F.col("pred"))) if "scored" in oof.columns else oof
    out.write.mode("overwrite").parquet(path)


def checkpoint_predictions(df: DataFrame, path: str) -> DataFrame:
    """Write and read back, so that later failures find predictions there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_verdicts(verdicts: DataFrame, path: str) -> None:
    verdicts.write.mode("overwrite").json(path)
