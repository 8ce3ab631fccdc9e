"""Tables that an iterating operator keeps for a while, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where a session on one machine names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.loomtab.stored.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
    if not named:
        named = "file://" + tempfile.mkdtemp(prefix="loomtab-")
        spark.conf.set("spark.loomtab.stored.dir", named)
    return named.rstrip("/")


@contextlib.contextmanager
def storage(spark: SparkSession) -> Iterator:
    """keep(df): df written and read back, which cuts its lineage. All that was kept goes when the block ends, so nothing that
    is lazy may leave it."""
    folder = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
