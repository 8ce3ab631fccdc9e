"""Helpers that the corpus operators share: shared storage, batches of bounded size, Arrow word splitting."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step inside a task works on at once; bounds the task's memory whatever the batch holds.
CHUNK_BYTES = 4 << 20
BATCH_BYTES = 16 << 20

#: White space of the corpus contracts, as a Java regular expression class.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or one of our own where a session on one machine names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.loomtab.shared.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
    if not named:
        named = "file://" + tempfile.mkdtemp(prefix="loomtab-")
        spark.conf.set("spark.loomtab.shared.dir", named)
    if "://" not in named:  # a bare path lies in the default file system, for Spark's writers and for ours
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        named = ("file://" if default.startswith("file:") else default.rstrip("/")) + "/" + named.removeprefix("file:").lstrip("/")
    return named.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/loomtab/{tag}-{uuid.uuid4().hex}"


def remove_tables(spark: SparkSession) -> None:
    """Remove what the operators have written: for when the results that were read from it are stored. Results still to be
    computed would miss their inputs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/loomtab")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, keeps random ids stable."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of df has, nor begins with."""
    name = f"__{name}"
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name


def numbered_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a long that tells rows apart, and its name. Unique doc_ids serve as they are; otherwise rows are numbered
    and stored, since numbers of partitions and places only hold for what is written."""
    uid = free_name(docs, "uid")
    ids = docs.select(F.col("doc_id").cast("long").alias("i"))
    if ids.groupBy("i").count().filter("count > 1 OR i IS NULL").isEmpty():
        return docs.withColumn(uid, F.col("doc_id").cast("long")), uid
    return table(docs.withColumn(uid, F.monotonically_increasing_id()), "rows"), uid


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow over batches of at most BATCH_BYTES: a task holds two batches at a time, in the JVM and in Python."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


_KEPT: dict[str, object] = {}


def kept(name: str, make):
    """What a Python worker keeps from task to task. Only the last operator's is kept, so that the workers of a long
    session, which serve all operators in turn, do not gather them all."""
    if name not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        _KEPT[name] = make()
    return _KEPT[name]


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal a small control table over all cores; its rows stand for much work each."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *cols)


def write_file(uri: str, data: bytes) -> None:
    """Write one file to any store that pyarrow can reach. Names are unique to the attempt, so a retry never collides."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)


def is_mounted(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def read_file(uri: str) -> np.ndarray:
    """The file as bytes: memory-mapped where the store is a mounted folder, else read whole."""
    if is_mounted(uri):
        path = urlparse(uri).path
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), np.uint8)


def texts(column: pa.Array) -> pa.Array:
    """A string column with null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that its texts stay under limit bytes; a longer text stands alone, whole."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def space_words(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words of every text between ASCII white space, in one flat array, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return flat.filter(full), np.diff(ends[offsets - offsets[0]])


def row_ids(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def crc_mod(column: str, n: int) -> F.Column:
    """crc32 of an id written as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
