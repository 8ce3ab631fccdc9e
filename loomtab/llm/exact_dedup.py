"""Exact dedup with a heavy-hitter split.

Every text is normalised (each run of ASCII white space becomes one space) and digested with SHA-256. A Misra-Gries
sketch of every partition finds the digests that may be frequent; an exact count verifies them and picks each one's
winner. The verified winners, at most `counters` rows by the sketch's own bound, are broadcast and settle their rows
map-side; the remaining digests, none of which is frequent, go through an ordinary shuffle.

Null text is the empty text. Null doc_ids sort after all others; of rows with equal text and equal doc_id exactly one
is kept. An empty table gives an empty result. Columns other than doc_id and text are not looked at, whatever their names.
Texts are normalised and digested whole, in the JVM; from there on rows carry 32 bytes whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

COUNTERS = 1024


def misra_gries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Values that more than 2/counters of all rows may share: (column, low), low a lower bound of the count.

    A partition's sketch undercounts by less than its rows / counters; the sums of sketches undercount by less than all
    rows / counters. At most `counters` values can have low > rows / counters.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for x in batch.column(0).value_counts().to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            if len(held) > counters:  # subtract the (counters + 1)-th largest count from all; what is left fits
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: v - cut for k, v in held.items() if v > cut}
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], [column, "low"])

    return digests.select(column).transform(common.map_batches, sketch, f"{column} binary, low long").groupBy(column).agg(F.sum("low").alias("low"))


def dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), common.SPACE, " ")
    rows = common.table(
        docs.select("doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.monotonically_increasing_id().alias("uid")),
        "digests",
    )
    n = rows.count()
    likely = misra_gries(rows, "digest", counters).filter(F.col("low") > n / counters).select("digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
    found = rows.join(F.broadcast(likely), "digest").groupBy("digest").agg(F.count("*").alias("group_size"), first.alias("first"))
    winners = F.broadcast(common.table(found, "winners"))
    heavy = rows.join(winners, "digest")
    light = rows.join(winners, "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(F.count("*").alias("group_size"), first.alias("first")), "digest")
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
