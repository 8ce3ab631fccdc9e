"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a line of words: its documents in a seeded random order, laid end to end, and cut into blocks of about
`block_words` words. A source's target is met by running along its line, again from the start where the target is
larger than the source, and past documents that are too long for what is missing; so each source owes the mix an exact number of blocks. The output shards are the leaves of a
binary tree: at each node the block quotas of all sources split between left and right by a multivariate-hypergeometric
draw, seeded by the node, until every shard has its exact quota of each source. Shards take consecutive blocks of the
permuted lines, so no block is drawn twice, and shuffle what they got locally.

All is a function of the data and the seed: reruns agree, whatever the partitions. Null text has size 0 and is never
taken; null source is a source of its own, last in order; equal rows and equal or null doc_ids each take part; an empty
table mixes to an empty one; other columns are carried along as they are, whatever their names. Texts are only counted and
hashed, whole, in the JVM. Quotas are a number for each source on the driver and in each task of the tree: meant for up to
some ten thousand sources.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BLOCK_WORDS = 20_000
SHARD_BLOCKS = 64
SEED = 17


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, common.SPACE))).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (source, source_size) with target: weights by turns over sources in code-point order, null last; no target
    above epochs times its size, what is over being shared again by weight.

    Sharing again until none is above ends at one level L with target = least(weight * L, cap): sort by cap / weight, and
    L is what the rest of the total leaves to the weights that are not capped.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", turn).withColumn("cap", F.col("source_size") * float(epochs)).withColumn("ratio", F.col("cap") / F.col("weight"))
    whole, line = Window.partitionBy(), Window.orderBy("ratio", F.col("source").isNull(), "source")
    rows = rows.withColumns(
        {
            "total": F.sum("source_size").over(whole).cast("double"),
            "capped": F.sum("cap").over(line) - F.col("cap"),
            "open": F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    # The first source, in this order, that its share does not lift above its cap fixes the level for it and all after.
    level = F.min(F.when((F.col("total") - F.col("capped")) / F.col("open") <= F.col("ratio"), F.struct("ratio", ((F.col("total") - F.col("capped")) / F.col("open")).alias("level")))).over(whole)["level"]
    return rows.withColumn("level", level).select("source", "source_size", F.coalesce(F.least(F.col("weight") * F.col("level"), F.col("cap")), F.col("cap")).alias("target"))


def _splits(quota: np.ndarray, shards: int, seed: int, leaves: np.ndarray) -> np.ndarray:
    """Rows for `leaves` of the table (shard, source) of blocks; only the nodes on their paths are drawn."""
    return _starts_and_splits(quota, shards, seed, leaves)[1]


def _starts_and_splits(quota: np.ndarray, shards: int, seed: int, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows for `leaves` of the tables (shard, source): blocks of the shards before it, and its own blocks."""
    known: dict[tuple[int, int], np.ndarray] = {(0, shards): quota}
    out, before = np.zeros((len(leaves), len(quota)), np.int64), np.zeros((len(leaves), len(quota)), np.int64)
    total = int(quota.sum())

    def room(lo: int, hi: int) -> int:  # blocks of shards lo to hi: the total dealt as evenly as whole blocks allow
        return total * hi // shards - total * lo // shards

    for k, leaf in enumerate(leaves.tolist()):
        lo, hi = 0, shards
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if (lo, mid) not in known:
                have = known[lo, hi]
                draw = np.random.default_rng([seed, lo, hi])
                left = _hypergeometric(draw, have, room(lo, mid))
                known[lo, mid], known[mid, hi] = left, have - left
            if leaf >= mid:
                before[k] += known[lo, mid]
            lo, hi = (lo, mid) if leaf < mid else (mid, hi)
        out[k] = known[lo, hi]
    return before, out


def _hypergeometric(draw: np.random.Generator, have: np.ndarray, n: int) -> np.ndarray:
    """A multivariate-hypergeometric draw of n, source by source, at any size of the counts."""
    out, rest, n = np.zeros_like(have), int(have.sum()), int(n)
    for i, h in enumerate(have.tolist()):
        rest -= h
        if rest + h < 1_000_000_000:
            out[i] = draw.hypergeometric(h, rest, n) if n and h else 0
        else:  # numpy's generator stops at 10^9: the normal limit, kept within what is possible
            mean = n * (h / (rest + h))
            sd = (mean * (1 - h / (rest + h)) * (rest + h - n) / max(1, rest + h - 1)) ** 0.5
            out[i] = min(max(round(draw.normal(mean, sd)), n - rest, 0), h, n)
        n -= int(out[i])
    return out


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: int = SEED, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """What the mix takes. docs: (uid, doc_id, source, text), uid telling rows apart.

    Returns (documents, draws): documents has uid, doc_id, source, size, source_size, target, copies; draws has a row for
    each copy taken: uid, copy, block, shard, place (a random order within the shard).
    """
    spark = docs.sparkSession
    # The random order is of ids, texts and seed, not of partitions; uid only parts rows that are equal.
    sized = docs.select("uid", "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("luck"))
    sized = common.table(sized, "sizes")
    goal = common.table(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs), "targets")
    placed = _line(sized).alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select("p.*", "source_size", "target")
    # A document is taken once for each whole run along the line, and once more if it ends before the target does.
    full = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))  # a source may have no words
    rest = F.col("target") - full * F.col("source_size")
    more = (F.col("start") + F.col("size") <= rest).cast("long")
    per_run = F.ceil(F.col("source_size") / block_words)
    placed = placed.withColumns({"copies": F.when(F.col("size") == 0, 0).otherwise(full + more).cast("long"), "blocks": (full * per_run + F.ceil(rest / block_words)).cast("long"), "per_run": per_run.cast("long"), "full": full})
    documents = common.table(placed, "placed")
    documents = common.table(_fill(documents, epochs), "filled")

    # Exact block quotas: blocks are numbered along the line, run after run.
    quotas = documents.filter("size > 0").groupBy("source").agg(F.max("blocks").alias("blocks"))
    quotas = common.table(quotas.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1), "quotas")
    return documents, _draws(spark, documents, quotas, seed, block_words)


def _line(rows: DataFrame) -> DataFrame:
    """rows (uid, doc_id, source, size, luck, ...) with start: words of the source before the row, in its random order.
    Prefix sums over 2^8 coarse slots of the order, over the 2^8 fine slots of each, then inside each fine slot."""
    rows = rows.withColumn("slot", F.shiftright("luck", 48))
    fine = rows.groupBy("source", "slot").agg(F.sum("size").alias("words")).withColumn("coarse", F.shiftright("slot", 8))
    coarse = fine.groupBy("source", "coarse").agg(F.sum("words").alias("all"))
    coarse = coarse.select("source", "coarse", (F.sum("all").over(Window.partitionBy("source").orderBy("coarse")) - F.col("all")).alias("base"))
    within = (F.sum("words").over(Window.partitionBy("source", "coarse").orderBy("slot")) - F.col("words")).alias("within")
    fine = fine.select("source", "coarse", "slot", within).alias("f")
    both = F.col("f.source").eqNullSafe(F.col("c.source")) & (F.col("f.coarse") == F.col("c.coarse"))
    before = fine.join(coarse.alias("c"), both).select("f.source", "slot", (F.col("base") + F.col("within")).alias("base"))
    inside = Window.partitionBy("source", "slot").orderBy("luck", "doc_id", "uid")
    placed = rows.withColumn("start", F.sum("size").over(inside) - F.col("size"))
    placed = placed.alias("p").join(before.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.slot") == F.col("b.slot")))
    return placed.select("p.*", "base").withColumn("start", F.col("start") + F.col("base")).drop("slot", "base")


def _fill(documents: DataFrame, epochs: int) -> DataFrame:
    """Fill what a source misses of its target: go on along its line past documents that do not fit, again and again over
    those left that are no larger than the gap, until the gap is below the smallest one left; and at last take that one
    if it comes nearer. last_start: where a document that fills the gap lies in its source's last run."""
    full = F.first(F.col("target") - F.col("full") * F.col("source_size")).alias("rest")
    gaps = documents.groupBy("source").agg(full, F.sum(F.col("size") * (F.col("copies") - F.col("full"))).alias("words"))
    gaps = common.table(gaps.select("source", (F.col("rest") - F.col("words")).alias("gap"), "rest"), "gaps")
    left = open_ = documents.filter((F.col("size") > 0) & (F.col("copies") == F.col("full")) & (F.col("copies") < epochs)).select("uid", "doc_id", "source", "size", "luck")
    taken = []
    while True:
        fits = left.alias("d").join(gaps.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")) & (F.col("d.size") <= F.col("g.gap"))).select("d.*", "gap", "rest")
        step = common.table(_line(fits).withColumn("takes", F.col("start") + F.col("size") <= F.col("gap")), "fits")
        now = step.filter("takes").select("uid", "source", "size", F.floor(F.col("rest") - F.col("gap") + F.col("start")).alias("last_start"))
        if now.isEmpty():  # the first one along the line fits, so none is left
            break
        taken.append(now.select("uid", "last_start"))
        words = now.groupBy("source").agg(F.sum("size").alias("words"))
        gaps = gaps.alias("g").join(words.alias("w"), F.col("g.source").eqNullSafe(F.col("w.source")), "left")
        gaps = common.table(gaps.select("g.source", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"), "rest"), "gaps")
        left = step.filter("NOT takes").select("uid", "doc_id", "source", "size", "luck")
    got = reduce(DataFrame.unionByName, taken) if taken else now.select("uid", "last_start")
    least = open_.join(got, "uid", "left_anti").groupBy("source").agg(F.min(F.struct("size", "luck", "doc_id", "uid")).alias("least"))
    last = least.alias("l").join(gaps.alias("g"), F.col("l.source").eqNullSafe(F.col("g.source"))).filter("least.size < 2 * gap")
    got = got.unionByName(last.select("least.uid", F.floor(F.col("rest") - F.col("gap")).alias("last_start")))
    out = documents.join(got, "uid", "left").withColumn("copies", F.col("copies") + F.col("last_start").isNotNull().cast("long"))
    return out.select(*documents.columns, "last_start")


def _draws(spark, documents: DataFrame, quotas: DataFrame, seed: int, block_words: int) -> DataFrame:
    # One number for each source: the size of the table of sources, never of documents.
    quota = np.array([r.blocks for r in quotas.orderBy("nth").select("blocks").collect()], np.int64)
    shards = max(1, -(-int(quota.sum()) // SHARD_BLOCKS))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            start, got = _starts_and_splits(quota, shards, seed, batch["id"].to_numpy())
            leaf, nth = np.nonzero(got)
            yield pd.DataFrame({"shard": batch["id"].to_numpy()[leaf], "nth": nth, "start": start[leaf, nth], "n": got[leaf, nth]})

    schema = "shard long, nth int, start long, n long"
    leaves = spark.range(shards).mapInPandas(split, schema) if len(quota) else spark.createDataFrame([], schema)
    dealt = leaves.select("shard", "nth", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("block"))
    dealt = dealt.join(F.broadcast(quotas) if len(quota) < 10_000 else quotas, "nth").select("source", "shard", "block")

    taken = documents.filter("copies > 0").select("uid", "luck", "source", "per_run", "blocks", "start", "full", "last_start", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    # What filled a gap lies in the last run where it was put.
    start = F.when(F.col("copy") == F.col("full"), F.coalesce("last_start", "start")).otherwise(F.col("start"))
    taken = taken.withColumn("run_block", F.least(F.col("copy") * F.col("per_run") + F.floor(start / block_words), F.col("blocks") - 1))
    drawn = taken.alias("t").join(dealt.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source")) & (F.col("t.run_block") == F.col("d.block")))
    return drawn.select("uid", "copy", F.col("run_block").alias("block"), "shard", F.xxhash64(F.lit(seed), "luck", "copy", "shard").alias("place"))


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards (the shards its copies go to)."""
    rows, uid = common.numbered_rows(docs.select("doc_id", "source", "text"))
    documents, draws = plan(rows.select(F.col(uid).alias("uid"), "doc_id", "source", "text"), **options)
    got = draws.groupBy("uid").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("shard")).alias("shards"))
    out = documents.select("uid", "doc_id", "size", "source_size", "target").join(got, "uid", "left")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("n", F.lit(0))).alias("taken"), F.coalesce("shards", F.array().cast("array<bigint>")).alias("shards"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs mixed: every copy taken is a row, in shard order and random order within a shard. Columns are those of docs."""
    rows, uid = common.numbered_rows(docs)
    _, draws = plan(rows.select(F.col(uid).alias("uid"), "doc_id", "source", "text"), **options)
    out = rows.join(draws.select(F.col("uid").alias(uid), F.col("shard").alias(f"{uid}_shard"), F.col("place").alias(f"{uid}_place")), uid)
    out = out.repartitionByRange(f"{uid}_shard").sortWithinPartitions(f"{uid}_shard", f"{uid}_place")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
