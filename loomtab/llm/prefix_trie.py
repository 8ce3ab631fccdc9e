"""Prefix trie of conversations: ternary search trees over ids of turns, one for each range of sequences.

Every distinct turn (role and text) gets a number from a dictionary. A conversation is then a sequence of numbers, and equal
sequences become one row with its number of conversations, its smallest conv_id and a digest of all of them. The sequences
are dealt to shards by ranges of their order. A shard builds one ternary search tree, inserting the median of its sorted
sequences first, then the medians of both halves and so on, so that the trees of siblings are balanced. One walk over the
nodes, last made first, adds up members, children, leaves and savings. What is not on the path of a shard's first or last
sequence belongs to this shard alone and is done. The nodes on these two paths may go on in the neighbours: they are merged
in rounds of FAN_IN neighbouring shards, and each round finishes what is not on the outer paths of its group.

Null role or text is empty. Rows without conv_id belong to no conversation and are left out. Equal turns of a conversation are
taken null first and, where turn numbers tie, in the order of the turn's SHA-256, so repeated rows stand next to each other
and each counts. An empty table has no conversation and no node. Columns other than conv_id, turn, role and text are not looked
at, whatever their names. Texts are digested whole in the JVM and travel no further; a conversation travels as 16 bytes a turn
in one row, which bounds it to some 100 million turns. Members of a hot sequence are digested in sorted runs: no task gathers them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: A shard holds so many turns of distinct sequences, or one longer sequence: some 200 MB while its tree is walked.
SHARD_TURNS = 400_000
#: Neighbouring shards whose open nodes are merged by one task.
FAN_IN = 16
#: Decimal conv_ids of a sequence that travel as one string.
RUN_IDS = 4096
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: A finished node (done) or a part of an open one; key and parent_key name open nodes, left and right the outer paths they are on.
PART = NODE + ", done boolean, key string, parent_key string, bytes long, shard long, left boolean, right boolean"
COLUMNS = [c.split()[0] for c in PART.split(", ")]


# Sequences


def turn_ids(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id, bytes: every turn by its number in the dictionary of distinct (role, text). Numbers rise with the
    turns' SHA-256."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    words = turns.groupBy("digest").agg(F.max("bytes").alias("bytes")).repartitionByRange("digest").sortWithinPartitions("digest")
    words = common.table(words.withColumn("id", F.monotonically_increasing_id()), "turns")
    return turns.drop("bytes").join(words, "digest").select("conv_id", "turn", "id", "bytes")


def own_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, ids, bytes: the conversations as they are, turn by turn. Turns meet in parts that tasks have gathered before."""
    turns = turn_ids(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "bytes"))).alias("turns"))
    return turns.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("bytes"))


def rebuild(sequences: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """conv_id, ids, bytes: the first h turns of conversation c - c % family, then what c has after its own first h turns;
    h = crc32(c) % heads. Both arrays are cut alike."""
    base = F.col("conv_id") - F.col("conv_id") % family
    # A family has at most 2 * family - 1 conversations (around zero), each one row.
    met = sequences.groupBy(base.alias("base")).agg(F.collect_list(F.struct("conv_id", "ids", "bytes")).alias("all"))
    met = met.select("base", F.get(F.filter("all", lambda c: c["conv_id"] == F.col("base")), 0).alias("head"), F.explode("all").alias("c"))
    h = common.crc_mod("c.conv_id", heads).cast("int")

    def spliced(name: str) -> F.Column:
        first = F.coalesce(F.slice(F.col(f"head.{name}"), F.lit(1), h), F.array().cast("array<long>"))
        return F.concat(first, F.slice(F.col(f"c.{name}"), h + 1, F.size(f"c.{name}") + 1)).alias(name)

    return met.select("c.conv_id", spliced("ids"), spliced("bytes"))


# Distinct sequences


def distinct(sequences: DataFrame) -> DataFrame:
    """ids, bytes, n, conv_id (the smallest), ends_sha256: one row for each distinct sequence.

    Members are sorted by ranges of (sequence, conv_id), which part hot sequences; a task joins runs of up to RUN_IDS ids, and
    the runs of a sequence pass through one hash in order, row by row."""
    rows = common.table(sequences.withColumn("key", F.unhex(F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256))), "sequences")
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            cut = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            cut = [a for a, b in zip(cut, [*cut[1:], len(keys)]) for a in range(a, b, RUN_IDS)]
            ends = [*cut[1:], len(keys)]
            first = batch.take(pa.array(cut, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [first.column(c) for c in ("key", "conv_id", "ids", "bytes")]
                + [pa.array([b - a for a, b in zip(cut, ends)], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in zip(cut, ends)])],
                ["key", "conv_id", "ids", "bytes", "n", "run"],
            )

    runs_of = rows.transform(common.map_batches, runs, "key binary, conv_id long, ids array<long>, bytes array<long>, n long, run string")
    runs_of = runs_of.repartition("key").sortWithinPartitions("key", "conv_id")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, total, sha = None, None, 0, hashlib.sha256()

        def closed() -> list:
            return [[held.column(c) for c in ("ids", "bytes", "conv_id")] + [pa.array([total], pa.int64()), pa.array([sha.hexdigest()])]] if held else []

        for batch in batches:
            out = []
            for i, (key, n, run) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "n", "run")), strict=True)):
                if key != last:
                    out += closed()
                    last, held, total, sha = key, batch.slice(i, 1), n, hashlib.sha256(run.encode())
                else:
                    total += n
                    sha.update(b"," + run.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*out, strict=True)], ["ids", "bytes", "conv_id", "n", "ends_sha256"])
            held = held.take(pa.array([0])) if held else None  # a copy, which lets the batch go
        for row in closed():
            yield pa.RecordBatch.from_arrays(row, ["ids", "bytes", "conv_id", "n", "ends_sha256"])

    return runs_of.transform(common.map_batches, digest, "ids array<long>, bytes array<long>, conv_id long, n long, ends_sha256 string")


# Trees


class TernaryTree:
    """A ternary search tree over sequences of ids. Every node is the prefix that ends in it; node 0 is the empty prefix."""

    def __init__(self):
        self.id, self.low, self.high, self.down = [-1], [0], [0], [0]
        self.parent, self.depth, self.bytes = [0], [0], [0]

    def _new(self, token: int, parent: int, size: int) -> int:
        self.id.append(token)
        for links in (self.low, self.high, self.down):
            links.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.bytes.append(size)
        return len(self.id) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node of the whole sequence."""
        at = 0
        for token, size in zip(ids, sizes, strict=True):
            links, place = self.down, at
            while node := links[place]:
                if token == self.id[node]:
                    break
                links, place = (self.low, node) if token < self.id[node] else (self.high, node)
            if not node:
                node = links[place] = self._new(token, at, size)
            at = node
        return at

    def path(self, node: int) -> list[int]:
        """Nodes from the root to node."""
        out = [node]
        while node:
            node = self.parent[node]
            out.append(node)
        return out[::-1]


def balanced(n: int) -> Iterator[int]:
    """0 to n - 1 with every range's median before the rest of the range."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


def open_keys(path_ids: list[int]) -> list[str]:
    """A name for every prefix of a sequence, the same in all shards."""
    sha, out = hashlib.sha256(), []
    for token in [None, *path_ids]:
        sha.update(b"" if token is None else token.to_bytes(8, "big"))
        out.append(sha.hexdigest())
    return out


def shard_nodes(rows: list[tuple[list[int], list[int], int, int, str]], shard: int) -> dict[str, list]:
    """Columns of PART for one shard. rows: (ids, sizes, n, smallest conv_id, ends_sha256), distinct and sorted by ids."""
    tree, ends = TernaryTree(), {}
    for i in balanced(len(rows)):
        ends[tree.insert(rows[i][0], rows[i][1])] = i
    size = len(tree.id)
    n, least, leaves, saved, children = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    sha = [EMPTY] * size
    for node, i in ends.items():
        _, _, n[node], least[node], sha[node] = rows[i]
    node_of = {i: node for node, i in ends.items()}
    first, last = tree.path(node_of[0]), tree.path(node_of[len(rows) - 1])
    keys = dict(zip(first, open_keys(rows[0][0]))) | dict(zip(last, open_keys(rows[-1][0])))
    left, right = set(first), set(last)
    parent, depth, width = tree.parent, tree.depth, tree.bytes
    for node in range(size - 1, 0, -1):  # children were made after their parents
        up = parent[node]
        n[up] += n[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
        if node not in keys:
            leaves[node] += not children[node]
            saved[node] += (n[node] - 1) * width[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    done = [node not in keys for node in range(size)]
    return {
        "conv_id": least, "depth": depth, "parent_conv_id": [least[parent[i]] if i and done[parent[i]] else None for i in range(size)],
        "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": sha,
        "done": done, "key": [keys.get(i) for i in range(size)], "parent_key": [keys.get(parent[i]) if i else None for i in range(size)],
        "bytes": width, "shard": [shard] * size, "left": [i in left for i in range(size)], "right": [i in right for i in range(size)],
    }


def shards(sequences: DataFrame) -> DataFrame:
    """PART rows of all shards. sequences: what distinct() gives, stored."""
    turns = sequences.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    parts = math.ceil(turns / SHARD_TURNS)
    parts = max(parts, min(4 * sequences.sparkSession.sparkContext.defaultParallelism, math.ceil(turns / 5000)), 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("ids", "bytes", "n", "conv_id", "ends_sha256")), strict=True)]
        if rows:
            got = pa.table(shard_nodes(rows, TaskContext.get().partitionId()), _arrow(PART))
            yield from got.to_batches(max_chunksize=50_000)

    return sequences.repartitionByRange(parts, "ids").sortWithinPartitions("ids").transform(common.map_batches, build, PART)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def merge_last(parts: pd.DataFrame) -> pd.DataFrame:
    """The open parts of all shards: every node is done."""
    return merge_group(parts, True)


def merge_some(parts: pd.DataFrame) -> pd.DataFrame:
    return merge_group(parts, False)


def merge_group(parts: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Open parts of neighbouring shards as one: nodes off the outer paths are done, the others stay open for the next round."""
    lo, hi = parts["shard"].min(), parts["shard"].max()
    nodes: dict[str, dict] = {}
    for r in parts.sort_values("depth", kind="stable").to_dict("records"):
        outer = {"left": r["left"] and r["shard"] == lo, "right": r["right"] and r["shard"] == hi}
        if (x := nodes.get(r["key"])) is None:
            nodes[r["key"]] = r | outer
            continue
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            x[c] += r[c]
        x["conv_id"] = min(x["conv_id"], r["conv_id"])
        x["ends_sha256"] = r["ends_sha256"] if x["ends_sha256"] == EMPTY else x["ends_sha256"]
        x |= {k: x[k] or outer[k] for k in outer}
    for x in reversed(nodes.values()):  # deeper nodes first
        x["done"] = last or not (x["left"] or x["right"])
        if x["done"]:
            x["n_leaves"] += not x["n_children"]
            x["saved_tokens"] += (x["n_convs"] - 1) * x["bytes"]
            if up := nodes.get(x["parent_key"]):
                up["n_children"] += 1
                up["n_leaves"] += x["n_leaves"]
                up["saved_tokens"] += x["saved_tokens"]
    return pd.DataFrame(list(nodes.values()), columns=COLUMNS)


def trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of sequences (conv_id, ids, bytes): the columns of NODE."""
    parts = common.table(shards(common.table(distinct(sequences), "distinct")), "parts")
    finished = [parts.filter("done")]
    still, n = parts.filter("not done"), (parts.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        n = -(-n // FAN_IN)
        group = F.floor(F.col("shard") / FAN_IN)
        last = n == 1
        merged = still.groupBy(group.alias("group")).applyInPandas(merge_last if last else merge_some, PART)
        merged = common.table(merged, "merged")
        finished.append(merged.filter("done"))
        still = merged.filter("not done").withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        if last:
            break
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.unionByName(more)
    names = [c.split()[0] for c in NODE.split(", ")]
    # What hangs on nodes that were open learns their smallest member now; the others know it.
    ends = nodes.filter("key is not null").select(F.col("key").alias("up_key"), F.col("conv_id").alias("up_id"))
    known, open_ = nodes.filter("parent_key is null"), nodes.filter("parent_key is not null")
    open_ = open_.join(ends, open_["parent_key"] == ends["up_key"]).withColumn("parent_conv_id", F.col("up_id"))
    return known.select(names).unionByName(open_.select(names))


def report(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    return trie(rebuild(own_sequences(conversations)))
