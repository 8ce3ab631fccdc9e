"""Trees that grow by whole levels: boosting on histograms with second-order leaves, and extremely randomised trees.

Rows are stored once. A level is one aggregate over them: tasks send every row down the trees so far and add up what the open
nodes need, by (class or tree, node, feature, bin); the sums of all tasks meet in a shuffle of such cells, windows over a
node's cells find its best split, and one line for each open node comes to the driver. The trees themselves, a few numbers a
node, are all that the driver and the tasks hold.

Models follow the estimators of models.py: fit(df) on `label` and `features` (a vector, or an array of doubles), transform(df)
adds `prediction`, and `probability` for classes 0 to classes - 1. Missing and NaN features have a place of their own. Rows
without a label are left out of fits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.stored import storage

#: Boosting rounds after which the margins are stored: tasks apply at most so many rounds of trees again.
STORE_ROUNDS = 10
#: Extremely randomised trees that grow side by side.
SIDE_BY_SIDE = 16


@dataclass
class Tree:
    """Nodes in the order they were made. left is a node's left child (the right one follows it), or -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, cut: float, missing_left: bool, values: tuple) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node] = feature, cut, missing_left, len(self.left)
        for v in values:
            self.feature.append(-1)
            self.cut.append(0.0)
            self.missing_left.append(False)
            self.left.append(-1)
            self.value.append(v)
        return self.left[node], self.left[node] + 1

    def places(self, x: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The node that each row of x (rows, features) ends in."""
        feature, cut, skip, left = np.array(self.feature), np.array(self.cut), np.array(self.missing_left), np.array(self.left)
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            f = np.maximum(feature[at], 0)
            right = np.where(missing[rows, f], ~skip[at], x[rows, f] > cut[at])
            at = np.where(left[at] >= 0, left[at] + right, at)
        return at


def _numbers(df: DataFrame) -> F.Column:
    """`features` as an array of doubles."""
    return vector_to_array("features") if dict(df.dtypes)["features"] == "vector" else F.col("features").cast("array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of `width` numbers as a matrix; nulls are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _targets(label: np.ndarray, classes: int) -> np.ndarray:
    """(rows, columns): the number itself, the chance of class 1 of two, or an indicator for each class."""
    return label[:, None] if classes < 3 else (label[:, None] == np.arange(classes)).astype(np.float64)


def _chances(margin: np.ndarray, classes: int) -> np.ndarray:
    if not classes:
        return margin
    if classes == 2:
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Model:
    """What both kinds of trees share when they predict: raw(x) gives (rows, columns) in a task."""

    def __init__(self, classes: int, width: int):
        self.classes, self.numClasses, self.width = classes, max(classes, 2), width

    def raw(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        """df with prediction (and probability)."""
        spark, width, classes = df.sparkSession, self.width, self.classes
        shared = spark.sparkContext.broadcast(self)  # bounded by the settings: trees, depth, features
        names = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for b in batches:
                got = model.raw(_matrix(b.column("__x"), width))
                if classes == 2 and got.shape[1] == 1:
                    got = np.concatenate([1 - got, got], 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * got.shape[1]), pa.array(got.ravel()))
                kept = [i for i, n in enumerate(b.schema.names) if n != "__x"]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), lists], [*(b.schema.names[i] for i in kept), "__p"])

        # Vectors travel as arrays and are made again: Arrow has no type for them.
        vectors = [n for n, t in df.dtypes if t == "vector"]
        rows = df.withColumn("__x", _numbers(df)).withColumns({v: vector_to_array(v) for v in vectors})
        schema = ", ".join([f"`{n}` {t if t != 'vector' else 'array<double>'}" for n, t in df.dtypes] + ["__p array<double>"])
        out = rows.mapInArrow(run, schema).withColumns({v: array_to_vector(v) for v in vectors})
        if not classes:
            return out.select(*names, F.get("__p", F.lit(0)).alias("prediction"))
        best = (F.array_position("__p", F.array_max("__p")) - 1).cast("double")
        return out.select(*names, array_to_vector("__p").alias("probability"), best.alias("prediction"))


# Boosting


class BoostedModel(Model):
    def __init__(self, classes: int, edges: list[list[float]], base: np.ndarray, trees: list[list[Tree]]):
        super().__init__(classes, len(edges))
        self.edges, self.base, self.trees = edges, base, trees

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([_binned(x[:, f], e) for f, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), np.int16)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        return _chances(self.base + _margins(b, self.trees, len(self.base)), self.classes)


def _binned(v: np.ndarray, edges: list[float]) -> np.ndarray:
    """0 for missing; else 1 + the number of edges below the value."""
    return np.where(np.isnan(v), 0, 1 + np.searchsorted(np.array(edges, np.float64), v, "left")).astype(np.int16)


def _margins(bins: np.ndarray, rounds: list[list[Tree]], columns: int) -> np.ndarray:
    out, missing = np.zeros((len(bins), columns)), bins == 0
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[:, k] += np.array(tree.value)[tree.places(bins, missing)]
    return out


def bin_edges(df: DataFrame, bins: int = 64, accuracy: int = 10_000) -> list[list[float]]:
    """Inclusive upper ends of the bins of each feature, from one quantile sketch a feature: every value that more than a
    share of 1 / bins of the rows has gets a bin of its own. df has `x`, an array; the last end is left out."""
    long = df.select(F.posexplode("x").alias("f", "v")).filter("v IS NOT NULL AND NOT isnan(v)")
    at = F.percentile_approx("v", [i / bins for i in range(bins + 1)], accuracy)
    found = {r.f: r.e for r in long.groupBy("f").agg(F.array_sort(F.array_distinct(at)).alias("e")).collect()}
    width = df.select(F.max(F.size("x"))).first()[0] or 0
    return [[float(v) for v in found.get(f, [])][:-1] for f in range(width)]


class HistBoosting:
    """Gradient boosting on binned features. A leaf is -G / (H + l2) times step, G and H the sums of first and second
    derivatives of the loss (squares, logistic, softmax); a split gains G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2).
    A round grows one tree, or one for each of three classes or more. Missing values go to the side that gains more."""

    def __init__(self, classes: int = 0, rounds: int = 150, step: float = 0.05, depth: int = 5, leaf: int = 20, bins: int = 64, l2: float = 0.0, least_hessian: float = 1e-3):
        self.classes, self.rounds, self.step, self.depth = classes, rounds, step, depth
        self.leaf, self.bins, self.l2, self.least_hessian = leaf, bins, l2, least_hessian

    def fit(self, df: DataFrame) -> BoostedModel:
        rows = df.filter("label IS NOT NULL").select(F.col("label").cast("double").alias("label"), _numbers(df).alias("x"))
        with storage(df.sparkSession) as keep:
            rows = keep(rows)
            edges, base = bin_edges(rows, self.bins), self._base(rows)
            model, columns = BoostedModel(self.classes, edges, base, []), len(base)
            stored = keep(self._with_margins(rows.select("label", "x"), model, "x"))
            done: list[list[Tree]] = []
            for n in range(self.rounds):
                trees = [Tree() for _ in range(columns)]
                opened = {(k, 0) for k in range(columns)}
                for _ in range(self.depth):
                    best = self.best_splits(stored, edges, model.trees[len(done) :], trees, opened)
                    opened = set()
                    for r in best:
                        left, right = trees[r.k].split(r.node, r.f, r.b, r.missing_left, (-self.step * r.gl / (r.hl + self.l2), -self.step * r.gr / (r.hr + self.l2)))
                        opened |= {(r.k, left), (r.k, right)}
                    for k in {k for k, _ in opened}:
                        trees[k].depth += 1
                    if not opened:
                        break
                if not any(t.depth for t in trees):
                    break
                model.trees.append(trees)
                if (n + 1) % STORE_ROUNDS == 0 and n + 1 < self.rounds:
                    part = BoostedModel(self.classes, edges, np.zeros(columns), model.trees[len(done) :])
                    stored, done = keep(self._with_margins(stored, part, "bins")), list(model.trees)
        return model

    def _base(self, rows: DataFrame) -> np.ndarray:
        """The constant that fits best: the mean, or (log) odds of the classes."""
        if not self.classes:
            return np.array([rows.agg(F.avg("label")).first()[0] or 0.0])
        counts = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
        share = np.array([max(counts.get(k, 0), 1e-9) for k in range(self.classes)], float)
        share /= share.sum()
        return np.array([math.log(share[1] / share[0])]) if self.classes == 2 else np.log(share)

    def _with_margins(self, rows: DataFrame, model: BoostedModel, source: str) -> DataFrame:
        """label, bins, margin: what stands so far; from raw features at first, then from what was stored."""
        shared, columns, width = rows.sparkSession.sparkContext.broadcast(model), len(model.base), len(model.edges)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in batches:
                bins = m.bins(_matrix(b.column("x"), width)) if source == "x" else _matrix(b.column("bins"), width).astype(np.int16)
                margin = m.base + _margins(bins, m.trees, columns)
                if source != "x":
                    margin = margin + _matrix(b.column("margin"), columns)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel())) for v in (bins, margin)]
                yield pa.RecordBatch.from_arrays([b.column("label"), *lists], ["label", "bins", "margin"])

        return rows.mapInArrow(run, "label double, bins array<smallint>, margin array<double>")

    def best_splits(self, stored: DataFrame, edges: list[list[float]], rounds: list[list[Tree]], trees: list[Tree], opened: set[tuple[int, int]]) -> list:
        """One row for each open node that can be split: k, node, f, b, missing_left, gain, and both sides' g, h, n."""
        sizes = [len(e) + 2 for e in edges]  # bins of a feature: missing, one for each edge, and one above
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        cells, columns, width, classes = int(starts[-1]), len(trees), len(edges), self.classes
        slots = [{node: i for i, node in enumerate(sorted(n for c, n in opened if c == k))} for k in range(columns)]
        shared = stored.sparkSession.sparkContext.broadcast((rounds, trees, slots))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, now, slot_of = shared.value
            sums = [np.zeros((3, len(s) * cells)) for s in slot_of]
            for b in batches:
                bins = _matrix(b.column("bins"), width).astype(np.int64)
                chance = _chances(_matrix(b.column("margin"), columns) + _margins(bins, before, columns), classes)
                y = _targets(b.column("label").to_numpy(zero_copy_only=False), classes)
                g, h = chance - y, chance * (1 - chance) if classes else np.ones_like(chance)
                for k, tree in enumerate(now):
                    place = np.full(len(tree.left), -1)
                    for node, i in slot_of[k].items():
                        place[node] = i
                    slot = place[tree.places(bins, bins == 0)]
                    ok = slot >= 0
                    for f in range(width):
                        cell = slot[ok] * cells + starts[f] + bins[ok, f]
                        for i, w in enumerate((g[ok, k], h[ok, k], None)):
                            sums[k][i] += np.bincount(cell, w, len(sums[k][i]))
            for k, s in enumerate(slot_of):
                at = np.flatnonzero(sums[k][2])
                nodes, inside = np.array(list(s), np.int32), at % cells if cells else at
                f = np.searchsorted(starts, inside, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)), pa.array(nodes[at // cells] if len(at) else np.zeros(0, np.int32)), pa.array(f.astype(np.int32)), pa.array((inside - starts[f]).astype(np.int32))]
                    + [pa.array(sums[k][0][at]), pa.array(sums[k][1][at]), pa.array(sums[k][2][at].astype(np.int64))],
                    ["k", "node", "f", "b", "g", "h", "n"],
                )

        parts = stored.mapInArrow(run, "k int, node int, f int, b int, g double, h double, n long")
        return self._best(parts.groupBy("k", "node", "f", "b").agg(*[F.sum(c).alias(c) for c in "ghn"])).collect()

    def _best(self, cells: DataFrame) -> DataFrame:
        """The best split of each node, from its cells: windows over the bins of a node's feature."""
        whole = Window.partitionBy("k", "node", "f")
        upto = whole.orderBy("b")
        c = cells.select("*", *[F.sum(F.when(F.col("b") > 0, F.col(x))).over(upto).alias(f"{x}c") for x in "ghn"], *[F.sum(x).over(whole).alias(f"{x}t") for x in "ghn"], *[F.coalesce(F.sum(F.when(F.col("b") == 0, F.col(x))).over(whole), F.lit(0)).alias(f"{x}m") for x in "ghn"])
        sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("missing_left")
        c = c.filter("b > 0").select("*", sides).filter("nm > 0 OR NOT missing_left")
        c = c.withColumns({f"{x}l": F.col(f"{x}c") + F.when(F.col("missing_left"), F.col(f"{x}m")).otherwise(0) for x in "ghn"})
        c = c.withColumns({f"{x}r": F.col(f"{x}t") - F.col(f"{x}l") for x in "ghn"})
        score = {s: F.try_divide(F.col(f"g{s}") * F.col(f"g{s}"), F.col(f"h{s}") + self.l2) for s in "lrt"}
        c = c.withColumn("gain", score["l"] + score["r"] - score["t"])
        c = c.filter((F.least("nl", "nr") >= self.leaf) & (F.least("hl", "hr") >= self.least_hessian) & (F.col("gain") > 1e-12))
        row = F.struct("f", "b", "missing_left", "gain", "gl", "hl", "nl", "gr", "hr", "nr")
        # Gains are compared as floats: what differs by the order of sums alone is a tie, which the first feature and bin win.
        return c.groupBy("k", "node").agg(F.min_by(row, F.struct(-F.col("gain").cast("float"), "f", "b", "missing_left")).alias("s")).select("k", "node", "s.*")


# Extremely randomised trees


def draw(seed: int, tree: int, node: int, feature: int) -> float:
    """A number in [0, 1) for a tree's node and feature: 32 bits of md5, which other engines can state."""
    return int(hashlib.md5(f"{seed}|{tree}|{node}|{feature}".encode()).hexdigest()[:8], 16) / 2**32


def tried(seed: int, tree: int, node: int, width: int, tries: int) -> list[int]:
    """The features that a node tries: those of the smallest draws under the next seed."""
    return sorted(range(width), key=lambda f: (draw(seed + 1, tree, node, f), f))[:tries]


class ExtraModel(Model):
    def __init__(self, classes: int, width: int, trees: list[Tree]):
        super().__init__(classes, width)
        self.trees = trees

    def raw(self, x: np.ndarray) -> np.ndarray:
        missing = np.isnan(x)
        return sum(np.array(t.value)[t.places(x, missing)] for t in self.trees) / len(self.trees)


class ExtraTrees:
    """Trees on all rows whose nodes try a few features, each at one random threshold between the node's extremes of it,
    and take the one that leaves least variance (least Gini impurity for classes). Missing values go left."""

    def __init__(self, classes: int = 0, trees: int = 200, depth: int = 10, leaf: int = 2, tries: int | None = None, seed: int = 7):
        self.classes, self.n_trees, self.depth, self.leaf, self.tries, self.seed = classes, trees, depth, leaf, tries, seed

    def fit(self, df: DataFrame) -> ExtraModel:
        rows = df.filter("label IS NOT NULL").select(F.col("label").cast("double").alias("label"), _numbers(df).alias("x"))
        with storage(df.sparkSession) as keep:
            rows = keep(rows)
            width = rows.select(F.max(F.size("x"))).first()[0] or 0
            tries = min(width, self.tries or max(1, round(math.sqrt(width))))
            grown: list[Tree] = []
            columns = self.classes or 1
            whole = [F.avg(F.col("label") if not self.classes else (F.col("label") == k).cast("double")) for k in range(columns)]
            mean = [v or 0.0 for v in rows.agg(*whole).first()]
            for first in range(0, self.n_trees, SIDE_BY_SIDE):
                batch = {t: Tree(value=[mean]) for t in range(first, min(first + SIDE_BY_SIDE, self.n_trees))}
                opened = {(t, 0) for t in batch}
                for _ in range(self.depth if width else 0):
                    found = self.best_splits(rows, batch, opened, width, tries)
                    opened = set()
                    for r in found:
                        values = [[s / n for s in sums] for sums, n in ((r.sl, r.nl), ([a - b for a, b in zip(r.st, r.sl, strict=True)], r.n - r.nl))]
                        left, right = batch[r.t].split(r.node, r.f, r.cut, True, tuple(values))
                        # A node of fewer rows than two leaves, or of one value, is done.
                        opened |= {(r.t, node) for node, n in ((left, r.nl), (right, r.n - r.nl)) if n >= 2 * self.leaf}
                    for t in {r.t for r in found}:
                        batch[t].depth += 1
                    if not opened:
                        break
                grown += batch.values()
        return ExtraModel(self.classes, width, grown)

    def best_splits(self, rows: DataFrame, trees: dict[int, Tree], opened: set[tuple[int, int]], width: int, tries: int) -> list:
        """t, node, f, cut, n, nl, sl, st (sums of the targets, left and whole) of each open node that can be split."""
        asked = {(t, node): tried(self.seed, t, node, width, tries) for t, node in opened}
        ends = self._cells(rows, trees, asked, None).groupBy("t", "node", "f").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
        cuts: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for r in ends:
            if r.lo is not None and r.lo < r.hi:
                cut = r.lo + draw(self.seed, r.t, r.node, r.f) * (r.hi - r.lo)
                cuts.setdefault((r.t, r.node), []).append((r.f, min(cut, np.nextafter(r.hi, -np.inf))))
        if not cuts:
            return []
        cells = self._cells(rows, trees, {k: [f for f, _ in v] for k, v in cuts.items()}, {(*k, f): c for k, v in cuts.items() for f, c in v})
        sums = cells.groupBy("t", "node", "f", "k").agg(F.first("cut").alias("cut"), *[F.sum(c).alias(c) for c in ("n", "nl", "sl", "st")])
        sums = sums.filter((F.col("nl") >= self.leaf) & (F.col("n") - F.col("nl") >= self.leaf))
        part = F.col("sl") * F.col("sl") / F.col("nl") + (F.col("st") - F.col("sl")) * (F.col("st") - F.col("sl")) / (F.col("n") - F.col("nl"))
        each = sums.groupBy("t", "node", "f").agg(*[F.first(c).alias(c) for c in ("cut", "n", "nl")], F.sum(part).alias("score"), F.sum(F.col("st") * F.col("st") / F.col("n")).alias("was"), F.array_sort(F.collect_list(F.struct("k", "sl", "st"))).alias("s"))
        row = F.struct("f", "cut", "n", "nl", F.col("s.sl").alias("sl"), F.col("s.st").alias("st"))
        better = each.filter(F.col("score") > F.col("was") * (1 + 1e-12))
        return better.groupBy("t", "node").agg(F.min_by(row, F.struct(-F.col("score").cast("float"), "f")).alias("s")).select("t", "node", "s.*").collect()

    def _cells(self, rows: DataFrame, trees: dict[int, Tree], asked: dict[tuple[int, int], list[int]], cuts: dict[tuple[int, int, int], float] | None) -> DataFrame:
        """Every task's extremes of the tried features of the open nodes; with cuts its counts and sums instead."""
        shared, classes = rows.sparkSession.sparkContext.broadcast((trees, asked, cuts)), self.classes
        columns = classes or 1
        schema = "t int, node int, f int, lo double, hi double" if cuts is None else "t int, node int, f int, k int, cut double, n long, nl long, sl double, st double"
        names = [c.split()[0] for c in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grown, todo, at = shared.value
            held: dict[tuple[int, int, int], list] = {}
            for b in batches:
                x = b.column("x")
                x = _matrix(x, len(x.flatten()) // max(1, len(x)))
                label = b.column("label").to_numpy(zero_copy_only=False)
                y = label[:, None] if not classes else (label[:, None] == np.arange(classes)).astype(np.float64)
                missing = np.isnan(x)
                for t, tree in grown.items():
                    place = tree.places(x, missing)
                    order = np.argsort(place, kind="stable")
                    nodes, first = np.unique(place[order], return_index=True)
                    for node, a, z in zip(nodes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
                        own = order[a:z]
                        for f in todo.get((t, node), ()):
                            v, key = x[own, f], (t, node, f)
                            if at is None:
                                v = v[~np.isnan(v)]
                                if len(v):
                                    lo, hi = held.get(key, (np.inf, -np.inf))
                                    held[key] = (min(lo, v.min()), max(hi, v.max()))
                            else:
                                left, new = ~(v > at[key]), y[own]
                                n, nl, sl, st = held.get(key, (0, 0, 0.0, 0.0))
                                held[key] = (n + len(own), nl + int(left.sum()), sl + new[left].sum(0), st + new.sum(0))
            if at is None:
                out = [(*k, float(lo), float(hi)) for k, (lo, hi) in held.items()]
            else:
                out = [(*key, k, at[key], n, nl, float(sl[k]), float(st[k])) for key, (n, nl, sl, st) in held.items() for k in range(columns)]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)), strict=True)), schema=_arrow(schema))

        return rows.mapInArrow(run, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])
