"""Free text as a few numbers: TF-IDF of words and pairs of words, projected on its leading directions.

What is learnt of training rows is a vocabulary with idf and a terms x k matrix of directions; it is applied to any rows. The
directions come from a randomised range finder: a random terms x l block is multiplied by the Gramian of the rows, one pass
over the rows each time, and only blocks of that size leave the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.operators.features import term_statistics, text_words


class TextProjector:
    """Fitted on `text` of the training rows. Null text has no terms; rows without a known term are zeros. Weights are
    (1 + ln tf) * idf, scaled to length 1. Fewer directions than asked for are filled up with zeros."""

    def __init__(self, train: DataFrame, text: str, row_id: str, terms: int = 400, k: int = 16, extra: int = 8, passes: int = 2, seed: int = 0):
        rows = term_statistics(train, text, row_id, terms).orderBy("term").collect()  # at most `terms`
        self.text, self.k = text, k
        self.place = {r.term: i for i, r in enumerate(rows)}
        self.idf = np.array([r.idf for r in rows])
        self.directions = self._range(train, min(len(rows), k + extra), passes, seed) if rows else np.zeros((0, k))

    def weights(self, words: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of a row's terms."""
        counts: dict[int, int] = {}
        for term in [*(words or ()), *(f"{a} {b}" for a, b in zip(words or (), (words or ())[1:]))]:
            if (i := self.place.get(term)) is not None:
                counts[i] = counts.get(i, 0) + 1
        at = np.fromiter(counts, np.int64, len(counts))
        w = np.array([1 + math.log(n) for n in counts.values()]) * self.idf[at] if counts else np.zeros(0)
        return at, w / np.linalg.norm(w) if counts else w

    def _matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, len(self.place)))
        for row, words in enumerate(batch.column("__words").to_pylist()):
            at, w = self.weights(words)
            out[row, at] = w
        return out

    def _times_gramian(self, train: DataFrame, block: np.ndarray) -> np.ndarray:
        """The Gramian of all rows times a terms x l block: one pass; tasks send one block each, summed by term."""
        shared, width = train.sparkSession.sparkContext.broadcast((self, block)), block.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, b = shared.value
            total = np.zeros_like(b)
            for batch in batches:
                for a in range(0, batch.num_rows, 1000):
                    x = own._matrix(batch.slice(a, 1000))
                    total += x.T @ (x @ b)
            at = np.flatnonzero(np.abs(total).sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, j]) for j in range(width))], ["at", *(f"v{j}" for j in range(width))])

        names = [f"v{j}" for j in range(width)]
        parts = train.select(text_words(self.text).alias("__words")).mapInArrow(run, "at long, " + ", ".join(f"{n} double" for n in names))
        out = np.zeros_like(block)
        for r in parts.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).collect():  # terms x l numbers
            out[r.at] = [r[n] for n in names]
        return out

    def _range(self, train: DataFrame, width: int, passes: int, seed: int) -> np.ndarray:
        self.directions = np.zeros((len(self.place), self.k))
        q = np.random.default_rng(seed).normal(size=(len(self.place), width))
        for _ in range(max(1, passes - 1)):
            q = np.linalg.qr(self._times_gramian(train, q))[0]
        small = q.T @ self._times_gramian(train, q)
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        v = (q @ vectors[:, ::-1])[:, : self.k] * (values[::-1][: self.k] > 1e-12)
        v = v * np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])  # the largest part of a direction is positive
        return np.pad(v, ((0, 0), (0, self.k - v.shape[1])))

    def names(self) -> list[str]:
        return [f"{self.text}__svd{j:02d}" for j in range(self.k)]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with a column for each direction."""
        shared, k = df.sparkSession.sparkContext.broadcast(self), self.k
        arrays = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for whole in batches:
                for a in range(0, whole.num_rows, 1000):
                    b = whole.slice(a, 1000)
                    got = own._matrix(b) @ own.directions
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * k), pa.array(got.ravel()))
                    kept = [i for i, n in enumerate(b.schema.names) if n != "__words"]
                    yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), lists], [*(b.schema.names[i] for i in kept), "__svd"])

        out = df.withColumn("__words", text_words(self.text)).mapInArrow(run, arrays + ", __svd array<double>")
        return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.get("__svd", F.lit(j)).alias(n) for j, n in enumerate(self.names())])


def term_weights(df: DataFrame, fitted: TextProjector, row_id: str) -> DataFrame:
    """row_id, term, weight: the TF-IDF of df's rows under what was fitted."""
    shared, id_type = df.sparkSession.sparkContext.broadcast(fitted), df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        terms = pa.array(list(own.place), pa.string())
        for b in batches:
            got = [own.weights(w) for w in b.column("__words").to_pylist()]
            rows = np.repeat(np.arange(len(got)), [len(at) for at, _ in got])
            at, w = (np.concatenate([np.zeros(0, t), *(g[i] for g in got)]) for i, t in ((0, np.int64), (1, float)))
            yield pa.RecordBatch.from_arrays([b.column(row_id).take(pa.array(rows)), terms.take(pa.array(at)), pa.array(w)], [row_id, "term", "weight"])

    return df.select(row_id, text_words(fitted.text).alias("__words")).mapInArrow(run, f"`{row_id}` {id_type}, term string, weight double")
