"""Ranked lexical search of all documents for many queries at once, sharing what the queries have in common.

A query's score is a sum over its terms, so queries with terms in common have partial sums in common. Queries come in blocks
of bounded size. For each block a plan is mined: the terms of every query are put in order of how many queries hold them, and
the pair of neighbours that most queries share becomes a new symbol, round after round (terms of equal membership are
neighbours, so whole shared sets grow out of pairs). Symbols form a directed acyclic graph over terms; a query is the sum of the
few symbols that are left of it. Nothing in this is quadratic in the terms of a query or in the queries of a term.

Documents are read once for a block: words that the block asks for are counted into postings of the document, and the number
of documents that hold each term is added up from there. Then every task scores its postings slice by slice: a row of term
contributions for each term, one addition for each symbol, which is the partial accumulator that all queries above it reuse,
and one sum for each query. Only the best `top` rows of each query leave a task, ties included by their order.

A document's m is 100 - 90 + (90 * n * N) div L with the document's n terms; a term adds w * (10^9 tf div (1000 tf + 8 m)), with
w = floor(1000 ln((2N + 2) / (2 df + 1))).

Null text has no terms and is neither counted nor found; a query without terms finds nothing. Queries of equal term sets are
evaluated once and each get their rows, so repeated items repeat. Repeated documents and equal doc_ids are ranked row by row;
equal scores by ascending doc_id, null last. Empty tables give an empty result. Columns other than doc_id, item_id and text are
not looked at, whatever their names. Texts are counted whole: a task holds a batch or one longer text, and a slice of rows.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 10
#: Query terms of a block, repeats over its queries counted; what a block's tables in the driver and in each worker hold.
BLOCK_TERMS = 200_000
#: Numbers that one slice of documents holds for terms, symbols and queries together: 64 MB.
SLICE_CELLS = 8 << 20
CHUNK = 4 << 20
ROUNDS = 200
#: Bytes of terms, A-Z in lower case; every other byte parts them.
_TABLE = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def term_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in one array, and the number of terms of each text."""
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1] if len(texts) else 0]
    clean = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_TABLE[data].tobytes()))
    return common.space_words(clean, lower=False)


# Plans


def mine(queries: list[list[int]], n_terms: int, rounds: int = ROUNDS) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Shared sums of queries (sets of terms 0 to n_terms - 1): pairs of symbols, and the symbols that each query is the sum of.

    Symbol n_terms + i stands for the i-th pair, whose members are terms or earlier symbols."""
    holders: dict[int, list[int]] = {}
    for q, terms in enumerate(queries):
        for t in terms:
            holders.setdefault(t, []).append(q)
    place = {t: k for k, t in enumerate(sorted(holders, key=lambda t: (-len(holders[t]), holders[t], t)))}
    left = [sorted(terms, key=place.__getitem__) for terms in queries]
    pairs: list[tuple[int, int]] = []
    for _ in range(rounds):
        seen = Counter(p for q in left for p in zip(q, q[1:]))
        chosen, busy = {}, set()
        for pair, count in sorted(((p, c) for p, c in seen.items() if c > 1), key=lambda x: (-x[1], x[0])):
            if busy.isdisjoint(pair):  # a symbol joins one pair a round, so pairs never overlap
                busy.update(pair)
                chosen[pair] = n_terms + len(pairs)
                pairs.append(pair)
        if not chosen:
            break
        for k, q in enumerate(left):
            out = []
            for s in q:
                if out and (new := chosen.get((out[-1], s))) is not None:
                    out[-1] = new
                else:
                    out.append(s)
            left[k] = out
    return pairs, left


def additions(pairs: list[tuple[int, int]], queries: list[list[int]]) -> int:
    """Row additions of a plan."""
    return len(pairs) + sum(max(0, len(q) - 1) for q in queries)


def term_sets(items: DataFrame) -> DataFrame:
    """item_id, query, terms: every item with terms, its sorted term set, and a digest that names the set."""
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.sort_array(F.array_distinct(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(0))))
    sets = items.select("item_id", terms.alias("terms")).filter(F.size("terms") > 0)
    return sets.withColumn("query", F.unhex(F.sha2(F.array_join("terms", " ").cast("binary"), 256)))


def plan_blocks(sets: DataFrame, block_terms: int = BLOCK_TERMS) -> list[str]:
    """Plan files of all blocks of queries, each made by one task from its block's term sets."""
    unique = sets.groupBy("query").agg(F.first("terms").alias("terms"))
    unique = common.table(unique, "queries")
    n = math.ceil((unique.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms)
    folder = common.fresh_dir(sets.sparkSession, "plans")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms = [], []
        for b in batches:
            names += b.column("query").to_pylist()
            terms += b.column("terms").to_pylist()
        if not names:
            return
        vocabulary = sorted({t for q in terms for t in q})
        number = {t: k for k, t in enumerate(vocabulary)}
        pairs, left = mine([[number[t] for t in q] for q in terms], len(vocabulary))
        path = f"{folder}/{uuid.uuid4().hex}"
        common.write_file(path, json.dumps({"terms": vocabulary, "pairs": pairs, "queries": left, "names": [x.hex() for x in names]}).encode())
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    # Dealt by a hash of the whole set, so that a term that many queries hold fills no block.
    blocks = unique.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(max(1, n)))).groupBy("block").agg(F.collect_list(F.struct("query", "terms")).alias("q"))
    rows = blocks.select("block", F.explode("q").alias("q")).select("block", "q.query", "q.terms")

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block stand together."""
        at, held = None, []
        for batch in batches:
            ids = batch.column("block").to_pylist()
            cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if held and ids[a] != at:
                    yield from build(iter(held))
                    held = []
                if b > a:
                    at = ids[a]
                    held.append(batch.slice(a, b - a))
        yield from build(iter(held))

    return sorted(r.path for r in common.table(rows.transform(common.map_batches, by_block, "path string"), "manifest").collect())


class Plan:
    """A block's plan, opened in a worker."""

    def __init__(self, path: str):
        got = json.loads(common.read_file(path).tobytes())
        self.terms = pa.array(got["terms"], pa.string())
        self.pairs, self.queries = got["pairs"], [np.array(q, np.int64) for q in got["queries"]]
        self.names = [bytes.fromhex(x) for x in got["names"]]


def _plan(path: str) -> Plan:
    return common.kept(f"search {path}", lambda: Plan(path))


# Documents


def postings(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n (all terms of the text), terms and tfs of the plan's terms that are in it; documents without terms are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _plan(path)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK):
                flat, n = term_words(common.texts(part.column("text")))
                term = pc.fill_null(pc.index_in(flat, plan.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                hit = term >= 0
                cell, tf = np.unique(np.repeat(np.arange(len(n)), n)[hit] * len(plan.terms) + term[hit], return_counts=True)
                sizes = np.bincount(cell // max(1, len(plan.terms)), minlength=len(n))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (cell % max(1, len(plan.terms)), tf)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.transform(common.map_batches, count, "doc_id long, n long, terms array<int>, tfs array<int>")


def frequencies(found: DataFrame, path: str) -> dict[int, int]:
    """How many documents hold each of the plan's terms: at most a block's terms, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _plan(path)
        total = np.zeros(len(plan.terms), np.int64)
        for b in batches:
            total += np.bincount(b.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    rows = found.select("terms").transform(common.map_batches, count, "term int, df long")
    return {r.term: r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best rows of every query so far: scores falling, doc_ids rising with null last."""

    def __init__(self, n: int, top: int):
        self.top, self.least = top, np.ones(n, np.int64)
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in range(n)]

    def add(self, q: int, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least[q])
        if len(at) > 4 * self.top:  # what is below the top-th score of this slice cannot stay
            at = at[scores[at] >= np.partition(scores[at], -self.top)[-self.top]]
            order = np.lexsort((docs[at], null[at], -scores[at]))
            at = at[order[: self.top]]
        rows = self.rows[q] = sorted([*self.rows[q], *zip((-scores[at]).tolist(), null[at].tolist(), docs[at].tolist())])[: self.top]
        if len(rows) == self.top:
            self.least[q] = -rows[-1][0]


def score(found: DataFrame, path: str, n_docs: int, n_terms: int, weights: dict[int, int], top: int = TOP) -> DataFrame:
    """query, doc_id, score: each task's best rows of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _plan(path)
        n_rows = len(plan.terms) + len(plan.pairs)
        w = np.array([weights.get(t, 0) for t in range(len(plan.terms))], np.int64)
        step = max(1, SLICE_CELLS // (n_rows + len(plan.queries)))
        best = Best(len(plan.queries), top)
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(part.column("doc_id"), 0).to_numpy(zero_copy_only=False)
                # Python's integers: 90 * n * N passes 64 bits where corpora are large.
                m = np.array([10 + 90 * n * n_docs // n_terms for n in part.column("n").to_pylist()], np.int64)
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False))
                term = part.column("terms").flatten().to_numpy(zero_copy_only=False)
                tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sums = np.zeros((n_rows, part.num_rows), np.int64)
                sums[term, doc] = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                for k, (x, y) in enumerate(plan.pairs, len(plan.terms)):
                    np.add(sums[x], sums[y], out=sums[k])
                for q, symbols in enumerate(plan.queries):
                    total = sums[symbols[0]] if len(symbols) == 1 else sums[symbols].sum(0)
                    if total.max(initial=0) >= best.least[q]:
                        best.add(q, total, ids, null)
        rows = [(plan.names[q], None if null else key, -minus) for q, kept in enumerate(best.rows) for minus, null, key in kept]
        names, docs, scores = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["query", "doc_id", "score"])

    return found.transform(common.map_batches, run, "query binary, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of every item, score above 0."""
    sets = common.table(term_sets(items), "items")
    ranked, totals = None, None
    for path in plan_blocks(sets, block_terms):
        found = common.table(postings(docs, path), "postings")
        totals = totals or found.agg(F.count("*"), F.sum("n")).first()
        n_docs, n_terms = totals
        weights = {t: weight(n_docs, df) for t, df in frequencies(found, path).items()}
        got = score(found, path, n_docs, n_terms or 1, weights, top)
        ranked = got if ranked is None else ranked.unionByName(got)
    if ranked is None:
        return sets.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return sets.select("item_id", "query").join(ranked, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
