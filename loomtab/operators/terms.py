"""Words and pairs of words of whole texts, counted in Arrow batches, and the most frequent of them without counting all.

A pair is at most as frequent as either of its words. So what is at least as frequent as the n-th word, pairs included, is made
of words at least as frequent as that one: only these, some more than n, are looked at by pairs, and no pair of rare words is
ever counted, kept or shuffled. The words themselves are found in one pass: a piece of text tells its frequent words with their
counts, and the largest count among the words it leaves out. The sum of the latter bounds what any count lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that a task works on at once, whatever the batch holds.
PIECE_BYTES, BATCH_BYTES = 8 << 20, 16 << 20

#: ASCII letters, digits and _ stay, other ASCII becomes a space; bytes of longer characters stay.
_WORDLIKE = bytes(i if i >= 128 or i == 95 or chr(i).isalnum() else 32 for i in range(256))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of features.text_words, of texts in lower case without nulls: in one flat array, with the row of each."""
    plain = pc.replace_substring_regex(texts, pattern=r"[^\p{L}\p{N}_\x00-\x7F]+", replacement=" ")
    _, offsets, data = plain.buffers()
    data = data.to_pybytes().translate(_WORDLIKE) if data else b""
    plain = pa.StringArray.from_buffers(len(plain), offsets, pa.py_buffer(data), offset=plain.offset)
    lists = pc.split_pattern(plain, " ")
    flat = lists.flatten()
    long = pc.greater_equal(pc.utf8_length(flat), 2)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return flat.filter(long), rows[long.to_numpy(zero_copy_only=False)]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Whole rows of a batch, of at most `limit` bytes of text together; a longer text stands alone."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def _lowered(df: DataFrame, text: str, *others: str) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.select(*others, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__text"))


def _tally(codes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each code occurs, and 1 if all of that is in one row, else 2. Rows ascend; each code occurs."""
    first, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
    first[codes[::-1]], last[codes] = rows[::-1], rows  # of several, the one assigned last stays
    return np.bincount(codes, minlength=size), 1 + (first != last)


def piece_counts(df: DataFrame, text: str, share: int, pairs: bool = False) -> DataFrame:
    """term, n, d: words by piece of text with their counts, d as in _tally, and a null term with the largest count left out.

    Left out are words of at most one occurrence in `share` words; with pairs, all words and pairs of words are told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(terms: pa.Array, n: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([terms, pa.array(n.astype(np.int64)), pa.array(d.astype(np.int64))], ["term", "n", "d"])

        for batch in batches:
            for piece in pieces(batch, "__text"):
                words, rows = split_words(piece.column("__text"))
                coded = words.dictionary_encode()
                names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                n, d = _tally(codes, rows, len(names))
                kept = n > (0 if pairs else len(codes) // share)
                yield told(names.filter(pa.array(kept)), n[kept], d[kept])
                yield told(pa.array([None], pa.string()), n[~kept].max(initial=0, keepdims=True), np.zeros(1))
                if pairs and len(codes) > 1:
                    near = rows[1:] == rows[:-1]
                    made, at = np.unique((codes[:-1] * len(names) + codes[1:])[near], return_inverse=True)
                    a, b = (names.take(pa.array(x)) for x in np.divmod(made, len(names)))
                    yield told(pc.binary_join_element_wise(a, b, " "), *_tally(at, rows[1:][near], len(made)))

    return _lowered(df, text).mapInArrow(run, "term string, n long, d long")


def frequent_words(df: DataFrame, text: str, terms: int, share: int | None = None, most: int | None = None) -> tuple[list[str], int]:
    """Words of which the `terms` most frequent words and pairs of words in two rows or more are made, and a count that all of those have.

    There are `most` words at most. Where the bounds of one pass leave more of them in question, as in texts whose words are all
    about as frequent, all words and pairs are counted instead."""
    most = 4 * terms + 100 if most is None else most
    # The n-th word of a natural text is one in some 10 n: by this, counts lack a small part of that.
    share = 200 * terms if share is None else share
    counts = piece_counts(df, text, share).groupBy("term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    rows = counts.orderBy(F.col("term").isNotNull(), F.desc("n"), "term").limit(most + 2).collect()
    lacking = rows[0].n if rows else 0
    rows = rows[1:]
    sure = [r.n for r in rows if r.d >= 2]
    floor = max(2, sure[terms - 1]) if len(sure) >= terms else 2
    words = [r.term for r in rows if r.n + lacking >= floor]
    if lacking < floor and len(words) <= most:
        return words, floor
    every = piece_counts(df, text, share, pairs=True).filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    top = every.filter("d >= 2").orderBy(F.desc("n"), "term").limit(terms).collect()
    return sorted({w for r in top for w in r.term.split(" ")}), top[-1].n if len(top) == terms else 2


def row_terms(df: DataFrame, text: str, row_id: str, words: list[str]) -> DataFrame:
    """row_id, __at, __n: which of the words, and pairs of them side by side, stand in each row, and how often; see term_name."""
    width = len(words) + 1
    number = T.IntegerType() if width * width < 1 << 31 else T.LongType()
    made = T.StructType([df.schema[row_id], T.StructField("__at", T.ArrayType(number)), T.StructField("__n", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kind = pa.array(words, pa.string()), np.int32 if width * width < 1 << 31 else np.int64
        for batch in batches:
            for piece in pieces(batch, "__text"):
                flat, rows = split_words(piece.column("__text"))
                at = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                one = at >= 0
                two = one[:-1] & one[1:] & (rows[:-1] == rows[1:])
                terms = np.concatenate([at[one] * width, at[:-1][two] * width + at[1:][two] + 1])
                keys, n = np.unique(np.concatenate([rows[one], rows[:-1][two]]) * width**2 + terms, return_counts=True)
                ends = pa.array(np.searchsorted(keys, np.arange(piece.num_rows + 1) * width**2).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((keys % width**2).astype(kind), n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([piece.column(row_id), *lists], [row_id, "__at", "__n"])

    return _lowered(df, text, row_id).mapInArrow(run, made)


def term_name(words: list[str], at: int) -> str:
    first, second = divmod(at, len(words) + 1)
    return words[first] + (f" {words[second - 1]}" if second else "")


def top_terms(counted: DataFrame, words: list[str], terms: int, floor: int) -> tuple[list[tuple[str, int, int, int]], int]:
    """term, at, n, df of the most frequent terms in two rows or more, equal ones by name, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, place = np.unique(b.column("__at").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.bincount(place, b.column("__n").flatten().to_numpy(zero_copy_only=False), len(at))
            told = ([-1, *at], [b.num_rows, *n], [0, *np.bincount(place, minlength=len(at))])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in told], ["at", "n", "d"])

    sums = counted.select("__at", "__n").mapInArrow(run, "at long, n long, d long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    # Pairs as frequent as the last word are bounded by its count: a few for each word.
    rows = {r["at"]: r for r in sums.filter((F.col("at") < 0) | (F.col("n") >= floor) & (F.col("d") >= 2)).collect()}
    total = rows.pop(-1).n if rows else 0
    found = [(term_name(words, at), at, r.n, r.d) for at, r in rows.items()]
    return sorted(found, key=lambda t: (-t[2], t[0]))[:terms], total
