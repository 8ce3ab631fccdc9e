"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items go into one suffix automaton. A document's words stream through it: the state always stands
for the longest suffix read so far that occurs in some item, and `length` for how long it is. A document word is hit
when it lies inside an occurrence of a window: `window` consecutive words of an item, or a whole shorter item.

Items are dealt to blocks of about BLOCK_WORDS words by a prefix sum of their words; longer items are cut into pieces
that share window - 1 words, which loses no window. A task builds the automaton of a block and writes it to the shared
folder; nothing but the files' names comes to the driver. Documents are read once: a task holds one automaton at a time and
takes each batch of documents through all of them. (A benchmark of usual size is one block, which a worker keeps.)

Null or wordless text has no words, no hits and stays. Items without words are never found. Equal items each count. Rows
are scanned one by one, so repeated documents and equal or null doc_ids give a row each; an empty table of documents gives
an empty result, an empty benchmark no hits; items of null id count as one of the empty id; columns other than doc_id and text are carried along or not looked at, and names
that clash are told apart by a prefix. Texts are scanned whole: a task holds a batch or one longer text, and some 60 bytes for
each of its words.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 10
BLOCK_WORDS = 500_000
#: Bytes of words: A-Z in lower case, a-z, 0-9 and all that is not ASCII; everything else parts words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class Automaton:
    """Generalised suffix automaton over items' words; a state knows the items whose windows end in it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, item in items:
            last = 0
            for w in item:
                last = self._extend(last, w)
        # By state, filled in order of length: the state of its suffixes of `window` words (0 if it is shorter), and the shorter
        # items that are suffixes of it, with their lengths, longest first. Both take what the suffix link has.
        self.whole = [0] * len(self.next)
        self.short: dict[int, list[tuple[int, str]]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        marks: list[tuple[int, str]] = []
        for key, item in items:
            state = 0
            for n, w in enumerate(item):
                state = self.next[state][w]
                if n + 1 >= window:
                    marks.append((state, key))
            if 0 < len(item) < window:
                ends.setdefault(state, []).append((len(item), key))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= window:
                self.whole[state] = self.whole[up] or state
            if state in ends:
                self.short[state] = sorted(ends[state], reverse=True) + self.short.get(up, [])
            elif up in self.short:
                self.short[state] = self.short[up]
        self.found: dict[int, set[str]] = {}  # by state of `window` words: items with a window that it stands for
        for state, key in marks:
            self.found.setdefault(self.whole[state], set()).add(key)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans [start, end) of hit words, and the items found."""
        nxt, link, length, window, short, whole = self.next, self.link, self.length, self.window, self.short, self.whole
        spans: list[list[int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        state = n = 0
        here = nxt[0]

        def hit(start: int, end: int) -> None:
            while spans and start <= spans[-1][1]:
                start, end = min(start, spans[-1][0]), max(end, spans.pop()[1])
            spans.append([start, end])

        for i, w in enumerate(text):
            to = here.get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(w)
            if to is None:
                here = nxt[0]
                continue
            state, n = to, n + 1
            if n >= window:
                hit(i + 1 - n, i + 1)
                if (at := whole[state]) not in seen:
                    seen.add(at)
                    items |= self.found[at]
            if state in short:
                for size, key in short[state]:
                    if size <= n:
                        hit(i + 1 - size, i + 1)
                        items.add(key)
            here = nxt[state]
        return [(a, b) for a, b in spans], items


def pieces(benchmark: DataFrame, window: int = WINDOW, most: int = BLOCK_WORDS) -> DataFrame:
    """key, words (parted by spaces), n: items in lower case, cut into pieces of at most `most` words (twice the window at
    least) that share window - 1 words with the next. Pieces that say the same of the same item stand once."""
    most = max(most, 2 * window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                item = words(text)
                last = max(len(item) - window, 0) if len(item) > most else 0  # where the last window starts
                own = [item[at : at + most] for at in range(0, last + 1, most - window + 1)] if item else []
                keys += [key] * len(own)
                parts += own
            columns = [pa.array(keys, pa.string()), pa.array([b" ".join(x).decode() for x in parts], pa.string()), pa.array(list(map(len, parts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "words", "n"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("key"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    return items.transform(common.map_batches, cut, "key string, words string, n long").distinct()


def write_automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[str]:
    """Names of the files with the automata of all items, each built by a task from at most block_words words, or four times
    the window where that is more."""
    half = max(1, block_words // 2)  # a block is what starts in a stretch of half of its words; the last piece may reach beyond it
    rows = common.table(pieces(benchmark, window, half).withColumn("luck", F.xxhash64("key", "words")).withColumn("slot", F.shiftright("luck", 48)), "items")
    slots = rows.groupBy("slot").agg(F.sum("n").alias("all"))
    base = slots.select("slot", (F.sum("all").over(Window.orderBy("slot")) - F.col("all")).alias("base"))  # over 65,536 slots at most
    inside = Window.partitionBy("slot").orderBy("luck", "key", "words")
    start = F.col("base") + F.sum("n").over(inside) - F.col("n")
    dealt = rows.join(base, "slot").select(F.floor(start / half).alias("block"), "key", "words")
    folder = common.fresh_dir(benchmark.sparkSession, "automata")

    def build(block: pd.DataFrame) -> pd.DataFrame:
        items = sorted((k, w.encode().split()) for k, w in zip(block["key"], block["words"], strict=True))
        path = f"{folder}/{uuid.uuid4().hex}"  # of the attempt, so that a lost or second one leaves no trace in the list
        common.write_file(path, pickle.dumps(Automaton(items, window)))
        return pd.DataFrame({"block": block["block"].iloc[:1], "path": [path]})

    built = common.spread(dealt, "block").groupBy("block").applyInPandas(build, "block long, path string")
    return [r.path for r in built.orderBy("block").collect()]  # a line for each block of words


def _scanner(paths: list[str]) -> Callable[[list[str | None]], list[tuple[int, list[int], list[str]]]]:
    """What gives n_words, spans and items of each of a batch of texts, with one automaton in memory at a time."""

    def scan(texts: list[str | None]) -> list[tuple[int, list[int], list[str]]]:
        out = [(len(words(t)), [], []) for t in texts] if len(paths) != 1 else [(0, [], [])] * len(texts)
        for path in paths:
            automaton = common.kept(path, lambda path=path: pickle.loads(common.read_file(path)))
            for i, text in enumerate(texts):
                read = words(text)
                got, found = automaton.scan(read)
                out[i] = (len(read), _merge(got, out[i][1]), sorted({*out[i][2], *found}))
        return out

    return scan


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, prefix: str = "") -> DataFrame:
    """docs with n_words, spans (starts and ends of hit words, in turn) and items (ids of items found, sorted).

    The three names take a prefix where docs has columns of these names. The automata are built when this is called."""
    scan = _scanner(write_automata(benchmark, window, block_words))
    own = [T.StructField(prefix + "n_words", T.LongType()), T.StructField(prefix + "spans", T.ArrayType(T.IntegerType())), T.StructField(prefix + "items", T.ArrayType(T.StringType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, spans, items = map(list, zip(*scan(batch.column("text").to_pylist()), strict=True)) if batch.num_rows else ([], [], [])
            new = [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *(f.name for f in own)])

    return docs.transform(common.map_batches, run, T.StructType([*docs.schema.fields, *own]))


def _merge(spans: list[tuple[int, int]], old: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted([*spans, *zip(old[::2], old[1::2])]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0), lambda acc, x: x - acc)  # -(starts) + (ends), by turns
    return found.select(
        "doc_id",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_span: int = 50, max_coverage: float = 0.2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with hit spans cut out of their texts; documents beyond max_span hit words in a row or max_coverage of all go.

    Documents without a hit pass unchanged, byte for byte; of others the spans are cut from the first character of the
    first hit word to the last of the last one, and again what comes together over a cut, until nothing is hit in
    any block. Limits are on all that is cut, against the words of the whole document. Columns are those of docs.
    """
    names, scan = docs.columns, _scanner(write_automata(benchmark, window, block_words))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").to_pylist()
            total, n_words, keep = [0] * len(text), [0] * len(text), [True] * len(text)
            todo, first = list(range(len(text))), True
            while todo:
                again = []
                for i, (n, own, _) in zip(todo, scan([text[i] for i in todo]), strict=True):
                    n_words[i] = n if first else n_words[i]
                    if own:
                        hit = [b - a for a, b in zip(own[::2], own[1::2])]
                        total[i] += sum(hit)
                        keep[i] = max(hit) <= max_span and total[i] <= max_coverage * n_words[i]
                        if keep[i]:
                            text[i] = cut_spans(text[i], own)
                            again.append(i)
                todo, first = again, False
            new = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in names], names).filter(pa.array(keep, pa.bool_()))

    return docs.transform(common.map_batches, cut, docs.schema)


def cut_spans(text: str, spans: list[int]) -> str:
    """text without the words of spans."""
    raw = text.encode()
    low = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.diff(low.astype(np.int8), prepend=0, append=0)
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()
