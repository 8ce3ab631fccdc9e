"""Token counts at every prefix, by dynamic programming.

A SentencePiece BPE model merges neighbouring symbols by score. No piece of the model holds a non-space character before
a space mark, so a text falls into independent runs: space marks and the characters up to the next space mark. Inside a
run the encoding of every prefix is found from those of shorter prefixes: the last token of prefix i is the one token
t ending at i that is compatible with the last token of the prefix before t (their concatenation encodes to just these
two). A run's counts are kept as differences from one character to the next, one signed byte each, so the table of a
text is the concatenation of its runs' bytes, and a cumulative sum gives the exact count at each prefix.
Short runs are worked out once in a Python worker and remembered up to a bound.

Null text is the empty text (0 tokens); counts are of the library's plain encoding, without begin or end tokens. Rows are
counted one by one, so repeated rows, equal and null doc_ids give a row each; an empty table gives an empty result; columns
other than doc_id and text are not looked at, whatever their names. A text is counted whole: a task holds a batch or one
longer text, with a byte of table for each character and, inside the longest run without a space, some 60 bytes for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK = "▁"
#: Runs of at most so many characters are remembered, and at most so many of them: some 100 MB.
RUN_CHARS = 48
CACHE_RUNS = 500_000
CACHE_PAIRS = 1_000_000


class PrefixCounter:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.piece = {i: m.id_to_piece(i) for i in usable}
        self.score = {p: m.get_score(i) for i, p in self.piece.items()}
        self.alphabet = frozenset(p for p in self.score if len(p) == 1)
        if any(MARK in p.lstrip(MARK) or not self.alphabet.issuperset(p) for p in self.score):
            raise ValueError("a piece of this model spans a space or holds a character without a piece of its own")
        self.endings = ahocorasick.Automaton()
        for i, p in self.piece.items():
            self.endings.add_word(p, (len(p), i))
        self.endings.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.runs: dict[str, bytes] = {}

    def bpe(self, text: str) -> list[str]:
        """Plain merging: the pair whose union scores best first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        a, b = self.piece[left], self.piece[right]
        ok = self.pairs[left << 32 | right] = self.bpe(a + b) == [a, b]
        return ok

    def known(self, text: str) -> list[int]:
        """Token counts of the prefixes of a text that has pieces for all its characters."""
        last, count, pairs = [-1] * (len(text) + 1), [0] * (len(text) + 1), self.pairs
        for at, (length, token) in self.endings.iter(text):
            end = at + 1
            if last[end] < 0:
                start = end - length
                if not start or (self.fits(last[start], token) if (ok := pairs.get(last[start] << 32 | token)) is None else ok):
                    last[end], count[end] = token, count[start] + 1
        return count[1:]

    def run(self, text: str) -> bytes:
        """Differences of the token counts of text's prefixes, one signed byte for each character.

        A character without a piece stands alone and becomes its UTF-8 bytes; it parts what is before and after it.
        """
        if self.alphabet.issuperset(text):
            count = self.known(text)
        else:
            count, part = [], ""
            for c in [*text, None]:
                if c in self.alphabet:
                    part += c
                    continue
                base = count[-1] if count else 0
                count += [base + x for x in self.known(part)]
                if c is not None:
                    count.append((count[-1] if count else 0) + len(c.encode()))
                part = ""
        return bytes([b - a & 255 for a, b in zip([0, *count], count)])  # read as signed

    def tables(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Prefix tables of the model's normalised forms of texts (the added mark in front included) and token counts."""
        if len(self.runs) >= CACHE_RUNS:
            self.runs.clear()
        out, totals, runs = [], np.zeros(len(texts), np.int64), self.runs
        for k, text in enumerate(texts):
            parts = []
            for run in _runs(self.model.normalize(text)):
                if (got := runs.get(run)) is None:
                    got = self.run(run)
                    if len(run) <= RUN_CHARS and len(runs) < CACHE_RUNS:
                        runs[run] = got
                parts.append(got)
            table = b"".join(parts)
            out.append(table)
            totals[k] = np.frombuffer(table, np.int8).sum(dtype=np.int64)
        return out, totals


def _runs(text: str) -> list[str]:
    """Cut before each mark that follows another character."""
    if not text:
        return []
    if MARK * 2 not in text:
        head, *rest = text.split(MARK)
        return [head] * bool(head) + [MARK + x for x in rest]
    cut = [0, *(i for i in range(1, len(text)) if text[i] == MARK and text[i - 1] != MARK), len(text)]
    return [text[a:b] for a, b in zip(cut, cut[1:])]


def prefix_count(table: bytes, characters: int) -> int:
    """Tokens of the first `characters` characters of the normalised text."""
    return int(np.frombuffer(table, np.int8)[:characters].sum(dtype=np.int64))


def longest_within(table: bytes, budget: int) -> int:
    """Characters of the longest normalised prefix that encodes to at most `budget` tokens."""
    ok = np.nonzero(np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64) <= budget)[0]
    return int(ok[-1]) + 1 if len(ok) else 0


def prefix_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, within_limit (characters of the longest prefix under the limit), prefix_table binary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = common.kept(f"counts {model}", lambda: PrefixCounter(model))
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                text = common.texts(piece.column("text"))
                tables, totals = counter.tables(text.to_pylist())
                within = [len(t) if n <= limit else longest_within(t, limit) for t, n in zip(tables, totals.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(totals), pa.array(totals > limit), pa.array(within, pa.int64()), pa.array(tables, pa.binary())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "within_limit", "prefix_table"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.transform(common.map_batches, count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, within_limit long, prefix_table binary")
