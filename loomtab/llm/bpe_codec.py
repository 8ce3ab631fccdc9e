"""Byte-pair encoding by backtracking, and decoding by an offset table.

A byte-level BPE vocabulary is read from a tokenizer file. A text falls into pieces by the vocabulary's pattern; a piece is
encoded on its own. One pass of an Aho-Corasick automaton notes the longest token that starts at every byte of the piece.
The encoder walks left to right, takes the longest token there, and keeps it if it is compatible with the token before:
the pair is what merging would leave of the two tokens' bytes. Otherwise it tries the token's next shorter prefix, and when
none is left it takes back the token before and marks this end as a dead one. Every end dies at most once, so the walk is
linear in the piece. Whether two tokens are compatible follows from the merges that made them, undone one by one across the
border; answers are kept in a table. Decoding looks up where each id's bytes start in one string of all tokens and copies.

Encoding is exactly the merges': lowest rank first, leftmost among equals. Special strings in a text become their own ids,
as the library does by default; truncation and padding that a file may set are not used.

Null text is the empty text (no ids, decoded to the empty text). Rows are encoded one by one, so repeated rows, ties, equal
and null doc_ids give a row each; an empty table gives an empty result; columns other than doc_id and text are not looked at,
whatever their names. A text is encoded whole: a task holds a batch or one longer text, some 100 bytes for each of its
characters. Ids outside the vocabulary are an error; ids whose bytes are no UTF-8 decode with U+FFFD, as the library does.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Pieces of at most so many characters are remembered, and at most so many of them; pairs of tokens likewise.
PIECE_CHARS = 32
KNOWN_PIECES = 500_000
KNOWN_PAIRS = 1_000_000
#: Text bytes that are encoded at once.
CHUNK = 2 << 20
#: White space of the splitting pattern: the characters of Unicode's White_Space property. Fixed values.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pattern of byte-level vocabularies. Fixed values.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as itself and the others, in order, as U+0100 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """A vocabulary's encoder and decoder."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        usual = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        added = spec.get("added_tokens") or []
        if not usual or spec.get("normalizer") or any(model.get(k) for k in odd) or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain byte-level BPE files, with special strings matched as they are")
        at = _byte_of()
        raw = {token: bytes(at[c] for c in token) for token in model["vocab"]}
        self.key = {raw[t]: i for t, i in model["vocab"].items()}
        if any(bytes([b]) not in self.key for b in range(256)):
            raise ValueError("a byte without a token")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # By token: the two tokens it is merged from, and the rank of the merge; bytes have none.
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right, whole = self.key[raw[a]], self.key[raw[b]], self.key[raw[a] + raw[b]]
            self.merged.setdefault((left, right), rank)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (left, right), rank
        self.size = {i: len(b) for b, i in self.key.items()}
        self.longest = ahocorasick.Automaton()
        for data, i in self.key.items():
            if len(data) == 1 or i in self.parts:  # what no merge makes cannot come out
                self.longest.add_word(data.decode("latin-1"), (len(data), i))
        self.longest.make_automaton()
        #: The longest shorter prefix of a token that is a token.
        self.shorter: dict[int, int] = {}
        for data, i in self.key.items():
            self.shorter[i] = next((self.key[p] for n in range(len(data) - 1, 0, -1) if (p := data[:n]) in self.key and (n == 1 or self.key[p] in self.parts)), -1)
        self.special = {a["content"]: a["id"] for a in added if a["content"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.pieces = regex.compile(PATTERN).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        # All tokens' bytes in one string; a token's own lie between two neighbouring offsets.
        table = {i: b for b, i in self.key.items()} | {i: c.encode() for c, i in self.special.items()}
        self.bytes_of = pa.array([table.get(i, b"") for i in range(max(table) + 1)], pa.large_binary())
        self.valid = np.array([i in table for i in range(max(table) + 1)])

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their bytes are merged.

        Undo the later of the two merges at the border, again and again: a merge across the border that comes before the
        one just undone would have taken its place."""
        parts, rank, merged = self.parts, self.rank, self.merged
        a, b = left, right
        limit, limit_right = len(merged) + 1, False  # the undone merge, and whether a merge of its own rank would be first
        while True:
            if (r := merged.get((a, b))) is not None and (r < limit or r == limit and limit_right):
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            # Of equal ranks the left one is merged first, so it is the right one that is undone first.
            if ra > rb:
                limit, limit_right, a = ra, False, parts[a][1]
            else:
                limit, limit_right, b = rb, True, parts[b][0]

    def _fits(self, left: int, right: int) -> bool:
        if (ok := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            ok = self.pairs[left, right] = self.fits(left, right)
        return ok

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(data)
        longest, length = [-1] * n, [0] * n
        for end, (size, token) in self.longest.iter(data.decode("latin-1")):
            start = end + 1 - size
            if size > length[start]:
                longest[start], length[start] = token, size
        alive, out, at = bytearray(b"\1") * (n + 1), [], 0
        sizes, shorter, fits = self.size, self.shorter, self._fits
        token = longest[0] if n else -1
        while at < n:
            end = at + sizes[token]
            if alive[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif (token := shorter[token]) < 0:
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
        return out

    def _ids(self, piece: str) -> tuple[int, ...]:
        if (got := self.known.get(piece)) is None:
            got = tuple(self.piece(piece.encode()))
            if len(piece) <= PIECE_CHARS:
                if len(self.known) >= KNOWN_PIECES:
                    self.known.clear()
                self.known[piece] = got
        return got

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        pieces = self.pieces(text)
        try:
            return list(map(self.known.__getitem__, pieces))
        except KeyError:
            return list(map(self._ids, pieces))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if self.split is None or not any(s in text for s in self.special):
            got = self._plain(text)
        else:
            got = []
            for part in self.split(text):
                got += [(self.special[part],)] if part in self.special else self._plain(part)
        return np.fromiter(itertools.chain.from_iterable(got), np.int32)

    def encode_all(self, texts: list[str]) -> pa.ListArray:
        ids = [self.encode(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))

    def decode_all(self, ids: pa.ListArray) -> list[str]:
        """Texts of lists of ids."""
        flat = ids.flatten()
        numbers = flat.to_numpy(zero_copy_only=False)
        if len(numbers) and not (numbers.min() >= 0 and numbers.max() < len(self.valid) and self.valid[numbers].all()):
            raise ValueError("an id outside the vocabulary")
        got = self.bytes_of.take(flat)
        at = np.frombuffer(got.buffers()[1], np.int64) if len(got) else np.zeros(1, np.int64)
        data = memoryview(got.buffers()[2]) if len(got) else memoryview(b"")
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return [str(data[at[a] : at[b]], "utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _codec(path: str) -> Codec:
    return common.kept(f"bpe {path}", lambda: Codec(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids array<int> of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), codec.encode_all(common.texts(part.column("text")).to_pylist())], ["doc_id", "ids"])

    return _rows(docs).transform(common.map_batches, run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every list of ids; null ids are an empty list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            ids = batch.column("ids")
            step = max(1, batch.num_rows * CHUNK // max(1, ids.nbytes))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(codec.decode_all(part.column("ids")), pa.string())], ["doc_id", "text"])

    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.transform(common.map_batches, run, "doc_id long, text string")


def report(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Encoded and decoded in one pass, so that the ids
    of all documents need not travel."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for part in common.chunks(batch, "text", CHUNK):
                ids = codec.encode_all(common.texts(part.column("text")).to_pylist())
                written = pc.binary_join(ids.cast(pa.list_(pa.string())), ",").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pc.list_value_length(ids).cast(pa.int64()),
                        pa.array([hashlib.sha256(w.encode()).hexdigest() for w in written]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in codec.decode_all(ids)]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _rows(docs).transform(common.map_batches, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
