"""Token-ID output: patched frame-of-reference blocks.

Ids are cut into blocks of 128. A block keeps its minimum, packs the differences at the width that 90 % of them need,
and lists the rest as exceptions; an index of block starts lets a reader decode any range alone. One shard file holds
whole documents in ascending doc_id order. Shard files carry names unique to the writing attempt; the manifest, which
Spark commits, names those that count, so a retried or speculative task leaves no trace in what is read.

Null text is the empty text (its document is the end id alone); null doc_id sorts first; equal and null doc_ids keep one
entry per row, ordered by a hash of the text, then the text, so repeated rows are alike; an empty table makes an empty
manifest; columns other than doc_id and text are not looked at, whatever their names. A text is never cut: a task holds a
batch of 16 MB or one longer text, and some 20 times its bytes while it is encoded; a word (text between ASCII white space)
goes through the library whole, which takes some 100 bytes for each of its characters.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLOCK = 128
PERCENTILE = 0.9
SHARD_IDS = 2_000_000
#: Stems of at most so many bytes are remembered, and at most so many of them: 16 MB of text and some 15 MB of ids.
STEM_BYTES = 32
KNOWN_STEMS = 500_000
#: Text bytes encoded at once, and blocks packed at once.
CHUNK = 8 << 20
PACKED = 4096
#: ASCII marks that part from an ASCII letter or digit before them; without those of contractions and of special tokens.
TAIL_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^`{}~"
_ALNUM = np.array([chr(c).isascii() and chr(c).isalnum() for c in range(256)])
_HEAD = struct.Struct("<4sIQQQ")
_BLOCK_HEAD = struct.Struct("<IBB")
#: Bits of small numbers.
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 128) unsigned values to (m, 2*width) 64-bit words."""
    out = np.zeros((2 * width, len(values)), np.uint64)
    lanes = np.ascontiguousarray(values.T, dtype=np.uint64)
    for i in range(BLOCK if width else 0):
        word, off = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(off)
        if off + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - off)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.zeros((BLOCK, len(words)), np.uint64)
    cols, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
    for i in range(BLOCK if width else 0):
        word, off = divmod(i * width, 64)
        x = cols[word] >> np.uint64(off)
        if off + width > 64:
            x = x | (cols[word + 1] << np.uint64(64 - off))
        lanes[i] = x & mask
    return lanes.T


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All blocks as bytes, and the offset of each (one more at the end)."""
    step = PACKED * BLOCK
    parts = [_encode_blocks(ids[a : a + step]) for a in range(0, len(ids), step)]
    ends = np.cumsum(np.concatenate([[0], *(np.diff(offsets.astype(np.int64)) for _, offsets in parts)]))
    return b"".join(data for data, _ in parts), ends.astype("<u8")


def _encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    n = -(-len(ids) // BLOCK)
    grid = np.full(n * BLOCK, ids[-1], np.uint32)
    grid[: len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    low = grid.min(1)
    diff = grid - low[:, None]
    bits = _BITS[diff] if diff.max() < len(_BITS) else np.frexp(diff.astype(np.float64))[1].astype(np.uint8)
    width = np.partition(bits, int(PERCENTILE * BLOCK), 1)[:, int(PERCENTILE * BLOCK)]
    odd = bits > width[:, None]
    count = odd.sum(1)
    block, place = np.nonzero(odd)
    extras = diff[odd].astype("<u4")
    diff[odd] = 0
    ends = np.cumsum(_BLOCK_HEAD.size + 5 * count + 16 * width.astype(np.int64))
    starts = np.concatenate([[0], ends[:-1]])
    out = np.zeros(ends[-1], np.uint8)
    head = np.concatenate([low.astype("<u4").view(np.uint8).reshape(n, 4), width[:, None], count.astype(np.uint8)[:, None]], 1)
    out[starts[:, None] + np.arange(_BLOCK_HEAD.size)] = head
    # Places of a block's exceptions, then their values, then the packed differences.
    nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[block] + _BLOCK_HEAD.size
    out[at + nth] = place
    out[(at + count[block] + 4 * nth)[:, None] + np.arange(4)] = extras.view(np.uint8).reshape(-1, 4)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        at = starts[rows] + _BLOCK_HEAD.size + 5 * count[rows]
        out[at[:, None] + np.arange(16 * w)] = _pack(diff[rows], w).astype("<u8").view(np.uint8)
    return out.tobytes(), np.concatenate([[0], ends]).astype("<u8")


def encode_shard(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard file: header, document ids and their nulls, sizes, block index, blocks."""
    blocks, index = encode_blocks(ids)
    known = np.array([x is not None for x in doc_ids], bool)
    keys = np.array([x or 0 for x in doc_ids], "<i8")
    head = _HEAD.pack(b"PFR1", BLOCK, len(doc_ids), len(ids), len(index) - 1)
    return b"".join([head, keys.tobytes(), np.packbits(known).tobytes(), sizes.astype("<u8").tobytes(), index.tobytes(), blocks])


class Shard:
    """A shard file opened for reading; ids(a, b) decodes only the blocks that hold places a to b."""

    def __init__(self, data: np.ndarray):
        magic, block, self.n_docs, self.n_ids, self.n_blocks = _HEAD.unpack(data[: _HEAD.size].tobytes())
        if magic != b"PFR1" or block != BLOCK:
            raise ValueError("not a token shard")
        at = _HEAD.size
        keys = np.frombuffer(data[at : (at := at + 8 * self.n_docs)].tobytes(), "<i8")
        known = np.unpackbits(data[at : (at := at + -(-self.n_docs // 8))])[: self.n_docs].astype(bool)
        self.doc_ids = [int(k) if ok else None for k, ok in zip(keys, known, strict=True)]
        self.sizes = np.frombuffer(data[at : (at := at + 8 * self.n_docs)].tobytes(), "<u8").astype(np.int64)
        self.index = np.frombuffer(data[at : (at := at + 8 * (self.n_blocks + 1))].tobytes(), "<u8").astype(np.int64)
        self.body = data[at:]

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        end = self.n_ids if end is None else min(end, self.n_ids)
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-end // BLOCK)
        base = self.index[first]
        body, off = np.asarray(self.body[base : self.index[last]]), self.index[first:last] - base
        low = np.ascontiguousarray(body[off[:, None] + np.arange(4)]).view("<u4")[:, 0]
        width, count = body[off + 4], body[off + 5].astype(np.int64)
        out = np.zeros((last - first, BLOCK), np.uint32)
        for w in np.unique(width):
            rows = np.nonzero(width == w)[0]
            if w:
                at = (off + _BLOCK_HEAD.size + 5 * count)[rows]
                words = np.ascontiguousarray(body[at[:, None] + np.arange(16 * int(w))]).view("<u8")
                out[rows] = _unpack(words, int(w))
        rows = np.repeat(np.arange(len(off)), count)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        at = off[rows] + _BLOCK_HEAD.size
        values = np.ascontiguousarray(body[(at + count[rows] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").reshape(-1)
        out[rows, body[at + nth]] = values
        out += low[:, None]
        return out.reshape(-1)[start - first * BLOCK : end - first * BLOCK]


class WordTokens:
    """Ids of texts by way of their words between ASCII white space.

    The tokenizer's pre-tokenizer never joins characters across white space and its normaliser works within words, so a
    text's ids are those of its words in order. It lowers case, and parts an ASCII letter or digit from an ASCII mark behind
    it; so a word is looked up as its stem in lower case and its tail of marks. A stem that ends in anything else keeps its
    marks: normal forms may end in a combining mark, which goes with the marks behind it.
    Distinct stems are encoded by the library and remembered: short ones only, in arrays of a bounded number of bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _split(self, words: pa.LargeStringArray) -> tuple[pa.LargeStringArray, pa.LargeStringArray]:
        """Stem and tail of every word."""
        special = pc.match_substring(words, "<|")  # may hold a special token, which is found before anything else
        lower = pc.if_else(special, words, pc.ascii_lower(words))
        stem = pc.ascii_rtrim(lower, characters=TAIL_MARKS)
        # ASCII letter or digit at the end of the stem, and a tail of at most eight marks.
        ends = np.frombuffer(stem.buffers()[1], "<i8")[stem.offset : stem.offset + len(stem) + 1]
        size, extra = np.diff(ends), (pc.binary_length(lower).to_numpy() - np.diff(ends)).astype(np.int64)
        data = np.frombuffer(stem.buffers()[2] or b"", np.uint8)
        last = data[np.maximum(ends[1:] - 1, 0)] if len(data) else np.zeros(len(stem), np.uint8)
        whole = (size == 0) | (extra > 8) | ~_ALNUM[last] | special.to_numpy(zero_copy_only=False)
        extra[whole] = 0
        tail = np.zeros((len(words), 8), np.uint8)
        ends = np.frombuffer(lower.buffers()[1], "<i8")[lower.offset : lower.offset + len(lower) + 1][1:]
        data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)
        for j in range(int(extra.max(initial=0))):
            rows = np.flatnonzero(extra > j)
            tail[rows, j] = data[ends[rows] - extra[rows] + j]
        kinds, back = np.unique(tail.view("<u8")[:, 0], return_inverse=True)
        tails = pa.array([int(k).to_bytes(8, "little").rstrip(b"\0").decode() for k in kinds], pa.large_string())
        return pc.if_else(pa.array(whole), lower, stem), tails.take(pa.array(back))

    def _encode(self, words: list[str]) -> list[bytes]:
        out = []
        for a in range(0, len(words), 5000):
            some = words[a : a + 5000]
            if all(w.isalpha() for w in some):  # letters alone: in one text each is one unit, and its last id says so
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                last = np.flatnonzero(self.ends[ids]) + 1
                if len(last) == len(some):  # else a tokenizer without word ends, or characters that fall apart
                    raw, at = ids.tobytes(), (4 * np.concatenate([[0], last])).tolist()
                    out += [raw[a:b] for a, b in zip(at, at[1:])]
                    continue
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def _look_up(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words."""
        place = pc.index_in(words, value_set=self.known)
        missing = np.flatnonzero(pc.is_null(place).to_numpy(zero_copy_only=False))
        plain = np.array([w.isalpha() for w in words.take(pa.array(missing)).to_pylist()], bool)
        missing = missing[np.argsort(~plain, kind="stable")]
        new = words.take(pa.array(missing))
        ids = pa.array(self._encode(new.to_pylist()), pa.large_binary())
        at = pc.fill_null(place, 0).to_numpy().copy()
        at[missing] = len(self.known) + np.arange(len(missing))
        out = pa.concat_arrays([self.ids, ids]).take(pa.array(at))
        short = pc.less_equal(pc.binary_length(new), STEM_BYTES)
        new, ids = new.filter(short), ids.filter(short)
        if len(self.known) + len(new) > KNOWN_STEMS:  # keep what was asked for last
            use = pc.unique(place.drop_null())
            self.known, self.ids = self.known.take(use), self.ids.take(use)
            new, ids = new[: KNOWN_STEMS - len(use)], ids[: KNOWN_STEMS - len(use)]
        self.known, self.ids = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.ids, ids])
        return out

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        words, counts = common.space_words(text, lower=False)
        coded = words.dictionary_encode()
        stem, tail = self._split(coded.dictionary.cast(pa.large_string()))
        stem, tail = stem.dictionary_encode(), tail.dictionary_encode()
        both = [self._look_up(x.dictionary).take(x.indices) for x in (stem, tail)]
        ids = pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary())).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[: len(ids) + 1] // 4 if len(ids) else np.zeros(1, np.int64)
        flat = np.frombuffer(ids.buffers()[2], "<u4")[: ends[-1]] if ends[-1] else np.zeros(0, "<u4")
        return flat, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def _with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(sizes), end, np.uint32)
    places = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
    out[places] = ids
    return out, sizes + 1


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 1, partitions: int | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode docs (doc_id, text) into shard files in ascending doc_id order; returns the manifest.

    Manifest: part int, seq int, path string, n_docs long, n_ids long, start long (ids in all shards before it).
    """
    spark, folder = docs.sparkSession, common.fresh_dir(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (part, seq) = common.kept(f"tokens {tokenizer}", lambda: WordTokens(tokenizer)), (TaskContext.get().partitionId(), 0)
        keys: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, keys, held
            ids, sizes = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            path = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.pfr"
            common.write_file(path, encode_shard(keys, sizes, ids))
            row = {"part": [part], "seq": [seq], "path": [path], "n_docs": [len(keys)], "n_ids": [len(ids)]}
            seq, keys, held = seq + 1, [], []
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for batch in batches:
            for piece in common.chunks(batch, "text", CHUNK):
                keys += piece.column("doc_id").to_pylist()
                held.append(_with_end(*encoder.encode(common.texts(piece.column("text"))), end_id))
                if sum(len(x[0]) for x in held) >= shard_ids:
                    yield flush()
                pa.default_memory_pool().release_unused()
        if keys:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The hash of the text parts rows of equal or null doc_id, however many they are.
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*([partitions] if partitions else []), "doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    shards = common.table(rows.transform(common.map_batches, write, "part int, seq int, path string, n_docs long, n_ids long"), "manifest")
    # Prefix sums in two steps: over tasks, then over the shards of each task.
    whole = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = whole.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return shards.join(before, "part").select("part", "seq", "path", "n_docs", "n_ids", (F.col("base") + inside).alias("start"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents back from the shard files: doc_id, start, n_tokens, ids array<int>."""
    return _read(manifest, "doc_id long, start long, n_tokens long, ids array<int>", lambda ids, a, b: ids[a:b].astype(np.int32))


def digest_tokens(manifest: DataFrame) -> DataFrame:
    """Documents back from the shard files, each with the crc32 of its ids instead of the ids."""
    return _read(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids, a, b: zlib.crc32(ids[a:b].astype("<u4").tobytes()))


def _read(manifest: DataFrame, schema: str, of) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]
    last = pa.list_(pa.int32()) if names[3] == "ids" else pa.int64()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                shard = Shard(common.read_file(path))
                ids, ends = shard.ids(), np.concatenate([[0], np.cumsum(shard.sizes)])
                values = [of(ids, a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(base + ends[:-1], pa.int64()), pa.array(shard.sizes, pa.int64()), pa.array(values, last)], names)

    return common.spread(manifest.select("path", "start"), "path").transform(common.map_batches, read, schema)
