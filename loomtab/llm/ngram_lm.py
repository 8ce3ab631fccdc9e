"""N-gram scoring with an Elias-Fano trie.

The first level is the vocabulary: word hashes in ascending order, Elias-Fano coded, with exact counts as their Elias-Fano
coded running sums; a word's place is its id. The second level holds, context by context, the ids of the words seen after
it; the third, pair by pair of the second, those seen after the pair. Pointers to a context's range of successors are
monotone and Elias-Fano coded. Successors are coded as offsets from the last member of the range before, so that a level is
one monotone sequence, and a successor is searched relative to its context, between the context's two pointers.
A chunk's words, pairs and triples are looked up once each, in ascending order.
Levels lie in shard files in the shared folder; tasks memory-map them. Contexts are dealt to shards by hash with all that
follows them; what follows words and pairs with a great share of all tokens is dealt one by one.

Probabilities: p1(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)); p(w|u) = max(c(u,w) - D, 0) / c(u) + D * T(u) / c(u) * p1(w), with
T(u) the number of distinct successors; p1 alone after an unknown word. With order 3, after a pair t u that was seen,
p(w|t,u) = max(c(t,u,w) - D, 0) / c(t,u) + D * T(t,u) / c(t,u) * p(w|u). Seen shares are kept as 16-bit codes of their
logarithms; T is the distance of two pointers. All counts cover all training documents; nothing is pruned.

Null text is the empty text: its one token is the end. Equal rows count again. With no training documents N = V = 0 and
every token has the unknown word's probability. Words are identified by 62 bits of xxh3. Columns other than doc_id and text
are not looked at, whatever their names. Texts are scored whole; a task holds a batch of 8 MB, or one longer text, and some
180 bytes for each of its words.
"""

from __future__ import annotations

import struct
import uuid
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DISCOUNT = 0.75
ADD = 0.1
ORDER = 2
SHARD_TOKENS = 2_000_000
#: Pairs with this share of a chunk's tokens are counted while words are; only the balance of shards depends on it.
PAIR_SHARE = 2.0**-14
MERGE_KEYS = 3_000_000
CHUNK = 8 << 20
KEEP_BYTES = 256 << 20
#: A context with more than this share of a shard's tokens is dealt out by successor.
HOT_SHARE = 0.25
END = 0

_POP = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Place of the k-th one in a byte.
_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence of integers below a bound, searchable without decoding.

    low: the lower bits, packed. high: for each value of the upper bits, a one for every member and then a zero.
    zeros: number of zeros before each 64-bit word of high.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.low, self.high, self.zeros = n, bits, low, high, zeros
        self.ones: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray, bound: int) -> EliasFano:
        n = len(values)
        bits = max(0, int(bound // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        upper = (values >> np.uint64(bits)).astype(np.int64)
        size = n + (bound >> bits) + 2
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[upper + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        zeros = np.cumsum(64 - _POP[high.view(np.uint8)].reshape(-1, 8).sum(1, dtype=np.int64))
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            at = np.arange(n, dtype=np.int64) * bits
            word, off = at >> 6, (at & 63).astype(np.uint64)
            part = values & np.uint64((1 << bits) - 1)
            starts = np.nonzero(np.diff(word, prepend=-1))[0]
            if n:
                low[word[starts]] |= np.bitwise_or.reduceat(part << off, starts)
                over = np.nonzero(off + np.uint64(bits) > np.uint64(64))[0]
                low[word[over] + 1] |= part[over] >> (np.uint64(64) - off[over])
        return cls(n, bits, low, high, np.concatenate([[0], zeros[:-1]]).astype("<i8"))

    def sections(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], "<i8"), self.low, self.high, self.zeros]

    @classmethod
    def open(cls, parts: Iterator[np.ndarray]) -> EliasFano:
        n, bits = next(parts).view("<i8").tolist()
        return cls(n, bits, next(parts).view("<u8"), next(parts).view("<u8"), next(parts).view("<i8"))

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        word, off = at >> 6, (at & 63).astype(np.uint64)
        x = self.low[word] >> off
        # A shift by 64 is undefined: shift by 63 - off and once more.
        x = x | (self.low[word + 1] << (np.uint64(63) - off)) << np.uint64(1)
        return (x & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of high; the k-th zero ends bucket k."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        return word * 64 + _nth(~self.high[word], k - self.zeros[word])

    def bucket(self, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the members whose upper bits are `upper`."""
        start = np.where(upper > 0, self._zero(np.maximum(upper - 1, 0)) + 1, 0)
        rest = ~self.high[np.minimum(start >> 6, len(self.high) - 1)] >> (start & 63).astype(np.uint64)
        end = start + np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1))  # the next zero, if in this word
        far = np.flatnonzero(rest == 0)
        end[far] = self._zero(upper[far])
        return start - upper, end - upper

    def find(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of each x among the members from begin to end (all if not given), or -1. x is within the bound."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        a, b = self.bucket(x >> self.bits)
        if begin is not None:
            a, b = np.maximum(a, begin), np.minimum(b, end)
        want, last = x & ((1 << self.bits) - 1), b
        b = b.copy()
        live = np.flatnonzero(b - a > 1)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            less = self.lows(mid) <= want[live]
            a[live[less]], b[live[~less]] = mid[less], mid[~less]
            live = live[b[live] - a[live] > 1]
        out = np.where(a < last, a, -1)
        hit = np.flatnonzero(out >= 0)
        out[hit[self.lows(out[hit]) != want[hit]]] = -1
        return out

    def _one(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one of high."""
        if self.ones is None:
            self.ones = np.arange(len(self.high), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(self.ones, k, "right") - 1
        return word * 64 + _nth(self.high[word], k - self.ones[word])

    def get(self, i: np.ndarray) -> np.ndarray:
        """Members by index."""
        return (self._one(i) - i) << self.bits | self.lows(i)

    def steps(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members by index, and the members that follow them."""
        place = self._one(i)
        rest = self.high[place >> 6] >> (place & 63).astype(np.uint64) >> np.uint64(1)
        after = place + 1 + np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1))  # the next one, if in this word
        far = np.flatnonzero(rest == 0)
        after[far] = self._one(i[far] + 1)
        return (place - i) << self.bits | self.lows(i), (after - i - 1) << self.bits | self.lows(i + 1)


def _nth(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one in each 64-bit word."""
    place, k = np.zeros(len(word), np.int64), k.astype(np.int64)
    for width in (32, 16, 8):
        count = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        up = k >= count
        place += up * width
        k -= np.where(up, count, 0)
        word = np.where(up, word >> np.uint64(width), word)
    return place + _SELECT[(word & np.uint64(255)).astype(np.int64), k]


def save(uri: str, parts: list[np.ndarray]) -> None:
    """Arrays one after another, each at a multiple of 8 bytes, behind a list of their sizes."""
    raw = [np.ascontiguousarray(p).tobytes() for p in parts]
    head = struct.pack(f"<{len(raw) + 1}q", len(raw), *map(len, raw))
    common.write_file(uri, head + b"".join(r + b"\0" * (-len(r) % 8) for r in raw))


def load(uri: str) -> Iterator[np.ndarray]:
    data = np.asarray(common.read_file(uri)).view(np.ndarray)
    count = int(data[:8].view("<i8")[0])
    at = 8 * (count + 1)
    for size in data[8:at].view("<i8").tolist():
        yield data[at : at + size]
        at += size + -size % 8


@dataclass
class Model:
    """What tasks need to find the levels: small, whatever the corpus."""

    tokens: int
    kinds: int
    words: list[tuple[int, str]] = field(default_factory=list)  # first hash and path of each vocabulary shard
    bases: list[int] = field(default_factory=list)  # first id of each
    shards: dict[int, str] = field(default_factory=dict)
    n_shards: int = 1
    hot: dict[int, float] = field(default_factory=dict)  # contexts dealt out by successor: their backoff weight
    pairs: dict[int, float] = field(default_factory=dict)  # the same of pairs, by a hash
    order: int = ORDER
    key: str = ""

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.tokens + ADD * (self.kinds + 1))

    def shard_of(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Shard of a pair, and of what follows the pair unless it is hot."""
        hot = np.isin(u, np.array(sorted(self.hot), np.int64))
        at = common.mix64(np.where(hot, u * 1_000_003 + w + 1, u).astype(np.uint64)) % np.uint64(self.n_shards)
        return at.astype(np.int64)

    def shard_after(self, pair: np.ndarray, home: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shards of words w after pairs with these hashes and shards; and which pairs are hot."""
        to, hot = home.copy(), np.isin(pair, np.array(sorted(self.pairs), np.int64))
        at = common.mix64((pair[hot] + w[hot] * 1_000_003).astype(np.uint64)) % np.uint64(self.n_shards)
        to[hot] = at.astype(np.int64)
        return to, hot


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of word hashes."""
    return common.mix64(a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)).view(np.int64)


class Vocabulary:
    def __init__(self, model: Model):
        self.first = np.array([x[0] for x in model.words], np.int64)
        self.paths = [x[1] for x in model.words]
        self.bases = np.array(model.bases, np.int64)
        self.opened: dict[int, tuple[EliasFano, EliasFano]] = {}

    def shard(self, i: int) -> tuple[EliasFano, EliasFano]:
        if i not in self.opened:
            parts = load(self.paths[i])
            self.opened[i] = (EliasFano.open(parts), EliasFano.open(parts))
        return self.opened[i]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of words (-1: unknown)."""
        out = np.full(len(hashes), -1, np.int64)
        for i, rows in _by_shard(np.searchsorted(self.first, hashes, "right") - 1):
            if i >= 0:
                got = self.shard(i)[0].find(hashes[rows])
                out[rows] = np.where(got >= 0, got + self.bases[i], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of words by id (-1: 0)."""
        out = np.zeros(len(ids), np.int64)
        for i, rows in _by_shard(np.searchsorted(self.bases, ids, "right") - 1):
            if i >= 0:
                before, to = self.shard(i)[1].steps(ids[rows] - self.bases[i])
                out[rows] = to - before
        return out


class Codes:
    """Logarithms of shares as 16-bit codes."""

    @staticmethod
    def of(shares: np.ndarray) -> list[np.ndarray]:
        x = np.log10(shares)
        lo, hi = (float(x.min()), float(x.max())) if len(x) else (0.0, 0.0)
        return [np.array([lo, (hi - lo) / 65535 or 1.0], "<f8"), np.rint((x - lo) / ((hi - lo) / 65535 or 1.0)).astype("<u2")]

    def __init__(self, parts: Iterator[np.ndarray]):
        self.lo, self.step = next(parts).view("<f8").tolist()
        self.codes = next(parts).view("<u2")

    def get(self, i: np.ndarray) -> np.ndarray:
        return 10.0 ** (self.lo + self.step * self.codes[i])


def _chained(words: np.ndarray, starts: np.ndarray) -> EliasFano:
    """Words of successive ranges, each ascending, as one ascending sequence: a range goes on from the last member before."""
    number = np.diff(np.append(starts, len(words)))
    top = words[np.append(starts[1:], len(words)) - 1] + 1 if len(starts) else words
    base = np.cumsum(top) - top
    values = np.repeat(base, number) + words + 1
    return EliasFano.of(values, int(top.sum()) + 1)


class Level:
    """Successors of contexts 0, 1, ...: pointers to their ranges, words and shares."""

    def __init__(self, parts: Iterator[np.ndarray]):
        self.pointers, self.words = EliasFano.open(parts), EliasFano.open(parts)
        self.share = Codes(parts)

    @staticmethod
    def sections(words: np.ndarray, pointers: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
        """Words by context, ascending in each; pointers has an entry for each context and one more."""
        full = pointers[:-1][np.diff(pointers) > 0]
        return [*EliasFano.of(pointers, len(words) + 1).sections(), *_chained(words, full).sections(), *Codes.of(share)]

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pointers.steps(context)

    def find(self, begin: np.ndarray, end: np.ndarray, nth: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Places of each w in the nth range (-1: not there). What comes before a range is read once for all its w."""
        base = np.zeros(len(begin), np.int64)
        later = np.flatnonzero(begin)
        base[later] = self.words.get(begin[later] - 1)
        x, a, b = base[nth] + w + 1, begin[nth], end[nth]
        out, near = np.full(len(nth), -1, np.int64), np.flatnonzero((b > a) & (x <= self.last))
        out[near] = self.words.find(x[near], a[near], b[near])
        return out

    @property
    def last(self) -> int:
        return int(self.words.get(np.array([self.words.n - 1]))[0]) if self.words.n else 0


class Successors:
    """One shard of the levels above the vocabulary."""

    def __init__(self, path: str, kinds: int):
        parts, self.kinds = load(path), kinds
        self.contexts = EliasFano.open(parts)
        self.pairs, self.after = Level(parts), Level(parts)
        levels = (self.contexts, self.pairs.pointers, self.pairs.words, self.after.pointers, self.after.words)
        self.n_bytes = sum(x.low.nbytes + x.high.nbytes + x.zeros.nbytes for x in levels) + self.pairs.share.codes.nbytes + self.after.share.codes.nbytes
        self.mapped = common.is_mounted(path)

    @staticmethod
    def build(path: str, u: np.ndarray, w: np.ndarray, n: np.ndarray, rank: np.ndarray, x: np.ndarray, m: np.ndarray, kinds: int, share, share_after) -> None:
        """Write a shard of ascending pairs (u, w) with counts n (0: only what follows them is here), and of ascending
        (rank of pair, x) with counts m. share and share_after give shares of pairs and of what follows them."""
        first = np.flatnonzero(np.diff(u, prepend=-1))
        ends = np.concatenate([[0], np.cumsum(np.bincount(rank, minlength=len(u)))])
        parts = [*EliasFano.of(u[first], kinds).sections(), *Level.sections(w, np.append(first, len(u)), share), *Level.sections(x, ends, share_after)]
        save(path, parts)

    def find(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pairs (-1: not seen), their shares (0: not seen), and the numbers of successors of contexts u."""
        own, back = _grouped(u)
        rank = self.contexts.find(own)
        begin, end = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        here = np.flatnonzero(rank >= 0)
        begin[here], end[here] = self.pairs.ranges(rank[here])
        place, share = np.full(len(u), -1, np.int64), np.zeros(len(u))
        rows = np.flatnonzero((rank[back] >= 0) & (w >= 0))
        place[rows] = self.pairs.find(begin, end, back[rows], w[rows])
        rows = rows[place[rows] >= 0]
        share[rows] = self.pairs.share.get(place[rows])
        return place, share, (end - begin)[back]

    def find_after(self, pair: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of x after pairs at these places (0: not seen), and the pairs' numbers of successors."""
        own, back = _grouped(pair)
        begin, end = self.after.ranges(own)
        share = np.zeros(len(pair))
        rows = np.flatnonzero(x >= 0)
        place = self.after.find(begin, end, back[rows], x[rows])
        share[rows[place >= 0]] = self.after.share.get(place[place >= 0])
        return share, (end - begin)[back]

    def successors(self, u: int) -> np.ndarray:
        """Ids of the words seen after u, by its pointers."""
        rank = self.contexts.find(np.array([u]))
        if rank[0] < 0:
            return np.zeros(0, np.int64)
        (a,), (b,) = self.pairs.ranges(rank)
        base = self.pairs.words.get(np.array([a - 1]))[0] if a else 0
        return self.pairs.words.get(np.arange(a, b)) - base - 1


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the end and of the distinct words of a chunk, ascending as their ids are, so that levels are searched from
    front to back; the places of all its words among them, and words by text."""
    words, counts = common.space_words(text)
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    h = np.maximum(np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct)) >> np.uint64(2), np.uint64(1)).view(np.int64)
    turn = np.argsort(h)
    place = np.empty(len(h), np.int64)
    place[turn] = np.arange(1, len(h) + 1)
    return np.concatenate([[END], h[turn]]), place[coded.indices.to_numpy()], counts


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order, and their places before, ascending for equal keys. Keys that leave room for their places in
    63 bits are sorted together with them, at a fraction of the time."""
    room = max(len(keys) - 1, 0).bit_length()
    if not len(keys) or keys.min() < 0 or int(keys.max()).bit_length() + room > 63:
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    both = keys << room
    both |= np.arange(len(keys))
    both.sort()
    order = both & ((1 << room) - 1)
    both >>= room
    return both, order


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the first place of each, the number of each key's among them, and how often they are there."""
    ordered, order = _sorted(keys)
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[first], order[first], number, np.diff(first, append=len(keys))


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the number of each key's among them; keys that ascend already are not sorted."""
    if (keys[1:] < keys[:-1]).any():
        return np.unique(keys, return_inverse=True)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new], np.cumsum(new) - 1


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    k, order = _sorted(k)
    c = c[order]
    first = np.nonzero(np.diff(k, prepend=k[0] - 1 if len(k) else 0))[0]
    return k[first], np.add.reduceat(c, first) if len(first) else c


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in groups of 7 bits, the top bit marking that more follow."""
    most = int(values.max()) if len(values) else 0
    if most < 128:
        return values.astype(np.uint8).tobytes()
    size = np.ones(len(values), np.int64)
    for bits in range(7, most.bit_length(), 7):
        size += values >> bits > 0
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]), np.uint8)
    start = ends - size
    for j in range(int(size.max())):
        rows = np.nonzero(size > j)[0]
        out[start[rows] + j] = (values[rows] >> (7 * j)) & 127 | np.where(size[rows] > j + 1, 128, 0)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.nonzero(raw < 128)[0]
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)


def _opened(model: Model) -> tuple[Vocabulary, Shards]:
    """The model's levels, mapped once in a Python worker; those of earlier models are let go."""
    return common.kept(f"trie {model.key} {len(model.shards)}", lambda: (Vocabulary(model), Shards(model)))


def _pairs(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every token with the one before it; a text begins after, and closes with, the end, whose place is 0."""
    stream = np.zeros(int(counts.sum()) + len(counts), np.int64)
    stream[np.arange(len(places)) + np.repeat(np.arange(len(counts)), counts)] = places
    return np.roll(stream, 1), stream


def count_words(rows: DataFrame) -> DataFrame:
    """(h, c, is_pair): count of every word, and of the end, over all rows; and of pairs that are frequent in a chunk, by
    their hash, as far as they are (a lower bound: it deals out shards and goes into no probability)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            k, c = _merge(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(np.zeros(len(k), bool))], ["h", "c", "is_pair"])
            k, c = _merge([x[0] for x in pairs], [x[1] for x in pairs])
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(np.ones(len(k), bool))], ["h", "c", "is_pair"])
            keys.clear(), counts.clear(), pairs.clear()

        for batch in batches:
            for piece in common.chunks(batch, "text", CHUNK):
                h, places, n = word_hashes(common.texts(piece.column("text")))
                before, token = _pairs(places, n)
                keys.append(h)
                counts.append(np.bincount(token, minlength=len(h)))
                code, c = np.unique(before * len(h) + token, return_counts=True)
                often = c >= max(2, PAIR_SHARE * len(token))
                code = code[often]
                pairs.append((pair_hash(h[code // len(h)], h[code % len(h)]), c[often]))
                if sum(map(len, keys)) > MERGE_KEYS:
                    yield from out()
        if keys:
            yield from out()

    return rows.select("text").transform(common.map_batches, run, "h long, c long, is_pair boolean").groupBy("h", "is_pair").agg(F.sum("c").alias("c"))


def fit(rows: DataFrame, shard_tokens: int = SHARD_TOKENS, order: int = ORDER) -> Model:
    """Learn from all rows (text). order: 2 for words and pairs, 3 for triples too."""
    if order not in (2, 3):
        raise ValueError("the trie has levels for order 2 and 3")
    spark = rows.sparkSession
    folder = common.fresh_dir(spark, "trie")
    found = common.table(count_words(rows), "words")
    counts = found.filter("NOT is_pair")
    tokens, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    model = Model(tokens, kinds, order=order, key=folder)
    if not tokens:
        return model

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("h").to_numpy(), b.column("c").to_numpy()) for b in batches]
        if got and (n := sum(len(x[0]) for x in got)):
            h, c = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
            path = f"{folder}/words-{uuid.uuid4().hex}"
            save(path, [*EliasFano.of(h, 1 << 62).sections(), *EliasFano.of(np.concatenate([[0], np.cumsum(c)]), int(c.sum()) + 1).sections()])
            yield pa.RecordBatch.from_arrays([pa.array([int(h[0])]), pa.array([path]), pa.array([n])], ["first", "path", "n"])

    ordered = counts.select("h", "c").repartitionByRange("h").sortWithinPartitions("h")
    # A line for each shard of the vocabulary: as many as the shuffle has partitions.
    for r in sorted(common.table(ordered.transform(common.map_batches, write_words, "first long, path string, n long"), "shards").collect()):
        model.bases.append(sum(model.bases[-1:]) + (last if model.words else 0))
        model.words.append((r.first, r.path))
        last = r.n
    model.n_shards = max(1, -(-tokens // shard_tokens))
    heavy = counts.filter(F.col("c") > HOT_SHARE * tokens / model.n_shards).select("h")
    hot = np.array([r.h for r in heavy.collect()], np.int64)  # at most n_shards / HOT_SHARE words
    model.hot = dict.fromkeys(Vocabulary(model).ids(hot).tolist(), 1.0)
    if order > 2:  # as few: a pair is no more frequent than its words
        often = found.filter("is_pair").filter(F.col("c") > HOT_SHARE * tokens / model.n_shards).select("h")
        model.pairs = dict.fromkeys((r.h for r in often.collect()), 1.0)
    shared = spark.sparkContext.broadcast(model)

    def count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _opened(shared.value)
        for batch in batches:
            for piece in common.chunks(batch, "text", CHUNK):
                yield _shard_counts(shared.value, vocabulary, *word_hashes(common.texts(piece.column("text"))))

    def write_shard(part: pa.Table) -> pa.Table:
        vocabulary, _ = _opened(shared.value)
        path = f"{folder}/pairs-{uuid.uuid4().hex}"
        rows = _write_shard(shared.value, vocabulary, path, [part.column(c).to_pylist() for c in _BLOB])
        return pa.table({"shard": [part.column("shard")[0].as_py()], "path": [path], **{k: pa.array([v.tolist()], pa.list_(pa.int64())) for k, v in rows.items()}})

    dealt = rows.select("text").transform(common.map_batches, count_shards, "shard long, " + ", ".join(f"{c} binary" for c in _BLOB))
    lists = ", ".join(f"{c} array<long>" for c in ("hot", "kinds", "pair", "pair_kinds", "total", "total_of"))
    built = common.table(dealt.groupBy("shard").applyInArrow(write_shard, f"shard long, path string, {lists}"), "pairs")
    after, pair_kinds, totals = Counter(), Counter(), Counter()
    for r in built.collect():  # a line for each shard, with its hot contexts
        model.shards[r.shard] = r.path
        for got, keys, numbers in ((after, r.hot, r.kinds), (pair_kinds, r.pair, r.pair_kinds), (totals, r.total, r.total_of)):
            got.update(dict(zip(keys, numbers, strict=True)))
    hot_ids = np.array(sorted(model.hot), np.int64)
    of = Vocabulary(model).counts(hot_ids)
    model.hot = {int(u): DISCOUNT * after[int(u)] / int(c) for u, c in zip(hot_ids, of, strict=True)}
    model.pairs = {k: DISCOUNT * pair_kinds[k] / totals[k] for k in model.pairs if totals[k]}
    return model


#: What a chunk sends to a shard: pairs (steps of u, w, counts, how many words follow, hashes of hot pairs or 0), and what follows.
_BLOB = ["u", "w", "n", "follow", "hashes", "x", "m"]


def _shard_counts(model: Model, vocabulary: Vocabulary, h: np.ndarray, places: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Counts of a chunk's pairs and triples by shard. Words are numbered in the order of their ids; the end comes first."""
    ids = vocabulary.ids(h)
    kinds = len(ids)
    before, token = _pairs(places, n)
    code, _, nth, count = _distinct(before * kinds + token)
    u = code // kinds
    w = code - u * kinds
    home, shards = model.shard_of(ids[u], ids[w]), np.int64(model.n_shards)
    entry, size = home * len(code) + np.arange(len(code)), count
    triple = np.zeros(0, np.int64)
    if model.order > 2:
        later = np.ones(len(token), bool)
        later[np.cumsum(n + 1) - n - 1] = False
        at = np.flatnonzero(later)
        triple, m = np.unique(nth[at - 1] * kinds + token[at], return_counts=True)
        pair = triple // kinds
        x = ids[triple - pair * kinds]
        hashes = pair_hash(h[u], h[w])
        to, hot = model.shard_after(hashes[pair], home[pair], x)
        follows = to * len(code) + pair
        # Pairs that are here for what follows them only.
        moved = follows[hot]
        stubs = np.unique(moved[moved // len(code) != home[moved % len(code)]])
        entry, size = np.concatenate([entry, stubs]), np.concatenate([size, np.zeros(len(stubs), np.int64)])
    entry, order = _sorted(entry)
    size = size[order]
    pairs, shard = entry % len(code), entry // len(code)
    follow, keys = np.zeros(len(entry), np.int64), np.zeros(len(entry), np.int64)
    if len(triple):
        follows, order = _sorted(follows)
        x, m, follows = x[order], m[order], np.searchsorted(entry, follows)
        follow = np.bincount(follows, minlength=len(entry))
        keys = np.where(np.isin(hashes[pairs], np.array(sorted(model.pairs), np.int64)), hashes[pairs], 0)
    else:
        x = m = np.zeros(0, np.int64)
    cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(entry))
    inner = np.concatenate([[0], np.cumsum(follow)])[cuts]
    left, right = ids[u[pairs]], ids[w[pairs]]
    columns: list[list[bytes]] = [[] for _ in _BLOB]
    for a, b, c, d in zip(cuts[:-1], cuts[1:], inner[:-1], inner[1:], strict=True):
        hot = keys[a:b]
        values = (pack(np.diff(left[a:b], prepend=0)), pack(right[a:b]), pack(size[a:b]), pack(follow[a:b]), hot.tobytes() if hot.any() else b"", pack(x[c:d]), pack(m[c:d]))
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]]), *(pa.array(c, pa.binary()) for c in columns)], ["shard", *_BLOB])


def _write_shard(model: Model, vocabulary: Vocabulary, path: str, blobs: list[list[bytes]]) -> dict[str, np.ndarray]:
    """Merge what chunks sent to a shard and write it; returns what is to be known of its hot contexts."""
    parts = list(zip(*blobs, strict=True))
    u, w, n, follow = (np.concatenate([np.cumsum(unpack(p[j])) if not j else unpack(p[j]) for p in parts]) for j in range(4))
    hashes = np.concatenate([np.frombuffer(p[4], np.int64) if p[4] else np.zeros(len(unpack(p[0])), np.int64) for p in parts])
    x, m = (np.concatenate([unpack(p[j]) for p in parts]) for j in (5, 6))
    del parts
    own, _, nth, _ = _distinct(u)
    key, first, rank, _ = _distinct(nth * model.kinds + w)
    n = np.bincount(rank, n).astype(np.int64)
    u = own[key // model.kinds]
    w, hashes = key % model.kinds, hashes[first]
    key, m = _merge([np.repeat(rank, follow) * model.kinds + x], [m]) if len(x) else (x, m)
    after, x = key // model.kinds, key % model.kinds
    total = np.maximum(vocabulary.counts(u[np.diff(u, prepend=-1) != 0]), 1)
    share = np.maximum(n - DISCOUNT, 0.1) / np.repeat(total, np.diff(np.append(np.flatnonzero(np.diff(u, prepend=-1)), len(u))))
    # A pair's count is that of what follows it; a hot pair's is not known here, and its shares are those of all tokens.
    of = np.where(hashes != 0, model.tokens, np.maximum(n, 1))[after]
    Successors.build(path, u, w, n, after, x, m, model.kinds, share, (m - DISCOUNT) / of)
    real, hot = n > 0, hashes != 0
    own, number = np.unique(u[real & np.isin(u, np.array(sorted(model.hot), np.int64))], return_counts=True)
    number_after = np.bincount(after, minlength=len(u))
    return {"hot": own, "kinds": number, "pair": hashes[hot], "pair_kinds": number_after[hot], "total": hashes[hot & real], "total_of": n[hot & real]}


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        vocabulary, shards = _opened(model)
        for batch in batches:
            for piece in common.chunks(batch, "text", CHUNK):
                h, places, n = word_hashes(common.texts(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, _score(model, vocabulary, shards, h, places, n))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.transform(common.map_batches, run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


class Shards:
    """Shards of a model, opened when asked for. Mapped files cost no memory of their own; of those read whole, the ones
    used last stay, up to KEEP_BYTES."""

    def __init__(self, model: Model):
        self.model, self.opened, self.held = model, OrderedDict(), 0

    def __getitem__(self, s: int) -> Successors | None:
        if s in self.opened:
            self.opened.move_to_end(s)
        elif s in self.model.shards:
            level = self.opened[s] = Successors(self.model.shards[s], self.model.kinds)
            self.held += 0 if level.mapped else level.n_bytes
            while self.held > KEEP_BYTES and len(self.opened) > 1:
                gone = self.opened.popitem(last=False)[1]
                self.held -= 0 if gone.mapped else gone.n_bytes
        return self.opened.get(s)


def _by_shard(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(home) and home.max() < 65536:
        order = np.argsort(home.astype(np.uint16), kind="stable")  # sorted by its digits; -1 comes last
    else:
        order = np.argsort(home, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(order) else ():
        yield int(home[at[0]]), at


def _of(table: dict[int, float], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys the table has, and their values there."""
    known = np.array(sorted(table), np.int64)
    if not len(known):
        return np.zeros(len(keys), bool), np.ones(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, np.array([table[int(x)] for x in known])[at]


def _score(model: Model, vocabulary: Vocabulary, shards: Shards, h: np.ndarray, places: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    ids = vocabulary.ids(h) if model.words else np.full(len(h), -1, np.int64)
    counts = vocabulary.counts(ids) if model.words else np.zeros(len(h), np.int64)
    single = model.unigram(counts)
    before, token = _pairs(places, n)  # places in h, not ids: unknown words stay apart
    own, nth = _distinct(before * len(h) + token)[::2]
    del before
    u = own // len(h)
    w = own - u * len(h)
    p = single[w]
    # After a known word the unigram share shrinks to the backoff weight, and a seen pair adds its own share.
    rows = np.flatnonzero(ids[u] >= 0)
    a, b = ids[u[rows]], ids[w[rows]]
    home, place, share = np.full(len(own), -1, np.int64), np.full(len(own), -1, np.int64), np.zeros(len(own))
    home[rows] = model.shard_of(a, b)
    backoff = np.ones(len(own))
    for s, at in _by_shard(home[rows]):
        if shard := shards[s]:
            place[rows[at]], share[rows[at]], number = shard.find(a[at], b[at])
            backoff[rows[at]] = np.where(number > 0, DISCOUNT * number / np.maximum(counts[u[rows[at]]], 1), 1.0)
    hot, value = _of(model.hot, a)
    backoff[rows[hot]] = value[hot]
    p = share + backoff * p
    del own, rows, a, b, backoff, hot, value
    log = np.log10(p)[nth]
    if model.order > 2 and model.shards:
        later = np.ones(len(token), bool)
        later[np.cumsum(n + 1) - n - 1] = False
        at = np.flatnonzero(later & (place[np.roll(nth, 1)] >= 0))  # after a pair that was seen
        triple, first, back = _distinct(nth[at - 1] * len(h) + token[at])[:3]
        last = nth[at[first]]
        pair = triple // len(h)
        x = ids[triple - pair * len(h)]
        del first, later
        hashes = pair_hash(h[u], h[w])[pair]
        to, hot = model.shard_after(hashes, home[pair], x)
        seen = np.maximum(np.rint(share[pair] * counts[u[pair]] + DISCOUNT), 1)  # the pair's count
        more, weight, spot = np.zeros(len(triple)), np.ones(len(triple)), place[pair]
        for s, r in _by_shard(to):
            if not (shard := shards[s]):
                continue
            moved = r[hot[r]]  # in another shard the pair lies elsewhere
            spot[moved] = shard.find(ids[u[pair[moved]]], ids[w[pair[moved]]])[0]
            r = r[spot[r] >= 0]
            more[r], number = shard.find_after(spot[r], x[r])
            weight[r] = np.where(number > 0, DISCOUNT * number / seen[r], 1.0)
        is_hot, value = _of(model.pairs, hashes)
        weight[is_hot], more[is_hot] = value[is_hot], more[is_hot] * model.tokens / seen[is_hot]
        log[at] = np.log10(more + weight * p[last])[back]
    size = n + 1
    doc = common.row_ids(size)
    return size, np.bincount(doc, counts[token] > 0, len(n)).astype(np.int64), np.bincount(doc, np.log10(single)[token], len(n)), np.bincount(doc, log, len(n))


def held_out(column: str = "doc_id") -> Column:
    return common.crc_mod(column, 10) == 0


def report(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = fit(rows.filter(~held_out()), order=order)
    return score(rows, model).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
