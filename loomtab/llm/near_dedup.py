"""MinHash near-dedup with circulant permutations, banding and exact verification.

One permutation scatters a document's shingles over a circle of 2^32 places; a second permutation of the circle, read k
places on, gives signature coordinate k. Two permutations so make all 120 coordinates. Bands of five
coordinates make buckets; a pair of similarity 0.85 shares no bucket with probability below 1e-6.

Documents with equal shingle sets form a class, and one member stands for it from there on, so copies never multiply.
Within buckets pairs are verified on full sets in three rounds, each leaving out what the rounds before have connected:
each class with the best hub among its buckets' (a hub is a bucket's member with most company in its own buckets); each
bucket's hub with members of other components; then, in buckets that still hold several components, members of different
ones that share a shingle among the rarest of both. Similar sets always do (prefix filtering): of a set of s shingles, only
so many of the rarest count as a similar partner may lack, so that shingles of a template, which all members have, do not
bring them together.
No similar pair that shares a bucket is left unverified unless it is connected already, and no group is expanded into all
pairs.
Hubs are salted by their number of pairs. Components come from alternating large-star and small-star steps.

Null or wordless text has no shingles and links with nothing; a text of fewer than five words is one shingle. Rows with
equal doc_id are told apart: one row of a group is kept. Null doc_ids sort last. An empty table gives an empty result;
other columns are not looked at, whatever their names. Texts are shingled whole: a task holds a long text with some 60
bytes for each of its words, and signs it a slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 24, 5
SLICE = 65_536
SALT_PAIRS = 200
#: Sets that meet the others of a rare shingle in one task of the last round.
MEET = 500
#: A shingle is frequent if it is one in so many of all rows: fewer than so many shingles are.
FREQUENT = 1000
#: Slots of the filter that keeps texts which are not asked for out of a shuffle: what is broadcast is bounded by it.
SLOTS = 1 << 20
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles (repeats included) and the number of each text."""
    words, counts = common.space_words(text)
    coded = words.dictionary_encode()
    kinds = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = kinds[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    n = np.where(counts >= SHINGLE, counts - SHINGLE + 1, counts > 0).astype(np.int64)
    padded = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    first = np.repeat(np.cumsum(counts) - counts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    size = np.repeat(np.minimum(counts, SHINGLE), n)
    out = common.mix64(size)
    for j in range(SHINGLE):
        out += np.where(j < size, padded[first + j] * _ODD[j], np.uint64(0))
    return common.mix64(out), n


class Circulant:
    """Signatures of many sets at once, SLICE shingles at a time, whatever the length of a text."""

    def __init__(self, seed: int = 23):
        self.first, self.second = (np.random.default_rng(seed).integers(0, 1 << 32, (2, 2), np.uint64) | np.uint64(1)).astype(np.uint32)

    @staticmethod
    def _permute(x: np.ndarray, odd: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """A permutation of the circle, in place: odd factors and shifted differences can be undone."""
        for factor, shift in zip(odd, (16, 15), strict=True):
            np.right_shift(x, np.uint32(shift), out=spare)
            np.bitwise_xor(x, spare, out=x)
            np.multiply(x, factor, out=x)
        np.right_shift(x, np.uint32(16), out=spare)
        np.bitwise_xor(x, spare, out=x)
        return x

    def signatures(self, hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(sets, 120) coordinates; hashes: shingles of all sets one after another, repeats allowed; n: how many of each."""
        out = np.full((len(n), BANDS * ROWS), np.uint32(0xFFFFFFFF))
        ends = np.cumsum(n)
        full = np.flatnonzero(n > 0)
        ends, starts = ends[full], (ends - n)[full]
        for a in range(0, len(hashes), SLICE):
            place = (hashes[a : a + SLICE] >> np.uint64(32)).astype(np.uint32)
            spare, value = np.empty_like(place), np.empty_like(place)
            self._permute(place, self.first, spare)
            lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(starts, a + len(place), "left")
            cuts, sets = np.maximum(starts[lo:hi] - a, 0), full[lo:hi]
            least = np.empty((BANDS * ROWS, len(sets)), np.uint32)
            for k in range(BANDS * ROWS):
                np.add(place, np.uint32(k), out=value)
                least[k] = np.minimum.reduceat(self._permute(value, self.second, spare), cuts)
            out[sets] = np.minimum(out[sets], least.T)
        return out

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        return self.signatures(hashes, np.array([len(hashes)]))[0]


def bands(signatures: np.ndarray) -> np.ndarray:
    """(documents, BANDS) bucket keys; the band's number is part of the key."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    out = common.mix64(np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]))
    for r in range(ROWS):
        out = common.mix64((out ^ parts[:, :, r]) * _ODD[0] + _ODD[1])
    return out.view(np.int64)


def _class_key(hashes: np.ndarray) -> bytes:
    """128 bits of a set, whatever its order."""
    a, b = common.mix64(hashes ^ _ODD[2]).sum(dtype=np.uint64), common.mix64(hashes ^ _ODD[3]).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(hashes))], "<u8").tobytes()


def signatures(rows: DataFrame) -> DataFrame:
    """uid, doc_id, n_shingles, class (null without shingles), bands, key. rows: (uid, doc_id, text).

    key: a hash of doc_id and text, by which a text is found again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = common.kept("circulant", Circulant)
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                hashes, n = shingle_hashes(common.texts(piece.column("text")))
                signs = circulant.signatures(hashes, n)
                ends = np.cumsum(n)
                sizes, keys = np.zeros(len(n), np.int64), []
                for i, (a, b) in enumerate(zip(ends - n, ends, strict=True)):
                    own = np.unique(hashes[a:b])
                    sizes[i] = len(own)
                    keys.append(_class_key(own) if len(own) else None)
                keyed = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(bands(signs).ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("uid"), piece.column("doc_id"), pa.array(sizes), pa.array(keys, pa.binary()), keyed, piece.column("key")], ["uid", "doc_id", "n_shingles", "class", "bands", "key"])

    keyed = rows.select("uid", "doc_id", "text", _text_key())
    return keyed.transform(common.map_batches, run, "uid long, doc_id long, n_shingles long, class binary, bands array<long>, key long")


def _text_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes. wanted: (node, key, class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                hashes, n = shingle_hashes(common.texts(piece.column("text")))
                ends = np.cumsum(n)
                own = [np.unique(hashes[a:b]) for a, b in zip(ends - n, ends, strict=True)]
                same = pa.array([_class_key(x) == k for x, k in zip(own, piece.column("class").to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays([piece.column("node"), pa.array([x.tobytes() for x in own], pa.binary())], ["node", "shingles"]).filter(same)

    # Texts that share no slot with a wanted one stay out of the shuffle; repeated rows, of one key, give the node again.
    slot = F.pmod("key", F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(wanted.select(slot).distinct())  # at most SLOTS numbers
    asked = rows.select(_text_key(), "text").withColumn("slot", slot).join(slots, "slot", "left_semi")
    hit = asked.join(wanted, "key")
    return hit.select("node", "class", "text").transform(common.map_batches, run, "node long, shingles binary").dropDuplicates(["node"])


def _attach(pairs: DataFrame, sets: DataFrame, side: str, other: str) -> DataFrame:
    """pairs with the set of one side; a node with many pairs is dealt out as copies, SALT_PAIRS pairs to each."""
    degree = pairs.groupBy(side).agg(F.ceil(F.count("*") / SALT_PAIRS).alias("copies"))
    salted = pairs.join(degree, side).withColumn("salt", F.pmod(F.xxhash64(other), "copies")).drop("copies")
    given = sets.withColumnRenamed("node", side).join(degree, side).select(side, F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"), F.col("shingles").alias(f"set_{side}"))
    return salted.join(given, [side, "salt"]).drop("salt")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of pairs (a, b) whose sets are as similar as asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([s, t])
                both.sort(kind="stable")  # merges two sorted runs
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    full = _attach(_attach(pairs, sets, "a", "b"), sets, "b", "a")
    return full.select("a", "b", "set_a", "set_b").transform(common.map_batches, run, "a long, b long")


def _prefixes(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, size, label, keys, h, pos): those shingles, rarest first, of which a partner must have one too, if another of
    the nodes has it. nodes: (node, size, label, keys). pos: the shingle's place in that order, from 1."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("shingles"), strict=True):
                own = np.frombuffer(data.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), node)), pa.array(own)], ["node", "h"])

    rows = common.table(sets.join(nodes.select("node"), "node", "left_semi").select("node", "shingles").transform(common.map_batches, explode, "node long, h long"), "open_shingles")
    twice = common.table(rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "open_counts")
    # What stands in so many sets meets them where they lie; fewer than FREQUENT shingles can be so frequent.
    often = f"n * {FREQUENT} > {rows.count()}"
    hot = F.broadcast(twice.filter(often))
    met = rows.join(hot, "h").unionByName(rows.join(hot.select("h"), "h", "left_anti").join(twice.filter(f"NOT {often}"), "h"))
    own = Window.partitionBy("node")
    met = met.select("node", "h", F.count("*").over(own).alias("met"), F.row_number().over(own.orderBy("n", "h")).alias("nth"))
    met = met.join(nodes, "node").withColumn("pos", F.col("size") - F.col("met") + F.col("nth"))
    return met.filter(f"pos <= size - (({percent} * size + 99) div 100) + 1").select("node", "size", "label", "keys", "h", "pos")


def _rare_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels and a common bucket that could be similar enough: all such pairs that are.

    Sets of sizes s and t need `both`, the least number of common shingles, so one of the rarest s - both + 1 of the first
    is among the rarest t - both + 1 of the second. The smaller set of a pair comes in by the places that this leaves it
    whatever the partner (`given`), the larger by all of its prefix. A shingle whose sets are all connected is left out, and
    those of its largest component do not meet each other. MEET sets at a time meet what is given."""
    by_label = prefixes.groupBy("h", "label").agg(F.count("*").alias("n"))
    main = by_label.groupBy("h").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels"), F.ceil(F.sum("n") / MEET).alias("salts"))
    rows = common.table(prefixes.join(main.filter("labels > 1").drop("labels"), "h").withColumn("is_main", F.col("label") == F.col("main")).drop("main"), "prefixes")
    x = rows.withColumn("salt", F.pmod(F.xxhash64("node"), "salts"))
    given = rows.filter(f"pos <= size - (({2 * percent} * size + {99 + percent}) div {100 + percent}) + 1")
    y = given.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    both = f"(({percent} * (x.size + y.size) + {99 + percent}) div {100 + percent})"
    near = F.expr(
        f"x.h = y.h AND x.salt = y.salt AND x.label <> y.label AND (y.size < x.size OR y.size = x.size AND y.node < x.node) AND 100 * y.size >= {percent} * x.size"
        f" AND x.pos <= x.size - {both} + 1 AND y.pos <= y.size - {both} + 1 AND arrays_overlap(x.keys, y.keys)"
    )

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.alias("x").join(y.alias("y"), near).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    return met(x.filter("NOT is_main"), y).unionByName(met(x.filter("is_main"), y.filter("NOT is_main"))).distinct()


def components(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """(node, label) for all nodes of edges (a, b): label is the smallest node reached."""
    stars = common.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), tag)
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        stars = common.table(small.filter("u <> v").distinct(), tag)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def link_classes(signs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes (class, node, doc_id, n) and components (node, label) of classes that link with another."""
    classes = common.table(signs.filter("class IS NOT NULL").groupBy("class").agg(F.min("uid").alias("node"), F.count("*").alias("n")), "classes")
    heads = signs.join(classes.select("node"), F.col("uid") == F.col("node"), "left_semi")
    keyed = heads.select(F.explode("bands").alias("key"), F.col("uid").alias("node"), F.col("n_shingles").alias("size"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sharing = common.table(keyed.join(shared, "key"), "sharing")
    # A bucket's hub is its member with most company: in a group of near copies the one that the others come from.
    company = sharing.groupBy("node").agg(F.sum("n").alias("company"))
    sharing = sharing.join(company, "node")
    hubs = sharing.groupBy("key").agg(F.max(F.struct("company", (-F.col("node")).alias("minus"))).alias("best"))
    members = sharing.join(hubs, "key").select("key", "node", "size", (-F.col("best.minus")).alias("hub"), F.col("best.company").alias("hub_company"))
    members = common.table(members, "members")
    wanted = members.select("node").distinct()
    wanted = common.table(heads.join(wanted, F.col("uid") == F.col("node"), "left_semi").select(F.col("uid").alias("node"), "key", "class"), "wanted")
    sets = common.table(_sets(rows, wanted), "sets")

    # Round 1: each class with the best of its buckets' hubs.
    pairs = members.groupBy("node").agg(F.max_by("hub", F.struct("hub_company", "hub")).alias("a")).filter("a <> node").select("a", F.col("node").alias("b"))
    edges = common.table(verified(pairs, sets, percent), "edges1")
    labels = components(edges)

    def labelled(labels: DataFrame) -> DataFrame:
        return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    # Round 2: each bucket's hub with members of other components.
    known = common.table(labelled(labels), "members2")
    hubs = known.filter("node = hub").select("key", F.col("label").alias("hub_label"), F.col("size").alias("hub_size"))
    able = f"100 * least(size, hub_size) >= {percent} * greatest(size, hub_size)"
    pairs = known.join(hubs, "key").filter("label <> hub_label").filter(able).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    edges2 = common.table(verified(common.table(pairs, "pairs2"), sets, percent), "edges2")
    stars = labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(edges2)
    labels = components(stars)

    # Round 3: members of buckets that hold several components, by the rare shingles they share; hubs are done.
    known = common.table(labelled(labels).filter("node <> hub"), "members3")
    counts = known.select("key", "label").distinct()
    several = counts.groupBy("key").agg(F.count("*").alias("labels")).filter("labels > 1").select("key")
    open_ = known.join(several, "key").groupBy("node").agg(F.first("size").alias("size"), F.first("label").alias("label"), F.collect_set("key").alias("keys"))  # BANDS keys at most
    pairs = _rare_pairs(_prefixes(sets, common.table(open_, "open"), percent), percent)
    edges3 = common.table(verified(common.table(pairs, "pairs3"), sets, percent), "edges3")
    if not edges3.isEmpty():
        labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(edges3))
    return classes, labels


def group(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """uid, doc_id, n_shingles, class_size, component_id, kept. rows: (uid, doc_id, text), doc_id a long."""
    signs = common.table(signatures(rows), "signatures")
    classes, labels = link_classes(signs, rows, percent)
    # Classes that need more than their own row: with copies, or linked.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    own = signs.filter("class IS NOT NULL").groupBy("class").agg(first)
    busy = classes.join(labels, "node", "left").filter("n > 1 OR label IS NOT NULL").withColumn("label", F.coalesce("label", "node"))
    busy = common.table(busy.join(own, "class").select("class", "label", "n", "first"), "busy")
    heads = busy.groupBy("label").agg(F.min("first").alias("head"))
    by_class = busy.join(heads, "label").select("class", "n", "head")
    out = signs.select("uid", "doc_id", "n_shingles", "class").join(by_class, "class", "left")
    alone = F.col("head").isNull()
    return out.select(
        "uid",
        "doc_id",
        "n_shingles",
        F.coalesce("n", F.lit(1)).cast("long").alias("class_size"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("uid") == F.col("head.uid")).alias("kept"),
    )


def report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_size (documents with the same set)."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return group(rows, percent).select("doc_id", "n_shingles", "component_id", "kept", "class_size")


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each group; columns are those of docs."""
    rows, uid = common.numbered_rows(docs)
    plain = rows.select(F.col(uid).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dropped = group(plain, percent).filter("NOT kept").select(F.col("uid").alias(uid))
    return rows.join(dropped, uid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
