"""The trie of three levels against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loomtab.llm import common, ngram_lm

from .test_llm_spark import SF, ascii_lower


def brute(texts, held):
    """Scores by dictionaries of all words, pairs and triples; and the tables themselves."""
    words = {k: [*re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t)), None] for k, t in texts.items()}
    one, two, three = collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for k, w in words.items():
        if not held(k):
            one.update(w)
            for a, b in zip([None, *w], w):
                two[a][b] += 1
            for a, b, c in zip([None, *w], w, w[1:]):
                three[a, b][c] += 1
    n, v = sum(one.values()), len(one)

    def p(c, b, a=None):
        q = (one[c] + 0.1) / (n + 0.1 * (v + 1))
        if one[b]:
            q = max(two[b][c] - 0.75, 0) / one[b] + 0.75 * len(two[b]) / one[b] * q
        if a is not None and (t := three.get(a)):
            total = sum(t.values())
            q = max(t[c] - 0.75, 0) / total + 0.75 * len(t) / total * q
        return q

    scores = {}
    for k, w in words.items():
        full = [None, *w]
        scores[k] = math.log10(p(w[0], None)) + sum(math.log10(p(full[i], full[i - 1], (full[i - 2], full[i - 1]))) for i in range(2, len(full)))
    return words, scores


@pytest.mark.parametrize("shard_tokens", [1_500, 4_000_000])
def test_scores_of_order_three(spark, shard_tokens, monkeypatch):
    monkeypatch.setattr(ngram_lm, "HOT_SHARE", 0.01 if shard_tokens < 10_000 else ngram_lm.HOT_SHARE)
    docs = common.tables(spark, SF, "documents").cache()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    words, want = brute(texts, lambda k: zlib.crc32(str(k).encode()) % 10 == 0)
    model = ngram_lm.fit(docs.filter(~ngram_lm.held_out()).select("text"), shard_tokens=shard_tokens, order=3)
    if shard_tokens < 10_000:
        assert len(model.shards) > 5 and model.hot and model.pairs  # words and pairs whose successors are dealt one by one
    got = ngram_lm.score(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-3 * len(words[r.doc_id]))
    two = ngram_lm.report(docs).agg({"score": "sum"}).first()[0]
    assert sum(r.score for r in got) > two  # the longer context tells more about the texts it learnt from


def test_every_seen_successor_is_found_between_its_pointers(tmp_path):
    dice = random.Random(4)
    kinds = 50
    pairs = sorted({(dice.randrange(0, kinds, 3), dice.randrange(kinds)) for _ in range(300)})
    u, w = (np.array(x) for x in zip(*pairs))
    triples = sorted({(dice.randrange(len(pairs)), dice.randrange(kinds)) for _ in range(900)})
    rank, x = (np.array(v) for v in zip(*triples))
    share = lambda n: np.array([dice.uniform(1e-7, 1) for _ in range(n)])
    s2, s3 = share(len(pairs)), share(len(triples))
    ngram_lm.Successors.build(f"file://{tmp_path}/s", u, w, np.ones(len(u), int), rank, x, np.ones(len(x), int), kinds, s2, s3)
    shard = ngram_lm.Successors(f"file://{tmp_path}/s", kinds)
    every = np.array([(a, b) for a in range(kinds) for b in range(-1, kinds)])
    place, got, number = shard.find(every[:, 0], every[:, 1])
    for (a, b), i, s, t in zip(every.tolist(), place, got, number):
        assert t == sum(p[0] == a for p in pairs)
        assert (i >= 0) == ((a, b) in pairs) and (i < 0 or pairs[i] == (a, b) and s == pytest.approx(s2[i], rel=1e-3))
    every = np.array([(a, b) for a in range(len(pairs)) for b in range(-1, kinds)])
    got, number = shard.find_after(every[:, 0], every[:, 1])
    for (a, b), s, t in zip(every.tolist(), got, number):
        assert t == sum(p[0] == a for p in triples)
        assert s == (pytest.approx(s3[triples.index((a, b))], rel=1e-3) if (a, b) in triples else 0)
    assert all(shard.successors(a).tolist() == [q for p, q in pairs if p == a] for a in range(kinds))


def test_elias_fano_on_dense_and_sparse_sequences():
    dice = np.random.default_rng(7)
    for n, bound in [(1, 1), (64, 64), (5000, 5001), (300, 1 << 50), (4000, 1 << 20)]:
        values = np.sort(dice.choice(min(bound, 1 << 22), n, replace=False).astype(np.int64) * max(1, bound >> 22)) if bound > 1 else np.zeros(1, np.int64)
        coded = ngram_lm.EliasFano.of(values, bound)
        assert (coded.get(np.arange(n)) == values).all() and (coded.find(values) == np.arange(n)).all()
        edges = np.arange(n)
        assert (coded.find(values, edges, edges + 1) == edges).all() and (coded.find(values, edges + 1, np.full(n, n)) == -1).all()


def test_levels_read_whole_stay_bounded(monkeypatch, tmp_path):
    monkeypatch.setattr(ngram_lm, "KEEP_BYTES", 1)
    monkeypatch.setattr(common, "is_mounted", lambda uri: False)
    paths = {}
    for i in range(4):
        paths[i] = f"file://{tmp_path}/{i}"
        one = np.array([i])
        ngram_lm.Successors.build(paths[i], one, one, one + 1, one * 0, one, one + 1, 9, np.array([0.5]), np.array([0.5]))
    shards = ngram_lm.Shards(ngram_lm.Model(1, 9, shards=paths))
    for i in (0, 1, 2, 3, 0):
        assert shards[i].find(np.array([i]), np.array([i]))[0].tolist() == [0] and len(shards.opened) == 1
    assert shards[7] is None


def test_rare_words_and_odd_texts_score(spark):
    rows = [(None, "a"), (1, None), (2, ""), (2, "a b a b a b"), (3, "z\x00z  Q q"), (3, "z\x00z  Q q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_lm.report(docs, order=3).collect()
    assert len(got) == 6 and all(np.isfinite(r.score) and r.score < 0 for r in got) and pa.array([r.n_tokens for r in got]).to_pylist().count(1) == 2
    assert ngram_lm.report(docs.limit(0), order=3).count() == 0
    with pytest.raises(ValueError):
        ngram_lm.fit(docs, order=4)


def test_what_precedes_a_range_is_read_once_for_all_words_after_a_context(tmp_path, monkeypatch):
    n = 1000
    u, w, none = np.repeat([3, 8], n), np.tile(np.arange(n), 2), np.zeros(0, int)
    ngram_lm.Successors.build(f"file://{tmp_path}/s", u, w, u, none, none, none, n, np.full(2 * n, 0.5), np.zeros(0))
    shard, read, get = ngram_lm.Successors(f"file://{tmp_path}/s", n), [], ngram_lm.EliasFano.get
    monkeypatch.setattr(ngram_lm.EliasFano, "get", lambda self, i: read.append(len(i)) or get(self, i))
    place, share, number = shard.find(np.full(n, 8), np.arange(n))
    assert place.tolist() == list(range(n, 2 * n)) and (number == n).all() and share == pytest.approx(0.5)
    assert sum(read) < 10


def test_words_of_a_chunk_ascend_as_their_ids_do():
    h, places, n = ngram_lm.word_hashes(pa.array(["b a c", "", "a Z a", "é"]))
    assert h[0] == ngram_lm.END and (np.diff(h) > 0).all() and n.tolist() == [3, 0, 3, 1]
    b, a, c, z, e = places[[0, 1, 2, 4, 6]].tolist()
    assert places.tolist() == [b, a, c, a, z, a, e] and sorted([b, a, c, z, e]) == [1, 2, 3, 4, 5]
    before, token = ngram_lm._pairs(places, n)
    assert token.tolist() == [b, a, c, 0, 0, a, z, a, 0, e, 0] and before.tolist() == [0, b, a, c, 0, 0, a, z, a, 0, e]
    h, places, n = ngram_lm.word_hashes(pa.array(["", " "]))
    assert h.tolist() == [ngram_lm.END] and not len(places) and [x.tolist() for x in ngram_lm._pairs(places, n)] == [[0, 0], [0, 0]]


@pytest.mark.parametrize("low,high", [(0, 5), (0, 1 << 40), (0, 1 << 62), (-9, 9), (-(1 << 62), 1 << 62)])
def test_distinct_keys_with_and_without_room_for_places(low, high):
    dice = np.random.default_rng(3)
    for n in (0, 1, 2, 700):
        keys = dice.integers(low, high, max(1, n // 2), np.int64)
        keys = keys[dice.integers(0, len(keys), n)]
        want = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(ngram_lm._distinct(keys), want, strict=True))
        ordered, order = ngram_lm._sorted(keys)
        assert (order == np.argsort(keys, kind="stable")).all() and (ordered == np.sort(keys)).all()
        for x in (keys, ordered):
            assert all((a == b).all() for a, b in zip(ngram_lm._grouped(x), np.unique(x, return_inverse=True), strict=True))


def test_members_with_those_that_follow():
    dice = np.random.default_rng(8)
    for values in (np.arange(300), np.sort(dice.integers(0, 1 << 45, 3000)), np.sort(np.concatenate([np.zeros(200, int), dice.integers(0, 90_000, 40)]))):
        coded, i = ngram_lm.EliasFano.of(values, int(values[-1]) + 1), dice.integers(0, len(values) - 1, 500)
        a, b = coded.steps(i)
        assert (a == values[i]).all() and (b == values[i + 1]).all()


def test_groups_of_a_few_and_of_very_many_shards():
    for top in (1, 40, 70_000):
        home = np.random.default_rng(top).integers(-1, top, 3000)
        home[0] = top
        got = {s: at.tolist() for s, at in ngram_lm._by_shard(home)}
        assert got == {s: np.flatnonzero(home == s).tolist() for s in np.unique(home).tolist()}


def test_packed_integers_of_every_width():
    for top in (127, 128, (1 << 14) - 1, 1 << 14, 1 << 42, (1 << 62) - 1):
        values = np.array([0, 1, top, top - 1, top // 2])
        assert (ngram_lm.unpack(ngram_lm.pack(values)) == values).all()
