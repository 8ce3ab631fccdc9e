"""Ranked search, BPE encoding and prefix tries against brute force, the tokenizers library and hard rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from loomtab.llm import bpe_codec, common, prefix_trie, queries, ranked_search

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 97}x{i % 1009}" for i in range(20_000))
HARD = [None, "", " \n ", "One two.", "one  two.", "one two two", LONG, LONG, "été ñandú 日本 <|endoftext|> x", "x" * 50_000, "12 34 !!", "ONE"]


def documents(spark, texts, extra="query string, terms string, n long, rank int"):
    rows = [(i, t, "q", "t", 1, 2) for i, t in enumerate(texts)] + [(None, "one null id", None, None, None, None)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


# Ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_search(docs, items, top=10):
    """Rows of every item (in its place of the list), scored document by document."""
    counts = [(k, collections.Counter(terms(t)), len(terms(t))) for k, t in docs if terms(t)]
    n, total, out = len(counts), sum(x[2] for x in counts), []
    df = collections.Counter(t for _, c, _ in counts for t in c)
    for item, text in items:
        got = []
        for key, c, size in counts:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            got += [(-s, key is None, key or 0, key)] if s > 0 else []
        out += [(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(got)[:top], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **more).collect()), key=str)


@pytest.mark.parametrize("block_terms", [200_000, 300])
def test_search_of_the_tables(spark, block_terms):
    docs, items = common.tables(spark, SF, "documents"), common.tables(spark, SF, "benchmark")
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(spark, docs, items, block_terms=block_terms) == want and len(want) == 400


def test_search_of_hard_rows(spark):
    docs = documents(spark, HARD)
    asked = [(1, "one TWO"), (2, None), (3, "..."), (4, "one TWO"), (4, "two one"), (None, "日本 x"), (5, LONG), (6, "nowhere")]
    items = spark.createDataFrame([(*r, "clash") for r in asked], "item_id long, text string, rank string")
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], asked, 3)
    assert found(spark, docs, items, top=3) == want
    ties = [r for r in want if r[0] == 5]
    assert [r[2] for r in ties[:2]] == [6, 7]  # equal texts, by doc_id
    assert found(spark, docs.limit(0), items) == [] and found(spark, docs, items.limit(0)) == []
    assert found(spark, spark.createDataFrame([(1, None)], "doc_id long, text string"), items) == []


def test_plans_share_what_queries_have_in_common():
    rng = random.Random(5)
    common_sets = [rng.sample(range(300), 12) for _ in range(6)]
    asked = [sorted({*rng.choice(common_sets), *rng.choice(common_sets), *rng.sample(range(300), 4)}) for _ in range(200)]
    pairs, left = ranked_search.mine(asked, 300)
    made = {}

    def all_terms(s):
        if s < 300:
            return [s]
        if s not in made:
            made[s] = [t for x in pairs[s - 300] for t in all_terms(x)]
        return made[s]

    for q, symbols in zip(asked, left, strict=True):
        assert sorted(t for s in symbols for t in all_terms(s)) == q  # each term once
    assert ranked_search.additions(pairs, left) < 0.5 * sum(len(q) - 1 for q in asked)
    wide = [list(range(50_000)) for _ in range(3)]
    pairs, left = ranked_search.mine(wide, 50_000)
    assert ranked_search.additions(pairs, left) < 50_010


def test_best_keeps_ties_in_order():
    import numpy as np

    best = ranked_search.Best(1, 2)
    for scores, ids in (([5, 5, 5, 5, 5, 5, 5, 5, 5, 0], [9, 8, 7, 6, 5, 4, 3, 2, 1, 0]), ([5, 6], [0, 50])):
        best.add(0, np.array(scores), np.array(ids), np.zeros(len(ids), bool))
    assert best.rows[0] == [(-6, False, 50), (-5, False, 0)]


# BPE


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(BYTES)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def test_codec_is_the_library(codec, library):
    rng, alphabet = random.Random(1), ["a", "b", " ", "  ", "\n", "é", "日", "<|endoftext|>", "<|endof", "'s", "'RE", "1", "22", "aaaa", "==", "\t", "the", "ing", "​", "🙂", "\xa0", "\x00", "\x1c", "\x85", "　"]
    for k in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) if k % 2 else "".join(rng.choice("abcdethinorsg") for _ in range(rng.randint(0, 80)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode_all(pa.array([ids], pa.list_(pa.int32()))) == [library.decode(ids, skip_special_tokens=False)] == [text]
    for ids in ([rng.randrange(50257) for _ in range(50)] for _ in range(300)):  # bytes that are no UTF-8
        assert codec.decode_all(pa.array([ids], pa.list_(pa.int32()))) == [library.decode(ids, skip_special_tokens=False)]
    with pytest.raises(ValueError, match="outside the vocabulary"):
        codec.decode_all(pa.array([[50257]], pa.list_(pa.int32())))


def test_characters_of_all_kinds(codec, library):
    for c in [*range(0x3500), *range(0xF900, 0x10000, 3), *range(0x10000, 0x1FFFF, 29), *range(0xE0000, 0xE01FF)]:
        text = f"a{chr(c)}1 {chr(c)}{chr(c)} x"
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_long_pieces_take_linear_time(codec, library):
    import time

    rng = random.Random(2)
    for make in (lambda n: "x" * n, lambda n: "ab" * (n // 2), lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n)), lambda n: "=" * n):
        took = []
        for n in (20_000, 80_000):
            text = make(n)
            began = time.process_time()
            ids = codec.encode(text).tolist()
            took.append(time.process_time() - began)
            assert ids == library.encode(text, add_special_tokens=False).ids
        assert took[1] < 12 * took[0] + 0.2


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe_codec.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_query(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r.doc_id: r.text for r in common.tables(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = queries.op12_bpe_codec(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_bpe_of_hard_rows(spark, library):
    docs = documents(spark, HARD, "ids string, n_tokens string, a long, b int")
    ids = bpe_codec.encode(docs, BYTES)
    assert {r.doc_id: r.ids for r in ids.collect()} == {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    assert {r.doc_id: r.text for r in bpe_codec.decode(ids, BYTES).collect()} == {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted((r.doc_id or -1, r.n_tokens) for r in bpe_codec.report(docs, BYTES).collect()) == sorted((r.doc_id or -1, len(r.ids)) for r in ids.collect())
    assert bpe_codec.report(docs.limit(0), BYTES).count() == 0
    assert bpe_codec.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), BYTES).first().text == ""


# Prefix trie


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(role, text) for *_, role, text in sorted(v)] for c, v in own.items() if c is not None}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]
    nodes, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + ((len(nodes[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    sha = lambda k: hashlib.sha256(",".join(str(c) for c in sorted(nodes[k]) if len(built[c]) == len(k)).encode()).hexdigest()
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], sha(k)) for k, m in nodes.items())


def nodes_of(conversations):
    return sorted(tuple(r) for r in prefix_trie.report(conversations).collect())


def test_trie_of_the_tables(spark):
    rows = common.tables(spark, SF, "conversations")
    assert nodes_of(rows) == brute_trie([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


@pytest.mark.parametrize("shard_turns, fan_in, run_ids", [(400_000, 16, 4096), (12, 2, 3), (40, 3, 1)])
def test_trie_of_hard_rows_in_few_and_many_shards(spark, monkeypatch, shard_turns, fan_in, run_ids):
    """Copies, long conversations, nulls, ties, repeated rows, turnless rebuilt conversations, negative ids."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(prefix_trie, "FAN_IN", fan_in)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", run_ids)
    rng, rows = random.Random(4), []
    for c in [*range(-12, 60), *range(1000, 1120)]:
        kind = rng.random()
        if kind < 0.4:
            rows += [(c, t, "user", f"same {t}") for t in range(9)]
        elif kind < 0.5:
            rows += [(c, t, rng.choice("ua"), f"{rng.randrange(3)}") for t in range(300)]
        else:
            rows += [(c, rng.choice([None, 0, 1, 2, t]), rng.choice([None, "", "user", "a"]), rng.choice([None, "", "é", "same 0", "same 1", str(rng.randrange(4))])) for t in range(rng.randint(1, 8))]
    rows += [rows[0], rows[0], (None, 1, "user", "no conversation"), (7777, 0, None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, bytes long").repartition(7)
    got = nodes_of(frame)
    assert got == brute_trie(rows)
    assert sum(r[1] == 0 for r in got) == 1
    assert nodes_of(frame.limit(0)) == [] and nodes_of(frame.filter("conv_id is null")) == []


def test_trees_are_balanced():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.balanced(1023):
        tree.insert([i], [1])
    deep, todo = 0, [(tree.down[0], 1)]
    while todo:
        node, depth = todo.pop()
        deep = max(deep, depth)
        todo += [(n, depth + 1) for n in (tree.low[node], tree.high[node]) if n]
    assert deep == 10 and sorted(prefix_trie.balanced(77)) == list(range(77))
