"""Cleaning over several blocks of items, and automata of repetitive items."""

import random
import time

import pytest

from loomtab.llm import decontaminate


@pytest.mark.parametrize("block_words", [1, 12, 500_000])
def test_limits_are_of_the_whole_document_in_any_number_of_blocks(spark, block_words):
    """A cut of 12 words brings 18 together; with both 30 of 70 words go."""
    first, second = [f"a{i}" for i in range(12)], [f"b{i}" for i in range(18)]
    text = " ".join([*(f"x{i}" for i in range(20)), *second[:9], *first, *second[9:], *(f"y{i}" for i in range(20))])
    bench = spark.createDataFrame([(1, " ".join(first)), (2, " ".join(second))], "item_id long, text string")
    docs = spark.createDataFrame([(1, text, "s"), (2, "nothing here", "s"), (3, None, "s")], "doc_id long, text string, hit_size string")
    strict = decontaminate.clean(docs, bench, max_coverage=0.35, block_words=block_words)
    assert sorted(r.doc_id for r in strict.collect()) == [2, 3] and strict.columns == docs.columns
    loose = {r.doc_id: r.text for r in decontaminate.clean(docs, bench, max_coverage=0.5, block_words=block_words).collect()}
    assert len(loose[1].split()) == 40 and loose[2] == "nothing here" and loose[3] is None


def test_equal_words_build_and_scan_in_linear_time():
    took = []
    for n in (25_000, 100_000):
        began = time.process_time()
        automaton = decontaminate.Automaton([("zeros", [b"0"] * n), ("short", [b"0"] * 3)])
        spans, items = automaton.scan([b"0"] * n)
        took.append(time.process_time() - began)
        assert spans == [(0, n)] and items == {"zeros", "short"}
    assert took[1] < 10 * took[0] + 0.3


def test_automaton_against_every_window():
    rng = random.Random(2)
    for _ in range(150):
        items = [(str(k), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 9))]) for k in range(6)]
        text, window = [rng.choice([b"a", b"b", b"c"]) for _ in range(40)], rng.randint(2, 5)
        hit, found = set(), set()
        for key, item in items:
            size = min(window, len(item))
            for i in range(len(item) - size + 1 if size else 0):
                for at in range(len(text) - size + 1):
                    if text[at : at + size] == item[i : i + size]:
                        hit |= set(range(at, at + size))
                        found.add(key)
        spans, got = decontaminate.Automaton(items, window).scan(text)
        assert {i for a, b in spans for i in range(a, b)} == hit and got == found


@pytest.mark.parametrize("block_words", [1, 50, 500_000])
def test_hits_in_any_number_of_blocks_against_every_window(spark, block_words):
    """Items longer than a block are cut into pieces; repeated items, equal ids and null ids and texts stand among them."""
    rng = random.Random(4)
    items = [(k % 7 if k % 5 else None, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 2, 9, 30, 130])))) for k in range(14)]
    items += [items[3], items[4], (3, None)]
    texts = [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(30)] + [items[k][1].upper() for k in range(14)] + ["", None]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, text in enumerate(texts):
        read, hit, found = (text or "").lower().split(), set(), set()
        for key, item in items:
            item = (item or "").split()
            size = min(10, len(item))
            windows = {tuple(item[a : a + size]) for a in range(len(item) - size + 1)} if size else set()
            for at in range(len(read) - size + 1):
                if tuple(read[at : at + size]) in windows:
                    hit |= set(range(at, at + size))
                    found.add("" if key is None else str(key))
        want[i] = (len(read), hit, sorted(found))
    got = decontaminate.find_hits(docs, bench, block_words=block_words).collect()
    assert {r.doc_id: (r.n_words, {i for a, b in zip(r.spans[::2], r.spans[1::2]) for i in range(a, b)}, r["items"]) for r in got} == want


def test_blocks_are_bounded_and_pieces_lose_no_window(spark):
    long = [f"w{i}" for i in range(1000)]
    bench = spark.createDataFrame([(1, " ".join(long)), (1, " ".join(long)), *((k, f"only {k} here") for k in range(2, 80))], "item_id long, text string")
    cut = [r.words.split() for r in decontaminate.pieces(bench, 10, 100).collect()]
    windows = sorted(tuple(c[a : a + 10]) for c in cut if len(c) > 9 for a in range(len(c) - 9))
    assert windows == sorted(tuple(long[a : a + 10]) for a in range(991)) and max(map(len, cut)) == 100
    import pickle

    from loomtab.llm import common

    blocks = [pickle.loads(common.read_file(p)) for p in decontaminate.write_automata(bench, block_words=200)]
    assert 5 <= len(blocks) <= 14 and all(len(a.next) <= 2 * 200 for a in blocks)
