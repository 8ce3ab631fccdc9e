"""Near-dedup where buckets are large: members that do not link, salts, repeated and null ids."""

import random

import numpy as np
import pytest

from loomtab.llm import near_dedup

from .test_llm_spark import brute_components, shingles

SCHEMA = "doc_id long, text string"


def brute(rows):
    return brute_components({k: shingles(t) for k, t in rows})


def test_signatures_in_slices_are_minima_over_the_whole_set(monkeypatch):
    dice = np.random.default_rng(2)
    n = np.array([0, 5, 0, 300, 1, 0, 777, 64, 0])
    hashes = dice.integers(0, 1 << 63, n.sum()).astype(np.uint64)
    c = near_dedup.Circulant()
    whole = c.signatures(hashes, n)
    monkeypatch.setattr(near_dedup, "SLICE", 64)
    assert (c.signatures(hashes, n) == whole).all()
    for i, (a, b) in enumerate(zip(np.cumsum(n) - n, np.cumsum(n))):
        if b > a:
            assert (c.signature(np.unique(hashes[a:b])) == whole[i]).all()
    place = np.arange(1 << 16, dtype=np.uint32)
    for odd in (c.first, c.second):
        assert len(np.unique(c._permute(place.copy(), odd, np.empty_like(place)))) == len(place)


def test_long_sets_do_not_agree_by_chance():
    dice, c = np.random.default_rng(3), near_dedup.Circulant()
    a, b = (c.signature(dice.integers(0, 1 << 63, 3_000_000).astype(np.uint64)) for _ in range(2))
    assert (a == b).mean() < 0.02


@pytest.mark.parametrize("meet", [7, 500])
def test_members_of_a_bucket_that_do_not_link(spark, monkeypatch, meet):
    """Texts that share 172 of 200 words and no more (0.75), some that share all the core, and chains over its parts."""
    monkeypatch.setattr(near_dedup, "MEET", meet)
    dice = random.Random(5)
    core, rows = [f"c{i}" for i in range(172)], []
    for i in range(150):
        rows.append((i, " ".join(core + [f"u{i}x{j}" for j in range(28)])))
    for i in range(150, 170):
        rows.append((i, " ".join(core[: dice.randint(160, 172)] + [f"u{i}x{j}" for j in range(dice.randint(0, 12))])))
    for i in range(170, 200):  # edited more and more
        w = rows[i % 7][1].split()
        for _ in range(i % 11):
            w[dice.randrange(len(w))] = f"e{dice.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    dice.shuffle(rows)
    want = brute(rows)
    got = {r.doc_id: r.component_id for r in near_dedup.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want and 100 < len(set(want.values())) < 199


def test_repeated_and_null_ids_keep_one_row_of_a_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (None, text + " end"), (7, text + " end"), (7, text + " end"), (7, other), (None, other), (3, "x")]
    got = near_dedup.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3
    assert {r.component_id for r in got} == {7, 3}


@pytest.fixture
def last_round(monkeypatch):
    """Numbers of pairs that the last round sent to verification."""
    seen, table = [], near_dedup.common.table

    def counted(df, tag):
        out = table(df, tag)
        if tag == "pairs3":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_dedup.common, "table", counted)
    return seen


@pytest.mark.parametrize("n", [500, 2000])
def test_a_template_does_not_bring_its_texts_together(spark, last_round, n):
    """Texts of one template whose two other passages each stand in one text more; every tenth has a copy with an edit that
    the hub does not show."""
    core = [f"c{i}" for i in range(160)]
    passage = lambda i: [f"p{i % n}x{j}" for j in range(20)]
    rows = [(i, " ".join(core + passage(i) + passage(i + 1))) for i in range(n)]
    rows += [(n + i, rows[i][1].rsplit(" ", 1)[0] + f" e{i}") for i in range(0, n, 10)]
    got = {r.doc_id: r.component_id for r in near_dedup.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: i % n for i, _ in rows}
    assert sum(last_round) < 20 * n


@pytest.mark.parametrize("meet, percent", [(3, 85), (500, 80), (3, 60)])
def test_rare_shingles_bring_all_similar_sets_together(spark, monkeypatch, meet, percent):
    monkeypatch.setattr(near_dedup, "MEET", meet)
    monkeypatch.setattr(near_dedup, "FREQUENT", 20)
    dice, sets = random.Random(meet), {}
    for i in range(120):
        own = set(range(dice.choice([0, 60, 75, 80]))) | {dice.randrange(1000, 1400) for _ in range(dice.choice([1, 5, 20]))}
        if i % 3 == 0 and i:
            own = set(sets[dice.randrange(i)]) | {dice.randrange(1000, 1400) for _ in range(dice.randrange(4))}
        sets[i] = own
    label, keys = {i: dice.choice([i, 0]) for i in sets}, {i: dice.sample(range(6), dice.randint(1, 3)) for i in sets}
    rows = spark.createDataFrame([(i, np.array(sorted(s), np.int64).tobytes()) for i, s in sets.items()], "node long, shingles binary")
    nodes = spark.createDataFrame([(i, len(s), label[i], keys[i]) for i, s in sets.items()], "node long, size long, label long, keys array<long>")
    got = {(r.a, r.b) for r in near_dedup._rare_pairs(near_dedup._prefixes(rows, nodes, percent), percent).collect()}
    able = {(a, b) for a in sets for b in sets if a < b and label[a] != label[b] and set(keys[a]) & set(keys[b])}
    near = {(a, b) for a, b in able if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert near and near <= got <= able and len(got) < len(able)
