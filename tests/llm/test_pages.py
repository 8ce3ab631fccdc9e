"""Page extraction against a brute-force extractor, and the cases that decide between markup and recurrence."""

import collections
import random
import time

import numpy as np
import pytest

from loomtab.llm import html_extract as H

SCHEMA = "page_id long, url string, html string"


def naive(pages):
    """Main texts of a host's pages by plain loops over all runs: no hashes, suffix arrays or pieces."""
    found = [H.blocks(p) for p in pages]
    units = lambda w: [tuple(w[i : i + H.RUN]) for i in range(len(w) - H.RUN + 1)] or [tuple(w)]
    contents = []
    for page in found:
        long = frozenset(t for k, t in page if k in (H.ARTICLE, H.OPEN) and len(t.split()) >= H.RUN)
        contents.append(long or frozenset(t for _, t in page))
    where = collections.defaultdict(set)  # unit: contents
    probes = collections.defaultdict(set)  # unit: pages
    by_key = {}
    for i, page in enumerate(found):
        for _, text in page:
            w = text.split(" ")
            for u in units(w):
                where[u].add(contents[i])
            for u in probes_of(units(w), by_key):
                probes[u].add(i)
    nearly = {u for u, p in probes.items() if len(p) >= H.NEARLY_ALL * len(pages) and len({contents[i] for i in p}) >= H.WELL_FILLED}
    out = []
    for page in found:
        kinds = [k for k, _ in page]
        if not {H.ARTICLE, H.OPEN} & set(kinds):
            kinds = [H.OPEN if k == H.WEAK else k for k in kinds]
        goes = [set(probes_of(units(t.split(" ")), by_key)) <= nearly for _, t in page]
        size = [len(t.split(" ")) for _, t in page]
        article = sum(n for n, k in zip(size, kinds) if k == H.ARTICLE)
        copied = 2 * sum(n for n, k, g in zip(size, kinds, goes) if k == H.ARTICLE and not g) < article
        kept, whole = [], []
        for (_, text), kind, gone in zip(page, kinds, goes):
            if kind == H.ARTICLE and (copied or not gone):
                kept.append(text)
            if kind == H.OPEN:
                whole.append(text)
                w, covered = text.split(" "), set()
                for j, u in enumerate(units(w)):
                    if len(where[u]) > 1:
                        covered |= set(range(j, j + len(u)))
                if len(covered) < H.MOSTLY * len(w):
                    kept.append(text)
                    continue
                run = []
                for j in range(len(w) + 1):
                    if j < len(w) and j not in covered:
                        run.append(w[j])
                        continue
                    if len(run) >= H.RUN:
                        kept.append(" ".join(run))
                    run = []
        out.append("\n".join(kept or whole))
    return out


def probes_of(units, by_key):
    """First, last and least unit of a block; the least one by the operator's own keys."""
    for u in units:
        if u not in by_key:
            h = H._hashes(H.pa.array(u))
            by_key[u] = int(H._run_keys(h, np.array([0]))[0]) if len(u) == H.RUN else 0
    return [units[0], units[-1], min(units, key=by_key.get)]


def page_of(dice, words, shapes):
    pick = lambda n: " ".join(dice.choice(words) for _ in range(n))
    made = []
    for _ in range(dice.randint(1, 5)):
        text = dice.choice(shapes) if dice.random() < 0.5 else pick(dice.randint(1, 30))
        made.append(f"<{dice.choice(['p', 'div', 'li', 'section class=promo'])}>{text}")
    body = "".join(made)
    return f"<nav>{shapes[0]}</nav>" + (f"<article>{body}</article><p>{shapes[1]}</p>" if dice.random() < 0.5 else body)


@pytest.mark.parametrize("seed", range(40))
def test_main_texts_agree_with_brute_force(seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(dice.choice([3, 40, 4000]))]
    shapes = [" ".join(dice.choice(words) for _ in range(n)) for n in (3, 9, 12, 25, 40)]
    pages = [page_of(dice, words, shapes) for _ in range(dice.choice([1, 2, 7, 70]))]
    pages += [dice.choice(pages) for _ in range(dice.choice([0, 3]))]
    assert H.main_texts([H.blocks(p) for p in pages]) == naive(pages)


def test_hosts_of_pieces_agree_with_brute_force(spark):
    """Hosts of one group and of many pieces, with and without open pages: the same rule as over the whole host at once."""
    dice, rows, want = random.Random(1), [], {}
    for h, (n, opened) in enumerate([(5, True), (200, True), (700, True), (900, False)]):
        words = [f"h{h}w{i}" for i in range(5000)]
        shapes = [" ".join(dice.choice(words) for _ in range(k)) for k in (3, 9, 12, 25, 40)]
        pages = [page_of(dice, words, shapes) for _ in range(n)]
        if not opened:
            pages = [f"<article><p>{shapes[3]}</p><h2>{shapes[0]}</h2>{p}</article>" for p in pages]
        want |= {1000 * h + i: t for i, t in enumerate(naive(pages))}
        rows += [(1000 * h + i, f"http://h{h}.example/{i}", p) for i, p in enumerate(pages)]
    got = {r.page_id: r for r in H.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert sum(r.n_by_recurrence for r in got.values()) > 500 and sum(r.n_by_markup for r in got.values()) > 500
    assert all(r.n_blocks >= r.n_by_markup + r.n_by_recurrence for r in got.values())
    alone = {r.page_id: r.text for r in H.extract(spark.createDataFrame([r for r in rows if "h2." in r[1]], SCHEMA)).collect()}
    assert all(want[k] == t for k, t in alone.items())  # other hosts do not matter


@pytest.mark.parametrize("copies", [1, 2, 5, 19, 20, 400])
def test_copied_articles_stay_whole(spark, copies):
    article = "A title\n" + "\n".join(" ".join(f"p{i}w{j}" for j in range(30)) for i in range(4))
    marked = "<article><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p><p>{}</p></article>".format(*article.split("\n"))
    for form in (marked, marked.replace("article", "div")):
        others = [f"<nav>menu</nav>{form.replace('w', f'x{i}y').replace('A title', f'Title {i}')}" for i in range(3)]
        rows = [(i, "http://h.example/", p) for i, p in enumerate([f"<nav>menu</nav>{form}"] * copies + others)]
        got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert all(got[i] == article for i in range(copies))


def test_a_paragraph_that_stories_share_stays_in_their_articles():
    common = "this paragraph on the rules of the contest stands in every one of the stories of this host"
    pages = [f"<article><h1>Story {i}</h1><p>{common}</p><p>" + " ".join(f"s{i}w{j}" for j in range(40)) + "</p></article>" for i in range(25)]
    assert all(common in t for t in H.main_texts([H.blocks(p) for p in pages]))


def test_pages_give_the_same_text_without_article_classes_and_roles():
    """Markup as a prior only: with it taken away, recurrence on the host finds the same furniture."""
    dice = random.Random(4)
    words = lambda n: " ".join(f"w{dice.randrange(10**6)}" for _ in range(n))
    menu, side, ad, foot = [words(2) for _ in range(6)], words(20), words(9), words(15)
    items = "".join(f"<li><a href='/x'>{m}</a></li>" for m in menu)
    rich, plain = [], []
    for i in range(30):
        body = f"<h1>{words(6)}</h1><p>{words(40)}</p><p>{words(3)}</p><p>{words(60)} {ad}</p>"
        rich.append(f"<body><nav><ul>{items}</ul></nav><div class='ad'>{ad}</div><article>{body}</article><aside id='sidebar'>{side}</aside><div role='contentinfo'>{foot}</div></body>")
        plain.append(f"<body><div><ul>{items}</ul></div><div>{ad}</div><div>{body}</div><div>{side}</div><div>{foot}</div></body>")
    a, b = H.main_texts([H.blocks(p) for p in rich]), H.main_texts([H.blocks(p) for p in plain])
    assert a == b and all(len(t.split()) == 118 for t in a)


def test_names_alone_do_not_take_all_of_a_page():
    text = " ".join(f"w{j}" for j in range(30))
    assert H.main_texts([H.blocks(f"<div class='share-price'><p>{text}</p></div><nav>menu</nav>")]) == [text]
    assert H.main_texts([H.blocks(f"<div class='ad'>{text}</div><p>main</p>")]) == ["main"]


@pytest.mark.parametrize(
    "page",
    ['<p title="' * 200_000, "<a " * 300_000, "<b>" * 200_000 + "</i>" * 200_000, "<b>" * 100_000 + "<div></div>" * 100_000, '<p title="' * 200_000 + '>"', "<li>" * 200_000, "<p " + "='" * 300_000 + ">", "<!--" * 300_000, "<script>" * 100_000, "<p " + "a" * 1_000_000 + ">x"],
)
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    H.main_texts([H.blocks(page)])
    assert time.process_time() - began < 8


def test_scanner_on_odd_markup():
    text = lambda p: [t for _, t in H.blocks(p)]
    assert text("<p title=it's>a</p> b's <p>c") == ["a", "b's", "c"]
    assert text('a <p title="x') == ['a <p title="x'] and text('a <p title="x>b') == ["a", "b"]
    assert text("<![CDATA[x]]>y<?php z ?>w<!doctype html>v") == ["ywv"]
    assert text("<SCRIPT>x</p></ScRiPt>y<textarea>q") == ["y"]
    assert text("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert text("1 < 2 <3 </ 4> &lt;p&gt;") == ["1 < 2 <3 </ 4> <p>"]
