"""Parts of the corpus operators that need no Spark, against brute force."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from loomtab.llm import common, decontaminate, html_extract, language_id, mixing, near_dedup, ngram_lm, quality_crf, token_counts, token_output

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_space_words_are_ascii_white_space_only():
    text = pa.array([" A b\tC\n", "", "x\u00a0y", "a\x1cb\x85c", "\x0b\x0c"])
    words, counts = common.space_words(text)
    assert words.to_pylist() == ["a", "b", "c", "x\u00a0y", "a\x1cb\x85c"] and counts.tolist() == [3, 0, 1, 1, 0]


def test_chunks_keep_rows_and_long_texts_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c"] * 5})
    parts = list(common.chunks(batch, "text", 20))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 20 for p in parts)


# ---- token files


@pytest.mark.parametrize("seed", range(30))
def test_blocks_round_trip(seed):
    dice = np.random.default_rng(seed)
    ids = dice.integers(0, [2, 50, 49_408, 2**32 - 1][seed % 4] + 1, dice.integers(0, 2000)).astype(np.uint32)
    if seed % 3 == 0 and len(ids):
        ids[dice.integers(0, len(ids), len(ids) // 20)] = 2**32 - 1  # outliers go to the exception lists
    cuts = np.sort(dice.integers(0, len(ids) + 1, 5))
    sizes = np.diff(np.concatenate([[0], cuts, [len(ids)]]))
    keys = [None if i == 2 else i * 7 for i in range(len(sizes))]
    shard = token_output.Shard(np.frombuffer(token_output.encode_shard(keys, sizes, ids), np.uint8))
    assert shard.doc_ids == keys and shard.sizes.tolist() == sizes.tolist() and (shard.ids() == ids).all()
    for a, b in dice.integers(0, len(ids) + 1, (10, 2)):
        assert (shard.ids(min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()


def test_word_route_gives_the_library_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), token_output.WordTokens(path)
    bits = ["don't", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y", "İstanbul", "é.", "a.́", "ﬁ½", "日本語", "a_b", "foo--", "!!!", " ", "x y", "12a", "K", "ΑΣ", "a\x1cb", "각", "́a"]
    for seed in range(600):
        dice = random.Random(seed)
        text = "".join(dice.choice(bits + list("abcXYZ .,!?'<|>%$-_\n\t")) for _ in range(dice.randint(0, 12)))
        ids, sizes = ours.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids)], text


def test_word_route_of_every_code_point_before_marks():
    """Letters whose normal form ends in a combining mark, digits, marks and spaces of all scripts, each before ASCII marks."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), token_output.WordTokens(path)
    points = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    for form in ("ब{}!!", "{}a?x{}9.", "{}'"):
        texts = [form.format(*[c] * form.count("{}")) for c in points]
        ids, sizes = ours.encode(pa.array(texts))
        want = library.encode_batch_fast(texts, add_special_tokens=False)
        at = np.concatenate([[0], np.cumsum(sizes)])
        assert [t for t, e, a, b in zip(texts, want, at, at[1:]) if ids[a:b].tolist() != e.ids] == []


def test_remembered_stems_stay_bounded(monkeypatch):
    monkeypatch.setattr(token_output, "KNOWN_STEMS", 50)
    ours = token_output.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(6):
        texts = [f"stem{j} Stem{j}!? {'日本語' * 1000}{j} " for j in range(20 * i, 20 * i + 30)]
        ids, sizes = ours.encode(pa.array(texts))
        got = np.split(ids, np.cumsum(sizes)[:-1])
        assert [g.tolist() for g in got] == [e.ids for e in ours.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert len(ours.known) <= 50 and max(len(w.encode()) for w in ours.known.to_pylist()) <= token_output.STEM_BYTES


# ---- prefix counts


def test_prefix_tables_agree_with_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, ours = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.PrefixCounter(path)
    for seed in range(300):
        dice = random.Random(seed)
        text = "".join(dice.choice(["ing", "tion", "the ", " ", "  ", "<s>", "▁", "é", "日本", "😀", "\n", "x", "<unk>", "aaaa", "\x00", "ﬁ"]) for _ in range(dice.randint(0, 20)))
        (table,), total = ours.tables([text])
        form = library.normalize(text)
        assert total[0] == len(library.encode(text)) and len(table) == len(form), text
        for cut in range(len(text)):
            part = library.normalize(text[:cut])
            if form.startswith(part) and text[:cut].strip():
                assert token_counts.prefix_count(table, len(part)) == len(library.encode(text[:cut])), (text, cut)
        fit = token_counts.longest_within(table, 5)
        assert token_counts.prefix_count(table, fit) <= 5


# ---- decontamination


@pytest.mark.parametrize("seed", range(300))
def test_automaton_finds_what_brute_force_finds(seed):
    dice = random.Random(seed)
    window, letters = dice.randint(1, 4), [b"a", b"b", b"c"][: dice.randint(2, 3)]
    items = [(str(k), [dice.choice(letters) for _ in range(dice.randint(0, 9))]) for k in range(dice.randint(0, 5))]
    text = [dice.choice([*letters, b"z"]) for _ in range(dice.randint(0, 25))]
    hit, found = set(), set()
    for key, item in items:
        for w in [item[j : j + window] for j in range(len(item) - window + 1)] if len(item) >= window else [item] * bool(item):
            for p in range(len(text) - len(w) + 1):
                if text[p : p + len(w)] == w:
                    hit |= set(range(p, p + len(w)))
                    found.add(key)
    spans, items_found = decontaminate.Automaton(items, window).scan(text)
    assert {x for a, b in spans for x in range(a, b)} == hit and items_found == found


def test_words_and_cutting():
    assert decontaminate.words("Hello, THE été_x 3") == [b"hello", b"the", "été".encode(), b"x", b"3"]
    assert decontaminate.words(None) == []
    assert decontaminate.cut_spans("Hello, the BIG dog; été!", [1, 3]) == "Hello,  dog; été!"


# ---- language, quality


def test_classifier_tells_languages_and_gives_up_without_letters():
    c = language_id.Classifier([("en", b"the and of that with this from have " * 40), ("de", b"der die und das nicht mit von auf " * 40)])
    assert c.classify(b"the house and that of this with")[0] == "en" and c.classify(b"und das nicht von der mit")[0] == "de"
    assert c.classify(b"")[0] == "und" and language_id.letters(pa.array(["12 %% !", "Ärger 7x"])).to_pylist() == ["", "ärger x"]
    assert language_id.Classifier([]).classify(b"text") == ("und", 0.0, 0.0)


@pytest.mark.parametrize("seed", range(20))
def test_forward_backward_sums_over_all_paths(seed):
    dice = np.random.default_rng(seed)
    counts = dice.integers(1, 5, 4)
    score, move = dice.normal(size=counts.sum()), dice.normal(size=(2, 2))
    good, moves, log_z = quality_crf.forward_backward(score, move, counts)
    want_moves, at = np.zeros((2, 2)), 0
    for i, n in enumerate(counts):
        total, marginal, local = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(score[at + t] * s for t, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += w
            marginal += w * np.array(path)
            for a, b in zip(path, path[1:]):
                local[a, b] += w
        assert np.allclose(good[at : at + n], marginal / total) and np.isclose(log_z[i], np.log(total))
        want_moves += local / total
        at += n
    assert np.allclose(moves, want_moves)


def test_line_features_of_odd_texts():
    own, size, counts = quality_crf.line_features(pa.array(["", "\n\n", "a\n\nb!", "é" * 5000, "x"]))
    assert counts.tolist() == [1, 1, 2, 1, 1] and np.isfinite(own).all() and size.tolist() == [0, 0, 1, 2, 10000, 1]


# ---- mixing


def test_splits_keep_quotas_and_shard_sizes():
    quota = np.array([5, 0, 17, 301])
    got = mixing._splits(quota, 7, 1, np.arange(7))
    assert (got.sum(0) == quota).all() and got.sum(1).max() - got.sum(1).min() <= 1
    assert (mixing._splits(quota, 7, 1, np.array([3])) == got[3]).all()  # a leaf alone is drawn alike
    big = np.array([3_000_000_000, 2_000_000_000, 7])
    assert (mixing._splits(big, 4, 1, np.arange(4)).sum(0) == big).all()


# ---- language model


def test_elias_fano_search_and_access():
    dice = np.random.default_rng(0)
    for n, bound in [(0, 10), (1, 5), (1000, 10**4), (5000, 10**12), (3000, 3001), (2000, 1 << 62)]:
        values = np.unique(dice.integers(0, bound, n)) if n else np.zeros(0, np.int64)
        coded = ngram_lm.EliasFano.of(values, bound)
        asked, place = np.concatenate([values, dice.integers(0, bound, 300)]), {int(v): i for i, v in enumerate(values)}
        assert coded.find(asked).tolist() == [place.get(int(x), -1) for x in asked]
        assert (coded.get(np.arange(len(values))) == values).all()


def test_packed_integers_round_trip():
    x = np.concatenate([np.random.default_rng(1).integers(0, 1 << 60, 500), [0, 1, 127, 128, 16383, 16384, 1 << 53, (1 << 56) - 1, (1 << 62) - 1]])
    assert (ngram_lm.unpack(ngram_lm.pack(x)) == x).all() and len(ngram_lm.unpack(ngram_lm.pack(x[:0]))) == 0


# ---- near dedup


def test_shingles_of_short_and_long_texts():
    text = pa.array(["", "a b", "A  B", "a b c d e", "a b c d e f", "f a b c d e"])
    hashes, n = near_dedup.shingle_hashes(text)
    assert n.tolist() == [0, 1, 1, 1, 2, 2]
    parts = np.split(hashes, np.cumsum(n)[:-1])
    assert parts[1][0] == parts[2][0] and parts[3][0] == parts[4][0] == parts[5][1] and parts[1][0] != parts[3][0]


def test_signature_agreement_estimates_similarity():
    dice = np.random.default_rng(5)
    a = dice.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], dice.integers(0, 1 << 62, 200).astype(np.uint64)])
    c = near_dedup.Circulant()
    assert abs((c.signature(a) == c.signature(b)).mean() - 800 / 1200) < 0.15


# ---- pages


def test_structure_decides_what_is_main_text():
    page = (
        "<html><head><title>t</title></head><body><header>H</header><nav><ul><li>a<li>b</ul></nav><article><h1>T &amp; x</h1><p><b>one<br>two<p>three&nbsp; four"
        '<div class="ad">AD</div><aside>S</aside><form>f</form><section id="comments"><p>c</p></section><script>if (a</b) "</p>"</script></article><div role="alert">N</div><footer>F</footer>'
    )
    assert [t for k, t in html_extract.blocks(page) if k == html_extract.ARTICLE] == ["T & x", "one two", "three four"]
    assert html_extract.blocks("") == [] and html_extract.blocks("a < b &lt; c") == [(html_extract.OPEN, "a < b < c")]
    assert [t for _, t in html_extract.blocks("<p title='a>b'>x</p><!-- <p>no</p> --><p>y")] == ["x", "y"]


@pytest.mark.parametrize("seed", range(100))
def test_recurring_runs(seed):
    dice = random.Random(seed)
    pages = [[[dice.randint(0, 2) for _ in range(dice.randint(0, 12))] for _ in range(dice.randint(0, 3))] for _ in range(4)]
    run, tokens, ends, page, seen = dice.randint(1, 5), [], [], [], collections.defaultdict(set)
    for i, p in enumerate(pages):
        for b in p:
            for k in range(len(b) - run + 1):
                seen[tuple(b[k : k + run])].add(i)
            tokens, page, ends = tokens + b, page + [i] * len(b), ends + [len(tokens) + len(b)] * len(b)
    want = [max([len(seen[tuple(b[k : k + run])]) for k in range(max(0, x - run + 1), x + 1) if k + run <= len(b)] or [0]) for p in pages for b in p for x in range(len(b))]
    assert html_extract.recurring(np.array(tokens, int), np.array(ends, int), np.array(page, int), run).tolist() == want


def test_boilerplate_goes_by_the_suffix_array_where_no_article_is_marked():
    menu, foot = "home news sport weather travel money food about us today", "all rights reserved by the owner of this site"
    pages = [f"<div>{menu}</div><div>story {i} is told here in words that no other page of the host repeats {i * 7}</div><div>{foot}</div>" for i in range(5)]
    texts = html_extract.main_texts([html_extract.blocks(p) for p in pages])
    assert all(t.startswith(f"story {i}") and "sport" not in t and "rights" not in t for i, t in enumerate(texts))
    copies = html_extract.main_texts([html_extract.blocks("<article><p>the same article stands on every page of this small host</p></article>")] * 5)
    assert all(copies)
