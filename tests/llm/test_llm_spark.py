"""The corpus operators on Spark: whole results against brute force, and the hard cases of every operator."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.llm import common, decontaminate, exact_dedup, html_extract, language_id, mixing, near_dedup, ngram_lm, quality_crf, queries, token_counts, token_output

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, size string, label string, row string, n_words string"
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER, MODEL = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns with the operators' own names."""
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    texts = [None, "", " \n\t ", "One two.", "one  two.", long_text, long_text, "a b c d e f g h i j k l m", "a b c d e f g h i j k l m", "été ñandú 日本 <|endoftext|>", "x" * 50_000, "12 34 !!"]
    rows = [(i, t, ["en", "de", None][i % 3], [None, "s1", "s2", ""][i % 4], len(t or ""), "u", "z", "l", "r", "n") for i, t in enumerate(texts)]
    rows += [rows[7], (None, "null id text", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.tables(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def test_token_files_hold_the_library_ids(spark, docs, texts):
    from tokenizers import Tokenizer

    library, at = Tokenizer.from_file(TOKENIZER), 0
    got = {r.doc_id: r for r in token_output.digest_tokens(token_output.write_tokens(docs, TOKENIZER, shard_ids=20_000)).collect()}
    for key in sorted(texts):
        ids = library.encode(texts[key], add_special_tokens=False).ids + [1]
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_of_hard_rows(hard, empty):
    manifest = token_output.write_tokens(hard, TOKENIZER)
    rows = token_output.read_tokens(manifest).collect()
    assert len(rows) == 14 and sum(r.doc_id is None for r in rows) == 1
    assert [r.n_tokens for r in rows if r.doc_id == 0] == [1] and all(len(r.ids) == r.n_tokens and r.ids[-1] == 1 for r in rows)
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert token_output.digest_tokens(token_output.write_tokens(empty, TOKENIZER)).count() == 0


def test_token_counts(docs, texts, hard, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in token_counts.prefix_counts(docs, MODEL).collect():
        assert (r.n_tokens, r.n_bytes) == (len(library.encode(texts[r.doc_id])), len(texts[r.doc_id].encode()))
    rows = token_counts.prefix_counts(hard, MODEL, limit=10).collect()
    assert len(rows) == 14 and {(r.n_tokens, r.n_bytes) for r in rows if r.doc_id in (0, 1)} == {(0, 0)}
    assert all((token_counts.prefix_count(r.prefix_table, r.within_limit) <= 10) and r.over_limit == (r.n_tokens > 10) for r in rows)
    assert token_counts.prefix_counts(empty, MODEL).count() == 0


def test_decontamination_of_hard_rows_and_several_blocks(spark, hard, empty):
    bench = spark.createDataFrame([(1, "A b c d e f g h i j"), (2, "one TWO"), (3, None), (4, "..."), (5, "a b c d e f g h i j")], "item_id long, text string")
    one = {(r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.report(hard, bench).collect()}
    digest = decontaminate.item_digest
    assert {(7, 10, 2, digest(["1", "5"])), (3, 2, 1, digest(["2"])), (0, 0, 0, digest([])), (None, 0, 0, digest([]))} <= one
    many = decontaminate.find_hits(hard.select("doc_id", "text"), bench, block_words=3)
    assert {(r.doc_id, tuple(r.items)) for r in many.collect()} == {(r.doc_id, tuple(r.items)) for r in decontaminate.find_hits(hard.select("doc_id", "text"), bench).collect()}
    assert decontaminate.report(empty, bench).count() == 0 and decontaminate.report(hard, bench.limit(0)).filter("contaminated").count() == 0
    clean = decontaminate.clean(hard, bench, max_span=50, max_coverage=0.9)
    assert clean.columns == hard.columns and clean.count() == 12  # "one two" is covered whole: documents 3 and 4 go
    assert {r.text for r in clean.filter("doc_id = 7").collect()} == {" k l m"}


def test_language_id(spark, docs, hard, empty):
    got = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    rows = {r.doc_id: r for r in language_id.report(hard).collect()}
    assert len(rows) == 13 and rows[0].lang_pred == rows[2].lang_pred == rows[11].lang_pred == "und" and rows[3].lang_pred in ("en", "de")
    assert language_id.report(empty).count() == 0
    assert language_id.report(hard.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred = 'und'").count() == 14
    assert language_id.keep_identified(hard).columns == hard.columns


def test_quality(spark, docs, hard, empty):
    labels = common.tables(spark, SF, "labels")
    got = quality_crf.report(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)
    some = spark.createDataFrame([(3, 1, 0), (5, None, 0), (None, 1, 0), (7, 0, 1), (7, 0, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_crf.report(hard, some).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.score for r in quality_crf.report(hard, some.limit(0)).collect()} == {0.5}
    assert quality_crf.report(empty, some).count() == 0


def test_mixing(spark, docs, hard, empty):
    rows = mixing.report(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        by[r.source].append(r)
    total = sum(r.size for r in rows)
    weights = dict(zip(sorted(by), itertools.cycle((5.0, 2.0, 1.0))))
    cap, target, free = {s: 3.0 * sum(r.size for r in g) for s, g in by.items()}, {}, set(by)
    while True:  # share, cap, share the rest again
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap[s]}
        if not over:
            target |= share
            break
        target |= {s: cap[s] for s in over}
        free -= over
    for s, g in by.items():
        assert g[0].target == pytest.approx(target[s]) and g[0].source_size * 3 == cap[s]
        spare = [r.size for r in g if r.size and r.taken == r.size * (target[s] * 3 // cap[s])]  # could be taken once more
        assert abs(sum(r.taken for r in g) - target[s]) <= max(0.05 * target[s], min(spare, default=0))
    again = {r.doc_id: (r.taken, tuple(r.shards)) for r in mixing.report(docs.repartition(7)).collect()}
    assert again == {r.doc_id: (r.taken, tuple(r.shards)) for r in rows}
    got = mixing.report(hard).collect()
    assert len(got) == 14 and all(r.taken == 0 for r in got if r.size == 0) and mixing.report(empty).count() == 0
    mixed = mixing.mix(hard)
    assert mixed.columns == hard.columns and mixed.count() == sum(r.taken // r.size for r in got if r.size)
    assert mixing.report(hard.filter("text IS NULL")).first().taken == 0


def test_mixing_goes_on_past_a_document_that_does_not_fit(spark):
    """One document is longer than its source's target: the others fill it, spread over the source's blocks."""
    rows = [(i, "a", "w " * 100) for i in range(100)] + [(1000 + i, "b", "w " * 10) for i in range(1000)] + [(5000, "b", "w " * 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("uid", F.col("doc_id")).cache()
    for seed in (1, 2, 3):
        documents, draws = mixing.plan(docs, weights=(4.0, 1.0), seed=seed, block_words=500)
        words = draws.join(documents.select("uid", "source", "size", "target"), "uid").groupBy("source", "block").agg(F.sum("size").alias("n"), F.first("target").alias("target")).collect()
        for source in "ab":
            assert abs(sum(r.n for r in words if r.source == source) - next(r.target for r in words if r.source == source)) <= 50
        assert max(r.n for r in words) <= 1000 and sum(r.source == "b" for r in words) == 12


def test_exact_dedup(spark, docs, texts, hard, empty):
    form = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in texts.items()}
    groups = collections.defaultdict(list)
    for k, t in form.items():
        groups[t].append(k)
    for counters in (1024, 2):
        for r in exact_dedup.dedup(docs, counters).collect():
            g = groups[form[r.doc_id]]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (min(g), len(g), r.doc_id == min(g), hashlib.sha256(form[r.doc_id].encode()).hexdigest())
    rows = exact_dedup.dedup(hard).collect()
    assert len(rows) == 14 and sum(r.kept for r in rows) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in hard.collect()})
    assert sum(r.kept for r in rows if r.doc_id == 7) == 1  # a repeated row stays once
    assert exact_dedup.dedup(empty).count() == 0


def test_misra_gries_finds_all_heavy_values(spark):
    rows = spark.range(20_000, numPartitions=7).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id"))).cast("binary").alias("d"))
    found = {bytes(r.d): r.low for r in exact_dedup.misra_gries(rows, "d", 8).filter(F.col("low") > 20_000 / 8).collect()}
    assert set(found) == {b"hot"} and 6667 - 20_000 / 8 < found[b"hot"] <= 6667


def brute_components(sets, percent=85):
    up = {k: k for k in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = collections.defaultdict(list)
    for k, s in sets.items():
        for g in s:
            where[g].append(k)
    shared = collections.Counter(p for v in where.values() for p in itertools.combinations(sorted(v), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {k: top(k) for k in sets}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_dedup(spark, docs, texts, hard, empty):
    sets = {k: shingles(t) for k, t in texts.items()}
    want = brute_components(sets)
    for r in near_dedup.report(docs).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], r.doc_id == want[r.doc_id])
    rows = near_dedup.report(hard).collect()
    assert len(rows) == 14 and all(r.kept and r.n_shingles == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (4, 6, 8, None)} == {(4, 3), (6, 5), (8, 7), (None, None)}
    assert sum(r.kept for r in rows if r.doc_id == 7) == 1
    assert near_dedup.report(empty).count() == 0
    assert near_dedup.keep_first(hard).columns == hard.columns and near_dedup.keep_first(hard).count() == sum(r.kept for r in rows)


def test_near_dedup_of_a_group_of_edited_copies(spark):
    """Copies of one text with more and more edits: links, chains of links, and many pairs that almost link."""
    import random

    dice = random.Random(8)
    base = [f"w{dice.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(i % 9):
            w[dice.randrange(len(w))] = f"e{dice.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = brute_components({k: shingles(t) for k, t in rows})
    got = {r.doc_id: r.component_id for r in near_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_lm_scoring(spark, docs, texts, hard, empty):
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    words = {k: [*re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t)), None] for k, t in texts.items()}
    one, two = collections.Counter(), collections.defaultdict(collections.Counter)
    for k, w in words.items():
        if not held[k]:
            one.update(w)
            for a, b in zip([None, *w], w):
                two[a][b] += 1
    n, v = sum(one.values()), len(one)
    model = ngram_lm.fit(docs.filter(~ngram_lm.held_out()).select("text"), shard_tokens=2_000)  # several shards, hot contexts
    assert len(model.shards) > 2 and model.hot
    for got in (ngram_lm.report(docs), ngram_lm.score(docs, model)):
        for r in got.collect():
            w = words[r.doc_id]
            p1 = [(one[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
            p = [max(two[a][b] - 0.75, 0) / one[a] + 0.75 * len(two[a]) / one[a] * q if one[a] else q for a, b, q in zip([None, *w], w, p1)]
            assert (r.n_tokens, r.n_known) == (len(w), sum(one[x] > 0 for x in w)) and r.base_score == pytest.approx(sum(map(math.log10, p1)))
            assert r.score == pytest.approx(sum(map(math.log10, p)), abs=1e-3 * len(w))
    successors = ngram_lm.Successors(next(iter(model.shards.values())), model.kinds)
    context = int(successors.contexts.get(np.array([0]))[0])
    assert len(successors.successors(context)) >= 1
    rows = ngram_lm.report(hard).collect()
    assert len(rows) == 14 and all(r.n_tokens == 1 for r in rows if r.doc_id in (0, 1, 2)) and all(np.isfinite(r.score) for r in rows)
    assert ngram_lm.report(empty).count() == 0
    assert ngram_lm.report(hard.filter("doc_id = 0").withColumn("doc_id", F.lit(7).cast("long"))).first().train_tokens in (0, 1)


def test_pages(spark):
    pages, by_id = common.tables(spark, SF, "pages"), {}
    form = lambda t: "\n".join(x for x in (" ".join(line.split()) for line in t.split("\n")) if x)
    known = {form(r.text) for r in common.tables(spark, SF, "documents").select("text").collect()}
    rows = html_extract.extract(pages).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    assert sum(r.text.split("\n", 1)[-1] in known for r in rows) >= 0.99 * len(rows)  # a title, then the document
    by_id = spark.createDataFrame([(1, None, None), (None, "http://h/x", "<p>x"), (2, "http://h/x", ""), (2, "http://h/x", ""), (3, "HTTP://H/y", "<p>" + "long " * 50_000)], "page_id long, url string, html string")
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in html_extract.extract(by_id.withColumn("host", F.lit(1)).withColumn("text", F.lit(2))).collect())
    assert [(a, c) for a, _, c in got] == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 249_999)]
    assert html_extract.extract(by_id.limit(0)).count() == 0


def test_pages_of_a_host_of_several_groups(spark):
    """What recurs is judged on the whole host: runs shared by pages of different groups, notices inside articles."""
    dice = random.Random(3)
    words = lambda n: " ".join(f"w{dice.randrange(10**9)}" for _ in range(n))
    notice, short, twice = words(12), words(3), words(10)
    rows, want = [], {}
    for i in range(600):
        text = words(20)
        also = twice if i in (5, 406) else words(10)
        if i % 2:
            page, want[i] = f"<article><p>{text}</p><p>{also}</p><p>{notice}</p></article><p>{short}</p>", f"{text}\n{also}"
        else:
            page, want[i] = f"<p>{text}</p><p>{also}</p><p>{notice}</p><p>{short}</p>", text if i == 406 else f"{text}\n{also}"
        rows.append((i, f"http://one.example/{i}", page))
    rows += [(1000, "http://two.example/", f"<p>{notice}</p><p>{short}</p>")]
    want[1000] = f"{notice}\n{short}"
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES) == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline_stages(spark, hard):
    import corpus_pipeline as cp

    docs, kept = common.tables(spark, SF, "documents"), {}
    names = docs.columns
    for name, stage in cp.STAGES:
        docs = common.table(stage(spark, docs, SF), name)
        kept[name] = docs.collect()
        assert docs.columns == (names if name != "token_output" else ["doc_id", "start", "n_tokens", "ids_crc32"])
    assert len(kept["language_id"]) >= 0.95 * 200
    want = brute_components({r.doc_id: shingles(r.text) for r in kept["language_id"]}, 80)
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted(k for k, c in want.items() if k == c)
    bench = common.tables(spark, SF, "benchmark")
    clean = spark.createDataFrame(kept["decontamination"])
    assert decontaminate.report(clean, bench).filter("contaminated").count() == 0
    assert len(kept["mixing"]) == len(kept["token_output"])
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in cp.run(spark, SF).collect()) == sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in kept["token_output"])
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, hard, SF).columns == hard.columns
        assert stage(spark, hard.limit(0), SF).count() == 0
    tokens = cp.STAGES[-1][1](spark, hard, SF)
    assert tokens.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and tokens.count() == 14
    assert cp.STAGES[-1][1](spark, hard.limit(0), SF).count() == 0


def test_language_and_mixing_stages_agree_with_brute_force(spark):
    """What the first stage keeps by plain compression, and what mixing takes of each source, on the stages' own inputs."""
    import corpus_pipeline as cp

    docs = common.tables(spark, SF, "documents")
    model = language_id.Classifier(language_id.fit(docs.filter(~language_id.held_out()).select("doc_id", "text", "lang")))
    want = []
    for r in docs.collect():
        data = language_id.letters(common.texts(spark_array([r.text]))).to_pylist()[0].encode()
        sizes = sorted(model.sizes(data)) if data else []
        if sizes and 8 * (sizes[1] - sizes[0]) >= language_id.MARGIN * len(data.decode().replace(" ", "")):
            want.append(r.doc_id)
    kept = common.table(cp.identify_language(spark, docs, SF), "kept")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(want)
    report = {r.doc_id: r for r in mixing.report(kept).collect()}
    got = collections.Counter(r.doc_id for r in cp.mix_sources(spark, kept, SF).select("doc_id").collect())
    assert got == {k: r.taken // r.size for k, r in report.items() if r.size and r.taken}


def spark_array(values):
    import pyarrow as pa

    return pa.array(values, pa.string())
