"""Frequent words and pairs of words, and directions of texts: against counting everything in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtab.operators import features, terms
from loomtab.plans import panels

ODD = ["", " ", "a", "a b c", "ab", "Ab,aB;AB", "\x00x\x00yz\x7f", "naïve café — “quoted”…", "ÄÖÜ straße", "İstanbul", "日本語 文章 です", "x_1 _y __", "𝐀 𝐀𝐁 end", "ét́ résume", "½ ⅷ² ٣٤", "👍🏽 ok", "tab\tnew\nline\r nbsp sep", "ΣΑΣ σας", "don't re-do", "end"]


def words_of(text):
    return [w for w in re.split(r"\W+", (text or "").lower()) if len(w) >= 2]


def brute_terms(rows, most):
    n, df = Counter(), Counter()
    for _, text in rows:
        w = words_of(text)
        each = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        n.update(each)
        df.update(set(each))
    return sorted(((t, n[t], df[t]) for t in n if df[t] >= 2), key=lambda t: (-t[1], t[0]))[:most]


def texts_of(kind):
    dice = random.Random(kind)
    if kind == "odd":
        return [*enumerate([None, *ODD, *ODD[5:]])]
    if kind == "flat":  # every word about as frequent as any other
        return [(i, " ".join(f"w{dice.randrange(300)}" for _ in range(20))) for i in range(120)]
    if kind == "twice":  # texts that stand there twice, of words that stand nowhere else
        return [(i, " ".join(f"v{i // 2}{c}" for c in "abcdefgh")) for i in range(80)]
    if kind == "hidden":  # a word that is rare in any text; one that is frequent in one text alone; a pair as frequent as its words
        return [(i, "new york " * (i % 3) + "rare " + " ".join(f"n{i}x{j}" for j in range(30)) + (" solo" * 500 if i == 7 else "")) for i in range(90)]
    return [(i, " ".join(f"w{int(dice.paretovariate(0.7))}" for _ in range(dice.randint(0, 60)))) for i in range(150)]


def test_split_words_are_text_words(spark):
    df = spark.createDataFrame([*enumerate(ODD)], "i int, t string")
    want = {r.i: r.w for r in df.select("i", features.text_words("t").alias("w")).collect()}
    low = pa.array([r.t for r in df.select(F.lower("t").alias("t"), "i").orderBy("i").collect()], pa.string())
    for texts, first in ((low, 0), (low.slice(3, 9), 3), (low.slice(0, 0), 0), (low.slice(0, 1), 0)):
        words, rows = terms.split_words(texts)
        got = {i: [] for i in range(first, first + len(texts))}
        for w, r in zip(words.to_pylist(), rows):
            got[first + r].append(w)
        assert got == {i: want[i] for i in got}


@pytest.mark.parametrize("kind", ["odd", "flat", "twice", "hidden", "zipf"])
@pytest.mark.parametrize("share, most", [(None, None), (10, None), (10**9, None), (None, 3), (2, 0)])
def test_top_terms_are_those_of_counting_all(spark, kind, share, most):
    """By bounds, by counting all words, and by counting all words and pairs; equal counts go by name."""
    rows = texts_of(kind)
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(5)
    for k in (1, 7, 40):
        words, floor = terms.frequent_words(df, "text", k, share, most)
        top, total = terms.top_terms(terms.row_terms(df, "text", "row_id", words), words, k, floor)
        assert [(t, n, d) for t, _, n, d in top] == brute_terms(rows, k) and total == len(rows)


def test_rare_words_do_not_leave_tasks(spark):
    """Of 60,000 words that occur once and their pairs none is sent on; the frequent ones are found by their bounds."""
    rows = [(i, " ".join(f"{w} x{i}y{j}" for j, w in enumerate(["the", "of", "and"] * 200))) for i in range(100)]
    df = spark.createDataFrame(rows, "row_id long, text string").coalesce(2)
    assert terms.piece_counts(df, "text", 1000).count() < 20
    assert sorted(terms.frequent_words(df, "text", 3)[0]) == ["and", "of", "the"]


@pytest.mark.parametrize("kind", ["odd", "hidden", "zipf"])
def test_text_svd_against_numpy_reads_texts_twice(spark, kind):
    rows, k = texts_of(kind), 3
    reads = spark.sparkContext.accumulator(0)

    def seen(text):
        reads.add(1)
        return text

    df = spark.createDataFrame(rows, "row_id long, text string").repartition(3).withColumn("text", F.udf(seen)("text"))
    got = {r.row_id: r for r in features.text_svd(df, "text", "row_id", 25, k).collect()}
    assert reads.value <= 2 * len(rows)
    top = sorted(brute_terms(rows, 25))
    place, idf = {t[0]: i for i, t in enumerate(top)}, np.array([math.log((1 + len(rows)) / (1 + t[2])) + 1 for t in top])
    x = np.zeros((len(rows), len(top)))
    for i, text in rows:
        w = words_of(text)
        for t, n in Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]).items():
            if t in place:
                x[i, place[t]] = (1 + math.log(n)) * idf[place[t]]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    v = np.linalg.svd(x)[2][:k].T
    found = np.array([[got[i][f"svd{j:02d}"] for j in range(k)] for i in range(len(rows))])
    assert np.allclose(found @ found.T, (x @ v) @ (x @ v).T, atol=1e-8)  # the same up to signs


def test_text_svd_of_few_and_no_terms(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "one"), (3, None)], "__x long, n string")
    got = {r["__x"]: [abs(r[f"svd{j:02d}"]) for j in range(4)] for r in features.text_svd(df, "n", "__x", 10, 4).collect()}
    assert np.allclose([got[i] for i in (1, 2, 3)], [[1, 0, 0, 0], [1, 0, 0, 0], [0, 0, 0, 0]])
    assert features.text_svd(df.filter("n IS NULL"), "n", "__x", 10, 2).first().asDict() == {"__x": 3, "svd00": 0.0, "svd01": 0.0}
    assert features.text_svd(df.limit(0), "n", "__x", 10, 2).count() == 0


def test_texts_of_the_panel(spark, tmp_path):
    """The rows of the joined panel; texts are not shuffled where no document has two labels."""
    spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", "s", 1), (None, "c", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    for labels in ([(1, 1), (None, 0)], [(1, 1), (1, 0), (9, 1), (9, 1)], [(None, 1), (None, 1), (2, 0)]):
        spark.createDataFrame(labels, "doc_id long, quality int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        got = panels.texts(spark, str(tmp_path))
        order = lambda df: sorted((r.row_id or 0, r.text) for r in df.collect())
        assert order(got) == order(panels.quality(spark, str(tmp_path)))
        if labels[1] == (None, 0):
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
