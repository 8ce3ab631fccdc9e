"""Language identification and quality against plain brute force, and where they give up."""

import itertools
import math
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from loomtab.llm import common, language_id, quality_crf

from .test_llm_spark import SF


@pytest.fixture(scope="module")
def docs(spark):
    return common.tables(spark, SF.replace("0.001", "0.01"), "documents").cache()


def plain_letters(text):
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text or "")
    return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in low).split()


def test_languages_agree_with_plain_compression(spark, docs):
    model = language_id.fit(docs.filter(~language_id.held_out()).select("doc_id", "text", "lang"))
    assert all(len(d) <= language_id.DICT_BYTES for _, d in model)
    rows = docs.filter("doc_id % 7 = 0").select("doc_id", "text")
    got = {r.doc_id: r for r in language_id.classify(rows, model).collect()}
    for key, text in ((r.doc_id, r.text) for r in rows.collect()):
        data, sizes = " ".join(plain_letters(text)).encode(), {}
        for lang, words in model if data else ():
            plain = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = sum(len(plain.compress(data[a : a + language_id.SEGMENT])) for a in range(0, len(data), language_id.SEGMENT))
        best = min(sizes, key=sizes.get, default="und")
        assert got[key].lang_pred == best
        if sizes:
            second = sorted(sizes.values())[1]
            assert got[key].margin == pytest.approx(8 * (second - sizes[best]) / len(data.decode().replace(" ", "")))
            assert got[key].rejected == (got[key].margin < language_id.MARGIN)


def test_texts_of_a_language_that_was_not_learned_are_mostly_rejected(docs):
    shares = {}
    for out in ("fr", "de"):
        model = language_id.fit(docs.filter(~language_id.held_out()).filter(F.col("lang") != out).select("doc_id", "text", "lang"))
        for own, rows in ((True, docs.filter(F.col("lang") == out)), (False, docs.filter(F.col("lang") != out).filter(language_id.held_out()))):
            shares[out, own] = language_id.classify(rows.select("text"), model).agg(F.avg(F.col("rejected").cast("double"))).first()[0]
    assert shares["fr", True] > 0.03 and shares["de", True] > 0.7
    assert shares["fr", False] < 0.03 and shares["de", False] < 0.03


def test_any_number_of_languages_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(language_id, "ALL_BYTES", 300 * 400)
    rows = [(i, f"word{i} of language{chr(97 + i % 26)} " * 20, f"l{i % 300}", 1, 2) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, MARGIN int")
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    assert len(model) == 300 and all(0 < len(d) <= 400 for _, d in model)
    got = language_id.classify(docs.limit(5), model[:4])
    assert got.columns[:5] == docs.columns and [c.lstrip("_") for c in got.columns[5:]] == [f"language_{n}" for n in language_id.NEW]
    assert got.count() == 5 and got.select("score").first()[0] == 1
    assert language_id.keep_identified(docs.limit(0)).columns == docs.columns and language_id.keep_identified(docs.limit(0)).count() == 0


def test_quality_scores_agree_with_sums_over_all_labellings(spark):
    dice = np.random.default_rng(3)
    lines = ["A good plain line of words.", "BUY NOW!!! $$$", "||| 12 | 34", "", "Some more text, that reads well.", "x"]
    texts = ["\n".join(dice.choice(lines, dice.integers(1, 7))) for _ in range(60)] + ["", None, "\n\n"]
    labels = np.array([int((t or "").count("!") < 3) for t in texts])
    own, size, counts = quality_crf.line_features(common.texts(pa.array(texts)))
    field = quality_crf.calibrate(quality_crf.train(own, counts, labels, steps=15), dice.normal(size=len(texts)), labels)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality_crf.score(rows, field).collect()}
    at = 0
    for i, n in enumerate(counts):
        # Features of one document at a time: neighbours never come from another.
        alone, alone_size, _ = quality_crf.line_features(common.texts(pa.array([texts[i]])))
        x = (alone - field.mean) / field.spread
        wide = [np.concatenate([x[t], x[t - 1] if t else 0 * x[t], x[t + 1] if t + 1 < n else 0 * x[t], [float(t == 0), float(t + 1 == n), 1.0]]) for t in range(n)]
        odds = np.array(wide, np.float32) @ field.weights
        total, good = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(o * s for o, s in zip(odds, path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:])))
            total, good = total + w, good + w * np.array(path)
        weight = np.maximum(alone_size, 1)
        p = min(max(float((good / total * weight).sum() / weight.sum()), 1e-4), 1 - 1e-4)
        want = 1 / (1 + math.exp(-(field.slope * math.log(p / (1 - p)) + field.shift)))
        assert got[i] == pytest.approx(want, abs=1e-4), texts[i]
        at += n


def test_classes_of_bytes_are_counted_alike_in_slices(monkeypatch):
    texts = pa.array(["ab\n" + "é1!" * 50, "", "x" * 99 + "\n\n" + "Y." * 40])
    whole = quality_crf.line_features(texts)
    for n in (1, 7, 64):
        monkeypatch.setattr(quality_crf, "SLICE", n)
        assert all((a == b).all() for a, b in zip(quality_crf.line_features(texts), whole))


def test_quality_learns_one_text_of_repeated_doc_ids(spark, monkeypatch):
    monkeypatch.setattr(quality_crf, "FIT_DOCS", 4)
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, re.sub("x", str(j), "x text here.")) for i in ids for j in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    got = quality_crf.report(docs, labels).collect()
    assert len(got) == 30 * len(ids) and all(0 <= r.score <= 1 for r in got)
