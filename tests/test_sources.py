"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from loomtab.sources import readers, sinks


def test_tables_by_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,a\n2,b\n")
    (tmp_path / "b.tsv").write_text("x\ty\n1\ta\n")
    (tmp_path / "c.txt").write_text("x;y\n1;a\n")
    assert readers.read_table(spark, str(tmp_path / "a.csv")).count() == 2
    assert readers.read_table(spark, str(tmp_path / "b.tsv")).columns == ["x", "y"]
    assert readers.read_table(spark, str(tmp_path / "c.txt"), sep=";").dtypes[0] == ("x", "int")
    assert readers.read_table(spark, str(tmp_path / "c.txt")).columns == ["x", "y"]  # found by itself
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "d.xyz"))
    found = {r.path.rsplit("/", 1)[1]: r.rows for r in readers.discover(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": 2, "b.tsv": 1, "c.txt": 1}


def test_latin1_fallback_and_empty_files(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("x,y\n1,é\n".encode("latin-1"))
    df, warnings = readers.load_dataset(spark, str(tmp_path / "l.csv"))
    assert df.first().y == "é" and warnings
    (tmp_path / "e.csv").write_text("x,y\n")
    with pytest.raises(ValueError):
        readers.load_dataset(spark, str(tmp_path / "e.csv"))


def test_headers_by_suffix_and_legal_replacement_characters(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("x\ty,z\n1\t2\n")
    (tmp_path / "h.csv").write_text("x,y\n1,\ufffd é\n")
    (tmp_path / "h.txt").write_text("x;y\n1;2\n")
    assert readers.header(spark, str(tmp_path / "h.tsv")) == ["x", "y,z"] and readers.header(spark, str(tmp_path / "h.txt"), ";") == ["x", "y"]
    df, warnings = readers.load_dataset(spark, str(tmp_path / "h.csv"))
    assert df.first().y == "\ufffd é" and not warnings
    assert readers.header(spark, str(tmp_path / "h.txt")) == ["x", "y"]
    (tmp_path / "broken.parquet").write_bytes(b"not a table")
    found = {r.path.rsplit("/", 1)[1]: (r.rows, r.error is None) for r in readers.discover(spark, str(tmp_path)).collect()}
    assert found == {"h.tsv": (1, True), "h.csv": (1, True), "h.txt": (1, True), "broken.parquet": (None, False)}


def test_authored_features_go_by_row_id(spark):
    df = spark.createDataFrame([(1, "some text"), (2, "more")], "row_id int, t string")
    extra = spark.createDataFrame([(2, 0.2), (1, 0.1)], "row_id int, t_svd double")
    out = readers.attach_authored(df, extra, "row_id", {"t": ["t_svd"]})
    assert sorted((r.row_id, r.t_svd) for r in out.collect()) == [(1, 0.1), (2, 0.2)] and "t" not in out.columns
    with pytest.raises(ValueError):
        readers.attach_authored(df, extra.limit(1), "row_id")


def test_round_trips(spark, tmp_path):
    oof = spark.createDataFrame([(1, 0.5, True), (2, 0.7, False)], "row_id int, pred double, scored boolean")
    sinks.write_oof(oof, str(tmp_path / "oof"))
    assert {r.row_id: r.pred for r in spark.read.parquet(str(tmp_path / "oof")).collect()} == {1: 0.5, 2: None}
    folds = spark.createDataFrame([(1, 0), (2, 1)], "row_id int, fold int")
    sinks.write_folds(folds, str(tmp_path / "folds"))
    assert sinks.load_folds(spark, str(tmp_path / "folds"), oof.filter("row_id = 1"), "row_id").count() == 1
    assert sinks.checkpoint_predictions(oof, str(tmp_path / "cp")).agg(F.sum("pred")).first()[0] == pytest.approx(1.2)
    sinks.write_verdicts(oof, str(tmp_path / "v"))
    assert spark.read.json(str(tmp_path / "v")).count() == 2


@pytest.mark.parametrize(
    "text, sep",
    [
        ("a,b\n1,2\n", ","),
        ("a\tb\n1,5\t2\n3,5\t4\n", "\t"),
        ("a;b;c\n1,5;2,5;3\n1;2;3\n", ";"),
        ("a|b\n1;x|2\n", "|"),
        ('a;b\n"x,y,z";1\n"p,q,r";2\n', ";"),
        ('a,b\n"one;two\nthree;four",2\n5,6\n', ","),
        ("name\nsmith, john\n", None),
        ("", None),
        ("\n\n", None),
        ("a;b,c;d\n1;2,5;3\n1;2;3\n", ";"),
    ],
)
def test_separators_are_found(spark, tmp_path, text, sep):
    assert readers.sniff_separator(text.split("\n")) == sep
    if sep:
        (tmp_path / "t.txt").write_text(text)
        assert readers.header(spark, str(tmp_path / "t.txt")) == text.split("\n")[0].split(sep)
