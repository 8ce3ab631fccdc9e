"""Language identification by compression.

Each language has one zstandard raw-content dictionary: 64 KB of pieces of labelled texts. A text is reduced to its
lower-case letters, cut into segments, and every segment is compressed with every dictionary; the language whose
dictionary gives the fewest bytes in all is chosen. Segments keep a long text from becoming its own dictionary.
A text is rejected when the runner-up needs less than `margin` more bits for each letter of the text. On the test tables
texts of a learned language have 0.2 and more (99 of 100; the rest are mostly of a few words and tie), texts of a language that
was left out have less than 0.05 where no learned one resembles it (80 of 100 German ones, but 8 of 100 French ones).

The dictionaries are fitted on a bounded sample (FIT_PIECES pieces of at most PIECE_CHARS characters a language, from
texts picked by a hash of their ids; ALL_BYTES bounds the dictionaries of all languages together, however many there are);
all texts are classified whole.

Null text, or text without a letter, is `und` with score 0 and rejected. Ties go to the language with more labelled
texts, then to the first by name. Labels that are null teach nothing. An empty table gives an empty result; with rows
but no labelled text, every row is `und`. Rows are classified one by one: repeated rows, equal and null doc_ids alike. A
text is classified whole, segment by segment, in some 4 bytes for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

DICT_BYTES = 65_536
PIECE_CHARS = 600
FIT_PIECES = 160
#: Bytes of all dictionaries together: with more than a thousand languages each has less than DICT_BYTES.
ALL_BYTES = 64 << 20
SEGMENT = 1000
LEVEL = 6
#: Bits for each letter.
MARGIN = 0.05
UNDETERMINED = "und"


def letters(text: pa.Array) -> pa.Array:
    """Lower-case letters, every run of anything else as one space."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(text), r"[^\p{L}]+", " "), " ")


def fit(labelled: DataFrame, seed: int = 5) -> list[tuple[str, bytes]]:
    """Dictionaries by language, those with more labelled texts first. labelled: (doc_id, text, lang)."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a line for each language
    size = min(DICT_BYTES, ALL_BYTES // max(1, len(counts)))
    pieces_each = min(FIT_PIECES, -(-FIT_PIECES * size // DICT_BYTES))
    counts = F.broadcast(rows.sparkSession.createDataFrame(counts, "lang string, n long"))
    luck = F.xxhash64(F.lit(seed), "doc_id")
    # A hash threshold leaves a few hundred rows of each language, however many there are; then the first FIT_PIECES.
    share = F.pmod("luck", F.lit(1 << 30)) * F.col("n") < F.lit(4.0 * pieces_each * (1 << 30))
    start = F.pmod("luck", F.greatest(F.length("text") - PIECE_CHARS, F.lit(1))) + 1
    few = rows.withColumn("luck", luck).join(counts, "lang").filter(share).select("doc_id", "lang", "n", "luck", F.substr("text", start.cast("int"), F.lit(PIECE_CHARS)).alias("piece"))
    ranked = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("luck", "doc_id", "piece"))).filter(F.col("nth") <= pieces_each)
    found = ranked.orderBy(F.desc("n"), "lang", "nth").select("lang", "piece").collect()  # some 1.5 * ALL_BYTES at most
    pieces: dict[str, list[str]] = {}
    for r in found:
        pieces.setdefault(r.lang, []).append(r.piece)
    return [(lang, " ".join(letters(pa.array(p)).to_pylist()).encode()[:size]) for lang, p in pieces.items()]


class Classifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        import zstandard

        self.languages = [lang for lang, _ in dictionaries]
        self.compress = []
        for _, data in dictionaries:
            d = zstandard.ZstdCompressionDict(data or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        """Compressed bytes by language."""
        parts = [text] if len(text) <= SEGMENT else [text[a : a + SEGMENT] for a in range(0, len(text), SEGMENT)]
        return [sum(len(c(p)) for p in parts) for c in self.compress]

    def classify(self, text: bytes) -> tuple[str, float, float]:
        """Language, score and margin (bits a letter) of a text reduced to letters; the score is the share of 2 ** -bytes."""
        if not text or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        size = self.sizes(text)
        best = min(size)
        rest = sorted(size)[1] if len(size) > 1 else best * 2
        letters = len(text.decode()) - text.count(b" ")
        return self.languages[size.index(best)], 1 / sum(2.0 ** -min(s - best, 60) for s in size), 8 * (rest - best) / letters


def _refused(language: str, score: float, gap: float, margin: float) -> bool:
    return language == UNDETERMINED or gap < margin


NEW = ("lang_pred", "score", "margin", "rejected")


def classify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred, score, margin and rejected at the end. Where docs has a column of one of these names, all four
    take a prefix that no column of docs has: common.free_name(docs, "language_")."""
    names = docs.columns
    prefix = common.free_name(docs, "language_") if {c.lower() for c in names} & set(NEW) else ""
    own = [prefix + c for c in NEW]
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                got = [classifier.classify(t.encode()) for t in letters(common.texts(piece.column(at))).to_pylist()]
                lang, score, gap = (list(x) for x in zip(*got, strict=True)) if got else ([], [], [])
                refused = [_refused(*x, margin) for x in got]
                new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array(refused, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *new], [*piece.schema.names, *own])

    extra = [T.StructField(n, t) for n, t in zip(own, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()), strict=True)]
    return docs.transform(common.map_batches, run, T.StructType([*docs.schema.fields, *extra]))


def held_out(column: str = "doc_id") -> Column:
    return common.crc_mod(column, 3) == 1


def report(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, margin, rejected; learns from rows that are not held out."""
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    out = classify(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, margin)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def keep_identified(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """docs without the rejected ones; columns are those of docs."""
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                keep = [not _refused(*classifier.classify(t.encode()), margin) for t in letters(common.texts(piece.column(at))).to_pylist()]
                yield piece.filter(pa.array(keep, pa.bool_()))

    return docs.transform(common.map_batches, run, docs.schema)
