"""A training corpus from raw documents: five stages, each over all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the next docs. All but the last return
the columns of documents; the last returns a row for each document written, read back from the token files.

Every stage takes any rows: null text is the empty text, null and equal doc_ids and repeated rows stand each for itself, an
empty table gives an empty one, texts are worked on whole however long they are, and columns of any other names go through
as they are, also where they bear names that operators use. What a stage does with each case is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomtab.llm import common, decontaminate, language_id, mixing, near_dedup, token_output


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the rest go: texts that are null or without a letter, and those whose two best
    languages are too close, ties included. Rows are judged alone, so repeated ones go or stay together. Learns from docs that
    are not held out by doc_id; without labelled ones all go."""
    return language_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Language ID kept their texts whole, so groups are those of the input.
    Of a group the smallest doc_id stays, null last; of rows with equal doc_ids one row stays. Texts without words link with
    nothing and stay; shorter ones than five words link with their equals. Near is a similarity of 0.8 or more of five-word
    shingles."""
    return near_dedup.keep_first(docs, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark: short ones cut out, documents that are mostly benchmark dropped.
    Texts without a hit, null ones too, stay byte for byte; repeated rows are cut alike; an empty benchmark changes nothing."""
    return decontaminate.clean(docs, common.tables(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents of sources over their target drop out, those of sources under it repeat,
    three times at most. Texts without words, null ones too, are never taken; null source is a source; repeated rows are taken
    each for itself; ties of the random order are broken by doc_id."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; doc_id, start, n_tokens and ids_crc32 of each document, read back from them. Null doc_ids come first; rows
    of equal doc_id, such as copies that mixing made, keep an entry each; a text without tokens is its end id alone."""
    import public_tokenizers

    return token_output.digest_tokens(token_output.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]

#: No SQL states compression classifiers, seeded draws or tokenizers; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
