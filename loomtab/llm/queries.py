"""The registered queries of the corpus operators, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, common, decontaminate, exact_dedup, html_extract, language_id, mixing, near_dedup, ngram_lm, prefix_trie, quality_crf, ranked_search, token_counts, token_output


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_output.write_tokens(common.tables(spark, sf_dir, "documents"), _path("word_bpe_49k.json"), end_id=1)
    return token_output.digest_tokens(manifest)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(common.tables(spark, sf_dir, "documents"), common.tables(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(common.tables(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.report(common.tables(spark, sf_dir, "documents"), common.tables(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(common.tables(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(common.tables(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.prefix_counts(common.tables(spark, sf_dir, "documents"), _path("piece_bpe_32k.model")).drop("prefix_table")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.report(common.tables(spark, sf_dir, "documents"), order=3)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(common.tables(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(common.tables(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(common.tables(spark, sf_dir, "documents"), common.tables(spark, sf_dir, "benchmark"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.report(common.tables(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(common.tables(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_near_dedup": op9_near_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_ranked_search": op11_ranked_search,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Word and space classes as DuckDB's regular expressions write them.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i, w FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win FROM items),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, s.n, unnest(generate_series(1, len(w) - s.n + 1)) AS i, w FROM d, sizes s WHERE len(w) >= s.n),
found AS (
  SELECT doc_id, i, s.n, item_id FROM (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win FROM spots) s JOIN windows v ON v.n = s.n AND v.win = s.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op6_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op9_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS sh FROM i),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS content FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id AND r.root < u.b),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1),
k AS (SELECT content, count(*) AS class_size FROM n GROUP BY 1)
SELECT m.doc_id, coalesce(n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept, coalesce(class_size, 1) AS class_size
FROM m LEFT JOIN n ON n.doc_id = m.doc_id LEFT JOIN k USING (content)""",
    "op11_ranked_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT u, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM k),
i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT DISTINCT q, item_id, t FROM (SELECT q, item_id, unnest(w) AS t FROM i)),
o AS (
  SELECT u, t, count(*) AS tf FROM (SELECT u, unnest(w) AS t FROM k) WHERE t IN (SELECT t FROM it) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS wt FROM (SELECT t, count(*) AS df FROM o GROUP BY 1), s),
c AS (SELECT u, doc_id, 10 + (90 * n * nd) // nt AS m FROM k, s),
p AS (SELECT o.u, doc_id, o.t, wt * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS x FROM o JOIN c ON c.u = o.u JOIN f ON f.t = o.t),
r AS (SELECT q, item_id, u, doc_id, CAST(sum(x) AS BIGINT) AS score FROM it JOIN p ON p.t = it.t GROUP BY ALL),
g AS (SELECT q, item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM g WHERE rank <= 10""",
    "op13_prefix_trie": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS own FROM t GROUP BY 1),
c AS (  -- crc32 of the decimal conv_id, bit by bit
  SELECT conv_id, own, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
    lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, u: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h FROM o),
b AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(p.own, 1, h), []), list_slice(c.own, h + 1, len(c.own))) AS seq
  FROM c LEFT JOIN o p ON p.conv_id = c.base),
e AS (SELECT conv_id, seq, unnest(generate_series(0, len(seq))) AS depth FROM b),
n AS (
  SELECT list_slice(seq, 1, depth) AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CASE WHEN len(seq) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM e GROUP BY 1, 2),
u AS (SELECT list_slice(k, 1, depth - 1) AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.k[depth].x) ELSE 0 END AS own_saved
  FROM n LEFT JOIN u ON u.k = n.k),
a AS (
  SELECT list_slice(k, 1, d) AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(own_saved) AS saved_tokens
  FROM (SELECT k, n_children, own_saved, unnest(generate_series(0, depth)) AS d FROM f) GROUP BY 1)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN a ON a.k = f.k LEFT JOIN f p ON f.depth > 0 AND p.k = list_slice(f.k, 1, f.depth - 1)""",
}
