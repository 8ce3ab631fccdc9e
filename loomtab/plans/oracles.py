"""SQL that states the registered queries' results, written for DuckDB over the same tables."""

from __future__ import annotations

from loomtab.plans.panels import P1, P2, P3, P4


def _rounded(sql: str, **places: int) -> str:
    """The query with columns rounded; + 0.0 makes minus zero zero."""
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {n}) + 0.0 AS {c}' for c, n in places.items())}) FROM ({sql})"


def _hash(key: str, seed: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"


def _missing(table: str, names: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS n FROM {table}" for c in names)
    return f"""SELECT "column", missing, round(missing / n, 4) AS rate, CASE WHEN missing = 0 THEN 'complete' WHEN missing / n < 0.05 THEN 'low' WHEN missing / n < 0.2 THEN 'moderate' WHEN missing / n < 0.5 THEN 'high' ELSE 'critical' END AS severity FROM ({rows})"""


def _numeric(table: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, max({c}) AS max, avg({c}) AS mean, stddev({c}) AS std, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS median,
        quantile_cont({c}, 0.75) AS p75, count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives FROM {table}"""
        for c in names
    )


def _long(table: str, names: list[str], keep: str = "", value: str = "value") -> str:
    return " UNION ALL ".join(f"SELECT {keep} '{c}' AS \"column\", CAST({c} AS VARCHAR) AS {value} FROM {table}" for c in names)


_CAL = """cal AS (SELECT *, CAST(year(ts) AS INTEGER) AS ts__year, CAST(month(ts) AS INTEGER) AS ts__month, CAST(day(ts) AS INTEGER) AS ts__day, CAST(isodow(ts) - 1 AS INTEGER) AS ts__weekday,
  CAST(quarter(ts) AS INTEGER) AS ts__quarter, CAST(week(ts) AS INTEGER) AS ts__week, CAST(hour(ts) AS INTEGER) AS ts__hour FROM p2)"""
_FOLDED = f"f1 AS (SELECT *, CAST({_hash('row_id', 's')} % 5 AS INTEGER) AS fold FROM p1)"
#: Out-of-fold mean by segment and priority; every group has rows outside each fold.
_OOF = f"""{_FOLDED}, oof AS (SELECT a.*, (g.s - h.s) / (g.n - h.n) AS pred FROM f1 a
  JOIN (SELECT segment, priority, sum(y) AS s, count(*) AS n FROM f1 GROUP BY ALL) g USING (segment, priority)
  JOIN (SELECT segment, priority, fold, sum(y) AS s, count(*) AS n FROM f1 GROUP BY ALL) h USING (segment, priority, fold))"""
_SCORED = "sc AS (SELECT row_id, status = 'F' AS pos, status, round(acctbal / 100 + CASE WHEN status = 'F' THEN 20 ELSE 0 END, 0) AS score FROM p1)"
_LABELLED = f"la AS (SELECT row_id, status, CASE WHEN {_hash('row_id', 'p')} % 3 > 0 THEN status ELSE 'O' END AS guess FROM p1)"
_AUC_RUN = """th AS (SELECT score, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM sc WHERE score IS NOT NULL GROUP BY score),
run AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp, sum(p) OVER () AS tot_p, sum(n) OVER () AS tot_n FROM th)"""


def _coverage(t: str, q: str, c: str) -> str:
    return f"""SELECT *, predict_first > train_last AS predict_later, CASE WHEN predict_first > train_last THEN predict_steps ELSE 0 END AS horizon FROM (
  SELECT (SELECT min({c}) FROM {t}) AS train_first, (SELECT max({c}) FROM {t}) AS train_last, (SELECT count(DISTINCT {c}) FROM {t}) AS train_steps,
  (SELECT min({c}) FROM {q}) AS predict_first, (SELECT max({c}) FROM {q}) AS predict_last, (SELECT count(DISTINCT {c}) FROM {q}) AS predict_steps,
  (SELECT count(*) FROM (SELECT DISTINCT {c} FROM {t} INTERSECT SELECT DISTINCT {c} FROM {q})) AS shared_steps)"""


def _within(t: str, q: str) -> str:
    parts = {"dayofmonth": "day(ts)", "hour": "hour(ts)", "weekday": "isodow(ts) - 1", "month": "month(ts)", "week": "week(ts)"}
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS part, (SELECT max({e}) FROM {t}) AS train_max, (SELECT min({e}) FROM {q}) AS predict_min, (SELECT count(DISTINCT {e}) FROM {t}) AS train_values, (SELECT count(DISTINCT {e}) FROM {q}) AS predict_values" for n, e in parts.items()
    )
    return f"SELECT part, CAST(train_max AS INTEGER) AS train_max, CAST(predict_min AS INTEGER) AS predict_min, train_values, predict_values, train_max < predict_min AND train_values >= 2 AND predict_values >= 2 AS splits FROM ({rows})"


def _shift(t: str, q: str, names: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS \"column\", (SELECT avg({e}) FROM {t}) AS a, (SELECT avg({e}) FROM {q}) AS b, (SELECT stddev({e}) FROM {t}) AS s" for n, e in names.items())
    return f"""SELECT "column", abs(a - b) / s AS z, CASE WHEN abs(a - b) / s > 3 THEN 'high' WHEN abs(a - b) / s > 2 THEN 'medium' ELSE 'low' END AS level FROM ({rows}) WHERE abs(a - b) / s > 1 ORDER BY z DESC, 1 LIMIT 10"""


def _levels(table: str, names: list[str], least: int, most: int) -> str:
    return f"""rows_ AS ({_long(table, names, "y, ", "level")}), lev AS (SELECT "column", level, count(*) AS n, avg(y) AS mean, stddev(y) AS std FROM rows_ WHERE level IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
lv AS (SELECT * FROM lev WHERE "column" IN (SELECT "column" FROM lev GROUP BY 1 HAVING count(*) BETWEEN {least} AND {most}))"""


def _autocorr(rows: str) -> str:
    """CTEs per and au over `rows` (nation, flag, k, y)."""
    return f"""per AS (SELECT nation, flag, count(*) AS n, stddev(y) AS s, max(k) - min(k) + 1 AS span FROM {rows} GROUP BY ALL HAVING count(*) >= 4 AND stddev(y) > 0),
pr AS (SELECT a.nation, a.flag, l.lag, corr(a.y, b.y) AS r FROM {rows} a CROSS JOIN (SELECT unnest([1, 3, 6, 12]) AS lag) l JOIN {rows} b ON a.nation = b.nation AND a.flag = b.flag AND b.k = a.k + l.lag GROUP BY ALL),
au AS (SELECT CAST(lag AS INTEGER) AS lag, count(*) AS groups, avg(r) AS mean, avg(r) >= 0.2 AS strong FROM pr JOIN per USING (nation, flag) WHERE span > lag + 2 AND r IS NOT NULL AND NOT isnan(r) GROUP BY lag)"""


def _sanity(pred: str) -> str:
    """Verdict rows of q1's group means against t1."""
    return f"""a AS (SELECT count(*) FILTER (pred IS NULL) AS bad, stddev(pred) AS ps, quantile_cont(pred, 0.5) AS pm FROM {pred}), b AS (SELECT stddev(y) AS ts, quantile_cont(y, 0.5) AS tm FROM t1),
sane AS (SELECT 'sanity' AS stage, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, 'finite predictions' AS reason, 'pred' AS "column", CAST(bad AS VARCHAR) AS value FROM a
UNION ALL SELECT 'sanity', CASE WHEN ps / ts < 0.01 THEN 'fail' ELSE 'pass' END, 'spread of predictions', 'pred', CAST(round(ps / ts, 4) AS VARCHAR) FROM a, b
UNION ALL SELECT 'sanity', CASE WHEN pm / tm > 3 OR pm / tm < 1 / 3 THEN 'warn' ELSE 'pass' END, 'median of predictions', 'pred', CAST(round(pm / tm, 4) AS VARCHAR) FROM a, b)"""


_GROUP_PRED = "gp AS (SELECT q1.*, coalesce(m.m, (SELECT avg(y) FROM t1)) AS pred FROM q1 LEFT JOIN (SELECT nation, avg(y) AS m FROM t1 GROUP BY 1) m USING (nation))"

_FACTS = """SELECT '{what}' AS what, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, count(*) AS "distinct", coalesce(bool_and(x IS NOT NULL), false) AS "numeric", coalesce(bool_and(coalesce(x % 1 = 0, false)), false) AS integer_like,
  CASE WHEN count(*) = 2 THEN 'binary' WHEN NOT bool_and(x IS NOT NULL) THEN 'multiclass' WHEN bool_and(coalesce(x % 1 = 0, false)) AND count(*) <= 20 THEN 'multiclass' ELSE 'regression' END AS kind
  FROM (SELECT {c} AS v, count(*) AS n, try_cast({c} AS DOUBLE) AS x FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)"""


def _facts(what: str, t: str, c: str) -> str:
    return _FACTS.format(what=what, t=t, c=c)


#: Orders with their class and four features in long form; x is null where the feature is missing.
_TREES = f"""{P1}, tr AS (SELECT row_id, CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label, CAST(month(ts) AS DOUBLE) AS x0, CAST(substr(priority, 1, 1) AS DOUBLE) AS x1,
  floor(gappy / 2500) AS x2, CAST(year(ts) AS DOUBLE) AS x3 FROM p1),
lf AS (SELECT row_id, label, 0 AS f, x0 AS x FROM tr UNION ALL SELECT row_id, label, 1, x1 FROM tr UNION ALL SELECT row_id, label, 2, x2 FROM tr UNION ALL SELECT row_id, label, 3, x3 FROM tr)"""


def _boost_level(out: str, nodes: str) -> str:
    """Best split of every (class, node): nodes has row_id, k, node, g, h."""
    return f"""{out}_c AS (SELECT k, node, f, x, sum(g) AS g, sum(h) AS h, count(*) AS n FROM lf JOIN {nodes} USING (row_id) GROUP BY ALL),
{out}_w AS (SELECT *, sum(g) FILTER (x IS NOT NULL) OVER o AS gc, sum(h) FILTER (x IS NOT NULL) OVER o AS hc, sum(n) FILTER (x IS NOT NULL) OVER o AS nc, sum(g) OVER t AS gt, sum(h) OVER t AS ht, sum(n) OVER t AS nt,
  coalesce(sum(g) FILTER (x IS NULL) OVER t, 0) AS gm, coalesce(sum(h) FILTER (x IS NULL) OVER t, 0) AS hm, coalesce(sum(n) FILTER (x IS NULL) OVER t, 0) AS nm
  FROM {out}_c WINDOW t AS (PARTITION BY k, node, f), o AS (PARTITION BY k, node, f ORDER BY x NULLS FIRST)),
{out}_s AS (SELECT k, node, f, x AS cut, ml, gc + ml * gm AS gl, hc + ml * hm AS hl, nc + ml * nm AS nl, gt, ht, nt FROM {out}_w, (SELECT unnest([0, 1]) AS ml) WHERE x IS NOT NULL AND (nm > 0 OR ml = 0)),
{out}_g AS (SELECT *, gl * gl / hl + (gt - gl) * (gt - gl) / (ht - hl) - gt * gt / ht AS gain FROM {out}_s WHERE nl >= 20 AND nt - nl >= 20 AND hl >= 1e-3 AND ht - hl >= 1e-3),
{out} AS (SELECT * FROM {out}_g WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY CAST(gain AS FLOAT) DESC, f, cut, ml) = 1)"""


def _boost_step(out: str, nodes: str, best: str) -> str:
    """Rows one level down; v is the leaf's value."""
    return f"""{out} AS (SELECT n.row_id, n.k, n.g, n.h, CASE WHEN b.k IS NULL THEN n.node WHEN CASE WHEN l.x IS NULL THEN ml = 1 ELSE l.x <= b.cut END THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node,
  CASE WHEN b.k IS NULL THEN n.v WHEN CASE WHEN l.x IS NULL THEN ml = 1 ELSE l.x <= b.cut END THEN -gl / hl ELSE -(gt - gl) / (ht - hl) END AS v
  FROM {nodes} n LEFT JOIN {best} b ON b.k = n.k AND b.node = n.node LEFT JOIN lf l ON l.row_id = n.row_id AND l.f = b.f)"""


def _outside(name: str, keys: str) -> str:
    """Chances of each row's classes from the other folds' rows of its keys."""
    on = " AND ".join(f"{{0}}.{k} = f1.{k}" for k in keys.split(", "))
    return f"""{name} AS (SELECT f1.row_id, f1.status AS y, cls.c, (coalesce(g.n, 0) - coalesce(h.n, 0))::DOUBLE / (gt.n - ht.n) AS p FROM f1 CROSS JOIN cls
  JOIN (SELECT {keys}, count(*) AS n FROM f1 GROUP BY ALL) gt ON {on.format("gt")} JOIN (SELECT {keys}, fold, count(*) AS n FROM f1 GROUP BY ALL) ht ON {on.format("ht")} AND ht.fold = f1.fold
  LEFT JOIN (SELECT {keys}, status AS c, count(*) AS n FROM f1 GROUP BY ALL) g ON {on.format("g")} AND g.c = cls.c
  LEFT JOIN (SELECT {keys}, fold, status AS c, count(*) AS n FROM f1 GROUP BY ALL) h ON {on.format("h")} AND h.fold = f1.fold AND h.c = cls.c)"""


_TWO = f"""{P1}, {_FOLDED}, cls AS (SELECT DISTINCT status AS c FROM p1), {_outside("pa", "priority, segment")}, {_outside("pb", "nation")},
ab AS (SELECT pa.row_id, pa.y, pa.c, pa.p AS a, pb.p AS b FROM pa JOIN pb ON pa.row_id = pb.row_id AND pa.c = pb.c),
gr AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a) FILTER (c = y) AS ta, sum(b) FILTER (c = y) AS tb FROM ab)"""


def _draw(seed: int, feature: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || t || '|0|' || {feature}), 1, 8) AS BIGINT)"


ORACLES: dict[str, str] = {
    "profile_missing": f"WITH {P1} {_missing('p1', ['row_id', 'y', 'ts', 'month', 'priority', 'status', 'segment', 'acctbal', 'nation', 'gappy'])}",
    "profile_numeric": _rounded(f"WITH {P1} {_numeric('p1', ['y', 'acctbal', 'gappy'])}", min=4, max=4, mean=4, std=4, p25=4, median=4, p75=4),
    "profile_categorical": f"""WITH {P1}, l AS ({_long('p1', ['priority', 'segment', 'nation', 'status'])}), c AS (SELECT "column", value, count(*) AS count FROM l WHERE value IS NOT NULL GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS INTEGER) AS nth FROM c) WHERE nth <= 5""",
    "profile_duplicates": "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    "profile_flags": f"""WITH {P1}, k(c, kind) AS (VALUES ('row_id', 'numeric'), ('y', 'numeric'), ('priority', 'categorical'), ('status', 'categorical'), ('nation', 'categorical'), ('gappy', 'numeric')),
l AS ({_long('p1', ['row_id', 'y', 'priority', 'status', 'nation', 'gappy'])}), n AS (SELECT "column", count(DISTINCT value) AS "distinct", count(*) AS rows FROM l GROUP BY 1)
SELECT "column", kind, "distinct", "column" = 'row_id' AS id_like, "distinct" <= 1 AS constant, kind = 'categorical' AND "distinct" > 20 AND "distinct" / rows > 0.5 AS high_cardinality,
"column" = 'y' AS target_like, false AS leakage_like FROM n JOIN k ON k.c = n."column" """,
    "column_exclusions": f"""WITH {P1} SELECT * FROM (VALUES ('row_id', 'id-like'), ('priority', NULL), ('gone', 'critically missing'), ('same', 'constant')) t("column", reason)""",
    "series_summary": _rounded(f"WITH {P1} SELECT count(gappy) AS count, count(*) - count(gappy) AS missing, avg(gappy) AS mean, stddev(gappy) AS std, min(gappy) AS min, quantile_cont(gappy, 0.5) AS median, max(gappy) AS max FROM p1", mean=4, std=4, min=4, median=4, max=4),
    "class_distribution": f"""WITH {P4}, c AS (SELECT CAST(y AS VARCHAR) AS label, count(*) AS count FROM p4 WHERE y IS NOT NULL GROUP BY 1)
SELECT label, count, round(count / sum(count) OVER (), 6) AS fraction, round(max(count) OVER () / sum(count) OVER (), 6) AS majority_rate, max(count) OVER () / sum(count) OVER () > 0.8 AS imbalanced FROM c""",
    "metric_advice": f"""WITH {P1}, {P4}, v AS (SELECT 'status' AS target, CAST(status AS VARCHAR) AS s FROM p1 UNION ALL SELECT 'y', CAST(y AS VARCHAR) FROM p1 UNION ALL SELECT 'quality', CAST(y AS VARCHAR) FROM p4 UNION ALL SELECT 'late', CAST(CAST(month >= '2000-07' AS INT) AS VARCHAR) FROM p1), c AS (SELECT target, s, count(*) AS c, TRY_CAST(s AS DOUBLE) AS x FROM v WHERE s IS NOT NULL GROUP BY ALL),
f AS (SELECT target, sum(c) AS n, max(c) AS c, CASE WHEN count(*) = 2 THEN 'binary' WHEN NOT bool_and(x IS NOT NULL) THEN 'multiclass' WHEN bool_and(coalesce(x % 1 = 0, false)) AND count(*) <= 20 THEN 'multiclass' ELSE 'regression' END AS kind FROM c GROUP BY 1), g AS (SELECT *, CASE WHEN kind <> 'regression' THEN c / n END AS r FROM f)
SELECT target, kind, round(r, 6) AS majority_rate, coalesce(r > 0.8, false) AS imbalanced, CASE kind WHEN 'binary' THEN 'roc_auc,f1_weighted,accuracy,confusion_matrix' WHEN 'multiclass' THEN 'f1_weighted,f1_macro,accuracy,confusion_matrix' ELSE 'rmse,mae,r2' END AS metrics, CASE WHEN r > 0.8 THEN 'one class dominates; prefer roc_auc to accuracy' END AS advice FROM g""",
    "datetime_detect": f"""WITH {P1}, v AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN row_id % 4 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE 'n/a' END AS mixed, segment FROM p1), l AS ({_long('v', ['day', 'mixed', 'segment'])})
SELECT "column", round(avg(CASE WHEN try_cast(value AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END), 6) AS parse_rate, avg(CASE WHEN try_cast(value AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END) >= 0.6 AS is_datetime FROM l WHERE value IS NOT NULL GROUP BY 1""",
    "time_of_day": "SELECT 'events' AS panel, bool_or(hour(ts) > 0 OR minute(ts) > 0 OR second(ts) > 0) AS has_time FROM events UNION ALL SELECT 'orders', bool_or(hour(o_orderdate) > 0 OR minute(o_orderdate) > 0 OR second(o_orderdate) > 0) FROM orders",
    "text_detect": _rounded(
        f"""WITH {P4}, l AS (SELECT "column", trim(value, ' ') AS value FROM ({_long('p4', ['lang', 'source', 'text'])})), t AS (SELECT "column", value, len(string_split_regex(value, '[ \\t\\n\\x0B\\f\\r]+')) AS k FROM l WHERE value <> '')
SELECT "column", count(*) AS filled, count(DISTINCT value) AS "distinct", avg(k) AS mean_tokens, avg(k) >= 3 AND count(*) >= 10 AND count(DISTINCT value) >= 10 AS is_text FROM t GROUP BY 1""",
        mean_tokens=4,
    ),
    "value_overlap": f"""WITH {P1}, p AS (SELECT DISTINCT * FROM ({_long('q1', ['month', 'priority', 'segment', 'nation', 'status'])}) WHERE value IS NOT NULL), t AS (SELECT DISTINCT *, 1 AS hit FROM ({_long('t1', ['month', 'priority', 'segment', 'nation', 'status'])}))
SELECT "column", count(*) AS values, count(hit) AS shared, round(count(hit) / count(*), 6) AS overlap FROM p LEFT JOIN t USING ("column", value) GROUP BY 1""",
    "scoring_subset": f"""WITH {P1}, qq AS (SELECT * FROM q1 WHERE nation < 'M' AND status <> 'P'), p AS (SELECT DISTINCT *, 1 AS p FROM ({_long('qq', ['nation', 'status', 'month', 'segment'])}) WHERE value IS NOT NULL),
t AS (SELECT "column", value, count(*) AS n FROM ({_long('t1', ['nation', 'status', 'month', 'segment'])}) WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", count(p) AS predict_values, count(*) FILTER (p IS NULL) AS train_only, CAST(coalesce(sum(n) FILTER (p IS NOT NULL), 0) AS BIGINT) AS rows_in_scope, count(*) FILTER (n IS NULL) = 0 AND count(*) FILTER (p IS NULL) > 0 AS restricts
FROM t FULL JOIN p USING ("column", value) GROUP BY 1""",
    "group_keys": f"""WITH {P1}, p AS (SELECT DISTINCT * FROM ({_long('q1', ['priority', 'segment', 'nation', 'month'])}) WHERE value IS NOT NULL), t AS (SELECT DISTINCT *, 1 AS hit FROM ({_long('t1', ['priority', 'segment', 'nation', 'month'])}) WHERE value IS NOT NULL),
o AS (SELECT "column", count(hit) / count(*) AS overlap FROM p LEFT JOIN t USING ("column", value) GROUP BY 1), f AS (SELECT "column", count(*) AS levels FROM t GROUP BY 1),
fit AS (SELECT "column", levels FROM f JOIN o USING ("column") WHERE levels BETWEEN 2 AND 2000 AND overlap >= 0.5)
SELECT "column" AS keys, levels FROM fit UNION ALL SELECT string_agg("column", ',' ORDER BY "column"), NULL FROM (SELECT * FROM fit ORDER BY levels DESC, "column" LIMIT 2) HAVING count(*) = 2""",
    "period_rank": f"WITH {P1} SELECT month, CAST(row_number() OVER (ORDER BY a, month) - 1 AS INTEGER) AS rank FROM (SELECT month, min(ts) AS a FROM p1 GROUP BY 1)",
    "column_diff": f"""WITH {P1}, c AS (SELECT * FROM (VALUES ('row_id', 'both'), ('y', 'train'), ('ts', 'both'), ('month', 'both'), ('priority', 'both'), ('status', 'train'), ('segment', 'both'), ('acctbal', 'both'), ('nation', 'both'), ('gappy', 'both'), ('extra', 'predict')) t("column", side))
SELECT *, (SELECT count(*) FROM t1) AS train_rows, (SELECT count(*) FROM q1) AS predict_rows FROM c""",
    "join_train": """WITH o AS (SELECT o_orderkey AS row_id, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS k FROM orders), c AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT NULL, -1.0)
SELECT o.k IS NULL AS no_key, count(*) AS n, count(v) AS matched, round(sum(v), 2) AS total FROM o LEFT JOIN c ON o.k IS NOT DISTINCT FROM c.k GROUP BY 1""",
    "join_predict": f"WITH {P1} SELECT n_regionkey AS region, count(*) AS n FROM q1 LEFT JOIN nation ON nation = n_name GROUP BY 1",
    "join_predict_common": f"""WITH {P1}, c AS (SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT q1.segment, count(*) AS n, CAST(sum(customers) AS BIGINT) AS customers, 'segment,nation' AS keys FROM q1 LEFT JOIN c ON q1.segment IS NOT DISTINCT FROM c.segment AND q1.nation IS NOT DISTINCT FROM c.nation GROUP BY 1""",
    "join_keys": f"""WITH {P1}, p AS (SELECT DISTINCT 'nation' AS "column", nation AS v FROM q1 UNION SELECT DISTINCT 'segment', segment FROM q1), t AS (SELECT DISTINCT 'nation' AS "column", nation AS v FROM t1 UNION SELECT DISTINCT 'segment', segment FROM t1)
SELECT p."column", count(*) AS "values", count(t.v) AS shared, count(t.v) / count(*) AS overlap, 'nation,segment,balance' AS keys FROM p LEFT JOIN t ON p."column" = t."column" AND p.v = t.v WHERE p.v IS NOT NULL GROUP BY 1""",
    "join_by_order": "SELECT c_mktsegment AS seg, count(*) AS rows, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1",
    "shared_rows": f"""WITH {P1}, a AS (SELECT priority, segment, nation, status, count(*) AS n FROM t1 GROUP BY ALL), b AS (SELECT priority, segment, nation, status, count(*) AS m FROM q1 GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS left_rows, CAST(coalesce(sum(n * m), 0) AS BIGINT) AS shared FROM a LEFT JOIN b ON a.priority IS NOT DISTINCT FROM b.priority AND a.segment IS NOT DISTINCT FROM b.segment AND a.nation IS NOT DISTINCT FROM b.nation AND a.status IS NOT DISTINCT FROM b.status""",
    "set_relation": f"""WITH {P1}, a AS (SELECT DISTINCT month FROM q1), b AS (SELECT DISTINCT month FROM t1), c AS (SELECT (SELECT count(*) FROM a SEMI JOIN b USING (month)) AS shared, (SELECT count(*) FROM a ANTI JOIN b USING (month)) AS left_only, (SELECT count(*) FROM b ANTI JOIN a USING (month)) AS right_only)
SELECT *, left_only = 0 AND right_only > 0 AS strict_subset FROM c""",
    "attach_statistics": _rounded(
        f"""WITH {P1}, t AS (SELECT * FROM t1 WHERE nation < 'P'), g AS (SELECT nation, avg(y) AS m, coalesce(stddev(y), 0) AS s, count(y) AS c FROM t GROUP BY 1), w AS (SELECT avg(y) AS m, stddev(y) AS s FROM t)
SELECT q1.nation, count(*) AS n, max(coalesce(g.m, w.m)) AS mean, max(coalesce(g.s, w.s)) AS std, max(coalesce(c, 0)) AS seen FROM q1 LEFT JOIN g USING (nation), w GROUP BY 1""",
        mean=4,
        std=4,
    ),
    "align_oof": _rounded(f"WITH {P1} SELECT count(*) AS n, avg(y) AS a, avg(acctbal) AS b FROM p1 WHERE row_id % 3 <> 0 AND row_id % 5 <> 0 AND acctbal IS NOT NULL AND y IS NOT NULL", a=4, b=4),
    "time_features": _rounded(
        f"""WITH {P2}, {_CAL} SELECT row_id, ts__year, ts__month, sin(2 * pi() * ts__month / 12) AS ts__month_sin, cos(2 * pi() * ts__month / 12) AS ts__month_cos, ts__day, ts__weekday, sin(2 * pi() * ts__weekday / 7) AS ts__weekday_sin,
CAST(ts__weekday >= 5 AS INTEGER) AS ts__weekend, ts__quarter, ts__week, ts__hour, sin(2 * pi() * ts__hour / 24) AS ts__hour_sin, cos(2 * pi() * ts__hour / 24) AS ts__hour_cos FROM cal""",
        ts__month_sin=6,
        ts__month_cos=6,
        ts__weekday_sin=6,
        ts__hour_sin=6,
        ts__hour_cos=6,
    ),
    "ordinal_encode": f"WITH {P1} SELECT month AS value, CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS ordinal FROM (SELECT month FROM t1 UNION SELECT month FROM q1)",
    "interactions": _rounded(
        f"""WITH {P2}, {_CAL}, k AS (SELECT *, user_id % 7 AS k FROM cal), r AS ({" UNION ALL ".join(f"SELECT '{a}_x_{b}' AS pair, corr({a} * {b}, y) AS r FROM k" for a in ("ts__hour", "ts__weekday", "ts__day") for b in ("k", "user_id"))})
SELECT pair, r FROM r ORDER BY abs(r) DESC, pair LIMIT 6""",
        r=6,
    ),
    "impute_median": _rounded(f"WITH {P1}, v AS (SELECT coalesce(gappy, (SELECT quantile_cont(gappy, 0.5) FROM t1)) AS g FROM q1) SELECT count(g) AS n, avg(g) AS mean, min(g) AS low FROM v", mean=4, low=4),
    "impute_mode": f"""WITH {P1}, m AS (SELECT segment FROM t1 GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1)
SELECT coalesce(CASE WHEN row_id % 4 <> 0 THEN segment END, (SELECT segment FROM m)) AS segment, count(*) AS n FROM q1 GROUP BY 1""",
    "onehot_levels": f"""WITH {P2}, c AS (SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS n FROM p2 WHERE user_id IS NOT NULL GROUP BY 1), k AS (SELECT value FROM c WHERE n >= 0.0065 * (SELECT sum(n) FROM c) ORDER BY n DESC, value LIMIT 20)
SELECT value, n, CASE WHEN value IN (SELECT value FROM k) THEN value ELSE '__rare__' END AS level FROM c""",
    "fold_levels": f"""WITH {P2}, c AS (SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS n FROM p2 WHERE user_id IS NOT NULL GROUP BY 1), k AS (SELECT value FROM c WHERE n >= 0.0065 * (SELECT sum(n) FROM c) ORDER BY n DESC, value LIMIT 20)
SELECT CASE WHEN value IN (SELECT value FROM k) THEN value ELSE '__rare__' END AS u, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1""",
    "tfidf_terms": f"""WITH {P4}, w AS (SELECT row_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2) AS w FROM p4),
t AS (SELECT row_id, unnest(list_distinct(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])))) AS term FROM w)
SELECT term, count(*) AS df, round(ln((1.0 + (SELECT count(*) FROM p4)) / (1.0 + count(*))) + 1.0, 6) AS idf FROM t GROUP BY term HAVING count(*) >= 2 ORDER BY df DESC, term LIMIT 400""",
    "target_transform": _rounded(
        f"""WITH {P1}, {P2}, v AS (SELECT 'events' AS panel, y FROM p2 UNION ALL SELECT 'orders', y FROM p1)
SELECT panel, count(y) AS n, skewness(y) AS skew, CASE WHEN count(y) > 10 AND min(y) >= 0 AND skewness(y) > 1.5 THEN 'log1p' WHEN count(y) > 10 AND min(y) >= 0 AND skewness(y) > 0.5 THEN 'sqrt' ELSE 'none' END AS transform FROM v GROUP BY 1""",
        skew=6,
    ),
    "transform_round_trip": _rounded("SELECT count(*) AS n, avg(value) AS mean, 0.0::DOUBLE AS gap FROM events", mean=6),
    "label_codes": f"WITH {P1} SELECT priority AS label, CAST(row_number() OVER (ORDER BY priority) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT priority FROM p1 WHERE priority IS NOT NULL)",
    "positive_label": f"WITH {P1}, {P4} SELECT 'quality' AS panel, CAST(max(y) AS VARCHAR) AS label FROM p4 UNION ALL SELECT 'orders', max(status) FROM p1",
    "choose_columns": """SELECT * FROM (VALUES ('row_id', 'row id'), ('y', 'target'), ('ts', NULL), ('month', NULL), ('priority', NULL), ('status', NULL), ('segment', NULL), ('acctbal', NULL), ('nation', NULL), ('gappy', NULL),
('post_value', 'outcome word in its name'), ('postal', NULL), ('only_train', 'absent from predict')) t("column", reason)""",
    "in_scope": f"WITH {P1} SELECT count(*) AS n, round(avg(y), 4) AS mean FROM t1 WHERE nation IN (SELECT nation FROM q1 WHERE nation < 'K')",
    "target_distribution": _rounded(
        f"""WITH {P2} SELECT count(y) AS n, avg(y) AS mean, stddev(y) AS std, {", ".join(f"quantile_cont(y, {q}) AS q{round(100 * q):02d}" for q in (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99))}, skewness(y) AS skew, kurtosis_pop(y) AS kurtosis,
avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) AS zero_share, avg(CASE WHEN abs(y) < 1e-6 THEN 1.0 ELSE 0.0 END) AS near_zero_share, min(y) >= 0 AS non_negative, skewness(y) > 1.5 AS right_skewed,
CASE WHEN abs(skewness(y)) < 0.5 THEN 'symmetric' WHEN skewness(y) > 1.5 THEN 'strongly right-skewed' WHEN skewness(y) > 0 THEN 'right-skewed' WHEN skewness(y) < -1.5 THEN 'strongly left-skewed' ELSE 'left-skewed' END AS shape FROM p2""",
        mean=5,
        std=5,
        **{f"q{q:02d}": 5 for q in (1, 5, 10, 25, 50, 75, 90, 95, 99)},
        skew=5,
        kurtosis=5,
        zero_share=5,
        near_zero_share=5,
    ),
    "target_by_group": _rounded(
        f"""WITH {P1}, {_levels('p1', ['priority', 'segment', 'nation', 'status', 'month'], 2, 48)}
SELECT "column", count(*) AS levels, max(mean) - min(mean) AS mean_range, stddev(mean) AS mean_std, max(mean) - min(mean) > 0.5 * (SELECT stddev(y) FROM p1) AS is_predictive FROM lv GROUP BY 1""",
        mean_range=4,
        mean_std=4,
    ),
    "top_groups": _rounded(f"""WITH {P1}, {_levels('p1', ['priority', 'nation'], 2, 48)} SELECT * FROM (SELECT "column", level, n, mean, CAST(row_number() OVER (PARTITION BY "column" ORDER BY mean DESC, level) AS INTEGER) AS nth FROM lv) WHERE nth <= 5""", mean=4),
    "time_target_signal": _rounded(f"""WITH {P2}, {_CAL}, {_levels('cal', ['ts__hour', 'ts__weekday', 'ts__week'], 2, 50)} SELECT * FROM lv""", mean=4, std=4),
    "feature_corr": _rounded(
        f"""WITH {P1}, h AS (SELECT *, y / 2 + acctbal AS half FROM p1), r AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", corr({c}, y) AS r FROM h" for c in ("acctbal", "gappy", "half", "row_id"))}), s AS (SELECT *, CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS sign FROM r)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sign ORDER BY abs(r) DESC, "column") AS INTEGER) AS nth FROM s) WHERE sign = 'positive' AND nth <= 10 OR sign = 'negative' AND nth <= 5""",
        r=6,
    ),
    "distribution_shift": _rounded(f"WITH {P2} {_shift('t2', 'q2', {'late': 'day(ts)', 'flat': 'y', 'row_id': 'row_id', 'user_id': 'user_id'})}", z=4),
    "high_cardinality": _rounded(f"""WITH {P1}, l AS ({_long('p1', ['row_id', 'segment', 'month'])}) SELECT "column", count(DISTINCT value) AS "distinct", count(DISTINCT value) / count(*) AS ratio, count(DISTINCT value) / count(*) > 0.5 AS id_risk FROM l GROUP BY 1""", ratio=6),
    "target_components": _rounded(
        f"""WITH {P1}, v AS (SELECT *, y * 0.4::DOUBLE + acctbal * 0.1::DOUBLE AS part FROM p1), r AS (SELECT 'part' AS "column", corr(part, y) AS r, avg(part / nullif(y, 0)) AS mean_share FROM v UNION ALL SELECT 'other', corr(acctbal, y), avg(acctbal / nullif(y, 0)) FROM v)
SELECT "column", r, CASE WHEN abs(r) >= 0.8 THEN 'strong' WHEN abs(r) >= 0.5 THEN 'medium' WHEN abs(r) >= 0.3 THEN 'weak' ELSE 'none' END AS tier, mean_share, mean_share > 0 AND mean_share < 1.01 AS additive FROM r""",
        r=6,
        mean_share=6,
    ),
    "interaction_scan": _rounded(
        f"""WITH {P2}, {_CAL}, k AS (SELECT *, user_id % 5 AS k FROM cal), c AS ({" UNION ALL ".join(f"SELECT '{t}' AS time, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, {t} AS moment, count(*) AS n, avg(y) AS m FROM k GROUP BY ALL" for t in ("ts__hour", "ts__weekday") for c in ("event_type", "k"))}),
per AS (SELECT time, "column", level, sum(n) AS n, count(*) AS k, max(m) - min(m) AS range, avg(m) AS mean FROM c WHERE level IS NOT NULL AND moment IS NOT NULL GROUP BY ALL HAVING sum(n) >= 4 AND count(*) >= 2)
SELECT time, "column", count(*) AS levels, max(range) - min(range) AS strength, max(mean) - min(mean) AS spread FROM per GROUP BY ALL HAVING count(*) >= 2 ORDER BY strength DESC, time, "column" LIMIT 3""",
        strength=4,
        spread=4,
    ),
    "time_coverage": f"WITH {P1} {_coverage('t1', 'q1', 'month')}",
    "rank_coverage": f"WITH {P1}, rk AS (SELECT month, CAST(row_number() OVER (ORDER BY a, month) - 1 AS INTEGER) AS rank FROM (SELECT month, min(ts) AS a FROM p1 GROUP BY 1)), tr AS (SELECT * FROM t1 JOIN rk USING (month)), qr AS (SELECT * FROM q1 JOIN rk USING (month)) {_coverage('tr', 'qr', 'rank')}",
    "within_period": f"WITH {P2}, a AS (SELECT * FROM p2 WHERE day(ts) <= 19), b AS (SELECT * FROM p2 WHERE day(ts) > 19) {_within('a', 'b')}",
    "series_shape": _rounded(
        f"""WITH {P3}, c AS (SELECT nation, flag, month, count(*) AS n FROM p3 GROUP BY ALL), l AS (SELECT nation, flag, count(month) AS len FROM c GROUP BY ALL), w AS (SELECT month, sum(n) AS n FROM c GROUP BY 1)
SELECT (SELECT count(month) FROM w) AS periods, (SELECT avg(n) FROM w) AS rows_per_period, count(*) AS groups, min(len) AS shortest, quantile_cont(CAST(len AS DOUBLE), 0.5) AS median, max(len) AS longest FROM l""",
        rows_per_period=4,
        median=4,
    ),
    "autocorrelation": _rounded(f"WITH {P3}, s AS (SELECT nation, flag, rank AS k, y FROM p3), {_autocorr('s')} SELECT * FROM au", mean=6),
    "lag_advice": f"""WITH {P3}, e AS (SELECT max(rank) - 12 AS e FROM p3), t AS (SELECT * FROM p3 WHERE rank <= (SELECT e FROM e)), q AS (SELECT * FROM p3 WHERE rank > (SELECT e FROM e)), s AS (SELECT nation, flag, rank AS k, y FROM t), {_autocorr('s')},
st AS (SELECT min(lag) AS shortest_lag, max(lag) AS longest_lag FROM au WHERE strong), cv AS ({_coverage('t', 'q', 'rank')}), sh AS (SELECT min(n) AS shortest FROM (SELECT count(DISTINCT month) AS n FROM t GROUP BY nation, flag))
SELECT CASE WHEN shortest_lag IS NULL THEN 'static' WHEN NOT predict_later THEN 'unavailable' WHEN horizon > 0 AND horizon <= shortest_lag THEN 'direct' ELSE 'recursive' END AS advice, shortest_lag, horizon, coalesce(shortest < 3 * longest_lag, false) AS experimental FROM cv, st, sh""",
    "validation_advice": f"""WITH {P2}, w AS ({_within('t2', 'q2')}), c AS ({_coverage('t2', 'q2', 'ts')}), s AS ({_shift('t2', 'q2', {'user_id': 'user_id', 'row_id': 'row_id'})})
SELECT CASE WHEN (SELECT bool_or(splits) FROM w) THEN 'within-period' WHEN predict_later THEN 'time' ELSE 'random' END AS scheme, (SELECT skewness(y) > 1.5 FROM t2) AS skewed, (SELECT count(*) > 0 FROM s) AS drifting FROM c""",
    "group_target_stats": _rounded(
        f"""WITH {P1} SELECT segment, priority, avg(y) AS mean, quantile_cont(y, 0.5) AS median, coalesce(stddev(y), 0) AS std, min(y) AS min, max(y) AS max, quantile_cont(y, 0.25) AS q25, quantile_cont(y, 0.75) AS q75, count(y) AS count FROM p1 GROUP BY ALL""",
        mean=4,
        median=4,
        std=4,
        min=4,
        max=4,
        q25=4,
        q75=4,
    ),
    "crossfit_target_stats": _rounded(
        f"""WITH {P1}, {_FOLDED}, g AS (SELECT a.segment, a.nation, k.fold, avg(y) AS mean, coalesce(stddev(y), 0) AS std, count(y) AS count FROM f1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL),
w AS (SELECT k.fold, avg(y) AS mean, stddev(y) AS std FROM f1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL)
SELECT row_id, coalesce(g.mean, w.mean) AS mean, coalesce(g.std, w.std) AS std, coalesce(g.count, 0) AS count FROM f1 LEFT JOIN g USING (segment, nation, fold) JOIN w USING (fold)""",
        mean=5,
        std=4,
    ),
    "crossfit_all_stats": _rounded(
        f"""WITH {P1}, {_FOLDED}, r1 AS (SELECT * REPLACE (gappy * 0.7310585::DOUBLE AS gappy), CASE WHEN row_id % 500 = 3 THEN CAST(row_id AS VARCHAR) ELSE nation END AS rare FROM f1),
g AS (SELECT a.rare, a.status, k.fold, avg(gappy) AS mean, quantile_cont(gappy, 0.5) AS median, coalesce(stddev(gappy), 0) AS std, min(gappy) AS min, max(gappy) AS max, quantile_cont(gappy, 0.25) AS q25, quantile_cont(gappy, 0.75) AS q75, count(gappy) AS count
  FROM r1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL),
w AS (SELECT k.fold, avg(gappy) AS mean, quantile_cont(gappy, 0.5) AS median, stddev(gappy) AS std, min(gappy) AS min, max(gappy) AS max, quantile_cont(gappy, 0.25) AS q25, quantile_cont(gappy, 0.75) AS q75
  FROM r1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL)
SELECT row_id, {", ".join(f"CASE WHEN g.count > 0 THEN g.{c} ELSE w.{c} END AS {c}" for c in ("mean", "median", "std", "min", "max", "q25", "q75"))}, coalesce(g.count, 0) AS count
FROM r1 LEFT JOIN g USING (rare, status, fold) JOIN w USING (fold)""",
        **dict.fromkeys(("mean", "median", "std", "min", "max", "q25", "q75"), 4),
    ),
    "crossfit_group_median": _rounded(
        f"""WITH {P1}, {_FOLDED}, g AS (SELECT a.nation, k.fold, quantile_cont(gappy, 0.5) AS m FROM f1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL),
w AS (SELECT k.fold, quantile_cont(gappy, 0.5) AS m FROM f1 a JOIN (SELECT DISTINCT fold FROM f1) k ON a.fold <> k.fold GROUP BY ALL)
SELECT row_id, coalesce(g.m, w.m, 0) AS q FROM f1 LEFT JOIN g USING (nation, fold) JOIN w USING (fold)""",
        q=4,
    ),
    "group_medians": _rounded(f"WITH {P1} SELECT nation, coalesce(quantile_cont(gappy, 0.5), (SELECT quantile_cont(gappy, 0.5) FROM p1)) AS gappy, coalesce(quantile_cont(y, 0.5), (SELECT quantile_cont(y, 0.5) FROM p1)) AS y FROM p1 GROUP BY 1", gappy=4, y=4),
    "baseline_group_mean": _rounded(
        f"""WITH {P1}, t AS (SELECT * FROM t1 WHERE nation <> 'PERU'), g AS (SELECT nation, status, avg(y) AS m FROM t GROUP BY ALL) SELECT row_id, coalesce(m, (SELECT avg(y) FROM t)) AS pred FROM q1 LEFT JOIN g USING (nation, status)""", pred=4
    ),
    "baseline_group_mode": _rounded(
        f"""WITH {P1}, c AS (SELECT nation, priority AS l, count(*) AS n FROM t1 WHERE nation < 'T' GROUP BY ALL), b AS (SELECT nation, l, n / sum(n) OVER (PARTITION BY nation) AS p, row_number() OVER (PARTITION BY nation ORDER BY n DESC, l) AS k FROM c),
w AS (SELECT l, n / sum(n) OVER () AS p, row_number() OVER (ORDER BY n DESC, l) AS k FROM (SELECT l, sum(n) AS n FROM c GROUP BY 1))
SELECT q1.nation, coalesce(b.l, w.l) AS pred, count(*) AS n, max(coalesce(b.p, w.p)) AS p FROM q1 LEFT JOIN b ON b.nation = q1.nation AND b.k = 1, w WHERE w.k = 1 GROUP BY ALL""",
        p=6,
    ),
    "folds_kfold": f"WITH {P1} SELECT row_id, CAST({_hash('row_id', 's')} % 5 AS INTEGER) AS fold FROM p1",
    "folds_group": f"""WITH {P1}, g AS (SELECT month, count(*) AS n FROM p1 GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, month) - 1 AS p FROM g)
SELECT month, n, CAST(CASE WHEN (p // 5) % 2 = 0 THEN p % 5 ELSE 4 - p % 5 END AS INTEGER) AS fold FROM r""",
    "folds_grouped_rows": f"""WITH {P1}, g AS (SELECT nation, count(*) AS n FROM p1 GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, nation) - 1 AS p FROM g)
SELECT CAST(CASE WHEN (p // 5) % 2 = 0 THEN p % 5 ELSE 4 - p % 5 END AS INTEGER) AS fold, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""",
    "folds_stratified": f"WITH {P1} SELECT row_id, CAST((row_number() OVER (PARTITION BY status ORDER BY {_hash('row_id', 's')}, row_id) - 1) % 5 AS INTEGER) AS fold FROM p1",
    "folds_expanding": f"""WITH {P1}, r AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM p1)), b AS (SELECT *, (n - 1 - rank) // 6 AS back, least(5, (n - 1) // 6) AS room FROM r)
SELECT month, CAST(rank AS INTEGER) AS rank, CAST(CASE WHEN back < room THEN room - 1 - back ELSE -1 END AS INTEGER) AS fold FROM b""",
    "holdout_time_tail": f"WITH {P1} SELECT row_id, row_number() OVER (ORDER BY ts, row_id) - 1 >= (SELECT count(*) - ceil(count(*) * 0.2) FROM p1) AS held_out FROM p1",
    "holdout_groups": f"""WITH {P1}, g AS (SELECT DISTINCT nation FROM p1 WHERE nation IS NOT NULL), r AS (SELECT nation, row_number() OVER (ORDER BY {_hash('nation', 's')}, nation) AS k, count(*) OVER () AS n FROM g)
SELECT nation, n >= 3 AND k <= ceil(n * 0.2) AS held_out FROM r""",
    "holdout_within_period": f"WITH {P2} SELECT day(ts) >= (SELECT quantile_cont(day(ts), 0.7) FROM p2) AS held_out, count(*) AS n, round(avg(y), 4) AS mean FROM p2 GROUP BY 1",
    "holdout_latest": f"""WITH {P1}, m AS (SELECT month, row_number() OVER (ORDER BY month DESC) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM p1))
SELECT month IN (SELECT month FROM m WHERE n >= 5 AND k <= ceil(n * 0.2)) AS held_out, count(*) AS n FROM p1 GROUP BY 1""",
    "split_three": f"""WITH {P1}, u AS (SELECT row_id, {_hash('row_id', 's')} / 4294967296.0::DOUBLE AS u FROM p1)
SELECT CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS part, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM u GROUP BY 1""",
    "coarsen_blocks": f"""WITH {P1}, b AS (SELECT 0 AS ord, 'year' AS unit, count(DISTINCT year(ts)) AS blocks, count(ts) AS n FROM p1 UNION ALL SELECT 1, 'month', count(DISTINCT month), count(ts) FROM p1
UNION ALL SELECT 2, 'week', count(DISTINCT isoyear(ts) * 100 + week(ts)), count(ts) FROM p1 UNION ALL SELECT 3, 'day', count(DISTINCT CAST(ts AS DATE)), count(ts) FROM p1),
s AS (SELECT *, CASE WHEN blocks BETWEEN 10 AND n / 4 THEN 300 - ord WHEN blocks >= 10 THEN 200 + ord WHEN blocks >= 2 THEN 100 - ord ELSE 0 END AS s FROM b) SELECT unit, blocks, s = max(s) OVER () AND s > 0 AS chosen FROM s""",
    "earlier_splits": f"""WITH {P2}, r AS (SELECT row_id, row_number() OVER (ORDER BY ts, row_id) - 1 AS k, count(*) OVER () AS n FROM p2)
SELECT k < floor(n * 0.8) AS before_80, k < floor(n * 0.6) AS before_60, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM r GROUP BY ALL""",
    "block_mae": f"WITH {P1}, {_OOF} SELECT round(avg(e), 4) AS score FROM (SELECT month, avg(abs(y - pred)) AS e FROM oof GROUP BY 1)",
    "regression_metrics": _rounded(
        f"""WITH {P1}, {_OOF}, m AS (SELECT count(*) AS n, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) * (y - pred))) AS rmse, 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) AS r2, CASE WHEN min(y) > 0 THEN avg(abs(y - pred) / y) END AS mape FROM oof)
SELECT *, rmse > 2 * mae AS heavy_tail, r2 < 0 AS worse_than_mean FROM m""",
        mae=4,
        rmse=4,
        r2=4,
        mape=4,
    ),
    "confusion_matrix": f"WITH {P1}, {_LABELLED}, c AS (SELECT status AS actual, guess AS predicted, count(*) AS n FROM la GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY actual), 6) AS share FROM c",
    "classification_metrics": _rounded(
        f"""WITH {P1}, {_LABELLED}, k AS (SELECT DISTINCT status AS c FROM la UNION SELECT DISTINCT guess FROM la), per AS (SELECT c, (SELECT count(*) FROM la WHERE status = c) AS n, (SELECT count(*) FROM la WHERE guess = c) AS m, (SELECT count(*) FROM la WHERE guess = c AND status = c) AS tp FROM k),
s AS (SELECT *, CASE WHEN m > 0 THEN tp / m ELSE 0 END AS p, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS r FROM per), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM s)
SELECT sum(tp) / sum(n) AS accuracy, sum(p * n) / sum(n) AS precision, sum(r * n) / sum(n) AS recall, sum(f * n) / sum(n) AS f1, avg(f) AS f1_macro, avg(r) FILTER (n > 0) AS balanced_accuracy FROM f""",
        accuracy=6,
        precision=6,
        recall=6,
        f1=6,
        f1_macro=6,
        balanced_accuracy=6,
    ),
    "roc_auc": f"WITH {P1}, {_SCORED}, {_AUC_RUN} SELECT round(sum(n * (tp - p) + 0.5::DOUBLE * n * p) / (any_value(tot_p) * any_value(tot_n)), 6) AS auc FROM run",
    "roc_curve": _rounded(f"WITH {P1}, {_SCORED}, {_AUC_RUN} SELECT score, fp / tot_n AS fpr, tp / tot_p AS tpr FROM run", score=6, fpr=6, tpr=6),
    "pr_curve": _rounded(f"WITH {P1}, {_SCORED}, {_AUC_RUN} SELECT score, tp / (tp + fp) AS precision, tp / tot_p AS recall, tp / (tp + fp) * p / tot_p AS ap_term FROM run", score=6, precision=6, recall=6, ap_term=6),
    "log_loss": f"WITH {P1}, {_SCORED}, c AS (SELECT pos, {_hash('row_id', 'q')} % 1000 / 1000.0::DOUBLE AS p FROM sc) SELECT round(avg(-ln(greatest(least(CASE WHEN pos THEN p ELSE 1 - p END, 1 - 1e-15), 1e-15))), 6) AS log_loss FROM c",
    "residual_summary": _rounded(f"WITH {P1}, {_OOF}, r AS (SELECT y - pred AS r FROM oof) SELECT avg(r) AS mean, stddev_pop(r) AS std, min(r) AS min, quantile_cont(r, 0.05) AS p5, quantile_cont(r, 0.95) AS p95, max(r) AS max FROM r", mean=4, std=4, min=4, p5=4, p95=4, max=4),
    "residual_quartiles": _rounded(
        f"""WITH {P1}, {_OOF}, v AS (SELECT y, round(pred, 2) AS p, y - round(pred, 2) AS r FROM oof), e AS (SELECT quantile_cont(p, [0.25, 0.5, 0.75]) AS ep, quantile_cont(y, [0.25, 0.5, 0.75]) AS ey FROM v)
SELECT 'predicted' AS "by", CAST(CASE WHEN p <= ep[1] THEN 1 WHEN p <= ep[2] THEN 2 WHEN p <= ep[3] THEN 3 ELSE 4 END AS INTEGER) AS bucket, count(*) AS n, avg(r) AS mean, avg(abs(r)) AS mean_abs FROM v, e GROUP BY ALL
UNION ALL SELECT 'true', CAST(CASE WHEN y <= ey[1] THEN 1 WHEN y <= ey[2] THEN 2 WHEN y <= ey[3] THEN 3 ELSE 4 END AS INTEGER), count(*), avg(r), avg(abs(r)) FROM v, e GROUP BY ALL""",
        mean=4,
        mean_abs=4,
    ),
    "residual_bias": _rounded(
        f"""WITH {P1}, {_OOF}, v AS (SELECT y, pred AS p, y - pred AS r FROM oof), e AS (SELECT quantile_cont(y, 0.75) AS q3, corr(p, abs(r)) AS spread_corr FROM v),
t AS (SELECT count(*) AS n, avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END) AS under, avg(CASE WHEN r < 0 THEN 1.0 ELSE 0.0 END) AS over, avg(r) AS mean, any_value(q3) AS q3, any_value(spread_corr) AS spread_corr FROM v, e WHERE y >= q3)
SELECT *, CASE WHEN abs(mean) < 0.01 * abs(q3) THEN 'negligible' WHEN mean > 0 THEN 'under' ELSE 'over' END AS direction FROM t""",
        under=4,
        over=4,
        mean=4,
        q3=4,
        spread_corr=4,
    ),
    "prediction_quantiles": _rounded(
        f"""WITH {P1}, v AS (SELECT 'train' AS side, y FROM t1 UNION ALL SELECT 'predict', y FROM q1)
SELECT side, quantile_cont(y, 0.05) AS p5, quantile_cont(y, 0.25) AS p25, quantile_cont(y, 0.5) AS p50, quantile_cont(y, 0.75) AS p75, quantile_cont(y, 0.95) AS p95, quantile_cont(y, 0.5) / (SELECT quantile_cont(y, 0.5) FROM t1) AS median_ratio FROM v GROUP BY 1""",
        p5=4,
        p25=4,
        p50=4,
        p75=4,
        p95=4,
        median_ratio=4,
    ),
    "fold_stability": _rounded(
        f"""WITH {P1}, {_OOF}, s AS (SELECT fold, avg(abs(y - pred)) AS s FROM oof GROUP BY 1), m AS (SELECT count(*) AS folds, avg(s) AS mean, stddev_pop(s) AS std, stddev_pop(s) / abs(avg(s)) AS relative_std FROM s)
SELECT *, CASE WHEN relative_std < 0.15 THEN 'stable' WHEN relative_std < 0.3 THEN 'moderate' ELSE 'unstable' END AS verdict FROM m""",
        mean=4,
        std=4,
        relative_std=4,
    ),
    "compare_metrics": _rounded(
        f"""WITH {P1}, {_OOF}, v AS (SELECT y, pred, avg(y) OVER () AS m FROM oof), a AS (SELECT count(*)::DOUBLE AS n, avg(abs(y - m)) AS mae, sqrt(avg((y - m) * (y - m))) AS rmse, 1 - sum((y - m) * (y - m)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - m) / y) AS mape FROM v),
b AS (SELECT count(*)::DOUBLE AS n, avg(abs(y - pred)) AS mae, sqrt(avg((y - pred) * (y - pred))) AS rmse, 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - pred) / y) AS mape FROM v)
{" UNION ALL ".join(f"SELECT '{c}' AS metric, a.{c} AS baseline, b.{c} AS candidate, b.{c} - a.{c} AS delta FROM a, b" for c in ("n", "mae", "rmse", "r2", "mape"))}""",
        baseline=4,
        candidate=4,
        delta=4,
    ),
    "class_shares": _rounded(
        f"""WITH {P1}, {_LABELLED}, t AS (SELECT status AS label, count(*) AS n FROM la GROUP BY 1), p AS (SELECT guess AS label, count(*) AS m FROM la GROUP BY 1), j AS (SELECT label, n / (SELECT sum(n) FROM t) AS base_rate, coalesce(m, 0) / (SELECT sum(m) FROM p) AS predicted_rate FROM t LEFT JOIN p USING (label))
SELECT *, predicted_rate / base_rate AS ratio, NOT predicted_rate / base_rate BETWEEN 0.6 AND 1.66 AS odd FROM j""",
        base_rate=6,
        predicted_rate=6,
        ratio=6,
    ),
    "gram_matrix": _rounded(
        f"""WITH {P1}, {_OOF}, v AS (SELECT pred AS a, acctbal * 10 AS b, y FROM oof) {" UNION ALL ".join(f"SELECT '{a}' AS a, '{b if b != 'y' else 'target'}' AS b, sum({a} * {b}) / 1e9 AS value FROM v" for a, b in (("a", "a"), ("a", "b"), ("a", "y"), ("b", "b"), ("b", "y")))}""",
        value=4,
    ),
    "keep_best": _rounded(f"WITH {P1}, {_OOF}, s AS (SELECT 'group_mean' AS candidate, avg(abs(y - pred)) AS score FROM oof UNION ALL SELECT 'balance', avg(abs(y - acctbal)) FROM oof) SELECT candidate, score FROM s ORDER BY score LIMIT 1", score=4),
    "task_infer": f"WITH {P1}, {P4} {_facts('orders.y', 'p1', 'y')} UNION ALL {_facts('quality.y', 'p4', 'y')} UNION ALL {_facts('orders.priority', 'p1', 'priority')}",
    "candidate_targets": f"""WITH {P4} SELECT 'y' AS "column", count(DISTINCT y) AS "distinct" FROM p4 UNION ALL SELECT 'label', count(DISTINCT source) FROM p4""",
    "value_format": """SELECT * FROM (VALUES ('y', 'float'), ('row_id', 'int'), ('segment', 'string'), ('u', 'prob01')) t("column", format)""",
    "task_consistency": f"""WITH {P1}, f AS ({_facts('y', 'p1', 'y')}) SELECT 'task' AS stage, CASE WHEN kind = 'regression' THEN 'pass' ELSE 'fail' END AS status, 'kind against data' AS reason, 'y' AS "column", kind AS value FROM f
UNION ALL SELECT 'task', 'fail', 'metric against kind', 'y', 'f1'""",
    "leakage_scan": _rounded(
        f"""WITH {P1}, n AS (SELECT nation, avg(y) AS m FROM p1 GROUP BY 1), g AS (SELECT max(abs(n.m - a.m)) AS gap FROM n JOIN (SELECT nation, avg(y) AS m FROM p1 GROUP BY 1) a USING (nation))
SELECT 'result_code' AS "column", 'named as an outcome' AS reason, NULL::DOUBLE AS value UNION ALL SELECT 'twice', 'correlates with the target', corr(2 * y, y) FROM p1
UNION ALL SELECT 'nation_profile', 'equals the target''s mean or median by nation', gap FROM g""",
        value=6,
    ),
    "univariate_strength": _rounded(
        f"""WITH {P1}, v AS (SELECT 'bal' AS "column", round(acctbal / 50, 0) AS v, status = 'F' AS pos FROM p1 UNION ALL SELECT 'gappy', gappy, status = 'F' FROM p1), t AS (SELECT "column", v, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY "column" ORDER BY v) - n AS below FROM t), a AS (SELECT "column", sum(p * below + 0.5::DOUBLE * p * n) / (sum(p)::DOUBLE * sum(n)) AS auc FROM r GROUP BY 1) SELECT "column", greatest(auc, 1 - auc) AS strength FROM a""",
        strength=6,
    ),
    "leakage_audit": f"""WITH {P1}, a AS (SELECT priority, segment, nation, status, count(*) AS n FROM t1 GROUP BY ALL), b AS (SELECT priority, segment, nation, status, count(*) AS m FROM q1 GROUP BY ALL), s AS (SELECT CAST(coalesce(sum(n * m), 0) AS BIGINT) AS shared FROM a JOIN b USING (priority, segment, nation, status))
SELECT 'leakage' AS stage, 'warn' AS status, 'id-like feature' AS reason, 'row_id' AS "column", '' AS value UNION ALL SELECT 'leakage', 'warn', 'post-outcome name', 'post_code', '' UNION ALL SELECT 'leakage', 'warn', 'scores not of the test split', '', 'train'
UNION ALL SELECT 'leakage', CASE WHEN shared > 0 THEN 'fail' ELSE 'pass' END, 'rows shared by the splits', '', CAST(shared AS VARCHAR) FROM s""",
    "schema_check": f"""WITH {P1} SELECT 'schema' AS stage, CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status, 'predict has rows' AS reason, '' AS "column", CAST(count(*) AS VARCHAR) AS value FROM q1
UNION ALL SELECT 'schema', 'pass', 'row id in predict', 'row_id', 'true' UNION ALL SELECT 'schema', 'pass', 'row id in train', 'row_id', 'true' UNION ALL SELECT 'schema', 'pass', 'target in train', 'y', 'true'""",
    "prediction_sanity": f"WITH {P1}, {_GROUP_PRED}, {_sanity('gp')} SELECT * FROM sane",
    "prediction_validate": f"""WITH {P1}, c AS (SELECT count(*) AS asked, count(*) FILTER (row_id % 100 <> 3) AS given, count(*) FILTER (row_id % 100 = 3) AS misplaced, count(*) FILTER (row_id % 100 <> 3 AND row_id % 50 = 7) AS nulls FROM p1)
SELECT 'hand-in' AS stage, CASE WHEN asked = given THEN 'pass' ELSE 'fail' END AS status, 'row count' AS reason, 'y' AS "column", CAST(given AS VARCHAR) AS value FROM c
UNION ALL SELECT 'hand-in', CASE WHEN misplaced = 0 THEN 'pass' ELSE 'fail' END, 'ids in order', 'y', CAST(misplaced AS VARCHAR) FROM c UNION ALL SELECT 'hand-in', CASE WHEN nulls = 0 THEN 'pass' ELSE 'fail' END, 'no nulls', 'y', CAST(nulls AS VARCHAR) FROM c
UNION ALL SELECT 'hand-in', 'pass', 'finite', 'y', '0'""",
    "worst_verdict": f"""WITH {P1}, {_GROUP_PRED}, {_sanity('gp')} SELECT 'sanity' AS stage, CASE max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status FROM sane UNION ALL SELECT 'schema', 'pass'""",
    "evaluation_validity": """SELECT * FROM (VALUES ('evaluation', 'fail', 'held-out scores only', '', '1'), ('evaluation', 'pass', 'has a baseline', '', '1'), ('evaluation', 'fail', 'metrics fit the task', '', '1')) t(stage, status, reason, "column", value)""",
    "hierarchy_repair": _rounded(
        f"""WITH {P3}, p AS (SELECT flag FROM p3 GROUP BY 1 ORDER BY avg(y) DESC, flag DESC LIMIT 1), c AS (SELECT month, nation, max(y) AS m FROM p3 WHERE flag <> (SELECT flag FROM p) GROUP BY ALL)
SELECT p3.month, p3.nation, flag, CASE WHEN flag = (SELECT flag FROM p) AND coalesce(m > y, false) THEN m ELSE y END AS y, flag = (SELECT flag FROM p) AND coalesce(m > y, false) AS adjusted FROM p3 LEFT JOIN c ON c.month = p3.month AND c.nation = p3.nation""",
        y=2,
    ),
    "clip_predictions": _rounded(
        f"""WITH {P1}, b AS (SELECT CASE WHEN min(y) >= 0 THEN 0.0::DOUBLE END AS low, CASE WHEN min(y) >= 0 THEN greatest(1.5 * max(y), 2 * quantile_cont(y, 0.99)) END AS high FROM t1),
v AS (SELECT least(greatest(y * CASE row_id % 10 WHEN 0 THEN -1 WHEN 1 THEN 9 ELSE 1 END, low), high) AS p, low, high FROM q1, b)
SELECT avg(p) AS mean, min(p) AS low, max(p) AS high, avg(CASE WHEN abs(p - low) <= 1e-8 OR abs(p - high) <= 1e-8 THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT p, low, high FROM v)""".replace("min(p) AS low, max(p) AS high, avg(CASE", "min(p) AS low_, max(p) AS high_, avg(CASE"),
        mean=4,
        low_=4,
        high_=4,
        share=4,
    ).replace("SELECT * REPLACE (round(mean, 4) + 0.0 AS mean, round(low_, 4) + 0.0 AS low_, round(high_, 4) + 0.0 AS high_, round(share, 4) + 0.0 AS share)", "SELECT round(mean, 4) + 0.0 AS mean, round(low_, 4) + 0.0 AS low, round(high_, 4) + 0.0 AS high, round(share, 4) + 0.0 AS share"),
    "sanitize_predictions": _rounded(f"WITH {P1}, v AS (SELECT CASE WHEN row_id % 9 <= 1 THEN (SELECT avg(y) FROM t1) ELSE y END AS p FROM q1) SELECT count(p) AS n, avg(p) AS mean FROM v", mean=4),
    "refit_average": _rounded(f"WITH {P1}, {_OOF} SELECT row_id, pred * 2 AS pred FROM oof", pred=2),
    "group_history": _rounded(
        f"""WITH {P1}, g AS (SELECT month, count(*) AS n FROM p1 GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, month) - 1 AS p FROM g), k AS (SELECT month, CAST(CASE WHEN (p // 5) % 2 = 0 THEN p % 5 ELSE 4 - p % 5 END AS INTEGER) AS fold FROM r),
f AS (SELECT p1.*, fold FROM p1 JOIN k USING (month)), o AS (SELECT a.*, (x.s - h.s) / (x.n - h.n) AS pred FROM f a JOIN (SELECT segment, priority, sum(y) AS s, count(*) AS n FROM f GROUP BY ALL) x USING (segment, priority) JOIN (SELECT segment, priority, fold, sum(y) AS s, count(*) AS n FROM f GROUP BY ALL) h USING (segment, priority, fold))
SELECT month, fold, count(*) AS n, avg(abs(y - pred)) AS mae FROM o GROUP BY ALL""",
        mae=2,
    ),
    "exact_quantiles": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {', '.join(f"round(quantile_cont({c}, {q}), 4) AS {n}" for n, q in (('q01', 0.01), ('q37', 0.37), ('q50', 0.5), ('q99', 0.99)))} FROM (WITH {P1} SELECT * FROM p1)"""
        for c in ("y", "acctbal", "gappy")
    ),
    "numbered_rows": f"WITH {P1} SELECT row_id, row_number() OVER (ORDER BY CAST(ts AS DATE), row_id) - 1 AS by_day, row_number() OVER (ORDER BY priority, CAST(ts AS DATE), row_id) - 1 AS by_priority FROM p1",
    "class_scores": f"""WITH {P1}, {_FOLDED}, cls AS (SELECT DISTINCT status AS c FROM p1),
g AS (SELECT priority, status AS c, count(*) AS n FROM f1 GROUP BY ALL), h AS (SELECT priority, fold, status AS c, count(*) AS n FROM f1 GROUP BY ALL),
gt AS (SELECT priority, count(*) AS n FROM f1 GROUP BY ALL), ht AS (SELECT priority, fold, count(*) AS n FROM f1 GROUP BY ALL),
pr AS (SELECT f1.row_id, f1.status AS y, cls.c, (coalesce(g.n, 0) - coalesce(h.n, 0))::DOUBLE / (gt.n - ht.n) AS p FROM f1 CROSS JOIN cls JOIN gt USING (priority) JOIN ht USING (priority, fold)
  LEFT JOIN g ON g.priority = f1.priority AND g.c = cls.c LEFT JOIN h ON h.priority = f1.priority AND h.fold = f1.fold AND h.c = cls.c),
th AS (SELECT c, p, count(*) FILTER (y = c) AS pos, count(*) FILTER (y <> c) AS neg FROM pr GROUP BY c, p),
run AS (SELECT *, sum(neg) OVER (PARTITION BY c ORDER BY p) - neg AS below FROM th),
auc AS (SELECT c, sum(pos * below + 0.5::DOUBLE * pos * neg) / (sum(pos) * sum(neg)) AS auc FROM run GROUP BY c),
best AS (SELECT row_id, y, arg_min(c, (-p, c)) AS guess FROM pr GROUP BY row_id, y),
per AS (SELECT c, count(*) FILTER (y = c) AS n, count(*) FILTER (guess = c) AS m, count(*) FILTER (y = c AND guess = c) AS tp FROM best CROSS JOIN cls GROUP BY c),
rates AS (SELECT n, tp, coalesce(tp / nullif(m, 0), 0) AS pr, coalesce(tp / nullif(n, 0), 0) AS re FROM per WHERE n > 0 OR m > 0)
SELECT metric, round(score, 6) AS score FROM (
  SELECT 'roc_auc' AS metric, avg(auc) AS score FROM auc UNION ALL SELECT 'log_loss', avg(-ln(greatest(least(p, 1 - 1e-15), 1e-15))) FROM pr WHERE c = y
  UNION ALL SELECT 'accuracy', sum(tp) / sum(n) FROM rates UNION ALL SELECT 'f1_macro', avg(coalesce(2 * pr * re / nullif(pr + re, 0), 0)) FROM rates UNION ALL SELECT 'balanced_accuracy', avg(re) FILTER (n > 0) FROM rates)""",
    "class_chances": f"""WITH {P1}, cls AS (SELECT DISTINCT status AS c FROM t1), g AS (SELECT nation, segment, status AS c, count(*) AS n FROM t1 GROUP BY ALL), gt AS (SELECT nation, segment, count(*) AS n FROM t1 GROUP BY ALL),
w AS (SELECT c, (SELECT count(*) FROM t1 WHERE status = c)::DOUBLE / (SELECT count(*) FROM t1) AS p FROM cls),
pr AS (SELECT q1.row_id, w.c, CASE WHEN gt.n IS NULL THEN w.p ELSE coalesce(g.n, 0)::DOUBLE / gt.n END AS p FROM q1 CROSS JOIN w LEFT JOIN gt ON gt.nation IS NOT DISTINCT FROM q1.nation AND gt.segment IS NOT DISTINCT FROM q1.segment
  LEFT JOIN g ON g.nation IS NOT DISTINCT FROM q1.nation AND g.segment IS NOT DISTINCT FROM q1.segment AND g.c = w.c)
SELECT row_id, arg_min(c, (-p, c)) AS label, round(max(p) FILTER (c = 'F'), 6) AS p_F, round(max(p) FILTER (c = 'O'), 6) AS p_O, round(max(p) FILTER (c = 'P'), 6) AS p_P FROM pr GROUP BY row_id""",
    "scores_by_metric": f"""WITH {P1}, {_OOF}, e AS (SELECT *, y - pred AS r FROM oof)
SELECT metric, round(score, 4) AS score FROM (SELECT 'mae' AS metric, avg(abs(r)) AS score FROM e UNION ALL SELECT 'rmse', sqrt(avg(r * r)) FROM e UNION ALL SELECT 'r2', 1 - sum(r * r) / (var_pop(y) * count(*)) FROM e
UNION ALL SELECT 'block_mae', avg(m) FROM (SELECT avg(abs(r)) AS m FROM e GROUP BY month))""",
    "lag_features": f"""WITH {P3} SELECT a.month, a.nation, a.flag, round(b.y, 2) AS y_lag1, round(c.y, 2) AS y_lag12 FROM p3 a
LEFT JOIN p3 b ON b.nation = a.nation AND b.flag = a.flag AND b.rank = a.rank - 1 LEFT JOIN p3 c ON c.nation = a.nation AND c.flag = a.flag AND c.rank = a.rank - 12""",
    "prepared_features": f"""WITH {P1}, m AS (SELECT nation, quantile_cont(gappy, 0.5) AS g, quantile_cont(acctbal, 0.5) AS a FROM t1 GROUP BY nation), w AS (SELECT quantile_cont(gappy, 0.5) AS g, quantile_cont(acctbal, 0.5) AS a FROM t1),
st AS (SELECT segment, avg(y) AS mean, count(y) AS n FROM t1 GROUP BY segment), big AS (SELECT nation FROM t1 GROUP BY nation HAVING count(*) >= 0.05 * (SELECT count(nation) FROM t1))
SELECT row_id, round(coalesce(gappy, m.g, w.g), 3) AS gappy, round(coalesce(acctbal, m.a, w.a), 3) AS acctbal, round(st.mean, 3) AS segment_mean, st.n AS segment_count, CAST(priority = '1-URGENT' AS INTEGER) AS urgent,
CAST(nation NOT IN (SELECT nation FROM big) AS INTEGER) AS rare_nation FROM q1 CROSS JOIN w LEFT JOIN m USING (nation) LEFT JOIN st USING (segment)""",
    "class_sanity": f"""WITH {P1}, c AS (SELECT nation, status, count(*) AS n FROM t1 GROUP BY ALL), b AS (SELECT nation, arg_min(status, (-n, status)) AS pred FROM c GROUP BY nation),
p AS (SELECT pred FROM q1 JOIN b USING (nation)), t AS (SELECT status AS label, count(*) AS n FROM t1 GROUP BY 1), r AS (SELECT label, (SELECT count(*) FROM p WHERE pred = label)::DOUBLE / (SELECT count(*) FROM p) / (n / (SELECT count(*) FROM t1)) AS ratio FROM t)
SELECT 'sanity' AS stage, 'pass' AS status, 'labels given' AS reason, 'pred' AS "column", '0' AS value
UNION ALL SELECT 'sanity', CASE WHEN count(DISTINCT pred) <= 1 THEN 'fail' ELSE 'pass' END, 'more than one class', 'pred', CAST(count(DISTINCT pred) AS VARCHAR) FROM p
UNION ALL SELECT 'sanity', CASE WHEN ratio BETWEEN 0.6 AND 1.66 THEN 'pass' ELSE 'warn' END, 'share of a class', label, CAST(round(ratio, 4) AS VARCHAR) FROM r""",
    "leakage_risk": f"""WITH {P1}, f AS (SELECT count(*) AS fails FROM (SELECT abs(corr(y * 2, y)) AS r FROM t1 UNION ALL SELECT abs(corr(acctbal, y)) FROM t1) WHERE r > 0.98),
h AS (SELECT count(*) AS n FROM t1 JOIN q1 ON t1.priority = q1.priority AND t1.acctbal IS NOT DISTINCT FROM q1.acctbal AND t1.y * 2 = q1.y AND t1.y = q1.y)
SELECT CASE WHEN fails + CAST(n > 0 AS INTEGER) > 0 THEN 'high' ELSE 'low' END AS risk, CAST(fails + CAST(n > 0 AS INTEGER) AS BIGINT) AS fails, CAST(0 AS BIGINT) AS warns FROM f, h""",
    "text_target_corr": f"""WITH {P1}, c AS (SELECT *, dense_rank() OVER (ORDER BY priority) - 1 AS code FROM p1)
SELECT 'y' AS "column", CAST(regr_count(y, code) AS BIGINT) AS n, round(corr(y, code), 6) AS r FROM c UNION ALL SELECT 'acctbal', CAST(regr_count(acctbal, code) AS BIGINT), round(corr(acctbal, code), 6) FROM c""",
    "holdout_matches": f"WITH {P1} SELECT count(*) AS n, round(avg(CASE WHEN row_id % 3 = 0 OR y = 0 THEN 1.0 ELSE 0.0 END), 6) AS share FROM p1",
    "output_consistency": """SELECT 'task' AS stage, 'fail' AS status, 'output against kind' AS reason, 'y' AS "column", 'regression' AS value UNION ALL SELECT 'task', 'pass', 'output against kind', 'status', 'multiclass'
UNION ALL SELECT 'task', 'fail', 'output against kind', 'priority', 'multiclass'""",
    "first_of_group": f"WITH {P1} SELECT nation, segment, arg_min(row_id, (ts, row_id)) AS row_id FROM p1 GROUP BY nation, segment",
    "hand_in": f"WITH {P1}, m AS (SELECT nation, avg(y) AS y FROM t1 GROUP BY nation) SELECT row_id, CASE WHEN row_id % 11 <> 0 THEN CAST(round(m.y) AS BIGINT) END AS y FROM q1 LEFT JOIN m USING (nation)",
    "folds_scored": f"WITH {P1} SELECT row_id, CAST({_hash('row_id', 's')} % 4 AS INTEGER) AS fold, priority = '1-URGENT' AS scored FROM p1",
    "build_features": f"""WITH {P1} SELECT "column", role, reason, CAST(filled AS BIGINT) AS filled FROM (
  SELECT unnest(['row_id', 'y', 'outcome_code', 'same', 'month', 'ts']) AS "column", 'dropped' AS role, unnest(['row id', 'target', 'outcome word in its name', 'constant', 'values that predict does not share', 'time']) AS reason, NULL AS filled
  UNION ALL SELECT unnest(['priority', 'status', 'segment', 'nation']), 'category', NULL, NULL
  UNION ALL SELECT 'gappy', 'number', NULL, count(gappy) FROM q1 UNION ALL SELECT 'acctbal', 'number', NULL, count(acctbal) FROM q1 UNION ALL SELECT 'few', 'number', NULL, count(*) FROM q1
  UNION ALL SELECT t || '__' || p, 'number', NULL, (SELECT count(ts) FROM q1) FROM (SELECT unnest(['ts', 'month']) AS t), (SELECT unnest(['year', 'day', 'quarter', 'week', 'weekend', 'month', 'month_sin', 'month_cos', 'weekday', 'weekday_sin', 'weekday_cos']) AS p))""",
    "hist_boosting_round": f"""WITH {_TREES}, ks AS (SELECT unnest([0, 1, 2]) AS k), pr AS (SELECT k, (SELECT count(*) FILTER (label = k)::DOUBLE / count(*) FROM tr) AS p FROM ks),
n0 AS (SELECT row_id, k, p - (label = k)::INT AS g, p * (1 - p) AS h, 0 AS node, 0.0::DOUBLE AS v FROM tr, pr), {_boost_level("b1", "n0")}, {_boost_step("n1", "n0", "b1")}, {_boost_level("b2", "n1")}, {_boost_step("n2", "n1", "b2")},
e AS (SELECT row_id, k, exp(ln(p) + v) AS e FROM n2 JOIN pr USING (k))
SELECT row_id, round(max(e) FILTER (k = 0) / sum(e), 6) AS p0, round(max(e) FILTER (k = 1) / sum(e), 6) AS p1, round(max(e) FILTER (k = 2) / sum(e), 6) AS p2 FROM e GROUP BY 1""",
    "extra_trees_stumps": f"""WITH {_TREES}, ts AS (SELECT unnest(generate_series(0, 7)) AS t), fs AS (SELECT f, min(x) AS lo, max(x) AS hi FROM lf GROUP BY 1),
tried AS (SELECT t, f, lo, hi FROM ts, fs QUALIFY row_number() OVER (PARTITION BY t ORDER BY {_draw(8, "f")}, f) <= 2),
cuts AS (SELECT t, f, lo + {_draw(7, "f")} / 4294967296.0::DOUBLE * (hi - lo) AS cut FROM tried WHERE lo < hi),
c AS (SELECT t, f, cut, label AS k, (x IS NULL OR x <= cut) AS l, count(*) AS n FROM lf JOIN cuts USING (f) GROUP BY ALL),
a AS (SELECT t, f, cut, k, coalesce(sum(n) FILTER (l), 0) AS sl, sum(n) AS st FROM c GROUP BY ALL), z AS (SELECT *, sum(sl) OVER (PARTITION BY t, f) AS nl, sum(st) OVER (PARTITION BY t, f) AS n FROM a),
sc AS (SELECT t, f, cut, max(nl) AS nl, max(n) AS n, sum(sl * sl / nl + (st - sl) * (st - sl) / (n - nl)) AS score, sum(st * st / n) AS was FROM z WHERE nl >= 2 AND n - nl >= 2 GROUP BY ALL),
best AS (SELECT * FROM sc WHERE score > was * (1 + 1e-12) QUALIFY row_number() OVER (PARTITION BY t ORDER BY CAST(score AS FLOAT) DESC, f) = 1),
kk AS (SELECT unnest([0, 1, 2]) AS k), w AS (SELECT k, (SELECT count(*) FILTER (label = k) / count(*) FROM tr) AS p FROM kk),
v AS (SELECT b.t, kk.k, coalesce(z.sl, 0) / b.nl AS pl, (coalesce(z.st, 0) - coalesce(z.sl, 0)) / (b.n - b.nl) AS pr FROM best b CROSS JOIN kk LEFT JOIN z ON z.t = b.t AND z.f = b.f AND z.k = kk.k),
r AS (SELECT tr.row_id, w.k, avg(CASE WHEN b.t IS NULL THEN w.p WHEN l.x IS NULL OR l.x <= b.cut THEN pl ELSE pr END) AS p
  FROM tr CROSS JOIN ts CROSS JOIN w LEFT JOIN best b ON b.t = ts.t LEFT JOIN lf l ON l.row_id = tr.row_id AND l.f = b.f LEFT JOIN v ON v.t = ts.t AND v.k = w.k GROUP BY ALL)
SELECT row_id, round(max(p) FILTER (k = 0), 6) AS p0, round(max(p) FILTER (k = 1), 6) AS p1, round(max(p) FILTER (k = 2), 6) AS p2 FROM r GROUP BY 1""",
    "gram_classes": f"""WITH {_TWO} SELECT a, b, round(value, 4) AS value FROM (SELECT 'a' AS a, 'a' AS b, aa AS value FROM gr UNION ALL SELECT 'a', 'b', ab FROM gr UNION ALL SELECT 'a', 'target', ta FROM gr
UNION ALL SELECT 'b', 'b', bb FROM gr UNION ALL SELECT 'b', 'target', tb FROM gr)""",
    "stack_classes": f"""WITH {_TWO}, w AS (SELECT (ta * bb - tb * ab) / (aa * bb - ab * ab) AS wa, (tb * aa - ta * ab) / (aa * bb - ab * ab) AS wb, ta * ta / aa > tb * tb / bb AS a_first FROM gr),
v AS (SELECT CASE WHEN wa >= 0 AND wb >= 0 THEN wa / (wa + wb) WHEN a_first THEN 1.0 ELSE 0.0 END AS va FROM w),
cand AS (SELECT 'a' AS candidate, 0 AS ord, row_id, y, c, a AS p FROM ab UNION ALL SELECT 'b', 1, row_id, y, c, b FROM ab UNION ALL SELECT 'stack', 2, row_id, y, c, a * va + b * (1 - va) FROM ab, v),
best AS (SELECT candidate, ord, row_id, y, arg_min(c, (-p, c)) AS guess FROM cand GROUP BY ALL),
per AS (SELECT candidate, ord, c, count(*) FILTER (y = c) AS n, count(*) FILTER (guess = c) AS m, count(*) FILTER (y = c AND guess = c) AS tp FROM best CROSS JOIN cls GROUP BY ALL),
f AS (SELECT candidate, ord, avg(CASE WHEN tp = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (n + m) END) AS score FROM per WHERE n > 0 OR m > 0 GROUP BY ALL)
SELECT candidate, round(score, 6) AS score, ord = (SELECT min(ord) FROM f WHERE score >= (SELECT max(score) FROM f) - 1e-9) AS kept FROM f""",
    "baselines": f"""WITH {P1}, g AS (SELECT nation, segment, avg(y) AS m FROM t1 GROUP BY ALL),
pv AS (SELECT 'global_mean' AS baseline, q1.y, (SELECT avg(y) FROM t1) AS p FROM q1 UNION ALL SELECT 'global_median', y, (SELECT quantile_cont(y, 0.5) FROM t1) FROM q1
  UNION ALL SELECT 'group_mean', q1.y, coalesce(m, (SELECT avg(y) FROM t1)) FROM q1 LEFT JOIN g USING (nation, segment)),
c AS (SELECT status AS l, count(*) AS n FROM t1 GROUP BY 1), r AS (SELECT l, n, sum(n) OVER (ORDER BY l) / (SELECT count(*) FROM t1) AS upto FROM c), top AS (SELECT l FROM c ORDER BY n DESC, l LIMIT 1),
gm AS (SELECT nation, status AS l FROM t1 GROUP BY nation, status QUALIFY row_number() OVER (PARTITION BY nation ORDER BY count(*) DESC, status) = 1),
ps AS (SELECT 'most_frequent' AS baseline, status AS y, (SELECT l FROM top) AS p FROM q1 UNION ALL SELECT 'group_mode', status, coalesce(l, (SELECT l FROM top)) FROM q1 LEFT JOIN gm USING (nation)
  UNION ALL SELECT 'stratified', status, (SELECT min(l) FROM r WHERE {_hash("row_id", "draw")} / 4294967296.0::DOUBLE < upto) FROM q1),
cl AS (SELECT y AS k FROM ps UNION SELECT p FROM ps), per AS (SELECT baseline, k, count(*) FILTER (y = k) AS n, count(*) FILTER (p = k) AS m, count(*) FILTER (y = k AND p = k) AS tp FROM ps, cl GROUP BY ALL)
SELECT baseline, metric, round(score, 4) AS score FROM (SELECT baseline, 'mae' AS metric, avg(abs(y - p)) AS score FROM pv GROUP BY 1 UNION ALL SELECT baseline, 'rmse', sqrt(avg((y - p) * (y - p))) FROM pv GROUP BY 1
  UNION ALL SELECT baseline, 'accuracy', avg((y = p)::INT) FROM ps GROUP BY 1 UNION ALL SELECT baseline, 'f1_macro', avg(CASE WHEN tp = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (n + m) END) FROM per WHERE n > 0 OR m > 0 GROUP BY 1)""",
    "target_transforms": f"""WITH {P1}, z AS (SELECT y, ln(y) AS steep, CASE WHEN row_id % 7 <> 0 THEN sqrt(y) END AS root, -(y ** 3) AS down, floor(y / 1000) AS coarse, acctbal, gappy FROM p1),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS k, {c}::DOUBLE AS x, y FROM z WHERE {c} IS NOT NULL AND y IS NOT NULL" for c in ("steep", "root", "down", "coarse", "acctbal", "gappy"))}),
r AS (SELECT k, rank() OVER (PARTITION BY k ORDER BY x) + (count(*) OVER (PARTITION BY k, x) - 1) / 2 AS rx, rank() OVER (PARTITION BY k ORDER BY y) + (count(*) OVER (PARTITION BY k, y) - 1) / 2 AS ry FROM l)
SELECT k AS "column", 'rises or falls with the target throughout' AS reason, round(corr(rx, ry), 5) AS value FROM r GROUP BY k HAVING abs(corr(rx, ry)) >= 0.9999 UNION ALL SELECT 'y_log', 'named as a transform of the target', NULL""",
    "rank_correlations": f"""WITH {P1}, z AS (SELECT y, floor(acctbal / 1000) AS coarse, gappy, length(segment) AS few FROM p1),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS k, {c}::DOUBLE AS x, y FROM z WHERE {c} IS NOT NULL AND y IS NOT NULL" for c in ("coarse", "gappy", "few"))}),
r AS (SELECT k, rank() OVER (PARTITION BY k ORDER BY x) + (count(*) OVER (PARTITION BY k, x) - 1) / 2 AS rx, rank() OVER (PARTITION BY k ORDER BY y) + (count(*) OVER (PARTITION BY k, y) - 1) / 2 AS ry FROM l)
SELECT k AS "column", round(corr(rx, ry), 6) AS rho FROM r GROUP BY k""",
    "fold_strategies": f"""WITH {P1}, c AS (SELECT count(DISTINCT month) AS months, count(DISTINCT nation) AS nations, count(DISTINCT day(ts)) AS days, count(ts) AS times, count(*) AS n FROM p1),
l AS (SELECT count(*) AS labels, min(n) AS rarest FROM (SELECT status, count(*) AS n FROM p1 WHERE row_id % 3 = 0 GROUP BY 1)),
r AS (SELECT 'expanding' AS strategy, CASE WHEN (months - 1) // 100 < 1 THEN 'too few periods before the first block' END AS reason, least(5, (months - 1) // 100) AS folds FROM c
UNION ALL SELECT 'group', CASE WHEN nations < 2 THEN 'fewer than two groups' END, least(5, nations) FROM c UNION ALL SELECT 'group_holdout', CASE WHEN nations < 3 THEN 'fewer than three groups' END, 1 FROM c
UNION ALL SELECT 'within_period', CASE WHEN days < 2 THEN 'one value within periods' END, 1 FROM c UNION ALL SELECT 'time_tail', CASE WHEN times < 2 THEN 'fewer than two times' END, 1 FROM c
UNION ALL SELECT 'stratified', CASE WHEN labels < 2 THEN 'fewer than two labels' WHEN rarest < 5 THEN 'a label with fewer rows than folds' END, 5 FROM l UNION ALL SELECT 'kfold', CASE WHEN n < 2 THEN 'fewer than two rows' END, least(5, n) FROM c)
SELECT strategy, reason IS NULL AS feasible, reason, CAST(CASE WHEN reason IS NULL THEN folds END AS INTEGER) AS folds, strategy = 'group' AS chosen FROM r""",
    "folds_fallback": f"""WITH {P1}, e AS (SELECT quantile_cont(day(ts), 0.8) AS edge FROM p1) SELECT row_id, CASE WHEN coalesce(day(ts) >= edge, false) THEN 0 ELSE -1 END AS fold, true AS scored, 'within_period' AS strategy FROM p1, e""",
    "text_weights": f"""WITH {P4}, w AS (SELECT row_id, y, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2) AS w FROM p4),
t AS (SELECT row_id, y, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
c AS (SELECT row_id, y, term, count(*) AS tf FROM t GROUP BY ALL),
v AS (SELECT term, ln((1.0 + (SELECT count(*) FROM p4 WHERE y IS NOT NULL)) / (1.0 + count(*))) + 1.0 AS idf FROM c WHERE y IS NOT NULL GROUP BY term HAVING count(*) >= 2 ORDER BY count(*) DESC, term LIMIT 400),
x AS (SELECT row_id, (1 + ln(tf)) * idf AS w FROM c JOIN v USING (term) WHERE y IS NULL),
n AS (SELECT row_id, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS w FROM x) SELECT row_id, count(*) AS terms, round(sum(w), 6) AS total, round(max(w), 6) AS top FROM n GROUP BY 1""",
    "heteroscedasticity": f"""WITH {P1}, {_OOF}, h AS (SELECT count(*) AS n, corr(pred, abs(y - pred)) AS c FROM oof WHERE pred IS NOT NULL AND y IS NOT NULL)
SELECT n, round(c, 6) AS corr, CASE WHEN c > 0.5 THEN 'strong' WHEN c > 0.25 THEN 'moderate' ELSE 'low' END AS note FROM h""",
    "prediction_shift": f"""WITH {P1}, {_OOF}, q AS (SELECT quantile_cont(y, 0.5) AS a50, quantile_cont(y, 0.95) AS a95, quantile_cont(pred, 0.5) AS b50, quantile_cont(pred, 0.95) AS b95 FROM oof)
SELECT round(b50 / abs(a50), 4) AS median_ratio, round(b50 - a50, 4) AS p50_delta, round(b95 - a95, 4) AS p95_delta FROM q""",
    "spread_ranks": f"""WITH {P1}, s AS (SELECT stddev(month(ts)) AS m, stddev(isodow(ts) - 1) AS w, stddev(CAST(substr(priority, 1, 1) AS INTEGER)) AS u, stddev(row_id % 7) AS g FROM p1)
SELECT pair, round(r, 6) AS r FROM (SELECT 'month_no_x_urgency' AS pair, m * u AS r FROM s UNION ALL SELECT 'month_no_x_digit', m * g FROM s UNION ALL SELECT 'weekday_x_urgency', w * u FROM s UNION ALL SELECT 'weekday_x_digit', w * g FROM s) ORDER BY r DESC, pair LIMIT 3""",
    "hand_in_types": """SELECT 'hand-in' AS stage, 'pass' AS status, 'type of predictions' AS reason, 'v' AS "column", '0' AS value UNION ALL SELECT 'hand-in', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, 'type of predictions', 'odd', CAST(count(*) AS VARCHAR) FROM orders
UNION ALL SELECT 'hand-in', 'fail', 'type of predictions', 'label', 'numeric'""",
}
