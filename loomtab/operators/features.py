"""Feature columns: calendar, interactions, imputation, rare levels, text terms, target transforms, label codes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtab.functions.exprs import agg_columns, correlation, name_tokens, number
from loomtab.operators.quantiles import exact_quantiles


def calendar(df: DataFrame, time: str, time_of_day: bool = False) -> DataFrame:
    """df with col__part columns; parts that turn round come with sine and cosine. A null time gives nulls."""
    c = F.col(time)
    turn = {"month": (F.month(c), 12), "weekday": (F.weekday(c), 7)} | ({"hour": (F.hour(c), 24)} if time_of_day else {})
    parts = {"year": F.year(c), "day": F.dayofmonth(c), "quarter": F.quarter(c), "week": F.weekofyear(c), "weekend": (F.weekday(c) >= 5).cast("int")}
    for name, (value, period) in turn.items():
        angle = 2 * math.pi * value / period
        parts |= {name: value, f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return df.withColumns({f"{time}__{k}": v for k, v in parts.items()})


def interaction_ranks(df: DataFrame, target: str, times: list[str], others: list[str], top: int = 6) -> DataFrame:
    """pair, r: products a_x_b of the strongest correlation with the target, nulls as 0."""
    names = {f"{a}_x_{b}": F.coalesce(number(a), F.lit(0.0)) * F.coalesce(number(b), F.lit(0.0)) for a in times for b in others}
    wide = df.select(number(target).alias("__y"), *[e.alias(n) for n, e in names.items()])
    rows = agg_columns(wide, list(names), lambda c: [("r", correlation(F.when(F.col("__y").isNotNull(), F.col(c)), "__y"))], 12)
    return rows.select(F.col("column").alias("pair"), "r").filter(F.col("r").isNotNull() & ~F.isnan("r")).orderBy(F.desc(F.abs("r")), "pair").limit(top)


def spread_ranks(df: DataFrame, times: list[str], others: list[str], top: int = 6) -> DataFrame:
    """pair, r: the same products by the standard deviations of their two sides multiplied, for want of a target that varies."""
    one = df.agg(*[F.coalesce(F.stddev(number(c)), F.lit(0.0)).alias(c) for c in dict.fromkeys([*times, *others])])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"{a}_x_{b}").alias("pair"), (F.col(a) * F.col(b)).alias("r")) for a in times for b in others])).alias("x")
    return one.select(pairs).select("x.*").orderBy(F.desc("r"), "pair").limit(top)


def ranked_interactions(df: DataFrame, target: str | None, times: list[str], others: list[str], top: int = 6, least: int = 5) -> DataFrame:
    """interaction_ranks where the target has `least` numbers that vary, else spread_ranks."""
    if target is not None:
        y = number(target)
        told = df.agg(F.count(y).alias("n"), F.stddev(y).alias("s")).first()
        if told.n >= least and (told.s or 0) > 0:
            return interaction_ranks(df, target, times, others, top)
    return spread_ranks(df, times, others, top)


def add_interactions(df: DataFrame, ranks: DataFrame) -> DataFrame:
    """df with the ranked products as columns; ranks has a handful of rows."""
    rows = [r.pair for r in ranks.collect()]
    # A name may itself hold the sign between the two: the cut is where both sides are columns.
    pairs = [next((p[:i], p[i + 3 :]) for i in range(len(p)) if p[i : i + 3] == "_x_" and p[:i] in df.columns and p[i + 3 :] in df.columns) for p in rows]
    return df.withColumns({f"{a}_x_{b}": F.coalesce(number(a), F.lit(0.0)) * F.coalesce(number(b), F.lit(0.0)) for a, b in pairs})


def median_impute(train: DataFrame, df: DataFrame, names: list[str], approx: bool = False) -> DataFrame:
    """df with missing numbers replaced by train's medians (0 where train has none)."""
    if approx:
        row = train.agg(*[F.percentile_approx(number(c), 0.5).cast("double") for c in names]).first()
        fit = dict(zip(names, row, strict=True))
    else:
        fit = {c: q[0] for c, q in exact_quantiles(train, names, [0.5]).items()}
    return df.select(*[F.coalesce(number(c), F.lit(fit[c] or 0.0)).alias(c) if c in names else c for c in df.columns])


def mode_impute(train: DataFrame, df: DataFrame, names: list[str]) -> DataFrame:
    """df with missing values replaced by train's most frequent one, the smallest among equals."""
    fit = train.agg(*[F.mode(c, True).alias(f"__{c}") for c in names])
    return df.join(fit).select(*[F.coalesce(c, f"__{c}").alias(c) if c in names else c for c in df.columns])


def level_map(df: DataFrame, name: str, rare: float = 0.01, most: int = 100) -> DataFrame:
    """value, n, level: frequent levels keep their name, rare and overflowing ones fold into one."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__t"))
    # Only levels above the share can be ranked among the kept: at most 1 / rare of them.
    kept = counts.join(total).filter(F.col("n") >= rare * F.col("__t"))
    kept = kept.withColumn("__k", F.row_number().over(Window.orderBy(F.desc("n"), "value"))).filter(F.col("__k") <= most).select("value", F.col("value").alias("level"))
    return counts.join(kept, "value", "left").select("value", "n", F.coalesce("level", F.lit("__rare__")).alias("level"))


def fold_levels(df: DataFrame, levels: DataFrame, name: str) -> DataFrame:
    """df with a column's levels folded by a level map; unseen values are rare, null stays null."""
    kept = levels.filter("level <> '__rare__'").select(F.col("value").alias("__v"), "level")
    out = df.join(kept, F.col(name) == F.col("__v"), "left")
    return out.select(*[F.when(F.col(name).isNotNull(), F.coalesce("level", F.lit("__rare__"))).alias(c) if c == name else df[c] for c in df.columns])


def text_words(text: str) -> Column:
    """Words of two letters or more, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)


def term_statistics(df: DataFrame, text: str, row_id: str, terms: int = 400, least: int = 2) -> DataFrame:
    """term, df, idf: words and pairs of words in at least `least` rows, the most frequent first, smoothed idf."""
    tokens = df.select(row_id, text_words(text).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("w", F.lit(1), n), F.slice("w", F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    each = tokens.select(F.explode(F.array_distinct(F.concat("w", pairs))).alias("term"))
    counts = each.groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= least)
    total = df.agg(F.count("*").alias("__n"))
    top = counts.orderBy(F.desc("df"), "term").limit(terms)
    return top.join(total).select("term", "df", (F.log((1.0 + F.col("__n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def text_svd(df: DataFrame, text: str, row_id: str, terms: int = 400, k: int = 16) -> DataFrame:
    """row_id, features: TF-IDF (sub-linear, L2) of words and pairs of words, projected on its first k singular directions.

    The vocabulary is the `terms` most frequent in all, equal ones by name, of those in two rows or more. Fewer directions than
    asked for are filled up with zeros. The Gramian of the terms is summed over tasks and is terms x terms, so its decomposition
    does not grow with the rows. Texts are read twice, for the frequent words and for each row's counts of what is made of them
    (once more where frequent_words has to count everything); the counts stay on the executors' disks until
    spark.catalog.clearCache(), and are made anew where they are gone.
    """
    from loomtab.operators.terms import frequent_words, row_terms, top_terms

    words, floor = frequent_words(df, text, terms)
    counted = row_terms(df, text, row_id, words).persist(StorageLevel.DISK_ONLY)
    top, total = top_terms(counted, words, terms, floor)
    top = sorted(top, key=lambda t: t[1])
    at, idf = np.array([t[1] for t in top], np.int64), np.array([math.log((total + 1) / (t[3] + 1)) + 1 for t in top])
    v = np.zeros((len(top), k))
    width = min(k, len(top))
    v[:, :width] = np.linalg.eigh(_gramian(counted, at, idf))[1][:, ::-1][:, :width]
    names = [f"svd{j:02d}" for j in range(k)]

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                got = _unit_rows(batch, at, idf) @ v
                yield pa.RecordBatch.from_arrays([batch.column(row_id), *(pa.array(got[:, j]) for j in range(k))], [row_id, *names])

    return counted.mapInArrow(run, T.StructType([df.schema[row_id], *(T.StructField(n, T.DoubleType()) for n in names)]))


def _unit_rows(batch: pa.RecordBatch, at: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of the rows' terms that are in `at` (ascending), each row scaled to length 1."""
    out = np.zeros((batch.num_rows, len(at)))
    if len(at):
        seen, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("__at", "__n"))
        rows = np.repeat(np.arange(batch.num_rows), batch.column("__at").value_lengths().to_numpy(zero_copy_only=False))
        place = np.minimum(np.searchsorted(at, seen), len(at) - 1)
        known = at[place] == seen
        out[rows[known], place[known]] = (1 + np.log(n[known])) * idf[place[known]]
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)
    return out


def _gramian(counted: DataFrame, at: np.ndarray, idf: np.ndarray) -> np.ndarray:
    terms = len(at)

    def sums(batches):
        total = np.zeros((terms, terms))
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                x = _unit_rows(batch.slice(a, 1000), at, idf)
                total += x.T @ x
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel()[places])], ["place", "x"])

    parts = counted.select("__at", "__n").mapInArrow(sums, "place long, x double")
    out = np.zeros(terms * terms)
    for r in parts.groupBy("place").agg(F.sum("x").alias("x")).collect():  # terms x terms at most
        out[r.place] = r.x
    return out.reshape(terms, terms)


def transform_choice(df: DataFrame, target: str) -> DataFrame:
    """n, skew, transform: log1p above 1.5, sqrt above 0.5, of a non-negative target of more than 10 rows."""
    from loomtab.functions.exprs import adjusted_skew

    one = df.select(number(target).alias("y")).agg(F.count("y").alias("n"), adjusted_skew("y").alias("skew"), F.min("y").alias("low"))
    able = (F.col("n") > 10) & (F.col("low") >= 0)
    return one.select("n", "skew", F.when(able & (F.col("skew") > 1.5), "log1p").when(able & (F.col("skew") > 0.5), "sqrt").otherwise("none").alias("transform"))


def transformed(df: DataFrame, target: str, how: str, out: str) -> DataFrame:
    return df.withColumn(out, {"log1p": F.log1p, "sqrt": F.sqrt, "none": lambda c: c}[how](F.col(target)))


def inverted(df: DataFrame, name: str, how: str) -> DataFrame:
    return df.withColumn(name, {"log1p": F.expm1, "sqrt": lambda c: c * c, "none": lambda c: c}[how](F.col(name)))


def lags(df: DataFrame, keys: list[str], rank: str, value: str, steps: tuple[int, ...] = (1, 12)) -> DataFrame:
    """df with value_lag<n> for each step: the value of the same series n periods before, null where that period is missing.

    rank numbers the periods; of several rows of a series and period the least value counts."""
    past = df.groupBy(*keys, F.col(rank).alias("__r")).agg(F.min(value).alias("__v"))
    for n in steps:
        from loomtab.operators.relate import same

        moved = past.select(*keys, (F.col("__r") + n).alias(rank), F.col("__v").alias(f"{value}_lag{n}"))
        df = df.alias("l").join(moved.alias("r"), same("l", "r", [*keys, rank]), "left").select("l.*", f"r.{value}_lag{n}")
    return df


def target_codes(df: DataFrame, target: str, out: str) -> DataFrame:
    """df with the target as numbers for correlations: itself where all of it is numeric, else codes by its order as text."""
    odd = df.filter(F.col(target).isNotNull() & number(target).isNull()).isEmpty()
    if odd:
        return df.withColumn(out, number(target))
    codes = label_codes(df, target).toDF("__l", "__code")
    return df.join(F.broadcast(codes), F.col(target).cast("string") == F.col("__l"), "left").withColumn(out, F.col("__code").cast("double")).drop("__l", "__code")


def label_codes(df: DataFrame, target: str) -> DataFrame:
    """label, code: dense codes from 0 by the label's string form."""
    labels = df.filter(F.col(target).isNotNull()).select(F.col(target).cast("string").alias("label")).distinct()
    return labels.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("code"))  # over labels


#: Own choice: labels that mean yes, the surest first.
POSITIVE = ("1", "1.0", "true", "yes", "y", "positive")


def positive_label(labels: DataFrame, yes: tuple[str, ...] = POSITIVE) -> DataFrame:
    """label: the positive class: a word for yes, the earlier in the list the better, else the last by order."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, yes)), F.lower("label")), F.lit(0))
    return labels.select("label", F.when(place > 0, 100 - place).otherwise(0).alias("__p")).agg(F.max_by("label", F.struct("__p", "label")).alias("label"))


def choose_columns(train: DataFrame, predict: DataFrame, target: str, row_id: str, keys: list[str] = (), substring: bool = False) -> DataFrame:
    """column, reason: every train column with why it is no feature (null: it is one)."""
    from loomtab.operators.profile import LEAK_WORDS

    def reason(c: str) -> str | None:
        plain = "".join(name_tokens(c))
        if c == target:
            return "target"
        if c == row_id:
            return "row id"
        if plain == "".join(name_tokens(target)):
            return "named as the target"
        hit = any(w in c.lower() for w in LEAK_WORDS) if substring else bool(set(name_tokens(c)) & set(LEAK_WORDS))
        if hit and c not in keys:
            return "outcome word in its name"
        return None if c in predict.columns else "absent from predict"

    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(reason(c)).cast("string").alias("reason")) for c in train.columns])).alias("x")
    return train.sparkSession.range(1).select(rows).select("x.*")


def valid_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(number(target).isNotNull())


def in_scope(df: DataFrame, name: str, values: DataFrame) -> DataFrame:
    """Rows whose value is among those scored."""
    return df.join(values.select(name).distinct(), name, "left_semi")


