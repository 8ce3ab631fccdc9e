"""Exact quantiles of whole columns and of groups, without a task that holds a column's or a hot group's values.

A sketch gives bounds near each rank that is asked for; rows are counted against them, and only what lies between is put in
order, as distinct values with their counts. Columns: a sketch, rounds of narrowing while too much lies between, and one pass
that counts what lies below and orders the rest. Groups: those of few rows are ordered as they are; hot ones are cut into
slots by bounds of their own, and only the slots that hold ranks are ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import long_form, number

#: Bounds of a sketch.
SLOTS = 512
#: Rows that are put in order in one task.
ORDERED = 50_000
#: Rows of one group that are put in order in one task.
HOT = 1_000_000


def order_statistics(df: DataFrame, names: Sequence[str], ranks, slots: int = SLOTS, ordered: int = ORDERED) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """Values by column and 0-based rank, and how many numbers a column has. ranks(n) gives the ranks that are asked for of a column with n numbers.

    Two jobs for columns of up to ordered * slots / 4 numbers, and one more for each further factor of slots / 4."""
    names, grid = list(dict.fromkeys(names)), [i / slots for i in range(slots + 1)]
    # The columns are cut out of their plan once; what a lost executor held is computed again.
    values = long_form(df.select(*[number(c).alias(c) for c in names]), names, (), "v", "double").filter("v IS NOT NULL").persist()
    try:
        sketch = F.percentile_approx("v", grid, 20 * slots).alias("grid")
        ends = {r.column: r for r in values.groupBy("column").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), sketch).collect()}
        sizes = {c: ends[c].n if c in ends else 0 for c in names}
        found: dict[str, dict[int, float]] = {c: {} for c in names}
        # Brackets: column, least and greatest value, rows below, rows inside, ranks, sketch of what is inside.
        todo = [(c, r.low, r.high, 0, r.n, sorted(set(ranks(r.n))), r.grid) for c, r in ends.items()]
        while todo:
            near = [b for t in todo for b in (_brackets(*t, slots) if t[4] > ordered else [t])]
            narrow = [b for b in near if b[4] > ordered and b[1] < b[2]]
            at, todo = _narrowed(values, narrow, sketch) if narrow else ([], [])
            for column, rank, value in at + _ordered(values, [b for b in near if b not in narrow]):
                found[column][rank] = value
            # A sketch that led astray: what is still missing is looked for among all of the column's distinct values.
            left = {c: [k for k in ranks(sizes[c]) if k not in found[c] and not any(t[0] == c and k in t[5] for t in todo)] for c in ends}
            for column, rank, value in _ordered(values, [(c, ends[c].low, ends[c].high, 0, 0, ks, None) for c, ks in left.items() if ks]):
                found[column][rank] = value
    finally:
        values.unpersist()
    return found, sizes


def _brackets(column: str, low: float, high: float, below: int, inside: int, asked: list[int], grid: list[float], slots: int) -> list[tuple]:
    """Brackets around each rank, from the sketch of a wider one, with the rows that each is likely to hold."""
    out: dict[tuple[float, float], list[int]] = {}
    for k in asked:
        at = (k - below) * slots / inside
        lo, hi = math.floor(at) - 1, math.ceil(at) + 1
        out.setdefault((grid[lo] if lo > 0 else low, grid[hi] if hi < slots else high), []).append(k)
    return [(column, a, b, None, math.ceil(4 * inside / slots), ks, None) for (a, b), ks in out.items()]


def _narrowed(values: DataFrame, brackets: list[tuple], sketch: Column) -> tuple[list[tuple[str, int, float]], list[tuple]]:
    """Brackets that hold too much, counted and sketched anew in one job: the ranks that fall on their ends, and brackets of what
    lies strictly between for the others. Ties of an end are counted, not ordered, so every round leaves fewer rows."""
    near = values.sparkSession.createDataFrame([(i, *b[:3]) for i, b in enumerate(brackets)], "id int, column string, low double, high double")
    held = values.join(F.broadcast(near), "column").filter("v <= high")
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    parts = held.select("id", (v < low).alias("below"), (v == low).alias("at_low"), (v == high).alias("at_high"), F.when((v > low) & (v < high), v).alias("v"))
    counts = [F.count_if(c).alias(c) for c in ("below", "at_low", "at_high")]
    rows = {r.id: r for r in parts.groupBy("id").agg(*counts, F.count("v").alias("inside"), F.min("v").alias("least"), F.max("v").alias("most"), sketch).collect()}
    found, todo = [], []
    for i, (column, lo, hi, _, _, asked, _) in enumerate(brackets):
        if (r := rows.get(i)) is None:
            continue
        first = r.below + r.at_low
        found += [(column, k, lo) for k in asked if r.below <= k < first] + [(column, k, hi) for k in asked if first + r.inside <= k < first + r.inside + r.at_high]
        if mine := [k for k in asked if first <= k < first + r.inside]:
            todo.append((column, r.least, r.most, first, r.inside, mine, r.grid))
    return found, todo


def _ordered(values: DataFrame, brackets: list[tuple]) -> list[tuple[str, int, float]]:
    """(column, rank, value) of brackets of few distinct values: one job, in which what lies below a bracket is one cell."""
    if not brackets:
        return []
    spark = values.sparkSession
    near = spark.createDataFrame([(i, *b[:3]) for i, b in enumerate(brackets)], "id int, column string, low double, high double")
    asked = spark.createDataFrame([(i, k) for i, b in enumerate(brackets) for k in b[5]], "id int, rank long")
    held = values.join(F.broadcast(near), "column").filter("v <= high")
    cells = held.groupBy("id", "column", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("id").orderBy(F.col("v").asc_nulls_first()))
    at = cells.withColumn("upto", upto).filter("v IS NOT NULL").join(F.broadcast(asked), "id").filter("rank < upto AND rank >= upto - n")
    return [(r.column, r.rank, r.v) for r in at.select("column", "rank", "v").collect()]


def exact_quantiles(df: DataFrame, names: Sequence[str], qs: Sequence[float], **options) -> dict[str, list[float | None]]:
    """The quantiles of each column, as `percentile` interpolates them; None for a column without numbers."""
    values, sizes = order_statistics(df, names, lambda n: [k for q in qs for k in _ranks(n, q)], **options)
    return {c: [_between(values[c], sizes[c], q) for q in qs] for c in names}


def _ranks(n: int, q: float) -> tuple[int, int]:
    at = (n - 1) * q
    return math.floor(at), math.ceil(at)


def _between(values: dict[int, float], n: int, q: float) -> float | None:
    if not n:
        return None
    at, (low, high) = (n - 1) * q, _ranks(n, q)
    if low == high or values[low] == values[high]:
        return values[low]
    return (high - at) * values[low] + (at - low) * values[high]


def column_quantiles(df: DataFrame, names: Sequence[str], qs: dict[str, float], **options) -> DataFrame:
    """column and a quantile by each name: one row for each column."""
    got = exact_quantiles(df, names, list(qs.values()), **options)
    schema = "column string, " + ", ".join(f"`{n}` double" for n in qs)
    return F.broadcast(df.sparkSession.createDataFrame([(c, *got[c]) for c in names], schema))


def quantile_columns(df: DataFrame, value: Column, qs: Sequence[float]) -> list[Column]:
    """One column's quantiles as constants."""
    got = exact_quantiles(df.select(value.alias("v")), ["v"], qs)["v"]
    return [F.lit(x).cast("double") for x in got]


def group_quantiles(df: DataFrame, keys: Sequence[str], names: Sequence[str], qs: dict[str, float], fold: str | None = None, folds: Sequence = (), slots: int = SLOTS // 2, hot: int = HOT) -> DataFrame:
    """keys, column and a quantile by each name, for the numbers of every group and column.

    With fold: keys, fold, column and quantiles of the group's rows outside each of `folds`; a fold's complement is the
    group's total less its own part, so no row is repeated. Groups of up to `hot` rows are put in order as they are, in two
    shuffles; those of more are sketched and cut into slots by value, and only slots that hold ranks are put in order: the
    largest task then has the distinct values of one slot.
    """
    k = [f"__k{i}" for i in range(len(keys))] + ["column"]
    views = list(folds) if fold is not None else [None]
    seen = {f"__o{i}": F.count("*") if fold is None else F.count_if(~F.col("__f").eqNullSafe(F.lit(v))) for i, v in enumerate(views)}
    renamed = df.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], *([F.col(fold).alias("__f")] if fold is not None else []), *[number(c).alias(c) for c in names])
    long = long_form(renamed, list(names), [*k[:-1], *(["__f"] if fold is not None else [])], "v", "double").filter("v IS NOT NULL")
    large = long.groupBy(*k).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot).drop("__n")
    if large.isEmpty():
        wide = _small_groups(long, k, seen, qs)
    else:
        wide = _small_groups(_joined(long, large, k, "left_anti"), k, seen, qs).unionByName(_large_groups(_joined(long, large, k, "left_semi"), k, seen, qs, slots))

    def quantile(o: str, name: str) -> Column:
        at, lo, hi = (F.col(f"{o}n") - 1) * F.lit(qs[name]), F.col(f"{o}_{name}_lo"), F.col(f"{o}_{name}_hi")
        return F.when(F.col(f"{o}n") > 0, F.when((lo == hi) | (F.floor(at) == F.ceil(at)), lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))

    per = [F.struct(*([F.lit(v).alias(fold)] if fold is not None else []), *[quantile(o, n).alias(n) for n in qs]) for v, o in zip(views, seen, strict=True)]
    out = wide.select(*[F.col(a).alias(b) for a, b in zip(k, [*keys, "column"], strict=True)], F.explode(F.array(*per)).alias("__x"))
    return out.select(*keys, *([f"__x.{fold}"] if fold is not None else []), "column", *[f"__x.{n}" for n in qs])


def _asked(seen, qs: dict[str, float]) -> dict[str, Column]:
    """By name of a column: the rank that is asked for, of the numbers __o?n that a view sees."""
    return {f"{o}_{n}_{end}": f((F.col(f"{o}n") - 1) * q).cast("long") for o in seen for n, q in qs.items() for end, f in (("lo", F.floor), ("hi", F.ceil))}


def _least(values: DataFrame, k: list[str], seen, qs: dict[str, float]) -> DataFrame:
    """One row for each group: the least value up to which a view has seen more rows (__o?u) than the rank."""
    least = [F.min(F.when(F.col(name[: name.index("_", 2)] + "u") > rank, F.col("v"))).alias(name) for name, rank in _asked(seen, qs).items()]
    return values.groupBy(*k).agg(*[F.first(f"{o}n").alias(f"{o}n") for o in seen], *least)


def _small_groups(long: DataFrame, k: list[str], seen: dict[str, Column], qs: dict[str, float]) -> DataFrame:
    group = Window.partitionBy(*k)
    cells = long.groupBy(*k, "v").agg(*[e.alias(o) for o, e in seen.items()])
    upto = cells.select(*k, "v", *[F.sum(o).over(group).alias(f"{o}n") for o in seen], *[F.sum(o).over(group.orderBy("v")).alias(f"{o}u") for o in seen])
    return _least(upto, k, seen, qs)


def _large_groups(long: DataFrame, k: list[str], seen: dict[str, Column], qs: dict[str, float], slots: int) -> DataFrame:
    grid = F.percentile_approx("v", [i / slots for i in range(1, slots)], 20 * slots)
    bounds = long.groupBy(*k).agg(F.array_distinct(grid).alias("__b"))
    long = _joined(long, bounds, k, "left").withColumn("__s", F.coalesce(F.size(F.filter("__b", lambda b: b < F.col("v"))), F.lit(0))).drop("__b")
    group, by_slot = Window.partitionBy(*k), Window.partitionBy(*k).orderBy("__s")
    # Slots with what each view sees before them and in all; those that hold no rank fall away.
    cells = long.groupBy(*k, "__s").agg(*[e.alias(o) for o, e in seen.items()])
    cells = cells.select(*k, "__s", *[F.sum(o).over(group).alias(f"{o}n") for o in seen], *[(F.sum(o).over(by_slot) - F.col(o)).alias(f"{o}b") for o in seen], *seen)
    holds = [(r >= F.col(f"{o}b")) & (r < F.col(f"{o}b") + F.col(o)) for name, r in _asked(seen, qs).items() for o in [name[: name.index("_", 2)]]]
    rows = _joined(long, cells.filter(reduce(lambda a, b: a | b, holds)).drop(*seen), [*k, "__s"], "inner")
    values = rows.groupBy(*k, "__s", "v").agg(*[F.first(f"{o}{x}").alias(f"{o}{x}") for o in seen for x in "nb"], *[e.alias(o) for o, e in seen.items()])
    inside = Window.partitionBy(*k, "__s").orderBy("v")
    return _least(values.withColumns({f"{o}u": F.col(f"{o}b") + F.sum(o).over(inside) for o in seen}), k, seen, qs)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on columns that may be null on both sides."""
    renamed = right.select(*[F.col(c).alias(f"__j{i}") for i, c in enumerate(on)], *[c for c in right.columns if c not in on])
    met = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__j{i}"]) for i, c in enumerate(on)])
    return left.join(renamed, met, how).drop(*[f"__j{i}" for i in range(len(on))])
