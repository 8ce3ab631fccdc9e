"""Splits and folds, as DataFrames (row_id, fold, scored). Hashes of ids take the place of shuffles: reruns and other engines agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtab.functions.exprs import hashed, number
from loomtab.operators.quantiles import quantile_columns
from loomtab.operators.windows import latest_periods, time_tail


def kfold(df: DataFrame, row_id: str, k: int = 5, seed: str = "s") -> DataFrame:
    return df.select(row_id, (hashed(row_id, seed) % k).cast("int").alias("fold"))


def group_folds(df: DataFrame, group: str, k: int = 5) -> DataFrame:
    """group, fold: whole groups, dealt in turns there and back by size, so folds balance. Ranks groups, not rows."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), F.col(group).asc_nulls_first())) - 1
    turn = F.floor(F.col("__p") / k) % 2
    return sizes.withColumn("__p", place).select(group, "n", F.when(turn == 0, F.col("__p") % k).otherwise(k - 1 - F.col("__p") % k).cast("int").alias("fold"))


def grouped_kfold(df: DataFrame, row_id: str, group: str, k: int = 5) -> DataFrame:
    dealt = group_folds(df, group, k).select(F.col(group).alias("__g"), "fold")
    return df.join(dealt, F.col(group).eqNullSafe(F.col("__g"))).select(row_id, "fold")


def stratified_kfold(df: DataFrame, row_id: str, label: str, k: int = 5, seed: str = "s") -> DataFrame:
    """Each label's rows spread evenly over folds. Within a label and one of 4096 hash slots rows are numbered, and slots
    start where the ones before ended: no label is ordered in one task."""
    rows = df.select(row_id, F.col(label).cast("string").alias("__l"), hashed(row_id, seed).alias("__h")).withColumn("__s", F.shiftright("__h", 20))
    sizes = rows.groupBy("__l", "__s").agg(F.count("*").alias("__n"))
    base = sizes.select(F.col("__l").alias("__bl"), F.col("__s").alias("__bs"), (F.sum("__n").over(Window.partitionBy("__l").orderBy("__s")) - F.col("__n")).alias("__b"))
    inside = F.row_number().over(Window.partitionBy("__l", "__s").orderBy("__h", row_id)) - 1
    placed = rows.withColumn("__i", inside).join(base, F.col("__l").eqNullSafe(F.col("__bl")) & (F.col("__s") == F.col("__bs")))
    return placed.select(row_id, ((F.col("__b") + F.col("__i")) % k).cast("int").alias("fold"))


def expanding_blocks(df: DataFrame, period: str, horizon: int, blocks: int = 5) -> DataFrame:
    """period, rank, fold: up to `blocks` blocks of `horizon` periods from the last one back; -1 is never validated.

    A fold trains on all earlier periods; the first block must leave some.
    """
    ranks = df.filter(F.col(period).isNotNull()).select(period).distinct()
    ranks = ranks.withColumns({"rank": F.row_number().over(Window.orderBy(period)) - 1, "__n": F.count("*").over(Window.partitionBy())})
    back = F.floor((F.col("__n") - 1 - F.col("rank")) / horizon)
    room = F.least(F.lit(blocks), F.floor((F.col("__n") - 1) / horizon))
    return ranks.select(period, "rank", F.when(back < room, room - 1 - back).otherwise(-1).cast("int").alias("fold"))


def expanding_folds(df: DataFrame, row_id: str, period: str, horizon: int, blocks: int = 5) -> DataFrame:
    """row_id, fold, rank: use train_rows / valid_rows below."""
    dealt = expanding_blocks(df, period, horizon, blocks).withColumnRenamed(period, "__p")
    return df.join(dealt, F.col(period) == F.col("__p")).select(row_id, "fold", "rank")


def train_rows(df: DataFrame, folds: DataFrame, row_id: str, fold: int) -> DataFrame:
    """Rows a fold trains on: those of other folds, or of earlier periods where folds carry ranks."""
    if "rank" in folds.columns:
        start = folds.filter(F.col("fold") == fold).agg(F.min("rank").alias("__lo"))
        keep = folds.join(start).filter(F.col("rank") < F.col("__lo")).select(row_id)
    else:
        keep = folds.filter(F.col("fold") != fold).select(row_id)
    return df.join(keep, row_id, "left_semi")


def valid_rows(df: DataFrame, folds: DataFrame, row_id: str, fold: int) -> DataFrame:
    rows = folds.filter(F.col("fold") == fold)
    rows = rows.filter("scored") if "scored" in folds.columns else rows
    return df.join(rows.select(row_id), row_id, "left_semi")


def holdout_groups(df: DataFrame, group: str, share: float = 0.2, seed: str = "s", least: int = 3) -> DataFrame:
    """group, held_out: a random share (rounded up) of groups, if there are enough. Ranks groups, not rows."""
    groups = df.filter(F.col(group).isNotNull()).select(group).distinct()
    ranked = groups.withColumns({"__k": F.row_number().over(Window.orderBy(hashed(group, seed), group)), "__n": F.count("*").over(Window.partitionBy())})
    return ranked.select(group, ((F.col("__n") >= least) & (F.col("__k") <= F.ceil(F.col("__n") * share))).alias("held_out"))


def holdout_within_period(df: DataFrame, part: F.Column, share: float = 0.2, threshold: float | None = None) -> DataFrame:
    """df with held_out: the date part reaches the threshold, or its (1 - share) quantile."""
    rows = df.withColumn("__p", part)
    edge = F.lit(threshold) if threshold is not None else quantile_columns(rows, F.col("__p"), [1 - share])[0]
    return rows.withColumn("held_out", F.coalesce(F.col("__p") >= edge, F.lit(False))).drop("__p")


def coarsen_blocks(df: DataFrame, time: str, least: int = 10) -> DataFrame:
    """unit, blocks, chosen: the coarsest of year, month, ISO week and day with 10 to n/4 blocks; else the finest with enough; else the coarsest with two."""
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), F.col(time)).cast("string"), F.lit("-"), F.lpad(F.weekofyear(time).cast("string"), 2, "0"))
    units = [("year", F.year(time).cast("string")), ("month", F.date_format(time, "yyyy-MM")), ("week", week), ("day", F.date_format(time, "yyyy-MM-dd"))]
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("unit"), e.alias("block")) for i, (n, e) in enumerate(units)])).alias("x")).select("x.*")
    counts = rows.filter("block IS NOT NULL").groupBy("ord", "unit", "block").agg(F.count("*").alias("c")).groupBy("ord", "unit").agg(F.count("*").alias("blocks"), F.sum("c").alias("n"))
    score = F.when(F.col("blocks").between(least, F.col("n") / 4), 300 - F.col("ord")).when(F.col("blocks") >= least, 200 + F.col("ord")).when(F.col("blocks") >= 2, 100 - F.col("ord")).otherwise(0)
    best = Window.partitionBy()  # over four units
    return counts.withColumn("__s", score).select("unit", "blocks", ((F.col("__s") == F.max("__s").over(best)) & (F.col("__s") > 0)).alias("chosen"))


def single_holdout(df: DataFrame, row_id: str, period: str | None = None, ordered: bool = True, label: str | None = None, share: float = 0.2) -> DataFrame:
    """row_id, held_out: latest periods, or whole random periods where order means nothing, or a stratified or plain random share."""
    if period and ordered:
        late = latest_periods(df, period, share).withColumn("held_out", F.lit(True))
        return df.join(late, period, "left").select(row_id, F.coalesce("held_out", F.lit(False)).alias("held_out"))
    if period:
        return df.join(holdout_groups(df, period, share), period, "left").select(row_id, F.coalesce("held_out", F.lit(False)).alias("held_out"))
    k = max(2, round(1 / share))
    folds = stratified_kfold(df, row_id, label, k) if label else kfold(df, row_id, k)
    return folds.select(row_id, (F.col("fold") == 0).alias("held_out"))


def split_three(df: DataFrame, row_id: str, shares: tuple[float, float] = (0.7, 0.15), label: str | None = None, seed: str = "s") -> DataFrame:
    """row_id, part: train, validation or test, by hash or label by label."""
    if label:
        place = stratified_kfold(df, row_id, label, 100, seed).select(row_id, (F.col("fold") / 100.0).alias("u"))
    else:
        place = df.select(row_id, (hashed(row_id, seed) / float(1 << 32)).alias("u"))
    return place.select(row_id, F.when(F.col("u") < shares[0], "train").when(F.col("u") < sum(shares), "validation").otherwise("test").alias("part"))


def block_values(df: DataFrame, name: str, least: int = 10, parse: float = 0.8) -> tuple[str, str | None] | None:
    """(column, unit) to hold out in whole by a column: None below three values; the column as it is where it has up to half
    as many values as rows; else, where it is a time, the calendar unit that `coarsen_blocks` chooses. Never for numbers."""
    from loomtab.functions.exprs import kind

    of = kind(df.schema[name].dataType)
    one = df.agg(F.count_distinct(name).alias("k"), F.count("*").alias("n"), (F.avg(F.try_to_timestamp(F.col(name).cast("string")).isNotNull().cast("double")) if of == "categorical" else F.lit(1.0)).alias("read")).first()
    if one.k < 3 or of in ("numeric", "boolean") and one.k > one.n / 2:
        return None
    if one.k <= one.n / 2:
        return name, None
    if (one.read or 0.0) < parse:
        return None
    rows = df if of == "datetime" else df.withColumn(name, F.try_to_timestamp(name))
    chosen = coarsen_blocks(rows, name, least).filter("chosen").first()
    return (name, chosen.unit) if chosen else None


def make_folds(df: DataFrame, row_id: str, strategy: str, *, scored: DataFrame | None = None, **options) -> DataFrame:
    """Folds by a named strategy; scored: row ids that count in scores (training is not restricted)."""
    makers = {"kfold": kfold, "group": grouped_kfold, "stratified": stratified_kfold, "expanding": expanding_folds}
    held = F.when(F.col("held_out"), 0).otherwise(-1).alias("fold")
    if strategy == "time_tail":
        folds = time_tail(df, options["time"], row_id, options.get("share", 0.2)).select(row_id, held)
    elif strategy == "within_period":
        folds = holdout_within_period(df, F.col(options["part"]), options.get("share", 0.2)).select(row_id, held)
    elif strategy == "group_holdout":
        group = options["group"]
        late = holdout_groups(df, group, options.get("share", 0.2)).select(F.col(group).alias("__g"), "held_out")
        folds = df.join(late, F.col(group).eqNullSafe(F.col("__g")), "left").select(row_id, F.coalesce(held, F.lit(-1)).alias("fold"))
    else:
        folds = makers[strategy](df, row_id, **options)
    if scored is None:
        return folds.withColumn("scored", F.lit(True))
    mark = scored.select(row_id).distinct().withColumn("__s", F.lit(True))
    return folds.join(mark, row_id, "left").withColumn("scored", F.coalesce("__s", F.lit(False))).drop("__s")


#: What is tried where the strategy that was asked for cannot be had, in this order.
FALLBACKS = ("expanding", "group", "within_period", "time_tail", "stratified", "kfold")


def strategies(df: DataFrame, wanted: str, *, period: str | None = None, group: str | None = None, part: str | None = None, time: str | None = None, label: str | None = None, horizon: int = 1, blocks: int = 5, k: int = 5, most_labels: int = 1000) -> DataFrame:
    """strategy, feasible, reason, folds, chosen: can the data bear each strategy, and why not? The one asked for is chosen where
    it is feasible, else the first feasible one of FALLBACKS. One aggregate counts what all strategies need; labels take another."""
    named = {"period": period, "group": group, "part": part, "time": time, "label": label}
    facts = [F.count("*").alias("rows"), *[(F.count_distinct(c) if n not in ("time", "label") else F.count(c)).alias(n) if c else F.lit(0).cast("long").alias(n) for n, c in named.items()]]
    one = df.agg(*facts)
    per = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")) if label else df.sparkSession.createDataFrame([], "n long")
    one = one.join(per.agg(F.count("n").alias("labels"), F.coalesce(F.min("n"), F.lit(0)).alias("rarest")))  # a row each
    room = F.floor((F.col("period") - 1) / horizon)
    cases = [
        ("expanding", period, [(room < 1, "too few periods before the first block")], F.least(F.lit(blocks), room)),
        ("group", group, [(F.col("group") < 2, "fewer than two groups")], F.least(F.lit(k), F.col("group"))),
        ("group_holdout", group, [(F.col("group") < 3, "fewer than three groups")], F.lit(1)),
        ("within_period", part, [(F.col("part") < 2, "one value within periods")], F.lit(1)),
        ("time_tail", time, [(F.col("time") < 2, "fewer than two times")], F.lit(1)),
        ("stratified", label, [(F.col("labels") < 2, "fewer than two labels"), (F.col("labels") > most_labels, "too many labels"), (F.col("rarest") < k, "a label with fewer rows than folds")], F.lit(k)),
        ("kfold", True, [(F.col("rows") < 2, "fewer than two rows")], F.least(F.lit(k), F.col("rows"))),
    ]
    if wanted not in [name for name, *_ in cases]:
        raise ValueError(f"no strategy {wanted}")
    order = [wanted, *[n for n in FALLBACKS if n != wanted], *[n for n, *_ in cases if n not in (wanted, *FALLBACKS)]]
    structs = []
    for name, column, faults, folds in cases:
        reason = F.lit("no column for it") if not column else F.coalesce(*[F.when(c, F.lit(r)) for c, r in faults])
        structs.append(F.struct(F.lit(name).alias("strategy"), reason.isNull().alias("feasible"), reason.alias("reason"), F.when(reason.isNull(), folds.cast("int")).alias("folds"), F.lit(order.index(name)).alias("__o")))
    rows = one.select(F.explode(F.array(*structs)).alias("x")).select("x.*")
    first = F.min(F.when(F.col("feasible") & F.col("strategy").isin(wanted, *FALLBACKS), F.col("__o"))).over(Window.partitionBy())  # over seven strategies
    return rows.withColumn("chosen", F.coalesce(F.col("__o") == first, F.lit(False))).drop("__o")


def dealt_folds(df: DataFrame, row_id: str, wanted: str, *, scored: DataFrame | None = None, share: float = 0.2, **options) -> tuple[DataFrame, str, DataFrame]:
    """(folds, strategy, table): folds by the strategy asked for, or by the first that the data can bear, and why."""
    table = strategies(df, wanted, **options)
    found = [r for r in table.collect() if r.chosen]
    if not found:
        raise ValueError("no strategy fits: " + "; ".join(f"{r.strategy}: {r.reason}" for r in table.collect()))
    name, n = found[0].strategy, found[0].folds
    own = {
        "expanding": lambda: {"period": options["period"], "horizon": options.get("horizon", 1), "blocks": options.get("blocks", 5)},
        "group": lambda: {"group": options["group"], "k": n},
        "group_holdout": lambda: {"group": options["group"], "share": share},
        "within_period": lambda: {"part": options["part"], "share": share},
        "time_tail": lambda: {"time": options["time"], "share": share},
        "stratified": lambda: {"label": options["label"], "k": n},
        "kfold": lambda: {"k": n},
    }[name]()
    return make_folds(df, row_id, name, scored=scored, **own), name, table


def target_ready(df: DataFrame, target: str, least: int = 5) -> DataFrame:
    """Rows with a usable target; refuses tables with too few."""
    out = df.filter(number(target).isNotNull())
    if len(out.limit(least).collect()) < least:
        raise ValueError(f"fewer than {least} rows have a target")
    return out
