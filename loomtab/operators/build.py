"""From tables to model features: which columns are used, and what is fitted to a fold's training rows only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.functions.exprs import hashed, kind, number
from loomtab.operators import encode, features, profile, relate
from loomtab.operators.quantiles import exact_quantiles
from loomtab.operators.text import TextProjector
from loomtab.spec import TableSpec


@dataclass(frozen=True)
class Kinds:
    """How feature columns are prepared."""

    numbers: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    group: str | None = None  # numbers take this column's medians first
    keys: tuple[str, ...] = ()  # of group statistics of the target
    texts: tuple[str, ...] = ()  # free text, projected on its leading directions


@dataclass
class FeatureSet:
    """Tables with their features, how to prepare them, and why columns are left out."""

    train: DataFrame
    predict: DataFrame
    kinds: Kinds
    times: list[str] = field(default_factory=list)
    dropped: dict[str, str] = field(default_factory=dict)


def time_sources(df: DataFrame, spec: TableSpec, threshold: float = 0.6, row_sample: int | None = None) -> list[str]:
    """Columns to take calendar features of: the time column if it is one, then row id and keys, then others; never the
    target. Text counts as a time where at least `threshold` of it can be read as one."""
    typed = [c for c in df.columns if kind(df.schema[c].dataType) == "datetime"]
    text = [c for c in df.columns if kind(df.schema[c].dataType) == "categorical" and c != spec.target]
    read = [r.column for r in profile.datetime_columns(df, text, row_sample, threshold, spec.row_id).filter("is_datetime").collect()] if text else []
    usable = [c for c in df.columns if c in (*typed, *read) and c != spec.target]
    first = [c for c in dict.fromkeys((spec.time, spec.row_id, *spec.keys)) if c in usable]
    return first + [c for c in usable if c not in first]


def unshared_keys(predict: DataFrame, train: DataFrame, names: list[str], least: float = 0.5) -> list[str]:
    """Keys of which the two sides share too few values to learn from; they stay in the tables but are no features."""
    if not names:
        return []
    return [r.column for r in relate.value_overlap(predict, train, names).filter(F.col("overlap") < least).collect()]


def same_columns(df: DataFrame, like: DataFrame, names: list[str]) -> DataFrame:
    """df with the columns that only `like` has, as nulls of their type."""
    return df.withColumns({c: F.lit(None).cast(like.schema[c].dataType) for c in names if c not in df.columns})


def column_kinds(train: DataFrame, predict: DataFrame, names: list[str], keys: list[str] = (), levels: int = 50, texts: list[str] = ()) -> Kinds:
    """Numbers, texts (those that are named) and categories among the features; the group of the median imputation is the
    category with most levels, up to `levels`."""
    numbers = tuple(c for c in names if kind(train.schema[c].dataType) in ("numeric", "boolean"))
    categories = tuple(c for c in names if kind(train.schema[c].dataType) == "categorical" and c not in texts)
    counts = {r.column: r.distinct for r in profile.distinct_counts(train, list(categories)).collect()} if categories else {}
    able = [c for c in categories if 2 <= counts[c] <= levels]
    return Kinds(numbers, categories, max(able, key=lambda c: (counts[c], c), default=None), tuple(keys), tuple(c for c in names if c in texts))


class Fitted:
    """What was learnt of training rows: apply it to any rows."""

    def __init__(self, train: DataFrame, kinds: Kinds, standardise: bool = False, row_id: str | None = None, target: str = "label", rare: float = 0.01, most: int = 100, terms: int = 400, directions: int = 16):
        self.kinds, self.names = kinds, list(kinds.numbers)
        self.train, self.target, self.row_id = train, target, row_id
        self.by_group = encode.group_medians(train, kinds.group, self.names) if kinds.group and self.names else None
        self.medians = {c: q[0] or 0.0 for c, q in exact_quantiles(train, self.names, [0.5]).items()} if self.names else {}
        self.levels = {c: [r.level for r in features.level_map(train, c, rare, most).filter("level <> '__rare__'").orderBy("level").collect()] for c in kinds.categories}
        self.texts = [TextProjector(train, c, row_id or c, terms, directions) for c in kinds.texts]
        self.scale: dict[str, tuple[float, float]] = {}
        if standardise and self.names:
            filled = self._filled(train)
            row = filled.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in self.names]).first()
            self.scale = {c: (row[c].m or 0.0, row[c].s or 1.0) for c in self.names}

    def _filled(self, df: DataFrame) -> DataFrame:
        """Missing numbers take their group's median, then the whole training side's."""
        if self.by_group is None:
            return df.withColumns({c: F.coalesce(number(c), F.lit(self.medians[c])) for c in self.names})
        of_group = self.by_group.select(F.col(self.kinds.group).alias("__g"), *[F.col(c).alias(f"__m_{c}") for c in self.names])
        out = df.join(F.broadcast(of_group), F.col(self.kinds.group) == F.col("__g"), "left")  # at most `levels` groups
        out = out.withColumns({c: F.coalesce(number(c), f"__m_{c}", F.lit(self.medians[c])) for c in self.names})
        return out.drop("__g", *[f"__m_{c}" for c in self.names])

    def _own_statistics(self, df: DataFrame, keys: list[str], folds: int = 5) -> DataFrame:
        """Group statistics of training rows, each from the rows outside its own fold."""
        dealt = df.withColumn("__fold", (hashed(self.row_id, "own") % folds).cast("int"))
        stats = encode.crossfit_statistics(dealt, self.row_id, keys, self.target, "__fold")
        named = stats.select(F.col(self.row_id).alias("__id"), *[F.col(n).alias(f"tgt_{n}__{'_'.join(keys)}") for n in encode.STATISTICS])
        return df.join(named, F.col(self.row_id) == F.col("__id")).drop("__id")

    def table(self, df: DataFrame, own: bool = False) -> tuple[DataFrame, list[str]]:
        """df with prepared columns, and their names: numbers, shares of the target by key, directions of texts, one column for
        each level. own: df is the training side itself, whose rows take group statistics from outside their own fold (where the
        row id is known)."""
        out, names = self._filled(df), list(self.names)
        if self.scale:
            out = out.withColumns({c: (F.col(c) - m) / s for c, (m, s) in self.scale.items()})
        for keys in [[k] for k in self.kinds.keys]:
            out = self._own_statistics(out, keys) if own and self.row_id else encode.apply_statistics(self.train, out, keys, self.target)
            names += [f"tgt_{n}__{keys[0]}" for n in ("mean", "std", "count")]
        for projector in self.texts:
            out = projector.transform(out)
            names += projector.names()
        marks = {}
        for c, levels in self.levels.items():
            value = F.col(c).cast("string")
            marks |= {f"{c}={level}": F.coalesce(value == level, F.lit(False)).cast("double") for level in levels}
            marks[f"{c}=__rare__"] = (value.isNotNull() & ~F.coalesce(value.isin(levels), F.lit(False))).cast("double")
        return out.withColumns(marks) if marks else out, [*names, *marks]

    def transform(self, df: DataFrame, own: bool = False) -> DataFrame:
        """df with `features`, a vector of all prepared columns."""
        out, names = self.table(df, own)
        plain = out.select(*df.columns, F.array(*[F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)) for n in names]).alias("__a"))
        from pyspark.ml.functions import array_to_vector

        return plain.withColumn("features", array_to_vector("__a")).drop("__a")


def preparer(kinds: Kinds, custom: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None, **options) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """prepare(train, valid) for out_of_fold: medians, group statistics, custom steps and levels, all fitted on train only.

    Given row_id, training rows take group statistics from outside their own fold; without it they see their own target."""

    def prepare(train: DataFrame, valid: DataFrame) -> tuple[DataFrame, DataFrame]:
        if custom:
            train, valid = custom(train, valid)
        fitted = Fitted(train, kinds, **options)
        return fitted.transform(train, own=True), fitted.transform(valid)

    return prepare


def assembled(df: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(df)


def build_features(train: DataFrame, predict: DataFrame, spec: TableSpec, covariates: list[tuple[DataFrame, list[str]]] = (), interactions: int = 6, threshold: float = 0.6) -> FeatureSet:
    """Join, calendar features, choice of columns, interactions and kinds: all that needs no fold. What learns from rows is
    left to `preparer`, inside every fold.

    Columns go that are targets, row ids, named as outcomes, constant, mostly missing, id-like, or keys that the sides do not
    share; `dropped` says why. Columns that predict lacks come as nulls where a covariate has them on the training side only.
    """
    for right, keys in covariates:
        train, predict = (relate.join_covariates(side, right, keys) for side in (train, predict))
    times = [c for c in time_sources(train, spec, threshold) if c in predict.columns]
    made: list[str] = []
    for c in times:
        sides = []
        for side in (train, predict):
            at = F.col(c) if kind(side.schema[c].dataType) == "datetime" else F.try_to_timestamp(c)
            sides.append(side.withColumn(f"{c}__at", at))
        fine = bool(profile.has_time_of_day(sides[0], f"{c}__at").first()[0])
        before = set(sides[0].columns)
        train, predict = (features.calendar(side, f"{c}__at", fine) for side in sides)
        names = {n: n.replace(f"{c}__at__", f"{c}__") for n in train.columns if n not in before}
        train, predict = (side.withColumnsRenamed(names).drop(f"{c}__at") for side in (train, predict))
        made += names.values()
    dropped: dict[str, str] = {}
    for r in features.choose_columns(train, predict, spec.target, spec.row_id, list(spec.keys)).collect():
        if r.reason:
            dropped[r.column] = r.reason
    for c in unshared_keys(predict, train, [c for c in dict.fromkeys((*spec.keys, spec.block)) if c in train.columns and c in predict.columns and c not in dropped]):
        dropped[c] = "values that predict does not share"
    raw = [c for c in train.columns if c not in dropped and c not in made]
    reasons = profile.exclusions(profile.flags(train, raw), profile.missing(train, raw), spec.target)
    words = [c for c in raw if kind(train.schema[c].dataType) == "categorical" and c not in (*times, *spec.keys)]
    texts = [r.column for r in profile.text_columns(train, words).filter("is_text").collect()] if words else []
    # Free text has many values by nature: that alone is no reason to leave it out.
    dropped |= {r.column: r.reason for r in reasons.filter("reason IS NOT NULL").collect() if r.column not in texts or "missing" in r.reason or "constant" in r.reason}
    dropped |= {c: "time" for c in times if c not in dropped}
    names = [c for c in raw if c not in dropped] + made
    few = [r.column for r in profile.distinct_counts(train, [c for c in names if c not in made and kind(train.schema[c].dataType) == "numeric"]).filter("distinct BETWEEN 2 AND 10").collect()] if any(kind(train.schema[c].dataType) == "numeric" for c in names if c not in made) else []
    cyclic = [c for c in made if c.endswith(("__month", "__weekday", "__hour"))]
    if few and cyclic and interactions:
        pairs = [(a, b) for a in cyclic for b in few]
        ranks = features.ranked_interactions(train, spec.target, cyclic, few, interactions).collect()
        chosen = {f"{a}_x_{b}": (a, b) for a, b in pairs}
        new = {r.pair: F.coalesce(number(chosen[r.pair][0]), F.lit(0.0)) * F.coalesce(number(chosen[r.pair][1]), F.lit(0.0)) for r in ranks}
        train, predict = (same_columns(side, train, few).withColumns(new) for side in (train, predict))
        names += new
    kinds = column_kinds(train, predict, names, [k for k in spec.keys if k in names], texts=texts)
    return FeatureSet(train, same_columns(predict, train, names), kinds, times, dropped)
