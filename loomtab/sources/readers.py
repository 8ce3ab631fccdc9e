"""Tables in: by suffix, with a fallback encoding; discovery of a folder's tables; out-of-process features and folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, sep: str | None = None, schema: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """csv, tsv, txt (whose separator is found if it is not named) or parquet. A schema saves the pass that infers one."""
    suffix = _suffix(path)
    if suffix == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("sep", sep or _separator(spark, path)).option("encoding", encoding)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def _suffix(path: str) -> str:
    return path.rstrip("/").rsplit(".", 1)[-1].lower()


#: Lines at the head of a file that tell its separator.
HEAD_LINES = 200


def sniff_separator(lines: list[str], candidates: str = ",\t;|") -> str | None:
    """The separator of a table's first lines: the one that cuts the most of them into the header's number of fields, and among
    equals into most fields; None if none is in the header. Separators inside double quotes part nothing, and a quoted field
    that goes on over a line's end goes on in the next."""
    best = None
    for sep in candidates:
        counts, n, quoted, filled = [], 1, False, False
        for line in lines:
            for c in line:
                quoted ^= c == '"'
                n += c == sep and not quoted
            filled = filled or bool(line.strip())
            if not quoted:
                if filled:
                    counts.append(n)
                n, filled = 1, False
        if counts and counts[0] > 1:
            key = (sum(c == counts[0] for c in counts) / len(counts), counts[0])
            best = max(best or (key, sep), (key, sep), key=lambda x: x[0])
    return best[1] if best else None


def _separator(spark: SparkSession, path: str) -> str:
    suffix = _suffix(path)
    if suffix == "txt":
        head = [r.value for r in spark.read.text(path).limit(HEAD_LINES).collect()]
        return sniff_separator(head) or ","  # one column: any will do
    if suffix not in ("csv", "tsv"):
        raise ValueError(f"no reader for .{suffix}")
    return {"csv": ",", "tsv": "\t"}[suffix]


def load_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A csv and warnings: read as UTF-8, or as Latin-1 where bytes are no UTF-8; an empty file is an error."""
    broken = spark.read.text(path).filter(~F.is_valid_utf8("value"))  # lines keep their bytes
    encoding, warnings = ("UTF-8", []) if broken.isEmpty() else ("ISO-8859-1", ["read as Latin-1"])
    df = read_table(spark, path, encoding=encoding)
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df, warnings


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """path, columns, rows, error of every table under a folder; unreadable ones are reported, not raised."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,tsv,txt,parquet}").load(folder).select("path")
    tables, errors = {}, {}
    for (path,) in found.toLocalIterator():  # one line for each file
        try:
            tables[path] = read_table(spark, path)
        except Exception as e:  # noqa: BLE001  a report of what cannot be read
            errors[path] = str(e).split("\n")[0][:200]
    counts = {p: df.agg(F.lit(p).alias("path"), F.count("*").alias("rows")) for p, df in tables.items()}
    try:  # all counts in one job
        rows = {r.path: r.rows for r in reduce(DataFrame.unionByName, counts.values()).collect()} if counts else {}
    except Exception:  # noqa: BLE001  one of them cannot be read to its end: find out which
        rows = {}
        for path, one in counts.items():
            try:
                rows[path] = one.first().rows
            except Exception as e:  # noqa: BLE001
                errors[path] = str(e).split("\n")[0][:200]
    out = [(p, tables[p].columns if p not in errors else [], rows.get(p), errors.get(p)) for p in sorted({*tables, *errors})]
    return spark.createDataFrame(out, "path string, columns array<string>, rows long, error string")


def header(spark: SparkSession, path: str, sep: str | None = None) -> list[str]:
    """Column names without reading rows: the footer of parquet, the first line of text."""
    if _suffix(path) == "parquet":
        return spark.read.parquet(path).columns
    return spark.read.option("header", True).option("sep", sep or _separator(spark, path)).csv(path).columns


def attach_authored(df: DataFrame, authored: DataFrame, row_id: str, covers: dict[str, list[str]] | None = None) -> DataFrame:
    """df with externally made columns by row id, one line for each row; a text column that new columns cover is dropped."""
    n, (rows, m) = df.count(), authored.agg(F.count("*"), F.count_distinct(row_id)).first()
    if n != m or rows != m:
        raise ValueError(f"authored features have {m} distinct rows for {n}")
    gone = [t for t, cols in (covers or {}).items() if all(c in authored.columns for c in cols)]
    new = [c for c in authored.columns if c == row_id or c not in df.columns]
    return df.join(authored.select(*new), row_id, "left").drop(*gone)
