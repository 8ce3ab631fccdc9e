"""Panels over the shared test tables: what the queries analyse, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.operators.relate import join_covariates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1: order values by month, priority, segment, nation; gappy is acctbal with every seventh value missing."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("y"), F.col("o_orderdate").alias("ts"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nk"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("nation"))
    out = join_covariates(join_covariates(o, c, ["cust"], check=False), n, ["nk"], check=False)
    return out.withColumn("gappy", F.when(F.col("row_id") % 7 != 0, F.col("acctbal"))).drop("cust", "nk")


def orders_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, at = orders(spark, sf_dir), F.lit("2000-07-01").cast("timestamp_ntz")
    return p.filter(F.col("ts") < at), p.filter(F.col("ts") >= at)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2: event values by type and user, with sub-day times."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), F.col("value").alias("y"), "ts", "event_type", "user_id")


def events_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, at = events(spark, sf_dir), F.lit("2024-01-25").cast("timestamp_ntz")
    return p.filter(F.col("ts") < at), p.filter(F.col("ts") >= at)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3: quantities shipped by month, supplier nation and return flag; rank numbers the calendar's months."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", F.col("l_returnflag").alias("flag"), F.date_format("l_shipdate", "yyyy-MM").alias("month"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("rank"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    # Sum by supplier first: the join then carries one row for each cell instead of each line.
    cells = li.groupBy("l_suppkey", "flag", "month", "rank").agg(F.sum("l_quantity").alias("q"))
    out = cells.join(s, cells.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    return out.groupBy("month", "rank", "nation", "flag").agg(F.sum("q").alias("y"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4: documents with their quality label, null where there is none."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang", "source", "n_chars")
    label = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), F.col("quality").alias("y"))
    return join_covariates(d, label, ["row_id"], check=False)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 by row_id and text alone. A label tells nothing of these but how often its document stands there, so texts only go
    through the join where some document has several labels; this runs a job."""
    told = table(spark, sf_dir, "labels").groupBy("doc_id").count()
    if told.filter("count > 1").isEmpty():
        return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return quality(spark, sf_dir).select("row_id", "text")


#: The same panels as SQL common table expressions.
P1 = """p1 AS (SELECT o_orderkey AS row_id, o_totalprice AS y, o_orderdate AS ts, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS priority,
  o_orderstatus AS status, c_mktsegment AS segment, c_acctbal AS acctbal, n_name AS nation, CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal END AS gappy
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
t1 AS (SELECT * FROM p1 WHERE ts < TIMESTAMP '2000-07-01'), q1 AS (SELECT * FROM p1 WHERE ts >= TIMESTAMP '2000-07-01')"""
P2 = """p2 AS (SELECT event_id AS row_id, value AS y, ts, event_type, user_id FROM events),
t2 AS (SELECT * FROM p2 WHERE ts < TIMESTAMP '2024-01-25'), q2 AS (SELECT * FROM p2 WHERE ts >= TIMESTAMP '2024-01-25')"""
P3 = """p3 AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS rank, n_name AS nation, l_returnflag AS flag, sum(l_quantity) AS y
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"""
P4 = """p4 AS (SELECT d.doc_id AS row_id, text, lang, source, n_chars, quality AS y FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
