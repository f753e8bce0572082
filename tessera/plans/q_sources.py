"""Queries: every sink written into the shared folder and read back (S-*).

Each entry writes a whole table in one format, reads it through the matching
reader and aggregates what came back; the twin aggregates the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from tessera.functions.hashing import row_uniform, row_uniform_sql
from tessera.plans.registry import query
from tessera.session import checkpoint_dir
from tessera.sources import tables as S
from tessera.sources.tables import table


def _place(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


# S-01 / S-02 / F-02 ---------------------------------------------------------
@query("s01_csv_round_trip", """
SELECT o_orderstatus, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(DISTINCT o_orderpriority) AS n_priorities
FROM orders GROUP BY 1""")
def s01_csv_round_trip(spark, d):
    """Orders as CSV with an index column, read with a declared schema and dates."""
    path = _place(spark, "s01")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "day", "o_orderpriority"]
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")).withColumn("Unnamed: 0", F.col("o_orderkey"))
    S.write_table(o.select("Unnamed: 0", *cols), path, "csv")
    kinds = [LongType(), LongType(), StringType(), DoubleType(), DateType(), StringType()]
    schema = StructType([StructField(c, t) for c, t in zip(["Unnamed: 0", *cols], kinds)])
    back = S.drop_unnamed(S.read_csv(spark, path, schema))
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
        F.count_distinct("o_orderpriority").alias("n_priorities"))


# S-03 / S-04 ----------------------------------------------------------------
@query("s03_s04_processed_pair", f"""
SELECT CASE WHEN {row_uniform_sql('c_custkey', 42)} < 0.2 THEN 'test' ELSE 'train' END AS part, count(*) AS n,
       CAST(sum(c_custkey) AS BIGINT) AS key_sum, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents
FROM customer GROUP BY 1""")
def s03_s04_processed_pair(spark, d):
    """Customers split by id, each part written, the pair read back."""
    path = _place(spark, "s03")
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "id")
    parts = c.select("id", F.when(row_uniform("id", 42) < 0.2, "test").otherwise("train").alias("split"))
    for which in ("train", "test"):
        S.write_table(S.split_part(c, parts, which), f"{path}/{which}")
    out = None
    for which, part in zip(("train", "test"), S.read_processed_pair(spark, path)):
        p = part.select(F.lit(which).alias("part"), "id", "c_acctbal")
        out = p if out is None else out.unionByName(p)
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("key_sum"),
                                   F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"))


# S-05 / S-06 ----------------------------------------------------------------
@query("s06_representation_round_trip", """
SELECT label, count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS id_sum,
       avg(CAST(embedding[1] AS DOUBLE)) AS mean_first FROM embeddings GROUP BY label""", doubles=["mean_first"])
def s06_representation_round_trip(spark, d):
    """Two representations in one partitioned store; one is read back and
    aligned to the rows that it describes."""
    path = _place(spark, "s06")
    e = table(spark, d, "embeddings")
    dims = 64
    S.write_representation(e.select("vec_id", "embedding"), path, "raw", dims)
    S.write_representation(e.select("vec_id", F.slice("embedding", 1, 10).alias("embedding")), path, "head", 10)
    back = S.read_representation(spark, path, "raw", dims)
    rows = S.align_embeddings(e.select("vec_id", "label"), back, "vec_id", expected_total=e.count())
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("id_sum"),
                                     F.avg(F.col("embedding")[0].cast("double")).alias("mean_first"))


# S-07 / S-09 / S-11 ---------------------------------------------------------
@query("s07_partitioned_round_trip", """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type""")
def s07_partitioned_round_trip(spark, d):
    """Events as Parquet partitioned by type."""
    path = _place(spark, "s07")
    S.write_table(table(spark, d, "events").select("event_type", "user_id"), path, partition_by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"))


@query("s11_json_round_trip", """
SELECT conv_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id""")
def s11_json_round_trip(spark, d):
    """Conversations as JSON lines, read with the table's schema."""
    path = _place(spark, "s11")
    c = table(spark, d, "conversations")
    S.write_table(c, path, "json")
    return spark.read.schema(c.schema).json(path).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


# S-08 -----------------------------------------------------------------------
@query("s08_summary_card", """
SELECT count(*) AS n_rows, count(DISTINCT lang) AS n_languages, min(n_chars) AS shortest, max(n_chars) AS longest,
       count(*) FILTER (WHERE text IS NULL) AS null_texts FROM documents""")
def s08_summary_card(spark, d):
    """A nested one-row JSON card of the documents, read back flat."""
    path = _place(spark, "s08")
    card = table(spark, d, "documents").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.struct(F.count_distinct("lang").alias("languages"), F.count_if(F.col("text").isNull()).alias("null_texts")).alias("counts"),
        F.struct(F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest")).alias("lengths"))
    S.write_summary_json(card, path)
    return spark.read.schema(card.schema).json(path).select(
        "n_rows", F.col("counts.languages").alias("n_languages"), "lengths.shortest", "lengths.longest", "counts.null_texts")
