"""Readers and writers (S-01 … S-11).

Parquet is the primary format: it carries the schema, supports predicate
pushdown and column pruning. CSV is read only with an explicit schema (no
inference pass over 100 TB), and written only for small result tables.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register the driver tables as temp views for SQL use."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


# S-01 / S-02: CSV with header, explicit schema, quoted commas, NA strings.
PANDAS_NA_STRINGS = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "#N/A")


def read_csv(spark: SparkSession, path: str, schema: StructType,
             na_strings=PANDAS_NA_STRINGS, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Read a header CSV with a declared schema.

    ``nullValue`` accepts one string only, so the remaining NA markers are
    mapped to NULL after the read, per string column.
    """
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("quote", '"')
          .option("escape", '"')
          .option("mode", "PERMISSIVE")
          .option("nullValue", "")
          .option("nanValue", "NaN")
          .option("dateFormat", date_format)
          .csv(path))
    string_cols = [f.name for f in schema.fields if f.dataType.simpleString() == "string"]
    if string_cols and na_strings:
        df = df.select(*[
            F.when(F.col(c).isin(list(na_strings)), F.lit(None)).otherwise(F.col(c)).alias(c)
            if c in string_cols else F.col(c)
            for c in df.columns
        ])
    return df


def drop_unnamed(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    """F-02: drop columns whose name starts with ``prefix`` (index spill-over)."""
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


# S-03: read a processed pair and fail with a helpful message if missing.
def read_processed_pair(spark: SparkSession, base: str, names=("train", "test")):
    out = []
    for name in names:
        path = os.path.join(base, name)
        try:
            out.append(spark.read.parquet(path))
        except AnalysisException as exc:
            raise FileNotFoundError(
                f"processed table '{name}' not found under {base}; run the cleaning step first"
            ) from exc
    return tuple(out)


# S-04: features/target separation for a split table.
def split_part(df: DataFrame, split_df: DataFrame, which: str, id_col: str = "id") -> DataFrame:
    """Rows of ``df`` whose id is in ``split_df`` with ``split = which`` (semi join)."""
    keys = split_df.filter(F.col("split") == which).select(id_col)
    return df.join(keys, on=id_col, how="left_semi")


# S-07 / S-09 / S-11: table sinks.
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


# S-08: nested JSON summary (one row, nested struct columns).
def write_summary_json(df_one_row: DataFrame, path: str) -> None:
    df_one_row.coalesce(1).write.mode("overwrite").json(path)


# S-06: representations stored partitioned by (kind, dim); the reader prunes.
def write_representation(df: DataFrame, base: str, kind: str, dim: int) -> None:
    (df.withColumn("kind", F.lit(kind)).withColumn("dim", F.lit(int(dim)))
       .write.mode("overwrite").partitionBy("kind", "dim")
       .option("partitionOverwriteMode", "dynamic").parquet(base))


def read_representation(spark: SparkSession, base: str, kind: str, dim: int) -> DataFrame:
    return (spark.read.parquet(base)
            .filter((F.col("kind") == kind) & (F.col("dim") == int(dim)))
            .drop("kind", "dim"))


# S-10: fitted models / pipelines.
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# S-05: align an embedding table to the rows it describes, with checks.
def align_embeddings(rows: DataFrame, embeddings: DataFrame, id_col: str,
                     expected_total: int | None = None) -> DataFrame:
    """Inner join on the id after checking that the two sides match.

    Fails when the embedding table does not hold ``expected_total`` rows (the
    row count before deduplication), or when a kept row has no embedding.
    Embeddings of rows removed by deduplication are dropped by the join.
    Both checks are anti joins with ``limit(1)`` — no full count of orphans.
    """
    if expected_total is not None:
        n_emb = embeddings.count()
        if n_emb != expected_total:
            raise ValueError(f"{n_emb} embeddings for {expected_total} rows")
    orphans = rows.select(id_col).join(embeddings.select(id_col), on=id_col, how="left_anti").limit(1).count()
    if orphans:
        raise ValueError("some rows have no embedding")
    return rows.join(embeddings, on=id_col, how="inner")
