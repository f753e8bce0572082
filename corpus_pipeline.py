"""The corpus pipeline: STAGES in order, each written as Parquet and reread.

``run(spark, sf_dir)`` applies them to ``documents``. Every stage but the last
returns the columns of its input; the last returns the packed sequences. Each
stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_cnn, line_dedup, packing, secret_scan, simhash
from tessera.llm.common import cut, documents


def _with_length(df: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars, where the table has it, follows the changed text."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select(*[F.col(f"`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: those without a letter and
    those that the network's reject class takes (dumps, markup, scripts of no
    label). The network is trained on the labelled rows outside the held-out
    fold; a table without labels rejects everything, for then nothing can be
    recognised."""
    net = byte_cnn.fit(docs.where(~byte_cnn.held_out()), reject=True)
    return byte_cnn.keep_known(docs, net)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows leave the texts."""
    return _with_length(line_dedup.line_dedup(docs, report=False), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base and linked secret spans become a mark; every document stays."""
    return _with_length(secret_scan.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every document's tokens in sequences of permitted lengths."""
    return packing.best_fit_packing(docs, [F.col("doc_id")], packing.word_tokens())


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup),
          ("secret_scan", mask_secrets), ("best_fit_packing", pack)]

# Language ID, SimHash and packing cannot be expressed in SQL; tests/llm checks
# the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
