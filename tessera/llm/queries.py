"""Registered queries of the pipeline operators: QUERIES and their ORACLE_SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import block_names as bn
from tessera.llm import bpe
from tessera.llm import byte_cnn as cnn
from tessera.llm import kd_shards as kd
from tessera.llm import lexical_search as ls
from tessera.llm import line_dedup as ld
from tessera.llm import packing
from tessera.llm import parity_join as pj
from tessera.llm import periodic_runs as pr
from tessera.llm import quality_rules as qr
from tessera.llm import secret_scan as ss
from tessera.llm import simhash as sh
from tessera.llm import substring_dedup as sd
from tessera.llm.common import documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near-equal bytes (law ``bytes``)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    crc = F.crc32(F.col("text").cast("binary"))
    dims = [kd.numeric_dim("doc_id"), kd.numeric_dim("n_chars"), kd.label_dim("source"), kd.label_dim("lang")]
    out = kd.kd_shards(documents(spark, sf_dir), dims, size,
                       [F.col("doc_id"), crc.alias("text_crc32")], n_shards=8)
    return out.select("doc_id", "size", F.coalesce("text_crc32", F.lit(0)).alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with repeated three-line windows removed."""
    return ld.line_dedup(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


ORACLE_SQL["op2_line_dedup"] = ld.ORACLE_SQL


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document: 3-word shingles,
    at most 3 differing bits."""
    return sh.simhash_components(documents(spark, sf_dir), shingle=3, radius=3) \
        .select("doc_id", "fingerprint", "component_id")


@register
def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by the byte network, trained outside the
    held-out fold."""
    docs = documents(spark, sf_dir)
    net = cnn.fit(docs.where(~cnn.held_out()))
    return cnn.predict(docs, net, carry=[F.col("doc_id"), cnn.held_out().alias("held_out")])


@register
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the adaptive verdict for every document."""
    return qr.quality_rules(documents(spark, sf_dir))


ORACLE_SQL["op6_quality_rules"] = qr.ORACLE_SQL


@register
def op7_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-duplicate groups of all documents, white space apart."""
    return bn.exact_groups(documents(spark, sf_dir)) \
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL["op7_block_naming"] = bn.ORACLE_SQL


@register
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded with the 49k word BPE."""
    import public_tokenizers
    return bpe.token_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                             carry=[F.col("doc_id")])


@register
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and linked secret spans of every whole document."""
    return ss.secret_digests(documents(spark, sf_dir))


@register
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 8192 tokens."""
    return packing.best_fit_packing(documents(spark, sf_dir), [F.col("doc_id")], packing.word_tokens())


@register
def op5_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word runs seen in an earlier one."""
    return sd.substring_digests(documents(spark, sf_dir), window=13) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every whole document, of which one in ten is looped."""
    docs = documents(spark, sf_dir)
    return pr.run_digests(docs.select("doc_id", pr.looped_texts(docs).alias("text")))


@register
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ls.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=20)


ORACLE_SQL["op13_ranked_search"] = ls.ORACLE_SQL


@register
def op12_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and near-duplicate class of every document: five words,
    Jaccard similarity 0.8."""
    return pj.jaccard_components(documents(spark, sf_dir))
