"""Operator 7 — exact dedup by deterministic block naming.

The normalised text (white space deleted) is cut into blocks of BLOCK bytes.
Equal blocks meet in one partition, are sorted there and get one integer name;
then adjacent names are paired and every distinct pair is named again, level by
level, until each document is one (level, name). Every naming is injective, so
two documents share an identity exactly if their normalised texts are equal; no
hash decides equality.

Texts cross the network once, as blocks. Before that shuffle each batch keeps
one copy of a block with the list of places it stands at, so a block shared by
a third of all documents arrives as one bounded row per batch; its places are
spread by place, not by block, before they are unfolded. Pair names are an
equi-join against a table unique on the pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, cut, free_names, null_safe, prepare, row_key, text_blocks

BLOCK = 4096
_KEY = ["doc_id", "text_key"]


def _squeezed(b: np.ndarray, off: np.ndarray) -> list[bytes]:
    raw, o = b.tobytes(), off.tolist()
    return [raw[a:z].translate(None, WHITE) for a, z in zip(o[:-1], o[1:])]


def text_facts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, code_points, text_sha256) per row; code points of the
    original text, SHA-256 of the normalised one."""
    prepare(df.sparkSession)

    def run(batches):
        for rb, b, off in text_blocks(batches, "text"):
            lead = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])      # bytes that start a code point
            sha = [hashlib.sha256(t).hexdigest() for t in _squeezed(b, off)]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(np.diff(lead[off])), pa.array(sha)],
                [*_KEY, "code_points", "text_sha256"])

    return df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, code_points long, text_sha256 string")


def text_block_names(df: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, idx, blocks, name): the named blocks of every text.
    An empty text is one empty block."""
    prepare(df.sparkSession)
    ref = pa.struct([("doc_id", pa.int64()), ("text_key", pa.int64()), ("idx", pa.int32()), ("blocks", pa.int32())])

    def split(batches):
        for rb, b, off in text_blocks(batches, "text"):
            ids, keys = rb.column(0).to_pylist(), rb.column(1).to_pylist()
            at: dict[bytes, list] = {}
            for i, t in enumerate(_squeezed(b, off)):
                n = max(1, -(-len(t) // block))
                for k in range(n):
                    at.setdefault(t[k * block:(k + 1) * block], []).append((ids[i], keys[i], k, n))
            ends = np.cumsum([0] + [len(v) for v in at.values()]).astype(np.int32)
            rows = [r for v in at.values() for r in v]
            cols = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), ref)]
            refs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(cols, fields=list(ref)))
            yield pa.RecordBatch.from_arrays([pa.array(list(at), pa.binary()), refs], ["content", "refs"])

    def name(batches):
        base = TaskContext.get().partitionId() << 36
        last, nth = None, 0
        for rb in batches:
            names = []
            for c in rb.column(0).to_pylist():
                if c != last:
                    last, nth = c, nth + 1
                names.append(base + nth)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), rb.column(1)], ["name", "refs"])

    shape = "array<struct<doc_id:bigint,text_key:bigint,idx:int,blocks:int>>"
    blocks = df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(split, f"content binary, refs {shape}")
    named = blocks.repartition("content").sortWithinPartitions("content").mapInArrow(name, f"name long, refs {shape}")
    spread = cut(named.repartition(F.col("refs")[0]["text_key"], F.col("refs")[0]["idx"]), "block-names")
    return spread.select("name", F.explode("refs").alias("r")) \
        .select("r.doc_id", "r.text_key", "r.idx", "r.blocks", "name")


def identities(df: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, level, name): one row per different (doc_id, text).
    Rows agree in (level, name) exactly if their normalised texts are equal."""
    cur = text_block_names(df, id_col, text, block) \
        .groupBy(*_KEY, "idx").agg(F.max("blocks").alias("blocks"), F.max("name").alias("name"))
    cur = cut(cur, "names-0")
    longest = cur.agg(F.max("blocks")).first()[0] or 1
    level, done = 0, []
    while True:
        done.append(cur.where("blocks = 1").select(*_KEY, F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        side = lambda k: F.max(F.when(F.col("idx") % 2 == k, F.col("name")))
        pairs = cut(cur.where("blocks > 1").groupBy(*_KEY, F.expr("idx div 2").cast("int").alias("idx"))
                    .agg(F.max(F.expr("(blocks + 1) div 2")).cast("int").alias("blocks"), side(0).alias("left"),
                         F.coalesce(side(1), F.lit(0)).alias("right")), "name-pairs")
        # names start at 1, so 0 marks "nothing beside it"
        table = cut(pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
                    .withColumn("name", F.monotonically_increasing_id() + 1), "pair-names")
        cur = cut(pairs.join(table, ["left", "right"]).select(*_KEY, "idx", "blocks", "name"), "names")
        level, longest = level + 1, (longest + 1) // 2
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    A null text counts as empty; all empty texts are one group. Of equal texts
    the row with the most code points in the original text stays, then the one
    with the smallest doc_id (rows without a doc_id last). Rows repeated as a
    whole (same doc_id, same text) count towards group_size and share one
    verdict. An empty table gives no rows; other columns play no part."""
    ident = identities(df, id_col, text, block)
    rows = cut(null_safe(text_facts(df, id_col, text), ident, _KEY), "exact-rows")
    best = F.min(F.struct((-F.col("code_points")).alias("c"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"),
                          F.col("text_key").alias("k")))
    groups = cut(rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "exact-groups")
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", "text_key", F.col("best.d").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.d")) & (F.col("text_key") == F.col("best.k"))).alias("kept"), "text_sha256")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``df`` with one row of every group of equal texts."""
    doc, key = free_names(df, "__doc", "__key")
    kept = exact_groups(df, id_col, text, block).where("kept").select(*_KEY).distinct() \
        .select(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
    extra = {doc: F.col(id_col), key: F.xxhash64(F.col(text))}
    return null_safe(df.withColumns(extra), kept, [doc, key], "left_semi").dropDuplicates([doc, key]).drop(doc, key)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents),
g AS (SELECT s, count(*) AS group_size, min({'c': -length(t), 'd': doc_id}) AS best FROM d GROUP BY s)
SELECT d.doc_id, g.best.d AS keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.best.d AS kept,
       sha256(d.s) AS text_sha256
FROM d JOIN g USING (s)
"""
