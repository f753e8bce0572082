"""Helpers shared by the operators: table binding, text blocks, lineage cuts.

A *text block* is a bounded slice of an Arrow batch seen as one flat byte array
plus document offsets, so that numpy works on many documents at once and memory
follows the block size, not the batch size. One document longer than the bound
is a block of its own.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, ship_package

WHITE = b" \t\n\x0b\x0c\r"                    # the characters of [\x20\x09-\x0D]
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"
BLOCK_BYTES = 4 << 20
ARROW_ROWS = 500                              # rows of one Arrow batch of whole texts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers and bound Arrow batches of
    whole texts (rows can be long, so the default of 10,000 rows is too many)."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor costs only a re-read."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_col: str = "doc_id", text: str = "text") -> list[Column]:
    """A row's identity without a generated id: (doc_id, XXH64 of the text).
    Rows equal in both are copies of one row and share every decision."""
    return [F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key")]


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key; the right side's key
    columns are dropped."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def columns_of(df: DataFrame, but: tuple = ()) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores added as no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


# ------------------------------------------------------------- Arrow and numpy
def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def text_blocks(batches, column: str = "text", limit: int = BLOCK_BYTES):
    """Yield (record batch slice, bytes, offsets) of at most ``limit`` bytes of
    text, or one document."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        b, o = flat(rb.column(rb.schema.get_field_index(column)))
        lo = 0
        while lo < rb.num_rows:
            hi = max(lo + 1, int(np.searchsorted(o, o[lo] + limit, side="right")) - 1)
            hi = min(hi, rb.num_rows)
            yield rb.slice(lo, hi - lo), b[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]
            lo = hi


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


def words_of(b: np.ndarray, off: np.ndarray):
    """Word starts, ends (byte positions, end exclusive) and the index of each
    word's document, for words ``[^\\x20\\x09-\\x0D]+`` inside each document."""
    if len(b) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_IS_WHITE[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[off] = True
    prev = np.empty_like(solid)
    prev[0] = False
    prev[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~prev | edge[:-1]))
    nxt = np.empty_like(solid)
    nxt[-1] = False
    nxt[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~nxt | edge[1:])) + 1
    doc = np.searchsorted(off, start, side="right") - 1
    return start, end, doc


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, from eight-byte lanes read for all words at once;
    words longer than a lane continue with the words still unfinished."""
    n = len(start)
    h = (end - start).astype(np.uint64) * _ODD
    if n == 0:
        return h
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded, (len(b) + 1, 8), (1, 1))
    pos, left, live = start.copy(), end - start, None
    while True:
        lane = np.ascontiguousarray(lanes[pos]).view(np.uint64).ravel()
        short = np.minimum(left, 8).astype(np.uint64)
        keep = np.where(short == 8, ~np.uint64(0), (np.uint64(1) << (short * np.uint64(8) & np.uint64(63))) - np.uint64(1))
        if live is None:
            h = mix64((h ^ (lane & keep)) * _ODD)
        else:
            h[live] = mix64((h[live] ^ (lane & keep)) * _ODD)
        more = np.flatnonzero(left > 8)
        if len(more) == 0:
            return h
        live = more if live is None else live[more]
        pos, left = pos[more] + 8, left[more] - 8


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (document edges are
    the caller's business); length len(h) - k + 1."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    g = h[:m].copy()
    for j in range(1, k):
        g = g * _ODD + h[j:j + m]
    return mix64(g)


def strings(values: list, binary: bool = False) -> pa.Array:
    return pa.array(values, pa.binary() if binary else pa.string())


# ---------------------------------------------------------- connected components
def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component = smallest node reachable) for edges (a, b) of longs.

    Each round every node takes the least label among itself and its
    neighbours, then the label of that label (pointer jumping), until nothing
    changes; no round cap. A round is two equi-joins against a table unique on
    its key and partial min aggregates, so a hub is split, never gathered.
    Every round's labels are written to the shared folder, with the change flag
    beside them, so no round is computed twice."""
    e = edges.select("a", "b").where("a <> b")
    e = cut(e.union(e.select("b", "a")).distinct(), f"{name}-edges")
    labels = cut(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("comp")), f"{name}-labels")
    while True:
        seen = e.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("comp").alias("m"))
        near = labels.join(seen, "node", "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", F.coalesce("m", "comp")).alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = cut(near.join(jump, "comp", "left").select(
            "node", F.least("comp", F.coalesce("far", "comp")).alias("comp"), "old"), f"{name}-labels")
        if new.where("comp <> old").limit(1).count() == 0:
            return new.select("node", "comp")
        labels = new.select("node", "comp")
