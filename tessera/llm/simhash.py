"""Operator 3 — SimHash near-dedup by tiled exact comparison.

Fingerprints: one pass over whole texts in Arrow batches. Links: distinct
fingerprints are laid out in *tiles* of equal population counts, and tiles are
compared with numpy exclusive-or and bit counts. The population count is taken
per 16-bit quarter: the Hamming distance of two fingerprints is at least the
sum of the differences of their quarter counts, so a tile pair whose counts
differ by more than the radius in sum holds no link and is skipped. With
random-like fingerprints this leaves about 5 % of all pairs (one count over the
whole word would leave about half).

A tile is cut into pieces of about TILE fingerprints by a hash, so a crowded
tile becomes many bounded pieces; each piece travels once to every neighbour
tile (at most 65). A tile pair reports a spanning forest of its links (at most
one edge per fingerprint), never all pairs of a family; joining those forests
gives the same components as all links would. Equal fingerprints are one node,
so copies never meet in pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, cut, flat, free_names, null_safe, prepare, row_key, text_blocks

TILE = 1024
QUARTER = 16
SEED = 42


# --------------------------------------------------------------- fingerprints
def _majority(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per run of hashes (runs end at ``ends``, none empty): bit set if set in
    over half of the run."""
    starts = np.concatenate([[0], ends[:-1]])
    need = (ends - starts) // 2
    out = np.zeros(len(ends), np.uint64)
    for bit in range(64):
        ones = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(1), starts)
        out |= (ones > need).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints_of(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """SimHash of each text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``,
    ``shingle``-word runs joined by a space, XXH64 with seed 42; a shorter text
    is one shingle, a text without words gives zero."""
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes, ends, which = [], [], []
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), seed))
        else:
            line = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            stop = np.cumsum(size)
            first = (stop - size)[:len(words) - shingle + 1].tolist()
            last = (stop[shingle - 1:] - 1).tolist()
            hashes.extend([digest(line[a:z], seed) for a, z in zip(first, last)])
        ends.append(len(hashes))
        which.append(i)
    out = np.zeros(len(texts), np.uint64)
    if which:
        out[which] = _majority(np.array(hashes, np.uint64), np.array(ends))
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fp): the 64-bit fingerprint of every row as a long."""
    prepare(df.sparkSession)

    def run(batches):
        for rb, b, off in text_blocks(batches, "text"):
            raw, o = b.tobytes(), off.tolist()
            fp = fingerprints_of([raw[a:z] for a, z in zip(o[:-1], o[1:])], shingle)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    return df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, fp long")


# ---------------------------------------------------------------------- links
def _neighbours(radius: int) -> list[int]:
    """Tile code differences (quarter counts in base 32) whose sum of absolute
    differences is within the radius, one of each mirrored couple."""
    out = []
    for d in product(range(-radius, radius + 1), repeat=4):
        if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0):
            out.append(((d[0] * 32 + d[1]) * 32 + d[2]) * 32 + d[3])
    return out


def forest(nodes: np.ndarray, u: np.ndarray, v: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Merge edges (u, v) of node positions into ``label`` (least position of
    each component)."""
    while len(u):
        a, c = label[u], label[v]
        live = a != c
        if not live.any():
            return label
        u, v, a, c = u[live], v[live], a[live], c[live]
        np.minimum.at(label, np.maximum(a, c), np.minimum(a, c))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or inside one), as
    pairs of fingerprints."""
    nodes = a if same else np.concatenate([a, b])
    label = np.arange(len(nodes))
    shift = 0 if same else len(a)
    strip = max(1, (1 << 20) // max(1, len(b)))
    for lo in range(0, len(a), strip):
        near = np.bitwise_count(a[lo:lo + strip, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            label = forest(nodes, i + lo, j + shift, label)
    hit = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hit], nodes[label[hit]]


def link_forest(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b): edges between distinct fingerprints that join exactly the
    fingerprints within ``radius`` bits of each other, transitively."""
    prepare(fps.sparkSession)
    code = None
    for q in range(4):
        ones = F.bit_count(F.shiftrightunsigned("fp", 48 - QUARTER * q).bitwiseAND(F.lit(0xFFFF)))
        code = ones if code is None else code * 32 + ones
    coded = fps.select("fp", code.cast("int").alias("code"))
    counts = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"))       # at most 17^4 codes
    pieces = cut(coded.join(counts, "code")
                 .withColumn("piece", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile)).cast("int"))
                 .groupBy("code", "piece").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    steps = F.array(*[F.lit(d) for d in _neighbours(radius)])
    left = pieces.select(F.col("code").alias("home"), F.col("piece").alias("p"), F.col("fps").alias("a"),
                         F.explode(F.transform(steps, lambda d: F.col("code") + d)).alias("code"))
    pairs = left.join(pieces, "code") \
        .where((F.col("home") < F.col("code")) | (F.col("home") > F.col("code")) | (F.col("p") <= F.col("piece"))) \
        .select("a", F.col("fps").alias("b"), ((F.col("home") == F.col("code")) & (F.col("p") == F.col("piece"))).alias("same"))

    def run(batches):
        for rb in batches:
            ca, cb, same = rb.column(0), rb.column(1), rb.column(2).to_pylist()
            (va, oa), (vb, ob) = _lists(ca), _lists(cb)
            us, vs = [], []
            for k in range(rb.num_rows):
                u, v = tile_links(va[oa[k]:oa[k + 1]], vb[ob[k]:ob[k + 1]], radius, same[k])
                if len(u):
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us).view(np.int64)),
                                                  pa.array(np.concatenate(vs).view(np.int64))], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _lists(col: pa.Array) -> tuple[np.ndarray, list]:
    off = col.offsets.to_numpy()
    return col.values.to_numpy().view(np.uint64), off.tolist()


def simhash_components(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                       shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``df``: doc_id, text_key, fingerprint (16 hex digits),
    component_id = smallest doc_id reachable over links of at most ``radius``
    differing bits, comp = the component itself (its least fingerprint as a
    long), which differs between unlinked texts that share a doc_id.

    Null and empty texts have fingerprint zero and link like any other. Rows
    without a doc_id take part in links but never name a component: a component
    of such rows only has a null component_id. Repeated rows and texts share a
    fingerprint. An empty table gives no rows."""
    rows = cut(fingerprints(df, id_col, text, shingle), "simhash-rows")
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    comp = components(link_forest(nodes, radius), "simhash")
    linked = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("comp", F.coalesce("comp", "fp"))
    least = linked.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_fp = cut(linked.select("fp", "comp").join(least, "comp").select("fp", "comp", "component_id"), "simhash-classes")
    return rows.join(by_fp, "fp") \
        .select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "comp")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """``df`` with one row of each component: of its rows with the smallest
    doc_id (null where no row of it has one) the one of least text key; of rows
    equal in doc_id and text, one stays. Unlinked texts under one doc_id are
    components of their own and each keep a row."""
    found = simhash_components(df, id_col, text, shingle, radius)
    doc, key = free_names(df, "__doc", "__key")
    chosen = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("comp", "doc_id").agg(F.min("text_key").alias("text_key")) \
        .select(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
    extra = {doc: F.col(id_col), key: F.xxhash64(F.col(text))}
    return null_safe(df.withColumns(extra), chosen, [doc, key], "left_semi").dropDuplicates([doc, key]).drop(doc, key)
