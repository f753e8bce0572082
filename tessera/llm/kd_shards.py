"""Operator 1 — sharding by K-d tree partitioning.

Every row is a point in metadata space with a weight (the bytes it will take).
A node that holds more than one leaf's worth is cut at the weighted quantile of
its *widest* dimension (extent inside the node over extent in the table), so
each child gets the share of bytes its leaves are due. Rows never move while
the tree grows: a level only aggregates weights per (node, bucket), narrows
every node's bucket around its goal, and sends back one row per open node.
Rows that tie on the dimension are told apart by a hash of the row and then by
a row number fixed when the points are written, so cuts fall between single
rows and one value holding a third of the table still splits.

Bounds: the driver and the broadcast tree hold a few numbers per tree node,
i.e. per shard; the shard count is a parameter or total bytes / target bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.common import cut

BUCKETS = 1024
TOLERANCE = 0.001            # a cut may miss its goal by this share of a leaf
SLOT_ROWS = 20_000           # rows numbered by one task
LIMIT = 2 ** 61              # coordinates are clamped to +-LIMIT


@dataclass
class _Cut:
    """Search state of one node: rows are ordered by (x[dim], hash, row number);
    ``fixed`` holds the leading keys already pinned to one value."""
    node: int
    parts: int
    left_parts: int
    dim: int
    lo: int
    hi: int
    goal: float              # bytes that belong left of the cut inside [lo, hi]
    slack: float
    fixed: tuple = ()
    at: int | None = None    # keys below ``at`` at level len(fixed) go left


def numeric_dim(c: Column | str) -> Column:
    """A number as a coordinate; null sorts first."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.least(F.greatest(c.cast("long"), F.lit(-LIMIT)), F.lit(LIMIT)), F.lit(-LIMIT - 1))


def label_dim(c: Column | str) -> Column:
    """A category as a coordinate: equal labels share a point; null sorts first."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.crc32(c.cast("string").cast("binary")), F.lit(-1))


def points(df: DataFrame, dims: list[Column], weight: Column, carry: list[Column]) -> DataFrame:
    """The slim table the tree works on: carried columns, weight, coordinates."""
    return df.select(*carry, weight.cast("long").alias("__w"), F.array(*dims).alias("__x")) \
        .withColumn("__h", F.shiftrightunsigned(F.xxhash64("*"), 3)) \
        .withColumns({"__r": F.monotonically_increasing_id(), "__node": F.lit(0)})


def _bucket(key: Column, lo: Column, step: Column) -> Column:
    return F.floor((key - lo) / step)


def kd_shards(df: DataFrame, dims: list[Column], weight: Column, carry: list[Column],
              n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Assign every row a ``shard`` (0 .. leaves - 1) and a ``slot`` (gapless
    from 0 inside the shard).

    Give ``n_shards``, or ``target_bytes`` to split until a leaf holds no more
    than that (within TOLERANCE and one row). Returns ``carry`` columns, weight
    as ``size``, ``shard``, ``slot``. Nulls in a dimension sort first; repeated
    rows and ties are separated by hash and row number; an empty table gives no
    rows. A single row heavier than the target is a leaf of its own."""
    names = [c for c in df.select(*carry).columns]
    rows = cut(points(df, dims, weight, carry), "kd-points")
    spark = df.sparkSession
    n_dims = len(dims)
    extent_cols = [f for d in range(n_dims) for f in
                   (F.min(F.col("__x")[d]).alias(f"lo{d}"), F.max(F.col("__x")[d]).alias(f"hi{d}"))]

    def stats(table):
        return {r["__node"]: r for r in table.groupBy("__node").agg(
            F.sum("__w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("__h").alias("lo_h"),
            F.max("__h").alias("hi_h"), F.min("__r").alias("lo_r"), F.max("__r").alias("hi_r"),
            *extent_cols).collect()}

    top = stats(rows).get(0)
    if top is None:
        return _numbered(rows, names)
    if n_shards is None:
        n_shards = max(1, -(-top["w"] // max(1, target_bytes)))
    leaf = top["w"] / n_shards
    whole = [max(1, top[f"hi{d}"] - top[f"lo{d}"]) for d in range(n_dims)]
    open_nodes, next_id, shard_of, info = {0: n_shards}, 1, {}, {0: top}
    while open_nodes:
        cuts = []
        for node, parts in sorted(open_nodes.items()):
            s = info.get(node)
            if parts == 1 or s is None:
                shard_of[node] = parts
                continue
            widths = [(s[f"hi{d}"] - s[f"lo{d}"]) / whole[d] for d in range(n_dims)]
            d = max(range(n_dims), key=lambda i: (widths[i], -i))
            left = parts // 2
            cuts.append(_Cut(node, parts, left, d, s[f"lo{d}"], s[f"hi{d}"], s["w"] * left / parts,
                             max(1.0, leaf * TOLERANCE)))
        if not cuts:
            break
        _search(spark, rows, cuts, info)
        tree = []
        open_nodes = {}
        for c in cuts:
            open_nodes[next_id], open_nodes[next_id + 1] = c.left_parts, c.parts - c.left_parts
            tree.append((c.node, c.dim, *_padded(c), next_id, next_id + 1))
            next_id += 2
        table = spark.createDataFrame(tree, _TREE).withColumnRenamed("node", "__node")
        goes_left = _below(F.col("__x")[F.col("dim")], F.col("__h"), F.col("__r"))
        rows = rows.join(F.broadcast(table), "__node", "left").withColumn(
            "__node", F.when(F.col("dim").isNull(), F.col("__node"))
            .when(goes_left, F.col("left")).otherwise(F.col("right"))).drop(*_TREE_COLS)
        info = stats(rows.where(F.col("__node").isin(list(open_nodes)) if len(open_nodes) <= 100
                                else F.col("__node") >= min(open_nodes)))
    number = {node: i for i, node in enumerate(sorted(shard_of))}
    leaves = spark.createDataFrame(sorted(number.items()), "__node int, shard int")
    return _numbered(rows.join(F.broadcast(leaves), "__node"), names)


_TREE = T.StructType([T.StructField(n, T.IntegerType() if n in ("node", "dim", "depth", "left", "right") else T.LongType())
                      for n in ("node", "dim", "depth", "f0", "f1", "at", "left", "right")])
_TREE_COLS = [f.name for f in _TREE.fields if f.name != "node"]


def _padded(c: _Cut):
    f = list(c.fixed) + [0, 0]
    return len(c.fixed), f[0], f[1], c.at


def _below(x: Column, h: Column, r: Column) -> Column:
    """Row order against a cut: leading keys pinned to f0, f1, then ``at``."""
    first = F.when(F.col("depth") == 0, x < F.col("at"))
    second = F.when(F.col("depth") == 1, (x < F.col("f0")) | ((x == F.col("f0")) & (h < F.col("at"))))
    third = (x < F.col("f0")) | ((x == F.col("f0")) & ((h < F.col("f1")) | ((h == F.col("f1")) & (r < F.col("at")))))
    return F.coalesce(first, second, third)


def _search(spark, rows: DataFrame, cuts: list[_Cut], info: dict) -> None:
    """Narrow all open cuts together, one aggregation a round."""
    schema = "__node int, dim int, depth int, f0 long, f1 long, lo long, hi long, step long, goal double"
    todo = list(cuts)
    while todo:
        table = []
        for c in todo:
            step = -(-(c.hi - c.lo + 1) // BUCKETS)
            f = list(c.fixed) + [0, 0]
            table.append((c.node, c.dim, len(c.fixed), f[0], f[1], c.lo, c.hi, step, float(c.goal)))
        state = F.broadcast(spark.createDataFrame(table, schema))
        x, h, r = F.col("__x")[F.col("dim")], F.col("__h"), F.col("__r")
        key = F.when(F.col("depth") == 0, x).when(F.col("depth") == 1, h).otherwise(r)
        inside = ((F.col("depth") < 1) | (x == F.col("f0"))) & ((F.col("depth") < 2) | (h == F.col("f1")))
        cells = rows.join(state, "__node").where(inside).withColumn("__k", key) \
            .where(F.col("__k").between(F.col("lo"), F.col("hi"))) \
            .groupBy("__node", "goal", _bucket(F.col("__k"), F.col("lo"), F.col("step")).alias("b")) \
            .agg(F.sum("__w").alias("w"), F.count(F.lit(1)).alias("n"),
                 F.min("__k").alias("k0"), F.max("__k").alias("k1"))
        # at most BUCKETS cells a node: a running sum finds the one that holds the goal
        run = Window.partitionBy("__node").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hit = cells.withColumn("before", F.coalesce(F.sum("w").over(run), F.lit(0))) \
            .where((F.col("before") <= F.col("goal")) & (F.col("before") + F.col("w") > F.col("goal")))
        found = {q["__node"]: q for q in hit.collect()}
        still = []
        for c in todo:
            q = found.get(c.node)
            if q is None:                       # goal at the very end: everything goes left
                c.at = c.hi + 1
                continue
            c.goal -= q["before"]
            if c.goal <= c.slack or q["n"] == 1 or q["w"] - c.goal <= c.slack:
                near_start = c.goal <= q["w"] - c.goal
                c.at = q["k0"] if near_start else q["k1"] + 1
                continue
            c.lo, c.hi = q["k0"], q["k1"]
            if c.lo == c.hi:                    # one value: order its rows by the next key
                c.fixed = (*c.fixed, c.lo)
                s = info[c.node]
                c.lo, c.hi = (s["lo_h"], s["hi_h"]) if len(c.fixed) == 1 else (s["lo_r"], s["hi_r"])
            still.append(c)
        todo = still


def _numbered(rows: DataFrame, names: list[str]) -> DataFrame:
    """Gapless slots: rows of a shard are spread over lots of about SLOT_ROWS,
    each lot is numbered by one task and offset by the lots before it."""
    if "shard" not in rows.columns:
        rows = rows.withColumn("shard", F.lit(0))
    n = rows.count()
    lots = max(1, -(-n // SLOT_ROWS))
    rows = rows.withColumn("__lot", F.pmod(F.xxhash64("__r"), F.lit(lots)).cast("int"))
    counts = rows.groupBy("shard", "__lot").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__lot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("shard", "__lot").orderBy("__h", "__r")
    return rows.withColumn("__i", F.row_number().over(inside)) \
        .join(starts, ["shard", "__lot"]) \
        .select(*names, F.col("__w").alias("size"), F.col("shard").cast("int"),
                (F.col("__start") + F.col("__i") - 1).cast("long").alias("slot"))
