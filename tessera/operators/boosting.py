"""Boosted trees of many step sizes over shared folds (V-07).

A tree over binned features sees a row only by its bins, so rows of one fold that
agree in all bins become one cell (rows, sum of the target; the same of the
held-out rows): at most min(rows, bins ^ features) cells, whatever the table's
size. Cells are packed into blocks and written once; a task streams the blocks of
one fold and grows the ensembles of a few step sizes over them in numpy. The
driver holds the cuts of the bins and one number per (step, fold).

The trees are those of Spark's ``GBTRegressor`` with squared loss: the same
candidate cuts where Spark takes all rows for them (here always all rows), gains and
doubled gradient; of cuts that gain the same to the last digits either may be taken. A
missing feature takes the mean of the fold's training rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import number
from tessera.operators.splits import kfold
from tessera.session import FIT_ROWS, ship_package, written

# Rows binned at a time; up to how many rows every value counts for
# the cuts, and values kept per chunk, fold and feature above (rank error: one
# part in POINTS); rows a block; cells worked on at a time (their buffers stay in
# the core's cache); bins; features a packed key; ensembles a task.
CHUNK, EXACT, POINTS, BLOCK, PART, BINS, KEY, STEPS = 500_000, 200_000, 2_048, 1_000_000, 65_536, 32, 12, 3
# Cells of a fold that one task may hold (about 60 bytes each).
MAX_CELLS = 12_000_000
PACKED = {"bins": np.uint8, "n": np.int64, "s": np.float64, "m": np.int64, "t": np.float64}


def _chunks(batches):
    """Arrow batches joined to tables of about ``CHUNK`` rows, as (fold, features, y)."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield _arrays(held)
            held, size = [], 0
    if size:
        yield _arrays(held)


def _arrays(batches):
    fold, *x, y = (c.to_numpy() for c in pa.Table.from_batches(batches).columns)
    return fold, x, y


def candidate_cuts(values, counts, bins: int = BINS) -> np.ndarray:
    """Cuts between ascending distinct values: all midpoints where there are fewer
    than ``bins``, else those nearest to equal shares of the rows."""
    bins = int(min(bins, counts.sum()))
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    total = np.cumsum(counts).astype(float)
    half = (total[:-1] + total[1:]) / 2
    stride = total[-1] / bins
    cuts, target, at = [], stride, 0
    while (at := max(at, int(np.searchsorted(half, target, "right")))) < len(half):
        cuts.append(middle[at])
        target += stride
        at += 1
    return np.array(cuts)


def _fold_cuts(folded: DataFrame, d: int, k: int, n: int, facts: dict) -> list[list[np.ndarray]]:
    """Cuts of every fold and feature, from the fold's training rows."""
    points = n if n <= EXACT else POINTS

    def summary(batches):
        for fold, x, _ in _chunks(batches):
            for g in np.unique(fold):
                for c in range(d):
                    v = x[c][fold == g]
                    v, m = np.unique(v[~np.isnan(v)], return_counts=True)
                    if len(v) > points:     # the largest value of each share, with the share's rows
                        share = np.cumsum(m) * points // (m.sum() + 1)
                        last = np.flatnonzero(np.r_[share[1:] != share[:-1], True])
                        v, m = v[last], np.diff(np.r_[0, np.cumsum(m)[last]])
                    yield pa.RecordBatch.from_pydict({"g": np.array([g], np.int32), "c": np.array([c], np.int32),
                                                      "v": pa.array([v.tobytes()], pa.binary()), "m": pa.array([m.astype(np.int64).tobytes()], pa.binary())})

    held: dict = {}
    for r in folded.mapInArrow(summary, "g int, c int, v binary, m binary").collect():
        held.setdefault((r.g, r.c), []).append((np.frombuffer(r.v), np.frombuffer(r.m, np.int64)))
    out = []
    for f in range(k):
        out.append([])
        for c in range(d):
            gaps = sum(facts[g]["n"] - facts[g]["held"][c] for g in facts if g != f)
            parts = [p for g in facts if g != f for p in held.get((g, c), [])]
            if gaps:
                parts.append((np.array([facts[f]["fill"][c]]), np.array([gaps])))
            if not parts:
                out[f].append(np.zeros(0))
                continue
            v, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            out[f].append(candidate_cuts(v, np.bincount(where, np.concatenate([p[1] for p in parts]))))
    return out


def fold_cells(df: DataFrame, cols, y: str, id_col: str, k: int, seed: int) -> tuple[DataFrame, dict]:
    """(blocks of cells, facts): per fold its cells in packed rows (f, size, one
    binary per array of ``PACKED``), and per fold the held-out rows' number, sums
    and the target's shift."""
    spark = df.sparkSession
    ship_package(spark)
    cols, d = list(cols), len(list(cols))
    folded = kfold(df, id_col, k, seed).filter("fold IS NOT NULL").select("fold", *[number(c).alias(f"x{i}") for i, c in enumerate(cols)],
                                                                            number(y).alias("y"))
    folded = written(folded, "boost-folds", FIT_ROWS)
    shift = folded.agg(F.avg("y")).first()[0] or 0.0
    out = F.col("y") - F.lit(float(shift))
    rows = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("n_y"), F.sum(out).alias("sum"), F.sum(out * out).alias("square"),
                                      *[f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(d) for f in (F.count, F.sum)]).collect()
    if any(r["n_y"] < r["n"] for r in rows):
        raise ValueError(f"rows without {y}")
    facts = {r["fold"]: {"n": r["n"], "sum": r["sum"], "square": r["square"], "held": [r[f"count{i}"] for i in range(d)],
                         "total": [r[f"sum{i}"] or 0.0 for i in range(d)]} for r in rows}
    for f in range(k):
        one = facts.setdefault(f, {"n": 0, "sum": 0.0, "square": 0.0, "held": [0] * d, "total": [0.0] * d})
        one["fill"] = [sum(o["total"][i] for g, o in facts.items() if g != f) / max(sum(o["held"][i] for g, o in facts.items() if g != f), 1)
                       for i in range(d)]
    cuts = _fold_cuts(folded, d, k, sum(o["n"] for o in facts.values()), facts)
    fills = [facts[f]["fill"] for f in range(k)]
    keys = [f"k{i}" for i in range(-(-d // KEY))]

    def cells(batches):
        for fold, x, target in _chunks(batches):
            target = target - shift
            for f in range(k):
                packed = [np.zeros(len(target), np.int64) for _ in keys]
                for c in range(d):
                    v = np.where(np.isnan(x[c]), fills[f][c], x[c])
                    packed[c // KEY] |= np.searchsorted(cuts[f][c], v, "left") << (5 * (c % KEY))
                r = _merged(packed, fold != f, fold == f, target)
                yield pa.RecordBatch.from_pydict({"f": np.full(len(r["n"]), f, np.int32), **r})

    n_blocks = sum(o["n"] for o in facts.values()) // BLOCK + 1
    parts = folded.mapInArrow(cells, ", ".join(["f int", *[f"{c} long" for c in keys], "n long", "s double", "m long", "t double"]))

    def pack(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_numpy() for c in table.column_names}
        r = _summed([columns[c] for c in keys], [columns[c] for c in ("n", "s", "m", "t")])
        bins = np.stack([(r[keys[c // KEY]] >> (5 * (c % KEY))) & (BINS - 1) for c in range(d)])
        row = {"bins": bins, **{c: r[c] for c in ("n", "s", "m", "t")}}
        return pa.table({"f": table["f"][:1].combine_chunks(), "size": pa.array([len(r["n"])], pa.int64())} | {
            c: pa.array([np.ascontiguousarray(row[c].astype(kind)).tobytes()], pa.binary()) for c, kind in PACKED.items()})

    blocks = parts.withColumn("b", F.pmod(F.xxhash64(*keys), F.lit(n_blocks))).groupBy("f", "b").applyInArrow(
        pack, "f int, size long, " + ", ".join(f"{c} binary" for c in PACKED))
    return written(blocks, "boost-cells", 1), facts


def _summed(keys, sums) -> dict:
    """One cell per distinct key: the sums of its rows."""
    order = np.lexsort(keys)
    first = np.zeros(len(order), bool)
    first[:1] = True
    for key in keys:
        first[1:] |= key[order][1:] != key[order][:-1]
    first = np.flatnonzero(first)
    out = {f"k{i}": key[order][first] for i, key in enumerate(keys)}
    return out | {c: np.add.reduceat(v[order], first) for c, v in zip(("n", "s", "m", "t"), sums)}


def _merged(keys, train, test, target) -> dict:
    return _summed(keys, [train.astype(np.int64), target * train, test.astype(np.int64), target * test])


class Booster:
    """Ensembles of trees of at most three levels over the cells of one fold."""

    def __init__(self, bins, n, s, m, t):
        self.bins, self.n, self.s, self.m, self.t = bins, n.astype(float), s, m.astype(float), t
        self.d, self.size = bins.shape
        # two features share a key, so that one count serves both
        self.pairs = [(c, min(c + 1, self.d - 1)) for c in range(0, self.d, 2)]
        self.keys = [bins[a].astype(np.uint16) * BINS + bins[b] for a, b in self.pairs]
        self.spans = [slice(lo, lo + PART) for lo in range(0, self.size, PART)]
        # buffers of a span, for new arrays cost more than the sums
        self.base, self.at = np.empty((2, PART), np.intp)
        self.open = np.empty(PART)
        self.rows = {}

    def _sums(self, weights, place=None, nodes: int = 1) -> np.ndarray:
        """(node, feature, bin) sums of ``weights(span)``; ``place(span)`` is the node of each cell."""
        joint = np.zeros((len(self.pairs), nodes * BINS * BINS))
        for span in self.spans:
            w = weights(span)
            base, at = self.base[:len(w)], self.at[:len(w)]
            if place:
                np.multiply(place(span), BINS * BINS, out=base, dtype=np.intp, casting="unsafe")
            else:
                base[:] = 0
            for row, key in zip(joint, self.keys):
                np.add(base, key[span], out=at)
                row += np.bincount(at, w, len(row))
        out = np.empty((nodes, self.d, BINS))
        for (a, b), row in zip(self.pairs, joint.reshape(-1, nodes, BINS, BINS)):
            out[:, a], out[:, b] = row.sum(2), row.sum(1)
        return out

    def _counted(self, box: dict) -> np.ndarray:
        """(feature, bin) training rows of a box {feature: (first bin, last bin + 1)} of at most two features."""
        names = tuple(sorted(box))
        if names not in self.rows:
            shape = (BINS,) * len(names)
            table = np.zeros((*shape, self.d, BINS))
            for c in range(self.d):
                joint = np.zeros(BINS ** (len(names) + 1))
                for span in self.spans:
                    at = np.zeros(len(self.n[span]), np.intp)
                    for name in (*names, c):
                        at = at * BINS + self.bins[name][span]
                    joint += np.bincount(at, self.n[span], len(joint))
                table[..., c, :] = joint.reshape(*shape, BINS)
            for axis in range(len(names)):
                table = np.concatenate([np.zeros_like(np.take(table, [0], axis)), np.cumsum(table, axis)], axis)
            self.rows[names] = table
        table = self.rows[names]
        for name in names:
            lo, hi = box[name]
            table = table[hi] - table[lo]
        return table

    def _split(self, sums, count):
        """(feature, bin) whose cut gains most, None where none gains."""
        left, n_left = np.cumsum(sums, 1)[:, :-1], np.cumsum(count, 1)[:, :-1]
        total, n = sums[0].sum(), count[0].sum()
        right, n_right = total - left, n - n_left
        ok = (n_left > 0) & (n_right > 0)
        if not ok.any():
            return None
        gain = np.where(ok, left ** 2 / np.maximum(n_left, 1) + right ** 2 / np.maximum(n_right, 1), -np.inf)
        at = int(np.argmax(gain))
        if gain.flat[at] - total ** 2 / n <= 0:
            return None
        return divmod(at, BINS - 1)

    def _places(self, tree, levels):
        """The node of each cell of a span after ``levels`` levels, as 0 … 2 ^ levels − 1;
        a node without a cut sends all cells left."""
        def at(span):
            node = None
            for level in range(levels):
                here = tree[level]
                right = None
                for i, cut in enumerate(here):
                    if cut is None:
                        continue
                    goes = self.bins[cut[0]][span] > cut[1]
                    if node is not None:
                        goes &= node == i
                    right = goes if right is None else right | goes
                size = len(self.n[span])
                right = np.zeros(size, np.uint8) if right is None else right.view(np.uint8)
                node = right if node is None else node * np.uint8(2) + right
            return node
        return at

    def fit_errors(self, step: float, rounds: int, depth: int = 3) -> float:
        """The sum of n F² − 2 F t over the held-out cells, for the prediction F after ``rounds`` trees."""
        pred = np.zeros(self.size)
        if not self.n.any():
            raise ValueError("a fold without training rows")

        def open_(span):
            out = self.open[:len(pred[span])]
            return np.subtract(self.s[span], np.multiply(self.n[span], pred[span], out=out), out=out)

        for r in range(rounds):
            tree, boxes, values = [], [{}], [None]
            for level in range(depth):
                sums = self._sums(open_, self._places(tree, level) if level else None, 2 ** level)
                cuts, below, means = [], [], []
                for i, box in enumerate(boxes):
                    cut, count, total = None, None, values[i]
                    if box is not None:
                        count = self._counted(box)
                        total = sums[i, 0].sum() / count[0].sum()
                        cut = self._split(sums[i], count)
                    cuts.append(cut)
                    if cut is None:
                        below += [None, None]
                        means += [total, total]
                        continue
                    c, at = cut
                    lo, hi = box.get(c, (0, BINS))
                    below += [box | {c: (lo, at + 1)}, box | {c: (at + 1, hi)}]
                    n_left, s_left = count[c, :at + 1].sum(), sums[i, c, :at + 1].sum()
                    means += [s_left / n_left, (sums[i, c].sum() - s_left) / (count[c].sum() - n_left)]
                tree.append(cuts)
                boxes, values = below, means
                if all(box is None for box in boxes):
                    break
            leaf = self._places(tree, len(tree))
            add = np.array(values) * (1.0 if r == 0 else 2.0 * step)  # the first tree counts whole, gradients are doubled
            for span in self.spans:
                pred[span] += add[leaf(span)]
        return float((self.m * pred * pred - 2.0 * pred * self.t).sum())


def boosted_scores(df: DataFrame, cols, y: str, id_col: str, steps, rounds: int = 100, k: int = 5, seed: int = 42) -> list[tuple] | None:
    """V-05 of one ensemble per step size: (step, mean and population std of RMSE,
    mean R²) over the ``k`` folds of :func:`kfold`. None where a fold has more
    than ``MAX_CELLS`` cells, which no single task should hold."""
    steps = list(steps)
    blocks, facts = fold_cells(df, cols, y, id_col, k, seed)
    if any(r["n"] > MAX_CELLS for r in blocks.groupBy("f").agg(F.sum("size").alias("n")).collect()):
        return None
    spark, d, a_fold = df.sparkSession, len(list(cols)), -(-len(steps) // STEPS)
    pairs = None
    for f in (f for f in range(k) if facts[f]["n"]):
        tasks = spark.range(f * a_fold, (f + 1) * a_fold, 1, a_fold).hint("shuffle_replicate_nl")
        one = blocks.filter(F.col("f") == f).coalesce(1).crossJoin(tasks)
        pairs = one if pairs is None else pairs.unionByName(one)
    if pairs is None:
        return []

    def run(batches):
        parts, task = [], None
        for batch in batches:
            for at in range(batch.num_rows):
                parts.append([np.frombuffer(batch.column(c)[at].as_buffer(), kind) for c, kind in PACKED.items()])
                task = batch.column("id")[at].as_py()
        if task is None:
            return
        bins = np.concatenate([p[0].reshape(d, -1) for p in parts], axis=1)
        booster = Booster(bins, *[np.concatenate([p[i] for p in parts]) for i in range(1, 5)])
        del parts
        f, lot = divmod(task, a_fold)
        for i in range(lot * STEPS, min((lot + 1) * STEPS, len(steps))):
            yield pa.RecordBatch.from_pydict({"f": np.array([f], np.int32), "i": np.array([i], np.int32),
                                              "e": [booster.fit_errors(steps[i], rounds)]})

    error = {(r["f"], r["i"]): r["e"] for r in pairs.mapInArrow(run, "f int, i int, e double").collect()}
    out = []
    for i, step in enumerate(steps):
        rmse, r2 = [], []
        for f in (f for f in range(k) if facts[f]["n"]):
            n, total, square = (facts[f][c] for c in ("n", "sum", "square"))
            sse, spread = max(square + error[f, i], 0.0), square - total * total / n
            rmse.append(math.sqrt(sse / n))
            if spread > 0:
                r2.append(1 - sse / spread)
        out.append((step, float(np.mean(rmse)), float(np.std(rmse)), float(np.mean(r2)) if r2 else None))
    return out
