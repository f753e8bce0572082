"""Scaling, projection and clustering (C-00 … C-09).

Fits are aggregates: means/standard deviations (one row), a p × p Gram or
covariance matrix, k centroids. They are small by construction (bounded by
the number of features and clusters), read on the driver, and applied back to
the rows as literal column expressions or a broadcast of k rows.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import long_table
from tessera.functions.hashing import row_hash
from tessera.session import FIT_ROWS, ship_package, written


# ---------------------------------------------------------------------- C-00
def fit_scaler(df: DataFrame, cols, ddof: int = 0) -> dict:
    """Mean, std (ddof 0 like sklearn's StandardScaler, or 1), min, max per column."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[std(c).alias(f"s_{c}") for c in cols],
                 *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: {"mean": row[f"m_{c}"], "std": row[f"s_{c}"], "min": row[f"lo_{c}"], "max": row[f"hi_{c}"]}
            for c in cols}


def standardise(df: DataFrame, cols, params: dict, keep=()) -> DataFrame:
    """C-00: (x − mean) / std with the fitted literals; a zero std maps to 0."""
    out = [F.col(k) for k in keep]
    for c in cols:
        m, s = params[c]["mean"], params[c]["std"]
        out.append(((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c))
    return df.select(*out)


def scaler_table(spark, params: dict) -> DataFrame:
    """C-00 report: (column, mean, std, min, max) saved next to the scaled data."""
    return spark.createDataFrame(
        [(c, float(p["mean"]), float(p["std"]), float(p["min"]), float(p["max"])) for c, p in params.items()],
        "column string, mean double, std double, min double, max double")


# ---------------------------------------------------------------------- C-01
def fit_pca(df: DataFrame, cols, k: int = 2) -> dict:
    """C-01: PCA on (already centred/scaled) columns from one covariance aggregate.

    The p × p covariance comes from ``covar_samp`` pairs in one pass; the
    eigen-decomposition of that small matrix runs on the driver. Components
    are sign-fixed so the largest-|loading| entry is positive.
    """
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.covar_samp(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    return {"cols": cols, "k": k, "eigenvalues": vals, "components": vecs[:, :k],
            "ratio": vals / vals.sum(), "means": means}


def pca_scores(df: DataFrame, model: dict, keep=()) -> DataFrame:
    """Project rows on the components (centring first; Spark ML PCA does not)."""
    out = [F.col(k) for k in keep]
    for j in range(model["k"]):
        expr = F.lit(0.0)
        for i, c in enumerate(model["cols"]):
            expr = expr + (F.col(c) - F.lit(model["means"][c])) * F.lit(float(model["components"][i, j]))
        out.append(expr.alias(f"pc{j + 1}"))
    return df.select(*out)


def pca_explained(spark, model: dict) -> DataFrame:
    return spark.createDataFrame(
        [(j + 1, float(model["eigenvalues"][j]), float(model["ratio"][j]),
          float(np.sum(model["ratio"][:j + 1]))) for j in range(len(model["eigenvalues"]))],
        "component int, explained_variance double, ratio double, cumulative double")


def pca_loadings(spark, model: dict) -> DataFrame:
    rows = [(c, *[float(model["components"][i, j]) for j in range(model["k"])])
            for i, c in enumerate(model["cols"])]
    schema = "feature string, " + ", ".join(f"pc{j + 1} double" for j in range(model["k"]))
    return spark.createDataFrame(rows, schema)


def fit_pca_vectors(df: DataFrame, vec_col: str, k: int) -> dict:
    """C-02: PCA of an array column with Spark ML (distributed covariance via
    a tree aggregate, local eigen-decomposition of the d × d matrix). Rows are
    centred with the fitted means first; components are sign-fixed as in
    :func:`fit_pca`. Fit once at the largest k; smaller k are prefixes."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector
    v = df.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="__v", outputCol="__c").fit(v)
    model = PCA(k=k, inputCol="__c", outputCol="__p").fit(scaler.transform(v))
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(k)]
    return {"scaler": scaler, "model": model, "signs": signs, "ratio": list(model.explainedVariance.toArray()),
            "dims": pc.shape[0]}


def pca_vector_scores(df: DataFrame, fitted: dict, vec_col: str, keep=()) -> DataFrame:
    """Scores of :func:`fit_pca_vectors` as an array column ``scores``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = df.select(*keep, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    out = fitted["model"].transform(fitted["scaler"].transform(v))
    signs = F.array(*[F.lit(s) for s in fitted["signs"]])
    return out.select(*keep, F.zip_with(vector_to_array("__p"), signs, lambda a, b: a * b).alias("scores"))


# ---------------------------------------------------------------- C-03 / C-04
RUNS = 4


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature vectors of the rows complete in ``cols``; the others (null or NaN,
    counted by Q-02) cannot be placed and are left out."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df.dropna(subset=list(cols)))


def fit_table(df: DataFrame, cols) -> DataFrame:
    """The rows of :func:`assemble` written once, in files small enough that all
    cores share every pass of a fit."""
    return written(assemble(df, cols), "kmeans-rows", FIT_ROWS)


def kmeans_best(df: DataFrame, cols, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 300,
                data: DataFrame | None = None):
    """C-03: k-means‖ runs with ``n_init`` seeds, RUNS at a time (each is a
    string of small jobs); keep the lowest training cost, of equal ones the
    first seed. Cluster ids are renumbered by the lexicographic order of the
    centroids so labels are stable across runs. ``data`` is the
    :func:`fit_table` of ``df`` where several fits share it; it is not cached
    here, so Spark's KMeans keeps each run's points decoded while it iterates."""
    data = fit_table(df, cols) if data is None else data

    def fit(i):
        m = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=1e-4, featuresCol="features",
                   predictionCol="__c").fit(data)
        return m.summary.trainingCost, i, m

    with ThreadPool(RUNS) as pool:
        cost, _, model = min(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(n_init)),
                             key=lambda run: run[:2])
    centers = model.clusterCenters()
    order = sorted(range(k), key=lambda j: tuple(centers[j]))
    relabel = {old: new for new, old in enumerate(order)}
    mapping = F.create_map(*[x for o, n in relabel.items() for x in (F.lit(o), F.lit(n))])
    labelled = model.transform(data).withColumn("cluster", mapping[F.col("__c")]).drop("__c")
    return labelled, [centers[j].tolist() for j in order], float(cost)


def silhouette(labelled: DataFrame, cluster: str = "cluster") -> float:
    """Silhouette with squared Euclidean distance (Spark's exact O(n·k) form)."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol=cluster,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(labelled))


SAMPLE_POINTS = 2000


def euclidean_silhouette(df: DataFrame, cols, cluster: str, id_col: str, points: int = SAMPLE_POINTS,
                         seed: int = 42) -> DataFrame:
    """C-04: (id, cluster, a, b, silhouette) with plain Euclidean distance for
    the first ``points`` rows in hash order (all of them in a smaller table),
    each measured against **all** rows.

    The sampled points travel to the tasks (``points`` x features numbers);
    every task adds up the distances of its rows to them per cluster in numpy
    blocks, and the sums are merged by a partial aggregate. a: mean distance to
    the other rows of the own cluster; b: least mean distance to another
    cluster; the value is (b - a) / max(a, b), 0 for a point alone in its
    cluster or where both are 0, null with one cluster. Rows with a missing
    feature or cluster take no part."""
    full = df.dropna(subset=[*cols, cluster]).select(F.col(id_col).alias("id"), F.col(cluster).cast("string").alias("c"),
                                                     F.array(*[F.col(x).cast("double") for x in cols]).alias("v"))
    chosen = full.orderBy(row_hash("id", seed), "id").limit(points).collect()
    kind = full.schema["id"].dataType
    if not chosen:
        return df.sparkSession.createDataFrame([], T.StructType([
            T.StructField("id", kind), T.StructField("cluster", T.StringType()),
            *[T.StructField(x, T.DoubleType()) for x in ("a", "b", "silhouette")]]))
    grid = np.array([r["v"] for r in chosen])

    def sums(batches):
        for rb in batches:
            c = np.array(rb.column(0).to_pylist(), object)
            x = rb.column(1).values.to_numpy(zero_copy_only=False).reshape(-1, grid.shape[1])
            for name in set(c):
                total = np.zeros(len(grid))
                part = x[c == name]
                for lo in range(0, len(part), 256):
                    total += np.sqrt(((part[lo:lo + 256, None, :] - grid[None]) ** 2).sum(2)).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid))), pa.array([name] * len(grid)), pa.array(total),
                                                  pa.array(np.full(len(grid), len(part)))], ["point", "other", "d", "n"])

    ship_package(df.sparkSession)
    per = full.select("c", "v").mapInArrow(sums, "point long, other string, d double, n long") \
        .groupBy("point", "other").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    own = df.sparkSession.createDataFrame([(i, r["id"], r["c"]) for i, r in enumerate(chosen)], T.StructType([
        T.StructField("point", T.LongType()), T.StructField("id", kind), T.StructField("cluster", T.StringType())]))
    mine = F.col("other") == F.col("cluster")
    near = per.join(own, "point").groupBy("point", "id", "cluster").agg(
        F.max(F.when(mine, F.col("d") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~mine, F.col("d") / F.col("n"))).alias("b"), F.count(F.lit(1)).alias("k"))
    value = F.when(F.col("k") < 2, F.lit(None)).when(F.col("a").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)) \
        .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return near.select("id", "cluster", "a", "b", value.alias("silhouette"))


def k_sweep(df: DataFrame, cols, ks, n_init: int = 10, seed: int = 42) -> DataFrame:
    """C-04: inertia and silhouette for each k."""
    rows = []
    data = fit_table(df, cols)
    for k in ks:
        lab, _, cost = kmeans_best(df, cols, k, n_init, seed, data=data)
        rows.append((int(k), cost, silhouette(lab)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


# ---------------------------------------------------------------------- C-05
def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """C-05: ARI of two labelings from their contingency counts (any n):
    (Σ C(n_ij,2) − E) / (½(Σ C(a_i,2) + Σ C(b_j,2)) − E), E = Σ C(a_i,2) Σ C(b_j,2) / C(n,2)."""
    c2 = lambda x: x * (x - 1) / 2.0
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    ra = cells.groupBy(a).agg(F.sum("nij").alias("ai"))
    rb = cells.groupBy(b).agg(F.sum("nij").alias("bj"))
    sij = cells.agg(F.sum(c2(F.col("nij"))).alias("sij"), F.sum("nij").alias("n"))
    sa = ra.agg(F.sum(c2(F.col("ai"))).alias("sa"))
    sb = rb.agg(F.sum(c2(F.col("bj"))).alias("sb"))
    one = sij.unionByName(sa, allowMissingColumns=True).unionByName(sb, allowMissingColumns=True) \
        .agg(F.max("sij").alias("sij"), F.max("n").alias("n"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))
    e = F.col("sa") * F.col("sb") / c2(F.col("n"))
    return one.select(((F.col("sij") - e) / (0.5 * (F.col("sa") + F.col("sb")) - e)).alias("ari"),
                      F.col("n").cast("long").alias("n"))


# ---------------------------------------------------------------------- C-06
def ward_on_centroids(centers: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Ward agglomeration of weighted centroids down to k groups (the input is
    the few micro-cluster centroids, never the rows). Returns the group of
    each centroid."""
    groups = {i: ([i], centers[i].astype(float), float(counts[i])) for i in range(len(centers))}
    while len(groups) > k:
        keys = list(groups)
        best = None
        for x in range(len(keys)):
            for y in range(x + 1, len(keys)):
                _, ca, na = groups[keys[x]]
                _, cb, nb = groups[keys[y]]
                cost = na * nb / (na + nb) * float(np.sum((ca - cb) ** 2))
                if best is None or cost < best[0]:
                    best = (cost, keys[x], keys[y])
        _, ka, kb = best
        ma, ca, na = groups.pop(ka)
        mb, cb, nb = groups.pop(kb)
        groups[ka] = (ma + mb, (ca * na + cb * nb) / (na + nb), na + nb)
    label = np.zeros(len(centers), dtype=int)
    ordered = sorted(groups.values(), key=lambda g: tuple(g[1]))
    for gi, (members, _, _) in enumerate(ordered):
        label[members] = gi
    return label


def ward_clusters(df: DataFrame, cols, k: int, micro: int = 50, seed: int = 42) -> DataFrame:
    """C-06: hierarchical (Ward) clustering re-aimed for scale: KMeans into
    ``micro`` micro-clusters (distributed), Ward merges of their centroids
    (micro × micro on the driver), mapped back with a k-row literal map."""
    n = df.count()
    m = int(min(micro, n))
    lab, centers, _ = kmeans_best(df, cols, m, n_init=1, seed=seed)
    counts = {r["cluster"]: r["count"] for r in lab.groupBy("cluster").count().collect()}
    cnt = np.array([counts.get(i, 0) for i in range(m)], dtype=float)
    keep = cnt > 0
    idx = np.flatnonzero(keep)
    groups = ward_on_centroids(np.array(centers)[keep], cnt[keep], k)
    mapping = F.create_map(*[x for i, g in zip(idx, groups) for x in (F.lit(int(i)), F.lit(int(g)))])
    return lab.withColumn("cluster_hc", mapping[F.col("cluster")]).drop("cluster")


# ---------------------------------------------------------------------- C-07
def purity_recall(df: DataFrame, cluster: str, segment: str) -> DataFrame:
    """C-07: for each cluster the share of its dominant segment (purity), and
    for each segment the share captured by its dominant cluster (recall)."""
    cells = df.groupBy(cluster, segment).agg(F.count(F.lit(1)).alias("n"))
    pur = cells.groupBy(cluster).agg((F.max("n") / F.sum("n")).alias("share"), F.sum("n").alias("size")) \
        .select(F.lit("purity").alias("kind"), F.col(cluster).cast("string").alias("label"), "share", "size")
    rec = cells.groupBy(segment).agg((F.max("n") / F.sum("n")).alias("share"), F.sum("n").alias("size")) \
        .select(F.lit("recall").alias("kind"), F.col(segment).cast("string").alias("label"), "share", "size")
    return pur.unionByName(rec)


# ---------------------------------------------------------------------- C-08
def compare_feature_sets(df: DataFrame, cols_a, cols_b, k: int, n_init: int = 10, seed: int = 42,
                         id_col: str = "id") -> DataFrame:
    """C-08: cluster on two feature sets; silhouette of each and ARI between them."""
    la, _, _ = kmeans_best(df, cols_a, k, n_init, seed)
    lb, _, _ = kmeans_best(df, cols_b, k, n_init, seed)
    sa, sb = silhouette(la), silhouette(lb)
    both = la.select(id_col, F.col("cluster").alias("a")).join(
        lb.select(id_col, F.col("cluster").alias("b")), on=id_col)
    ari = adjusted_rand_index(both, "a", "b").first()["ari"]
    return df.sparkSession.createDataFrame([(float(sa), float(sb), float(ari))],
                                           "silhouette_a double, silhouette_b double, ari double")


# ---------------------------------------------------------------------- C-09
def priority_score(df: DataFrame, signs: dict, keep=()) -> DataFrame:
    """C-09: mean of signed z-scores (ddof = 1, over **all** rows): +1 for
    columns where higher is worse, −1 where higher is better."""
    fit = df.agg(*[F.avg(c).alias(f"m_{c}") for c in signs],
                 *[F.stddev_samp(c).alias(f"s_{c}") for c in signs]).first()
    z = [F.lit(float(s)) * (F.col(c) - F.lit(fit[f"m_{c}"])) / F.lit(fit[f"s_{c}"]) for c, s in signs.items()]
    return df.select(*keep, *signs.keys(), (sum(z) / F.lit(len(z))).alias("score"))


def rank_in_worst_group(scored: DataFrame, group: str, id_col: str, top: int = 10) -> DataFrame:
    """C-09: the group with the highest mean score and its ``top`` members by
    score (ties by id).

    The worst group is a ``max_by`` over the per-group means, fitted first;
    the top members come from ``orderBy(...).limit`` (each task keeps its own
    best ``top`` rows), so a group holding a third of all rows is never
    sorted in one task. The rank is numbered over those ``top`` rows only.
    """
    worst = scored.groupBy(group).agg(F.avg("score").alias("m")).agg(F.max_by(group, "m")).first()[0]
    best = (scored.filter(F.col(group) == F.lit(worst))
            .orderBy(F.col("score").desc(), F.col(id_col)).limit(top))
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col(id_col))))
