"""Queries: scaling, PCA, clustering and partition comparison (C-*, D-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash_sql
from tessera.operators import cluster as C
from tessera.operators.describe import biplot_loadings
from tessera.plans.bindings import CUSTOMER_PROFILE_SQL, PROFILE_NUMERIC, customer_profile, with_sql
from tessera.plans.registry import query
from tessera.session import written

CP = with_sql(CUSTOMER_PROFILE_SQL)
NUM = list(PROFILE_NUMERIC)
U = "\nUNION ALL\n"


def _scaled(spark, d):
    p = written(customer_profile(spark, d), "profile")    # read by the scaler and by every use
    params = C.fit_scaler(p, NUM, ddof=0)
    return C.standardise(p, NUM, params, keep=["customer_id", "plan", "region"]), params


# C-00 -----------------------------------------------------------------------
@query("c00_standardise", CP + "\nSELECT customer_id, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in NUM) + " FROM customer_profile",
    doubles=NUM)
def c00_standardise(spark, d):
    return _scaled(spark, d)[0].drop("plan", "region")


@query("c00_scaler_params", CP + "\n" + U.join(
    f"SELECT '{c}' AS \"column\", avg({c}) AS mean, stddev_pop({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM customer_profile" for c in NUM), doubles=["mean", "std", "min", "max"])
def c00_scaler_params(spark, d):
    p = customer_profile(spark, d)
    return C.scaler_table(spark, C.fit_scaler(p, NUM, ddof=0))


# C-01 / D-08 ----------------------------------------------------------------
@query("c01_pca_explained")
def c01_pca_explained(spark, d):
    scaled, _ = _scaled(spark, d)
    return C.pca_explained(spark, C.fit_pca(scaled, NUM, k=2))


@query("c01_pca_scores")
def c01_pca_scores(spark, d):
    scaled, _ = _scaled(spark, d)
    return C.pca_scores(scaled, C.fit_pca(scaled, NUM, k=2), keep=["customer_id", "plan"])


@query("d08_biplot_loadings")
def d08_biplot_loadings(spark, d):
    scaled, _ = _scaled(spark, d)
    model = C.fit_pca(scaled, NUM, k=2)
    return biplot_loadings(C.pca_loadings(spark, model), C.pca_scores(scaled, model))


# C-03 / C-04 ----------------------------------------------------------------
@query("c03_kmeans_profile")
def c03_kmeans_profile(spark, d):
    scaled, _ = _scaled(spark, d)
    lab, _, _ = C.kmeans_best(scaled, NUM, k=3, n_init=10, seed=42)
    return lab.select("customer_id", "plan", "cluster")


@query("c04_k_sweep")
def c04_k_sweep(spark, d):
    scaled, _ = _scaled(spark, d)
    return C.k_sweep(scaled, NUM, range(2, 9))


_POINTS = C.SAMPLE_POINTS
_SIL_SQL = CP + ",\nx AS (SELECT customer_id, plan, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in NUM) + f""" FROM customer_profile),
p AS (SELECT * FROM x WHERE plan IS NOT NULL ORDER BY {row_hash_sql('customer_id', 42)}, customer_id LIMIT {_POINTS}),
d AS (SELECT p.customer_id, p.plan, x.plan AS other, sum(sqrt({" + ".join(f"(p.{c} - x.{c}) * (p.{c} - x.{c})" for c in NUM)})) AS d,
             count(*) AS n FROM p, x WHERE x.plan IS NOT NULL GROUP BY ALL),
ab AS (SELECT customer_id, plan, max(CASE WHEN plan = other THEN d / nullif(n - 1, 0) END) AS a,
              min(CASE WHEN plan <> other THEN d / n END) AS b FROM d GROUP BY ALL)
SELECT plan, count(*) AS n, avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette
FROM ab GROUP BY plan"""


@query("c04_euclidean_silhouette", _SIL_SQL, doubles=["silhouette"])
def c04_euclidean_silhouette(spark, d):
    """Mean Euclidean silhouette of the plans over the scaled profile."""
    scaled, _ = _scaled(spark, d)
    s = C.euclidean_silhouette(scaled, NUM, "plan", "customer_id")
    return s.groupBy(F.col("cluster").alias("plan")).agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))


# C-05 -----------------------------------------------------------------------
_ARI_SQL = CP + """,
cells AS (SELECT plan, region, count(*) AS nij FROM customer_profile GROUP BY ALL),
s AS (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM cells),
a AS (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT sum(nij) AS ai FROM cells GROUP BY plan)),
b AS (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT sum(nij) AS bj FROM cells GROUP BY region))
SELECT (sij - sa * sb / (n * (n - 1) / 2.0)) / (0.5 * (sa + sb) - sa * sb / (n * (n - 1) / 2.0)) AS ari,
       CAST(n AS BIGINT) AS n FROM s, a, b"""


@query("c05_ari_plan_vs_region", _ARI_SQL, doubles=["ari"], digits=9)
def c05_ari_plan_vs_region(spark, d):
    return C.adjusted_rand_index(customer_profile(spark, d), "plan", "region")


@query("c05_ari_kmeans_vs_plan")
def c05_ari_kmeans_vs_plan(spark, d):
    scaled, _ = _scaled(spark, d)
    lab, _, _ = C.kmeans_best(scaled, NUM, k=5, n_init=10, seed=42)
    return C.adjusted_rand_index(lab, "cluster", "plan")


# C-06 -----------------------------------------------------------------------
@query("c06_ward_vs_kmeans")
def c06_ward_vs_kmeans(spark, d):
    """Ward (micro-cluster re-aim) against KMeans, both k = 3: crosstab cells and ARI."""
    scaled, _ = _scaled(spark, d)
    km, _, _ = C.kmeans_best(scaled, NUM, k=3, n_init=10, seed=42)
    hc = C.ward_clusters(scaled, NUM, k=3, micro=50, seed=7)
    both = km.select("customer_id", "cluster").join(hc.select("customer_id", "cluster_hc"), on="customer_id")
    ari = C.adjusted_rand_index(both, "cluster", "cluster_hc").first()["ari"]
    return both.groupBy("cluster", "cluster_hc").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("ari", F.lit(float(ari)))


# C-07 -----------------------------------------------------------------------
@query("c07_purity_recall", CP + """,
cells AS (SELECT plan, region, count(*) AS n FROM customer_profile GROUP BY ALL)
SELECT 'purity' AS kind, plan AS label, max(n) / sum(n) AS share, sum(n) AS size FROM cells GROUP BY plan
UNION ALL
SELECT 'recall', region, max(n) / sum(n), sum(n) FROM cells GROUP BY region""",
       doubles=["share"], digits=9)
def c07_purity_recall(spark, d):
    """Plan taken as the cluster labelling, region as the reference segment."""
    return C.purity_recall(customer_profile(spark, d), "plan", "region")


# C-08 -----------------------------------------------------------------------
@query("c08_compare_feature_sets")
def c08_compare_feature_sets(spark, d):
    scaled, _ = _scaled(spark, d)
    return C.compare_feature_sets(scaled, NUM, [c for c in NUM if c != "tenure_days"], k=3,
                                  id_col="customer_id")


# C-09 -----------------------------------------------------------------------
# Fixed values: +1 where a higher value marks a customer at risk, −1 where higher is better.
PRIORITY_SIGNS = {"income": -1.0, "spend": -1.0, "frequency": -1.0, "ticket": -1.0, "tenure_days": 1.0}

_PRIO_SQL = CP + """,
s AS (SELECT customer_id, plan, """ + ", ".join(NUM) + ", (" + " + ".join(
    f"({sg}) * ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()" for c, sg in PRIORITY_SIGNS.items()) + \
    f") / {len(PRIORITY_SIGNS)} AS score FROM customer_profile)," + """
w AS (SELECT plan FROM s GROUP BY plan ORDER BY avg(score) DESC LIMIT 1)
SELECT customer_id, s.plan, score, CAST(row_number() OVER (ORDER BY score DESC, customer_id) AS INTEGER) AS rank
FROM s JOIN w ON s.plan = w.plan ORDER BY score DESC, customer_id LIMIT 10"""


@query("c09_priority_ranking", _PRIO_SQL, doubles=["score"])
def c09_priority_ranking(spark, d):
    scored = C.priority_score(customer_profile(spark, d), PRIORITY_SIGNS, keep=["customer_id", "plan"])
    return C.rank_in_worst_group(scored, "plan", "customer_id", top=10).select("customer_id", "plan", "score", "rank")
