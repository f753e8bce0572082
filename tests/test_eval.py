"""Evaluation, splits and text search against hand values and invariants."""

import random

from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import evaluate as E
from tessera.operators import splits as V
from tessera.operators import text as X


def test_identical_models_not_significant(spark):
    rows = [(i, i % 3, i % 3, (i * 7) % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, truth int, a int, b int")
    res = E.paired_bootstrap_f1(df, "truth", "a", "a", n_boot=500)
    assert res["observed_diff"] == 0.0 and not res["significant"] and res["p_value"] == 1.0


def test_clearly_worse_model_is_significant(spark):
    rnd = random.Random(0)
    truth = [rnd.randint(0, 2) for _ in range(360)]
    worse = [(t + 1) % 3 if rnd.random() < 0.3 else t for t in truth]
    df = spark.createDataFrame([(i, t, t, w) for i, (t, w) in enumerate(zip(truth, worse))],
                               "id long, truth int, good int, bad int")
    res = E.paired_bootstrap_f1(df, "truth", "good", "bad", n_boot=1000)
    back = E.paired_bootstrap_f1(df, "truth", "bad", "good", n_boot=1000)
    assert res["observed_diff"] > 0 and res["p_value"] < 0.05 and res["significant"]
    assert back["observed_diff"] == -res["observed_diff"] and back["significant"]


def test_coverage_falls_with_threshold(spark):
    df = spark.createDataFrame([(0, 0, 0.95), (1, 1, 0.6), (1, 0, 0.55), (0, 0, 0.92), (1, 1, 0.3)],
                               "truth int, pred int, conf double")
    cov = {r.threshold: r.coverage for r in E.coverage_by_threshold(df, "truth", "pred", "conf", [0.5, 0.9]).collect()}
    assert cov[0.5] == 0.8 and cov[0.9] == 0.4


def test_perfect_probabilities_give_pr_auc_one(spark):
    df = spark.createDataFrame([(i % 2, float(i % 2 == 0), float(i % 2 == 1)) for i in range(20)],
                               "truth int, p0 double, p1 double")
    ap = E.average_precision(df, "truth", {0: "p0", 1: "p1"}).agg(F.avg("ap")).first()[0]
    auc = E.roc_auc_ovr(df, "truth", {0: "p0", 1: "p1"}).agg(F.avg("auc")).first()[0]
    assert ap == 1.0 and auc == 1.0


def test_classification_metrics_hand_values(spark):
    # truth/pred pairs: class 0: tp 2, fn 1; class 1: tp 1, fp 1
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1)], "truth int, pred int")
    r = E.classification_metrics(df).first()
    assert r.accuracy == 0.75
    assert abs(r.precision_macro - (1.0 + 0.5) / 2) < 1e-12
    assert abs(r.recall_macro - (2 / 3 + 1.0) / 2) < 1e-12


def test_split_is_persistent_and_disjoint(spark, tmp_path):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(40)], "id long, label string")
    p = str(tmp_path / "split")
    s1 = V.persisted_split(df, "id", "label", p, 0.25, 42)
    s2 = V.persisted_split(df, "id", "label", p, 0.25, 42)
    a = {(r.id, r.split) for r in s1.collect()}
    assert a == {(r.id, r.split) for r in s2.collect()}
    test_ids = {i for i, s in a if s == "test"}
    assert len(test_ids) == 10 and len(a) == 40
    counts = {r.label: r["count"] for r in df.join(s1, "id").filter("split = 'test'").groupBy("label").count().collect()}
    assert counts == {"a": 5, "b": 5}


def test_split_independent_of_partitioning(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "id long, label int")
    a = {tuple(r) for r in V.stratified_split(df.repartition(1), "id", "label", 0.2, 7).collect()}
    b = {tuple(r) for r in V.stratified_split(df.repartition(7), "id", "label", 0.2, 7).collect()}
    assert a == b


def test_near_duplicate_one_extra_word(spark):
    train = spark.createDataFrame([(1, "blue cotton shirt with long sleeves"), (2, "steel kitchen knife")],
                                  "id long, text string")
    test = spark.createDataFrame([(3, "blue cotton shirt with long sleeves size")], "id long, text string")
    _, summary = X.near_duplicates(train, test, "id", "text", threshold=0.7)
    r = summary.first()
    assert (r.n_test, r.n_near_duplicate) == (1, 1)


def test_prefix_filter_matches_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    docs = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 12))) for _ in range(60)]
    docs += [d + " extra" for d in docs[:10]]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    post = X.postings(df, "id", "text")
    vocab = X.numbered(X.fit_vocabulary(post, n_docs=df.count()), "test-vocabulary")
    w = X.tfidf(post, vocab)
    ranked = X.ranked_weights(post, vocab)
    for t in (0.3, 0.5, 0.8, 0.95):
        fast = {(r.test_doc, r.train_doc): r.cosine for r in X.cosine_pairs(ranked, ranked, t).collect()}
        a, b = w.alias("a"), w.alias("b")
        brute = (a.join(b, "term").groupBy(F.col("a.doc").alias("x"), F.col("b.doc").alias("y"))
                 .agg(F.sum(F.col("a.w") * F.col("b.w")).alias("c")).filter(F.col("c") >= t - 1e-12))
        slow = {(r.x, r.y): r.c for r in brute.collect()}
        assert fast.keys() == slow.keys()
        assert all(abs(fast[k] - slow[k]) < 1e-9 for k in slow)


def test_template_family_costs_one_link_per_document(spark):
    """2,000 copies of a template with one changed word beside unrelated texts:
    star links join the family, the exact search forms no pair inside it."""
    base = [f"part{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i % 60] + [f"x{i}"] + base[i % 60 + 1:])) for i in range(2000)]
    rows += [(5000 + i, " ".join(f"o{i}n{k}" for k in range(20))) for i in range(50)]
    rows += [(6000 + i, t + " tail") for i, t in enumerate(x for _, x in rows[2000:2025])]
    df = spark.createDataFrame(rows, "id long, text string")
    kept = {r["id"] for r in X.remove_near_duplicates(df, "id", "text", 0.9).collect()}
    post = X.postings(df, "id", "text")
    ranked = X.ranked_weights(post, X.numbered(X.fit_vocabulary(post, n_docs=df.count()), "family"))
    star = X.star_links(ranked, ranked, 0.8, earlier=True)
    links = star.collect()
    assert len({r.test_doc for r in links}) == len(links) < len(rows)
    comps = X.connected_components(star, "test_doc", "train_doc")
    inside = X.links_between(ranked, comps, 0.8).where("test_doc < 2000 AND train_doc < 2000").count()
    assert inside <= 2 * 2000
    assert {5000 + i for i in range(50)} <= kept and not kept & set(range(6000, 6025))


def test_near_duplicate_removal_equals_brute_force(spark):
    rnd = random.Random(8)
    words = [f"v{i}" for i in range(25)]
    docs = [[rnd.choice(words) for _ in range(rnd.randint(4, 14))] for _ in range(50)]
    docs += [d[:-1] + [rnd.choice(words)] for d in docs[:25]] + [d + ["more"] for d in docs[10:30]]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "id long, text string")
    u = df.groupBy("text").agg(F.min("id").alias("id"))
    post = X.postings(u, "id", "text")
    w = X.tfidf(post, X.fit_vocabulary(post, n_docs=u.count()))
    vec = {}
    for r in w.collect():
        vec.setdefault(r.doc, {})[r.term] = r.w
    for t in (0.6, 0.8):
        comp = {i: i for i in vec}
        changed = True
        while changed:
            changed = False
            for i in vec:
                for j in vec:
                    if sum(x * vec[j].get(k, 0.0) for k, x in vec[i].items()) >= t - 1e-12 and comp[i] != comp[j]:
                        comp[i] = comp[j] = min(comp[i], comp[j])
                        changed = True
        got = {r["id"] for r in X.remove_near_duplicates(df, "id", "text", t).collect()}
        assert got == {i for i in vec if comp[i] == i}


def test_ari_identical_and_hand_counts(spark):
    df = spark.createDataFrame([(i, i % 4, i % 4) for i in range(40)], "id long, a int, b int")
    assert abs(C.adjusted_rand_index(df, "a", "b").first().ari - 1.0) < 1e-12
    cells = {(0, 1): 5, (0, 2): 84, (1, 0): 25, (1, 2): 6, (2, 1): 46, (2, 2): 1}
    rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    d2 = spark.createDataFrame(rows, "a int, b int")
    assert abs(C.adjusted_rand_index(d2, "a", "b").first().ari - 0.7838945400366291) < 1e-12


def test_grid_comparison_skips_incompatible_pairs(spark):
    from tessera.plans import REGISTRY
    from tessera.plans.q_models import _GRID_MODELS, _grid_compatible
    assert not _grid_compatible("naive_bayes", signed=True) and _grid_compatible("naive_bayes", signed=False)
    rows = REGISTRY["v06_grid_comparison"].run(spark, "/root/testdata/sf0.001").collect()
    # 5 representations (raw, raw_shifted, pca 10/20/30) × 4 models − 4 signed naive-Bayes pairs
    assert len(rows) == 5 * len(_GRID_MODELS) - 4
    assert len({(r.representation, r.dims, r.model) for r in rows}) == len(rows)
    assert not any(r.model == "naive_bayes" and r.representation != "raw_shifted" for r in rows)
    assert all(0.0 <= r.f1_macro <= 1.0 for r in rows)


def test_connected_components_match_union_find(spark):
    rnd = random.Random(11)
    # a long chain (diameter 40, beyond any small round cap) plus random edges
    edges = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    nodes = {n for e in edges for n in e}
    want = {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}
    got = X.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.comp for r in got.collect()} == want
