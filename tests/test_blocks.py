"""X-06 and X-07 by blocks: exact on many small blocks, and pairs are never shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks as B
from tessera.operators import text as X


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 150)


def ranked(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    post = X.postings(df, "id", "text")
    vocab = X.numbered(X.fit_vocabulary(post, n_docs=len(texts)), "test-blocks")
    vec = {}
    for r in X.tfidf(post, vocab).collect():
        vec.setdefault(r.doc, {})[r.term] = r.w
    return X.written(X.ranked_weights(post, vocab), "test-blocks"), vec


def dot(x, y):
    return sum(w * y.get(t, 0.0) for t, w in x.items())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(n=60):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    out = [" ".join(rnd.choices(words, weights=[1 / (k + 1) for k in range(60)], k=rnd.randint(2, 25))) for _ in range(n)]
    return out + [t + f" w{i}" for i, t in enumerate(out[:20])]


def roots(nodes, edges):
    comp = {x: x for x in nodes}
    for _ in nodes:
        for x, y in edges:
            comp[x] = comp[y] = min(comp[x], comp[y])
    return comp


def test_f3_pairs_over_many_blocks_equal_brute_force(spark, small_blocks):
    r, vec = ranked(spark, texts())
    test, train = r.filter("doc % 3 = 0"), r.filter("doc % 3 > 0")
    for t in (0.5, 0.9):
        want = {(x, y): c for x in vec if x % 3 == 0 for y in vec if y % 3 and (c := dot(vec[x], vec[y])) >= t - 1e-12}
        pairs = X.cosine_pairs(test, train, t)
        assert "CartesianProduct" in plan(pairs) and "Exchange" not in plan(pairs)
        got = {(p.test_doc, p.train_doc): p.cosine for p in pairs.collect()}
        assert got == pytest.approx(want, abs=1e-9)
        some = {p.test_doc for p in X.cosine_pairs(test, train, t, some=True).collect()}
        assert some == {x for x, _ in want}


def test_f1_largest_over_many_blocks_equals_brute_force(spark, small_blocks):
    r, vec = ranked(spark, [*texts(), "alone zz", "zz alone"])
    test, train = r.filter("doc % 3 = 0"), r.filter("doc % 3 > 0")
    out = X.largest_similarity(test, train)
    assert "CartesianProduct" in plan(out) and "SortMergeJoin" not in plan(out)
    got = {p.doc: p.max_cosine for p in out.collect()}
    want = {x: max(dot(vec[x], vec[y]) for y in vec if y % 3) for x in vec if x % 3 == 0}
    assert got == pytest.approx({x: c for x, c in want.items() if c > 0}, abs=1e-9)


def test_f4_links_join_what_all_links_join(spark, small_blocks):
    r, vec = ranked(spark, texts())
    comps = spark.createDataFrame([(3, 0), (0, 0), (5, 0)], "node long, comp long")
    known = [(3, 0), (5, 0)]
    for t in (0.5, 0.8, 0.9):
        links = X.links_between(r, comps, t)
        assert "CartesianProduct" in plan(links) and "Exchange" not in plan(links)
        got = links.collect()
        assert all(p.test_doc < p.train_doc and p.cosine == pytest.approx(dot(vec[p.test_doc], vec[p.train_doc]), abs=1e-9)
                   and p.cosine >= t - 1e-12 for p in got)
        every = [(x, y) for x in vec for y in vec if x < y and dot(vec[x], vec[y]) >= t - 1e-12]
        assert roots(vec, [(p.test_doc, p.train_doc) for p in got] + known) == roots(vec, every + known)


def test_f4_family_without_star_gives_a_tree_of_links(spark):
    """200 near-copies, no component known: before, all 19,900 pairs were returned."""
    base = [f"part{i}" for i in range(60)]
    r, _ = ranked(spark, [" ".join(base[:i % 60] + [f"x{i}"] + base[i % 60 + 1:]) for i in range(200)])
    none = spark.createDataFrame([], "node long, comp long")
    links = X.links_between(r, none, 0.5).collect()
    assert len(links) == 199
    assert set(roots(range(200), [(p.test_doc, p.train_doc) for p in links]).values()) == {0}


def test_documents_without_an_id_or_a_term(spark):
    r, _ = ranked(spark, ["blue shirt", "blue shirt shirt", "steel knife"])
    bare = r.withColumn("doc", F.when(F.col("doc") == 1, None).otherwise(F.col("doc")))
    assert [p.doc for p in X.largest_similarity(bare.filter("doc = 0"), bare.filter("doc IS NULL")).collect()] == [0]
    assert X.links_between(bare, spark.createDataFrame([], "node long, comp long"), 0.5).count() == 0
    assert X.cosine_pairs(r, r.filter("1 = 0"), 0.5).count() == 0 == X.largest_similarity(r.filter("1 = 0"), r).count()


def test_f1_f3_group_norms_bound_every_pair_and_spare_most_checks(spark):
    """Before, every candidate of the leading terms was checked exactly."""
    r, vec = ranked(spark, texts())
    blocks = X.packed(r, 0.9, "test-bound")

    def work(a, b):
        every = [(i, j) for i in range(len(a.doc)) for j in range(len(b.doc))]
        i, j = (B.np.array(v) for v in zip(*every))
        ok = B._bounded(a, b, i, j, 0.9)
        yield {"test_doc": a.doc[i], "train_doc": b.doc[j], "cosine": ok.astype(float)}

    kept = {(p.test_doc, p.train_doc) for p in B.crossed(blocks, blocks, work, B.PAIRS).collect() if p.cosine}
    near = {(x, y) for x in vec for y in vec if dot(vec[x], vec[y]) >= 0.9 - 1e-12}
    assert near <= kept and len(kept) < len(vec) ** 2 / 4


def test_f1_f2_f3_a_task_holds_several_blocks(spark):
    """Before, each pair of blocks was a task that read both anew."""
    assert B._held(100, 100, 8) == (16, 4) and B._held(2, 2, 8) == (1, 1)
    r, vec = ranked(spark, texts())
    a = spark.createDataFrame([(k,) for k in range(90)], "at int")
    n = X.packed(r, 0.9, "test-held").crossJoin(a).withColumn("block", F.col("at")).drop("at").repartition(90)
    one = lambda x, y: iter([{"test_doc": B.np.array([x.block]), "train_doc": B.np.array([y.block]), "cosine": B.np.array([0.0])}])
    pairs = B.crossed(n, n, one, B.PAIRS, same=True)
    assert pairs.rdd.getNumPartitions() < 90 * 90 / 8
    assert sorted((p.test_doc, p.train_doc) for p in pairs.collect()) == [(x, y) for x in range(90) for y in range(x, 90)]
