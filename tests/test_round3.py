"""Top-1 cosine search, Euclidean silhouette and cross-validated text models
against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import models as M
from tessera.operators import text as X


def cosines(train, test):
    """Largest cosine of each test text by comparing all pairs."""
    bag = lambda t: Counter(w for w in t.lower().split() if len(w) > 1)
    docs = {t: bag(t) for t in set(train)}
    n = len(docs)
    df = Counter(w for b in docs.values() for w in b)
    idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}

    def unit(b):
        v = {w: k * idf[w] for w, k in b.items() if w in idf}
        z = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / z for w, x in v.items()} if z else {}
    vec = [unit(b) for b in docs.values()]
    best = {}
    for t in set(test):
        q = unit(bag(t))
        best[t] = max((sum(x * v.get(w, 0.0) for w, x in q.items()) for v in vec), default=0.0)
    return best


def test_largest_similarity_equals_all_pairs(spark):
    rnd = random.Random(4)
    vocab = [f"w{k}" for k in range(120)]
    say = lambda: " ".join(rnd.choices(vocab, weights=[1 / (k + 1) for k in range(120)], k=rnd.randint(1, 25)))
    train = [say() for _ in range(150)]
    test = [say() for _ in range(60)] + train[:5] + [train[7] + " extra", "unknown terms only", "w0", "w0", "W0"]
    rows = [(i, t) for i, t in enumerate(train)]
    asked = [(1000 + i, t) for i, t in enumerate(test)]
    per, summary = X.similarity_report(spark.createDataFrame(rows, "id long, text string"),
                                       spark.createDataFrame(asked, "id long, text string"), "id", "text")
    want = cosines(train, test)
    text = dict(asked)
    got = {r["id"]: r["max_cosine"] for r in per.collect()}
    assert len(got) == len(set(test))
    for i, v in got.items():
        assert v == pytest.approx(want[text[i]], abs=1e-9)
    s = summary.first()
    assert s["n_test"] == len(test) and s["mean_similarity"] == pytest.approx(np.mean([want[t] for t in test]), abs=1e-9)
    assert s["n_near_duplicate"] == sum(want[t] >= 0.9 - 1e-12 for t in test)


def test_euclidean_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 1, (160, 3)) for m in (0, 2, 5)] + [np.zeros((1, 3))])
    c = ["a"] * 160 + ["b"] * 160 + ["c"] * 160 + ["alone"]
    rows = [(i, *map(float, v), k) for i, (v, k) in enumerate(zip(x, c))] + [(900, None, 1.0, 1.0, "a"), (901, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, p double, q double, r double, c string").repartition(3)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for points in (2000, 50):
        got = {r["id"]: r for r in C.euclidean_silhouette(df, ["p", "q", "r"], "c", "id", points=points).collect()}
        assert len(got) == min(points, len(x))
        for i, r in got.items():
            own = [j for j in range(len(x)) if c[j] == c[i] and j != i]
            b = min(np.mean([dist[i, j] for j in range(len(x)) if c[j] == k]) for k in set(c) - {c[i]})
            want = 0.0
            if own:
                a = dist[i, own].mean()
                want = (b - a) / max(a, b)
            assert r["silhouette"] == pytest.approx(want, abs=1e-9)
    assert C.euclidean_silhouette(df.where("1 = 0"), ["p"], "c", "id").count() == 0
    assert [r[0] for r in C.euclidean_silhouette(df.where("c = 'a'"), ["p"], "c", "id").select("silhouette").distinct().collect()] == [None]


def test_text_folds_see_no_held_out_term(spark):
    rnd = random.Random(8)
    words = {"x": ["alpha", "beta", "gamma"], "y": ["delta", "epsilon", "zeta"]}
    rows = [(i, " ".join(rnd.choices(words["xy"[i % 2]], k=6)) + f" only{i}", "xy"[i % 2]) for i in range(60)] + [(99, None, "x"), (98, "text", None)]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    terms: dict = {}
    table = M.cross_validate_text(df, "id", "text", "label", k=3, vocabularies=terms).orderBy("fold").collect()
    assert [r["fold"] for r in table] == [0, 1, 2] and sum(r["n_test"] for r in table) == 60
    assert all(r["n_train"] + r["n_test"] == 60 and r["f1_macro"] > 0.95 for r in table)
    own = [{w for w in terms[f] if w.startswith("only")} for f in range(3)]
    assert all(len(own[r["fold"]]) == r["n_train"] for r in table)          # one such term per training row, none held out
    assert not own[0] & own[1] & own[2]
