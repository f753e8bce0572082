"""Operator 11 against all lags tried on all positions, and closed properties."""

import random
import time
import zlib
from collections import Counter

import brute
import numpy as np
from pyspark.sql import functions as F

from tessera.llm import periodic_runs as pr


def all_runs(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            z = i
            while z + q < len(w) and w[z] == w[z + q]:
                z += 1
            part = w[i:z + q]
            if len(part) >= max(least, times * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, len(part), q))
            i = max(z, i) + 1
    return sorted(out)


def looped(i, w):
    h = zlib.crc32(str(i).encode())
    n, g = len(w), h // 10
    if i is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def digest(w):
    runs = all_runs(w)
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            brute.sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
            brute.sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def planted(rnd, letters):
    w = []
    for _ in range(rnd.randint(1, 6)):
        block = [rnd.choice(letters) for _ in range(rnd.randint(1, 25))]
        if rnd.random() < 0.4:
            block = block * 2 + block[:rnd.randint(0, len(block))]      # a period that repeats inside
        w += block * rnd.randint(1, 6) + block[:rnd.randint(0, len(block))]
        w += [rnd.choice(letters) for _ in range(rnd.randint(0, 15))]
    return w


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    total = 0
    for k in range(90):
        w = planted(rnd, "ab" if k % 3 else "abcdefgh")
        want = all_runs(w)
        assert pr.runs_of(pr._names(w)) == want
        total += len(want)
        assert pr.runs_of(pr._names(w), least=5, times=3) == all_runs(w, 5, 3)
    assert total > 90
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    for w in (fib[-1], "a" * 400, "ab" * 200, ("a" * 30 + "b") * 9, ("ab" * 15 + "c") * 4 + "ab" * 20, ""):
        assert pr.runs_of(pr._names(w)) == all_runs(w)


def test_long_texts_stay_near_linear():
    rng = np.random.default_rng(0)
    spent = []
    for n in (50_000, 400_000):
        ids = [np.zeros(n, np.int64), np.arange(n) % 7, np.arange(n) % (n // 4), rng.integers(0, 2, n)]
        ids.append(np.concatenate([np.zeros(n // 2, np.int64), rng.integers(0, 2, n // 2)]))
        t = time.process_time()
        assert [pr.runs_of(x) for x in ids[:3]] == [[(0, n, 1)], [(0, n, 7)], [(0, n, n // 4)]]
        pr.runs_of(ids[3]), pr.runs_of(ids[4])
        spent.append(time.process_time() - t)
    assert spent[1] < 8 * 3 * max(spent[0], 0.2)


def test_digests_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [(k, " ".join(planted(rnd, "abcdé"))) for k in range(60)]
    texts += [(k, "word \t\n" * rnd.randint(1, 90)) for k in range(60, 80)] + [(200, "x" * 10_000 + " y" * 50), (None, "a " * 30)]
    pairs = [(r[0], r[1]) for r in brute.awkward_rows() if r[0] != 110] + texts + texts[:3]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in pairs], "doc_id long, text string, runs int, `a.b` int, __text string") \
        .repartition(3)
    got = pr.run_digests(docs.withColumn("text", pr.looped_texts(docs)))
    want = Counter((i, *digest(looped(i, brute.words(t)))) for i, t in pairs)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[1] > 0 for r in want) > 40
    plain = Counter(map(tuple, pr.run_digests(docs).collect()))
    assert plain == Counter((i, *digest(brute.words(t))) for i, t in pairs)
    assert pr.run_digests(docs.where("1 = 0")).count() == 0
    flat = pr.periodic_runs(docs.where(F.col("doc_id") == 200), [F.col("`a.b`").alias("n")]).first()
    assert flat["n"] == 2 and flat["best"]["period"] == 1 and flat["collapsed"].endswith(" y")
