"""Operator 12 against every pair of documents compared in plain Python."""

import random
import re
from collections import Counter

import brute
import numpy as np
from conftest import SMOKE

from tessera.llm import parity_join as pj


def shingles(t, k=5):
    w = brute.words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def linked(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in where[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return Counter((i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def run(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n int, cls int, `a.b` int").repartition(3)
    return Counter(map(tuple, pj.jaccard_components(docs, **how).collect()))


def families(rnd):
    """Texts edited more and more, borderline overlaps, a shared passage in
    unrelated texts, templates that just miss the bound, and chains."""
    vocab = [f"w{k}" for k in range(4000)]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    rows = []
    add = lambda w: rows.append((len(rows), " ".join(w)))
    for n in (1, 2, 4, 5, 7, 8, 9, 12, 20, 33, 60, 130, 400):
        for _ in range(6):
            base = say(n)
            add(base)
            for part in (0.02, 0.05, 0.1, 0.2, 0.24, 0.3):
                add(base + say(int(n * part) + 1))
                add(base[:n - int(n * part)])
                changed = list(base)
                for _ in range(max(1, int(n * part / 10))):
                    changed[rnd.randrange(n)] = rnd.choice(vocab)
                add(changed)
    passage = say(60)
    for k in range(80):
        add(say(rnd.randint(3, 40)) + passage)
    base = say(100)
    for k in range(60):
        w = list(base)
        for spot in rnd.sample(range(100), rnd.choice((1, 2, 3, 4))):
            w[spot] = f"fresh{k}x{spot}"
        add(w)
    chain = say(50)
    for k in range(25):
        add(chain)
        chain = chain[2:] + say(2)
    return rows


def test_components_equal_brute_force(spark):
    rows = families(random.Random(2))
    want = linked(rows)
    assert len({c for _, _, c in want}) < len(rows) and run(spark, rows) == want
    assert run(spark, rows, tile=8) == want


def test_awkward_rows_and_smoke_table(spark):
    rows = [(r[0], r[1]) for r in brute.awkward_rows()]
    assert run(spark, rows) == linked(rows)
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    got = Counter(map(tuple, pj.jaccard_components(table).collect()))
    assert got == linked([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
    assert pj.jaccard_components(table.where("1 = 0")).count() == 0
    one = Counter(map(tuple, pj.jaccard_components(table.where("doc_id = 3")).collect()))
    assert sum(one.values()) == 1


def test_session_settings_come_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    run(spark, [(1, "a b"), (2, "a b")])
    assert spark.conf.get(key) == before


def test_bounds_are_exact():
    for a in range(1, 90):
        most = -1
        for b in range(1, 130):
            ok = [a + b - 2 * i for i in range(min(a, b) + 1) if 100 * i >= 80 * (a + b - i)]
            assert int(pj.allowed(np.int64(a), np.int64(b))) == max(ok, default=-1)
            most = max([most, *ok])
        assert pj.reach(a) >= most


def test_partners_share_a_part():
    """Any two linked sets keep a common part, whatever the bands."""
    rnd = random.Random(7)
    for _ in range(300):
        n = rnd.choice((4, 5, 8, 15, 16, 31, 32, 33, 60, 64, 100, 250, 255))
        base = [f"t{rnd.random()}" for _ in range(n + 4)]
        more = base + [f"u{rnd.random()}" for _ in range(n // 4)]
        raw = [" ".join(base).encode(), " ".join(more).encode()]
        s = pj.Sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        key, doc = s.parts((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        assert set(key[doc == 0].tolist()) & set(key[doc == 1].tolist())
        wide = [np.frombuffer(x, np.uint8) for x in s.sketches()]
        w = min(map(len, wide))
        apart = int(np.bitwise_count(pj.fold(wide[0], w) ^ pj.fold(wide[1], w)).sum())
        assert apart <= len(set(s.h[s.doc == 0].tolist()) ^ set(s.h[s.doc == 1].tolist()))
