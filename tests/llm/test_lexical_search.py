"""Operator 13 against every item scored on every document in plain Python."""

import math
import random
import re
from collections import Counter

import brute
import numpy as np

from tessera.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def ranked(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    size = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in size), sum(size)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        rows = []
        for (i, b), n in zip(bags, size):
            s = 0
            for t in terms(text):
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((1000000000 * b[t]) // (1000 * b[t] + 12 * (75 + 25 * n * n_docs // total)))
            if s > 0:
                rows.append((-s, i is None, i))
        for r, (s, _, i) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out[(item, r, i, -s)] += 1
    return out


def test_search_equals_brute_force(spark):
    rnd = random.Random(9)
    rows = [(r[0], r[1]) for r in brute.awkward_rows()]
    vocab = sorted({w for _, t in rows for w in terms(t)})
    rows += [(500 + k, "Copy of ONE page, word\x85word \x00 naïve") for k in range(40)] + [(470, "one copy of page WORD\x85word, naïve")]
    rows += [(600 + k, " ".join(rnd.choice(vocab) for _ in range(30))) for k in range(60)]
    rnd.shuffle(rows)
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 25)))) for k in range(30)]
    items += [(77, "copy page page ONE unknown"), (77, "copy page page ONE unknown"), (78, None), (79, ""), (80, "-- !!"), (None, "word\x85WORD"), (81, "nowhere")]
    docs = spark.createDataFrame([(i, t, 1, 2, "b") for i, t in rows], "doc_id long, text string, score int, rank int, `a.b` string") \
        .repartition(3)
    asked = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id int, text string, doc_id int, score int")
    want = ranked(rows, items)
    for block in (4096, 7):
        got = ls.ranked_search(docs, asked, item_block=block)
        assert Counter(map(tuple, got.collect())) == want
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert Counter(map(tuple, ls.ranked_search(docs, asked, top=3, term_block=5).collect())) == ranked(rows, items, 3)
    assert ls.ranked_search(docs.where("1 = 0"), asked).count() == 0
    assert ls.ranked_search(docs, asked.where("1 = 0")).count() == 0


def test_best_rows_break_ties_by_smallest_id():
    rng = np.random.default_rng(1)
    for _ in range(200):
        score, least = rng.integers(0, 4, 50), rng.permutation(50)
        want = sorted((k for k in range(50) if score[k]), key=lambda k: (-score[k], least[k]))[:7]
        assert ls.best_rows(score, least, 7).tolist() == want
