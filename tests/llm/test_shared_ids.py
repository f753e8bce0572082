"""Near-dedup where unlinked texts share a doc_id."""

import random
from collections import Counter

import brute

from tessera.llm import simhash


def test_every_component_keeps_one_row(spark):
    rnd = random.Random(6)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    a, b, c, d = say(80), say(80), say(80), say(80)
    rows = [(5, a), (5, b), (5, b), (6, a + " "), (7, b + "\n"), (8, c), (None, c), (None, d), (None, d + " ")]
    found = simhash.simhash_components(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], brute.SCHEMA))
    assert found.select("comp").distinct().count() == 4
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], brute.SCHEMA)
    kept = Counter((r["doc_id"], r["text"].strip()) for r in simhash.keep_one(df).collect())
    assert kept == Counter({(5, a): 1, (5, b): 1, (8, c): 1, (None, d): 1})
