"""Awkward column names in every operator that rewrites its table, and work
that stays linear in the lines or spans of one text."""

import random
import time
from collections import Counter

import brute
import pytest

from tessera.llm import block_names, line_dedup, secret_scan, simhash, substring_dedup

NAMES = ["__doc", "__key", "__starts", "__lines", "__kept", "a.b", "n_lines", "n_removed", "__s", "x`y"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *range(len(NAMES))) for i, t, *_ in brute.awkward_rows() if i != 110]
    kinds = ", ".join("`" + n.replace("`", "``") + "` int" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, {kinds}").repartition(3)


def test_columns_pass_through(docs):
    want = tuple(range(len(NAMES)))
    rewrite = [lambda d: line_dedup.line_dedup(d, report=False), secret_scan.redact, simhash.keep_one, block_names.exact_dedup,
               substring_dedup.substring_dedup]
    for f in rewrite:
        out = f(docs)
        assert out.columns == docs.columns
        assert {tuple(r)[2:] for r in out.collect()} == {want}
    pairs = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    told = line_dedup.line_dedup(docs)
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in told.collect()) == Counter(brute.line_dedup(pairs))
    assert sorted(told.columns) == sorted(docs.columns)


def test_masking_equals_brute_force():
    rnd = random.Random(1)
    for _ in range(300):
        t = "".join(rnd.choice("abé日") for _ in range(60))
        spans = sorted((a, a + rnd.randint(1, 9)) for a in rnd.sample(range(50), rnd.randint(1, 8)))
        hit = [False] * 61
        for a, z in spans:
            hit[a:z] = [True] * (z - a)
        runs, out = [], ""
        for a, z in spans:
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(z, runs[-1][1])
            else:
                runs.append([a, z])
        at = 0
        for a, z in runs:
            out, at = out + t[at:a] + "#", z
        assert secret_scan.mask_text(t, *zip(*spans), "#") == out + t[at:]


def test_one_long_text_stays_linear(spark):
    def seconds(n):
        lines = [f"line {k % (n // 4)} of the text" for k in range(n)]
        keys = " ".join(f"password=secret{k:08d}" for k in range(n // 8))
        df = spark.createDataFrame([(1, "\n".join(lines)), (2, keys)], "doc_id long, text string").coalesce(1)
        t = time.time()
        kept = line_dedup.line_dedup(df).where("doc_id = 1").first()
        masked = secret_scan.redact(df).where("doc_id = 2").first()
        assert kept["text"] == "\n".join(lines[:n // 4]) and kept["n_removed"] == n - n // 4
        assert masked["text"] == " ".join(["[SECRET]"] * (n // 8))
        return time.time() - t

    seconds(400)
    small, large = seconds(4_000), seconds(64_000)
    assert large < 16 * max(small, 1.0)
