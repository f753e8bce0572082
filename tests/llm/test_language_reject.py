"""The network's reject class in the pipeline's language stage."""

import base64
import random

import brute
from conftest import SMOKE

import corpus_pipeline as pipeline


def test_language_stage_rejects_lettered_noise_and_keeps_clean_documents(spark):
    rnd = random.Random(9)
    raw = bytes(rnd.randrange(256) for _ in range(700))
    noise = [raw.hex(), base64.b64encode(raw).decode(),
             "\n".join(f"{i:08x}  {raw[i:i + 16].hex(' ')}" for i in range(0, 320, 16)),
             "".join(f'<div class="row-{k}"><td width="{k * 7}"></td></div>\n' for k in range(20)),
             "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 6]
    assert all(any(c.isalpha() for c in t) for t in noise)
    clean = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    planted = spark.createDataFrame([(900000 + k, t, None, "b", len(t)) for k, t in enumerate(noise)], brute.SCHEMA)
    kept = {r["doc_id"] for r in pipeline.language_id(spark, clean.unionByName(planted), "").collect()}
    assert not {i for i in kept if i >= 900000}
    assert kept == {r["doc_id"] for r in clean.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
