"""Links of secret parts by the gap between them, every pair tried."""

import random

import brute

from tessera.llm import secret_scan

ROLE = {"access": "id", "assign": "secret", "hex": "secret", "weak_id": "id", "weak_key": "secret", "weak_endpoint": "endpoint"}
NEED = {"weak_id": {"secret"}, "weak_key": {"id", "endpoint"}, "weak_endpoint": {"secret"}}
KEY = "Zx9Qw8Er7Ty6Ui5Op4As3D"
WIKI = "see https://en.wikipedia.org/wiki/Battle_of_Hastings_1066 for more"


def gap(p, w):
    """Code points between two spans, None where they overlap."""
    if p[3] <= w[0]:
        return w[0] - p[3]
    return p[0] - w[3] if w[3] <= p[0] else None


def spans(t, scope):
    base, weak = brute.base_spans(t), brute.weak_spans(t)
    hit = [w for w in weak if any(ROLE[p[2]] in NEED[w[2]] and (g := gap(p, w)) is not None and g <= scope for p in base + weak)]
    return brute.show(sorted(base + hit))


def test_parts_link_by_their_gap_and_never_to_what_they_overlap(spark):
    rnd = random.Random(4)
    long = "https://bucket.example/" + "a/" * 110 + "?x=1"
    texts = [f"{long} {KEY}", f"{KEY} {long}", WIKI, f"client_id={KEY}", f"client_id={KEY} {KEY[::-1]}", f"user_id: bob99{' ' * 200}{KEY}", f"user_id: bob99{' ' * 201}{KEY}"]
    atoms = [KEY, KEY[::-1], "user_id: bob99", long, "https://h.example/q", f"client_id={KEY}", "AKIA" + "B7" * 8, "0af3" * 9,
             "é" * 30, " " * 60, "word " * 25, "x " * 97, "s3://b/" + KEY]
    texts += [" ".join(rnd.choice(atoms) for _ in range(rnd.randint(2, 9))) for _ in range(150)]
    docs = spark.createDataFrame([(k, t, "en", "b", len(t)) for k, t in enumerate(texts)], brute.SCHEMA)
    for scope in (200, 37):
        got = {r["doc_id"]: r["spans"] for r in secret_scan.secret_digests(docs, scope=scope).collect()}
        assert got == {k: spans(t, scope) for k, t in enumerate(texts)}
    hidden = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert hidden[0] == hidden[1] == "[SECRET] [SECRET]" and hidden[2] == WIKI and hidden[3] == texts[3]
    assert KEY not in hidden[4] and KEY not in hidden[5] and hidden[6] == texts[6]
