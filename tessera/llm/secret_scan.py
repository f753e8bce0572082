"""Operator 9 — secret scan with multipart credential linking.

One pass over whole texts finds *base* spans (assignments, access keys, long
hex), which stand on their own, and *parts*: weak candidates for an access
identifier, a secret or an endpoint that mean nothing alone. An interval join
then links parts to complementary parts of the same row that do not overlap
them and lie at most SCOPE code points off (from the end of the one to the start
of the other); only linked weak candidates are reported.

The join never lists pairs. Positions are cut into cells of SCOPE code points;
per (row, role, cell) the first and last start and the first and last end are
kept, which decides for every candidate whether some partner lies in reach. A
partner before it ends in the cell of its start (the first end decides) or in
the cell before (the last end decides); one after it starts in the cell of its
end (the last start decides) or in the next (the first start decides).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns_of, cut, free_names, null_safe, prepare, row_key, text_blocks

SCOPE = 200
# Fixed by the contract (letters of the keyword in either case).
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")     # runs are maximal, so this drops the short ones
HEX = re.compile(rb"[0-9a-f]{32,}")
BASE = ("assign", "access", "hex")
# Weak parts: kind -> role.
ROLE = {"weak_id": "id", "weak_key": "secret", "weak_endpoint": "endpoint", "access": "id", "assign": "secret", "hex": "secret"}
PARTNERS = {"weak_id": ["secret"], "weak_key": ["id", "endpoint"], "weak_endpoint": ["secret"]}
KINDS = [*BASE, *PARTNERS]                     # the order of kinds that start at one place
WEAK_ID = re.compile(rb"""(?i:(?:client|access|account|user|login)[_-]?(?:key[_-]?id|id|name))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
                     rb"""|A(?:SIA|ROA|IDA|GPA)[A-Z0-9]{12,}""")
WEAK_ID_WORDS = (b"client", b"access", b"account", b"user", b"login", b"asia", b"aroa", b"aida", b"agpa")
WEAK_KEY = re.compile(rb"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(rb"""(?:https?|s3|ftp|jdbc:[a-z]+)://[^\s"'<>]+|[A-Za-z0-9.-]+\.amazonaws\.com""")


def _mixed(key: bytes) -> bool:
    """A key-like run: digits, upper and lower case all present."""
    return any(48 <= c <= 57 for c in key) and any(65 <= c <= 90 for c in key) and any(97 <= c <= 122 for c in key)


def scan(raw: bytes) -> tuple[list, list]:
    """(base spans, weak spans) of one text as (kind, start, end) in bytes."""
    base, weak = [], []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        base += [("assign", *m.span()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in raw:
        base += [("access", *m.span()) for m in ACCESS.finditer(raw)]
    base += [("hex", *m.span()) for m in HEX.finditer(raw)]
    if any(w in low for w in WEAK_ID_WORDS):
        weak += [("weak_id", *m.span()) for m in WEAK_ID.finditer(raw)]
    weak += [("weak_key", *m.span()) for m in WEAK_KEY.finditer(raw) if _mixed(m.group())]
    if b"://" in raw or b".amazonaws.com" in raw:
        weak += [("weak_endpoint", *m.span()) for m in ENDPOINT.finditer(raw)]
    if weak and base:                          # what a base span already covers is not weak
        s = sorted((a, z) for _, a, z in base)
        first, reach = [a for a, _ in s], np.maximum.accumulate([z for _, z in s])
        before = np.searchsorted(first, [z for _, _, z in weak]) - 1
        weak = [w for w, k in zip(weak, before) if k < 0 or reach[k] <= w[1]]
    return base, weak


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def candidates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, base, weak): spans of every row in code points."""
    prepare(df.sparkSession)

    def run(batches):
        for rb, b, off in text_blocks(batches, "text"):
            raw, o = b.tobytes(), off.tolist()
            cols = ([], [])
            for a, z in zip(o[:-1], o[1:]):
                found = scan(raw[a:z])
                if (found[0] or found[1]) and not raw[a:z].isascii():
                    lead = np.concatenate([[0], np.cumsum((b[a:z] & 0xC0) != 0x80)])
                    found = [[(k, int(lead[s]), int(lead[e])) for k, s, e in part] for part in found]
                for col, part in zip(cols, found):
                    col.append([{"kind": k, "start": s, "end": e} for k, s, e in part])
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), *[pa.array(c, pa.list_(_SPAN)) for c in cols]],
                ["doc_id", "text_key", "base", "weak"])

    return df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id long, text_key long, base {_SPANS}, weak {_SPANS}")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, text_key, links): the weak spans with a partner in scope."""
    keys = ["doc_id", "text_key"]
    lookup = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    wanted = F.create_map(*[x for k, v in PARTNERS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    some = found.where(F.size("weak") > 0)
    cell = lambda at: F.floor(at / scope).cast("long")
    point = lambda side, at: F.struct(F.lit(side).alias("side"), at.alias("at"))
    parts = some.select(*keys, F.explode(F.concat("base", "weak")).alias("s")) \
        .select(*keys, lookup[F.col("s.kind")].alias("role"),
                F.explode(F.array(point("end", F.col("s.end")), point("start", F.col("s.start")))).alias("p")) \
        .select(*keys, "role", "p.side", "p.at", cell(F.col("p.at")).alias("cell"))
    cells = parts.groupBy(*keys, "role", "side", "cell").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    look = lambda side, at, step: F.struct(F.lit(side).alias("side"), F.lit(step).alias("step"), (cell(at) + step).alias("cell"))
    near = some.select(*keys, F.explode("weak").alias("s")) \
        .select(*keys, "s", F.explode(wanted[F.col("s.kind")]).alias("role")) \
        .select(*keys, "s", "role", F.explode(F.array(
            look("end", F.col("s.start"), 0), look("end", F.col("s.start"), -1),
            look("start", F.col("s.end"), 0), look("start", F.col("s.end"), 1))).alias("l")) \
        .select(*keys, "s", "role", "l.side", "l.step", "l.cell")
    in_reach = F.when(F.col("side") == "end", F.when(F.col("step") == 0, F.col("first") <= F.col("s.start"))
                      .otherwise(F.col("s.start") - F.col("last") <= scope)) \
        .otherwise(F.when(F.col("step") == 0, F.col("last") >= F.col("s.end"))
                   .otherwise(F.col("first") - F.col("s.end") <= scope))
    return null_safe(near, cells, [*keys, "role", "side", "cell"]).where(in_reach) \
        .groupBy(*keys).agg(F.collect_set("s").alias("links"))


def _joined(spans: Column) -> Column:
    order = F.array(*map(F.lit, KINDS))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("o"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, text_key, base, spans): base spans and all spans (base and
    linked weak ones) of every row.

    Null and empty texts have none. Scopes never cross rows. Rows repeated as a
    whole (same doc_id and text) get the same spans; an empty table gives no
    rows. Offsets are code points, ends exclusive."""
    found = cut(candidates(df, id_col, text), "secret-candidates")
    return null_safe(found, linked(found, scope), ["doc_id", "text_key"], "left") \
        .select("doc_id", "text_key", "base", F.concat("base", F.coalesce("links", F.array().cast(_SPANS))).alias("spans"))


def secret_digests(df: DataFrame, id_col: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row: counts of base spans by kind, their digest, all spans."""
    s = secret_spans(df, id_col, text, scope)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return s.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                    _joined(F.col("spans")).alias("spans"))


def redact(df: DataFrame, id_col: str = "doc_id", text: str = "text", scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret span of ``text`` replaced by ``mark``; spans
    that touch or overlap become one mark. No row goes; other columns pass
    through. Only rows with spans carry any to the join."""
    doc, key, starts, ends = free_names(df, "__doc", "__key", "__starts", "__ends")
    spans = secret_spans(df, id_col, text, scope).where(F.size("spans") > 0) \
        .withColumn("s", F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))) \
        .select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("s.start").alias(starts), F.col("s.end").alias(ends)) \
        .dropDuplicates([doc, key])
    extra = {doc: F.col(id_col), key: F.xxhash64(F.col(text))}
    j = null_safe(df.withColumns(extra), spans, [doc, key], "left")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else mask_text(t, a, z, mark) for t, a, z in zip(texts, first, last)], dtype=object)

    touched = F.when(F.col(starts).isNotNull(), F.col(text))            # other texts do not travel
    body = F.coalesce(masked(touched, F.col(starts), F.col(ends)), F.col(text))
    return j.select(*[body.alias(c) if c == text else x for c, x in zip(df.columns, columns_of(df))])


def mask_text(text: str, starts, ends, mark: str) -> str:
    """``text`` with the spans (sorted by start, then end) masked; spans that
    touch or overlap give one mark. Linear in the text and the spans."""
    out, at = [], 0
    for a, z in zip(starts, ends):
        if not out or a > at:
            out += [text[at:a], mark]
        at = max(at, z)
    return "".join(out) + text[at:]
