"""Operator 2 — line dedup over overlapping three-line windows.

Every document is split at ``\\n``; each run of ``window`` consecutive lines is
hashed (two independent 64-bit hashes, so 128 bits), repeated windows are found
over the whole table, and every occurrence but the first removes its lines; the
positions covered by overlapping windows are merged before the text is rebuilt.

Plan: windows are aggregated to (hash, count, first occurrence) with map-side
combine; only windows that repeat come back to meet the occurrences in an
equi-join whose small side is unique on the key, so AQE can split a window that
sits in a third of all documents. Texts are shuffled once, to meet their
removed positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns_of, cut, free_names, null_safe

NO_ID = 2 ** 63 - 1


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def line_windows(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """(doc_id, text_key, pos, h, g): one row per run of ``window`` lines that
    is not blank throughout; ``pos`` is the run's first line, from 0."""
    hashed = F.transform(_lines(text), lambda s: F.struct(
        F.xxhash64(s).alias("a"), F.xxhash64(F.lit(7), s).alias("b"),
        s.rlike(r"[^\x20\x09-\x0D]").alias("solid")))
    base = df.where(F.col(text).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), hashed.alias("__l")) \
        .where(F.size("__l") >= window)

    def run(i):
        part = [F.get(F.col("__l"), i + k) for k in range(window)]
        solid = part[0]["solid"]
        for p in part[1:]:
            solid = solid | p["solid"]
        return F.struct(i.alias("pos"), F.xxhash64(*[p["a"] for p in part]).alias("h"),
                        F.xxhash64(*[p["b"] for p in part]).alias("g"), solid.alias("solid"))

    runs = F.transform(F.sequence(F.lit(0), F.size("__l") - window), run)
    return base.select("doc_id", "text_key", F.explode(runs).alias("w")).where("w.solid") \
        .select("doc_id", "text_key", "w.pos", "w.h", "w.g")


def covered_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """(doc_id, text_key, starts): first lines of the windows to remove."""
    w = line_windows(df, id_col, text, window)
    order = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), F.col("pos").alias("p"))
    repeated = cut(w.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
                   .where("n > 1").select("h", "g", "first"), "repeated-windows")
    later = w.join(repeated, ["h", "g"]).where(order > F.col("first"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("starts"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 3,
               report: bool = True) -> DataFrame:
    """``df`` with ``text`` rebuilt and, if ``report``, two more columns,
    ``n_lines`` and ``n_removed`` (0 for a null text, which stays null).

    First occurrence: smallest (doc_id, line number). Rows that share a doc_id,
    or have none (they come last), count as one document for that order, so a
    row repeated as a whole loses nothing to its own copy. Windows are judged
    on the input, not on what is left. Windows of blank lines only never count;
    texts of fewer than ``window`` lines are kept. A text may become empty, its
    row stays. Other columns pass through unchanged, whatever their names; with
    ``report``, columns of the two names give way to the new ones.

    The covered positions are merged and the slices of lines between them
    joined, so the work is linear in the lines of a text."""
    doc, key, at, cut_at, whole, pieces = free_names(df, "__doc", "__key", "__starts", "__at", "__lines", "__pieces")
    found = covered_lines(df, id_col, text, window).select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.sort_array("starts").alias(at))
    extra = {doc: F.col(id_col), key: F.xxhash64(F.col(text))}
    j = null_safe(df.withColumns(extra), found, [doc, key], "left").withColumn(whole, _lines(text))
    n = F.size(F.col(whole))
    # gap i lies between the end of window i - 1 and the start of window i
    begin = F.concat(F.array(F.lit(0)), F.transform(at, lambda p: p + window))
    end = F.concat(F.col(at), F.array(n))
    gaps = F.arrays_zip(begin.alias("a"), end.alias("z"))
    slices = F.transform(cut_at, lambda g: F.slice(F.col(whole), g["a"] + 1, g["z"] - g["a"]))
    j = j.withColumn(cut_at, F.when(F.col(at).isNotNull(), F.filter(gaps, lambda g: g["z"] > g["a"]))) \
        .withColumn(pieces, F.when(F.col(at).isNotNull(), F.flatten(slices)))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(n)
    rebuilt = F.when(F.col(at).isNull(), F.col(text)).otherwise(F.array_join(pieces, "\n"))
    told = {"n_lines": n_lines.cast("long"),
            "n_removed": F.when(F.col(at).isNull(), 0).otherwise(n - F.size(pieces)).cast("long")} if report else {}
    same = [rebuilt.alias(c) if c == text else x for c, x in zip(df.columns, columns_of(df)) if c not in told]
    return j.select(*same, *[v.alias(c) for c, v in told.items()])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i - 1 AS pos, l[i] AS a, l[i+1] AS b, l[i+2] AS c
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE text IS NOT NULL)
      WHERE regexp_matches(concat(l[i], l[i+1], l[i+2]), '[^\x20\x09-\x0D]')),
f AS (SELECT a, b, c, min({'d': doc_id, 'p': pos}) AS first FROM w GROUP BY a, b, c HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM w JOIN f USING (a, b, c)
         WHERE {'d': doc_id, 'p': pos} > first),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS pos FROM d WHERE text IS NOT NULL),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
         FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(d.l) END AS BIGINT) AS n_lines,
       CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN n USING (doc_id)
"""
