"""Operator 13 — ranked lexical search with bag deduplication.

The items are the query set, read in blocks of at most ITEM_BLOCK rows and
TERM_BLOCK terms; every block is searched against all documents, and what
travels to the tasks (vocabulary, weights) is bounded by the block.

1. One scan restricts each document to the block's vocabulary: a *bag*, the
   sorted (term number, tf) vector as bytes, beside its number of terms n.
2. N, L and the document frequencies are aggregates of that table.
3. A document's score depends only on (m, bag). Rows are grouped by the hash of
   the couple and the couple itself, so a class holds equal vectors by
   comparison, not by hash alone; the group is partial in every task, so a
   class with a third of all rows is one row per task.
4. Every class is scored once, term by term, against all items of the block; a
   task keeps the best ``top`` classes of each item (by score, then smallest
   doc_id). No other class can reach the result: each of those classes has a
   document that ranks before all of its own.
5. Winning classes are expanded: of each class the ``top`` smallest doc_ids,
   then one ranking per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import cut, flat, prepare, text_blocks

ITEM_BLOCK = 4096
TERM_BLOCK = 200_000
CELLS = 1 << 21                      # scores (classes x items) held at a time
NO_ID = 2 ** 63 - 1
BAG = np.dtype([("term", "<i4"), ("tf", "<i4")])

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and code points from U+0080 on; A-Z lower-cased."""
    return text.translate(_FOLD).split()


def item_blocks(items: DataFrame, id_col: str, text: str, rows: int, terms: int) -> Iterator[list]:
    """The items as lists of (item_id, term counts), a block at a time."""
    block, size = [], 0
    for r in items.select(F.col(id_col), F.col(text)).toLocalIterator():
        bag = Counter(terms_of((r[1] or "").encode()))
        if block and (len(block) >= rows or size + len(bag) > terms):
            yield block
            block, size = [], 0
        block.append((r[0], bag))
        size += len(bag)
    if block:
        yield block


def bags(docs: DataFrame, vocabulary: list[bytes], id_col: str, text: str) -> DataFrame:
    """(doc_id, n, bag) of every row: all its terms counted, those of the
    vocabulary kept."""
    prepare(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches):
        number = known.value
        for rb, b, off in text_blocks(batches, "text"):
            raw, o, n, out = b.tobytes(), off.tolist(), [], []
            for a, z in zip(o[:-1], o[1:]):
                words = terms_of(raw[a:z])
                n.append(len(words))
                hit = sorted((number[w], k) for w, k in Counter(words).items() if w in number)
                out.append(np.array(hit, BAG).tobytes())
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                             ["doc_id", "n", "bag"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, n long, bag binary")


def _postings(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(postings, row of each) of a column of bags."""
    b, off = flat(col)
    post = np.frombuffer(b.tobytes(), BAG)
    return post, np.repeat(np.arange(len(off) - 1), np.diff(off) // BAG.itemsize)


def document_frequencies(table: DataFrame, size: int) -> np.ndarray:
    """Documents holding each term of the vocabulary."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for rb in batches:
            total += np.bincount(_postings(rb.column(0))[0]["term"], minlength=size)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in table.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def best_rows(score: np.ndarray, least: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` best scores above 0, equal scores by ``least``."""
    hit = np.flatnonzero(score > 0)
    if len(hit) > top:
        bar = np.partition(score[hit], len(hit) - top)[len(hit) - top]
        hit = hit[score[hit] >= bar]
    return hit[np.lexsort((least[hit], -score[hit]))][:top]


def class_scores(term: np.ndarray, row: np.ndarray, gain: np.ndarray, n_rows: int, n_items: int,
                 start: np.ndarray, item: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores (rows x items) of classes, added up one term at a time in 64-bit
    integers; ``start`` cuts ``item`` and ``weight`` by term."""
    out = np.zeros((n_rows, n_items), np.int64)
    order = np.argsort(term, kind="stable")
    term, row, gain = term[order], row[order], gain[order]
    edge = np.flatnonzero(np.diff(term, prepend=-1, append=-1)) if len(term) else np.zeros(1, int)
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
        s, e = start[term[a]], start[term[a] + 1]
        if s < e:
            out[row[a:z, None], item[None, s:e]] += gain[a:z, None] * weight[None, s:e]
    return out


def best_classes(classes: DataFrame, weights: tuple, n_items: int, top: int) -> DataFrame:
    """(item, score, least, h, m): the ``top`` best classes of each item in
    every task."""
    shared = classes.sparkSession.sparkContext.broadcast(weights)
    height = max(64, CELLS // n_items)

    def run(batches):
        start, item, weight = shared.value
        kept: list[list[np.ndarray]] = []                   # per finished block: item, score, least, h, m

        def squeeze():
            cols = [np.concatenate(c) for c in zip(*kept)]
            order = np.lexsort((cols[2], -cols[1], cols[0]))
            cols = [c[order] for c in cols]
            first = np.searchsorted(cols[0], cols[0])
            keep = np.arange(len(first)) - first < top
            kept[:] = [[c[keep] for c in cols]]

        for rb in batches:
            for lo in range(0, rb.num_rows, height):
                part = rb.slice(lo, height)
                h, m, least = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
                post, row = _postings(part.column(2))
                tf = post["tf"].astype(np.int64)
                gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
                score = class_scores(post["term"], row, gain, part.num_rows, n_items, start, item, weight)
                for i in range(n_items):
                    best = best_rows(score[:, i], least, top)
                    if len(best):
                        kept.append([np.full(len(best), i), score[best, i], least[best], h[best], m[best]])
            if kept:
                squeeze()
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in kept[0]], ["item", "score", "least", "h", "m"])

    return classes.select("h", "m", "bag", "least") \
        .mapInArrow(run, "item long, score long, least long, h long, m long")


def _search_block(docs: DataFrame, block: list, id_col: str, text: str, top: int) -> DataFrame | None:
    """(item, doc_id, score, rank) for one block of items; None without terms."""
    vocabulary = sorted(set().union(*(bag for _, bag in block)))
    if not vocabulary:
        return None
    table = cut(bags(docs, vocabulary, id_col, text), "search-bags")
    n_docs, length = table.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = document_frequencies(table, len(vocabulary))
    number = {t: i for i, t in enumerate(vocabulary)}
    entries = sorted((number[t], i, k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df[number[t]]) + 1))))
                     for i, (_, bag) in enumerate(block) for t, k in bag.items() if df[number[t]])
    term, item, weight = (np.array(c, np.int64) for c in (zip(*entries) if entries else ((), (), ())))
    weights = (np.searchsorted(term, np.arange(len(vocabulary) + 1)), item, weight)

    bag_rows = table.where(F.length("bag") > 0).select(
        "doc_id", F.expr(f"75 + (25 * n * {n_docs}L) div {length}L").alias("m"), "bag") \
        .withColumn("h", F.xxhash64("m", "bag"))
    order = F.coalesce("doc_id", F.lit(NO_ID))
    classes = cut(bag_rows.groupBy("h", "m", "bag").agg(F.min(order).alias("least")), "search-classes")
    each = Window.partitionBy("item").orderBy(F.desc("score"), "least", "h")
    winners = cut(best_classes(classes, weights, len(block), top)
                  .withColumn("place", F.row_number().over(each)).where(F.col("place") <= top).drop("place"), "search-winners")
    # at most top x ITEM_BLOCK rows of two numbers, so the broadcasts stay bounded
    named = winners.select("h", "m", "least").distinct()
    won = classes.join(F.broadcast(named), ["h", "m", "least"]).select("h", "m", "least", "bag")
    member = bag_rows.join(F.broadcast(named.select("h").distinct()), "h", "left_semi")
    inside = Window.partitionBy("h", "m", "least").orderBy(F.col("doc_id").asc_nulls_last())
    members = member.join(won, ["h", "m", "bag"]).select("h", "m", "least", "doc_id") \
        .withColumn("place", F.row_number().over(inside)).where(F.col("place") <= top).drop("place")
    final = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return winners.join(members, ["h", "m", "least"]).withColumn("rank", F.row_number().over(final)) \
        .where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 20, doc_id: str = "doc_id", doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK,
                  term_block: int = TERM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` the ``top``
    documents of highest score above 0, equal scores by ascending doc_id.

    Terms are runs of characters other than ``[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60
    \\x7B-\\x7F]``, A-Z lower-cased, of whole texts; N documents hold a term, L
    counts all terms, w = floor(1000 ln((2N+2)/(2df+1))), m = 75 + (25 n N) div
    L, and a score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the item's
    terms, repeats included. A null, empty or termless text counts in nothing
    and matches nothing. Every row is a document or item of its own, so repeated
    rows each take a rank or a list; a null doc_id ranks last among equals.
    Empty tables give no rows. Other columns are not read."""
    spark: SparkSession = docs.sparkSession
    kind = items.schema[item_id].dataType
    names = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)])
    out = spark.createDataFrame([], T.StructType([
        T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in item_blocks(items, item_id, item_text, item_block, term_block):
        found = _search_block(docs, block, doc_id, doc_text, top)
        if found is not None:
            ids = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], names)
            out = out.unionByName(cut(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"),
                                      "search-block"))
    return out


_TERMS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH items AS (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS k FROM items GROUP BY 1, 2),
split AS (SELECT doc_id, {_TERMS.format('text')} AS t FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, t, len(t) AS n FROM split WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sized),
postings AS (SELECT doc_id, n, term, count(*) AS tf
             FROM (SELECT doc_id, n, unnest(t) AS term FROM sized)
             WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM postings, total GROUP BY term, docs),
gains AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len)) AS g FROM postings, total),
scores AS (SELECT item_id, doc_id, CAST(sum(k * w * g) AS BIGINT) AS score
           FROM asked JOIN weights USING (term) JOIN gains USING (term) GROUP BY 1, 2 HAVING sum(k * w * g) > 0),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r, doc_id, score FROM scores)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 20
"""
