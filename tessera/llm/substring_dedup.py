"""Operator 5 — substring dedup with prefix-partitioned suffix trees.

A word covered by a run of ``window`` words that also starts in a document with
a smaller doc_id is removed. Suffixes start at words; only their first
``window`` words matter. A suffix row holds its leading PREFIX_WORDS words as
nine-bit codes packed into one long (so sorting rows sorts suffixes by prefix)
and a 64-bit hash of all ``window`` words, never the words themselves.

1. *Copies.* Rows with equal word sequences (SHA-256) are one content; its
   smallest doc_id stands for it, the later rows are covered whole.
2. *Sampling, exact.* Equal windows hold the same grams of GRAM words, hence
   the same least gram. A window can repeat only if its least gram occurs in two
   contents, so only the least grams (about a quarter of the words) are met over
   the table. A batch that sees a gram in several contents reports it as
   repeated itself and sends one row, so a passage found in a third of all
   documents arrives as one row per batch.
3. *Suffix groups.* Windows whose least gram repeats become suffix rows of
   their content, cut by prefixes of variable length: the sorted order of
   (prefix, window hash) is divided into ranges of a bounded number of
   suffixes (bounded by grams x windows per gram), each a set of whole subtrees.
   Inside a batch only the smallest document of a window is sent on; the others
   are known to be covered.
4. *Subtrees.* A task sorts its range and reads the suffix tree off the common
   prefix lengths of neighbours: internal nodes at least ``window`` words deep
   are the repeats; leaves with a larger doc_id than the node's least are
   covered. Overlapping and adjoining covers of a document merge into maximal
   repeats before words are dropped.

Texts travel once, compressed, to meet their repeated grams; the documents that
have any (with their text) are written to the shared folder and travel once
more to meet their covers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (columns_of, cut, free_names, mix64, null_safe, prepare, row_key, text_blocks,
                                window_hashes, word_hashes, words_of)

WINDOW = 13
GRAM = 8                     # shorter grams repeat by chance, longer ones are sampled more densely
PREFIX_WORDS = 7
CODE_BITS = 9
KIND = 48
GROUP_SUFFIXES = 2_000_000
NO_ID = 2 ** 63 - 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------ numpy on a block
class _Block:
    """Words, word hashes and windows of a block of texts."""

    def __init__(self, b: np.ndarray, off: np.ndarray, window: int):
        self.start, self.end, self.doc = words_of(b, off)
        self.h = word_hashes(b, self.start, self.end)
        self.n = np.bincount(self.doc, minlength=len(off) - 1)
        m = max(0, len(self.h) - window + 1)
        self.first = np.flatnonzero(self.doc[:m] == self.doc[window - 1:window - 1 + m]) if m else np.zeros(0, np.int64)

    def contents(self) -> np.ndarray:
        """An order-sensitive 64-bit code of each document's words."""
        lead = np.cumsum(self.n) - self.n
        nth = (np.arange(len(self.h)) - lead[self.doc]).astype(np.uint64)
        out = np.zeros(len(self.n), np.uint64)
        np.add.at(out, self.doc, mix64(self.h + nth * _STEP))
        return out

    def least_grams(self, window: int) -> np.ndarray:
        """For each window, its least gram (48 bits)."""
        g = window_hashes(self.h, GRAM)
        span, low, width = window - GRAM + 1, g, 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:len(g) - span + 1], low[span - width:])
        return (low[self.first] >> np.uint64(16)).view(np.int64)

    def suffix_keys(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed prefix, window hash) of each window."""
        code = mix64(self.h ^ _STEP) >> np.uint64(64 - CODE_BITS)
        prefix = np.zeros(len(self.first), np.uint64)
        for j in range(PREFIX_WORDS):
            prefix = (prefix << np.uint64(CODE_BITS)) | code[self.first + j]
        return prefix.view(np.int64), window_hashes(self.h, window)[self.first].view(np.int64)


def deep_nodes(prefix: np.ndarray, tail: np.ndarray, window: int = WINDOW):
    """Suffix tree of sorted-to-be suffixes, read off neighbours: (order, node)
    where ``node`` numbers the deepest node (>= ``window`` words) above each
    suffix in sorted order; a node of one suffix is a leaf."""
    order = np.lexsort((tail, prefix))
    p, t = prefix[order], tail[order]
    differs = (p[1:] ^ p[:-1]).view(np.uint64)
    # common words of neighbours: equal leading codes, or the whole window
    common = np.zeros(len(differs), np.int64)
    for k in range(1, PREFIX_WORDS + 1):
        common += (differs >> np.uint64(CODE_BITS * (PREFIX_WORDS - k))) == 0
    common = np.where((common == PREFIX_WORDS) & (t[1:] == t[:-1]), window, common)
    node = np.cumsum(np.concatenate([[0], (common < window).astype(np.int64)])) if len(p) else np.zeros(0, np.int64)
    return order, node


def covered_leaves(prefix, tail, doc, window: int = WINDOW):
    """(order, covered) in sorted order: covered if the node also has a smaller
    document."""
    order, node = deep_nodes(prefix, tail, window)
    if not len(order):
        return order, np.zeros(0, bool)
    d = doc[order]
    edge = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    least = np.minimum.reduceat(d, edge)
    return order, d > least[node]


# ---------------------------------------------------------------- Spark stages
def word_facts(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, sha, content): SHA-256 of the words joined by
    a space and the 64-bit content code."""
    prepare(df.sparkSession)

    def run(batches):
        for rb, b, off in text_blocks(batches, "text"):
            blk = _Block(b, off, window)
            raw, o = b.tobytes(), off.tolist()
            sha = [hashlib.sha256(b" ".join(raw[a:z].split())).digest() for a, z in zip(o[:-1], o[1:])]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(blk.n.astype(np.int64)), pa.array(sha, pa.binary()),
                 pa.array(blk.contents().view(np.int64))], ["doc_id", "text_key", "n_words", "sha", "content"])

    return df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, n_words long, sha binary, content long")


def repeated_grams(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """(content, grams): the least grams of each content that occur in another
    content too."""
    prepare(df.sparkSession)

    def runs_of(h, c):
        """Sorted by (gram, content), duplicates dropped; run starts, run of each row."""
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        pick = order[new]
        h, c = h[new], c[new]
        lead = np.concatenate([[True], h[1:] != h[:-1]])
        return h, c, lead, np.cumsum(lead) - 1, pick

    def sample(batches):
        for rb, b, off in text_blocks(batches, "text"):
            blk = _Block(b, off, window)
            if not len(blk.first):
                continue
            h, c = blk.least_grams(window), blk.contents().view(np.int64)[blk.doc[blk.first]]
            stay = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
            h, c, lead, run, _ = runs_of(h[stay], c[stay])
            several = np.bincount(run)[run] > 1
            # above the 48 bits of the gram, 0: one content here, 1: stands for several, 2: need not meet
            h = h | (np.where(lead, several, 2).astype(np.int64) << KIND)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c)], ["gram", "content"])

    def meet(batches):
        parts = [(rb.column(0).to_numpy(), rb.column(1).to_numpy()) for rb in batches if rb.num_rows]
        if not parts:
            return
        h, c = (np.concatenate(x) for x in zip(*parts))
        kind, h = h >> KIND, h & ((1 << KIND) - 1)
        known = kind == 2
        yield pa.RecordBatch.from_arrays([pa.array(c[known]), pa.array(h[known])], ["content", "gram"])
        h, c, kind = h[~known], c[~known], kind[~known]
        if not len(h):
            return
        marked = np.unique(h[kind == 1])
        h, c, lead, run, _ = runs_of(h, c)
        at = np.searchsorted(marked, h)
        flag = (at < len(marked)) & (marked[np.minimum(at, len(marked) - 1)] == h) if len(marked) else np.zeros(len(h), bool)
        hit = flag | (np.bincount(run)[run] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(c[hit]), pa.array(h[hit])], ["content", "gram"])

    rows = df.select(F.col(text).alias("text")).mapInArrow(sample, "gram long, content long")
    settled = F.shiftright("gram", KIND) == 2
    return rows.repartition(F.when(settled, F.col("content")).otherwise(F.col("gram").bitwiseAND(F.lit((1 << KIND) - 1)))) \
        .mapInArrow(meet, "content long, gram long") \
        .groupBy("content").agg(F.collect_set("gram").alias("grams"))


def packed_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, packed): texts compressed for the shuffle."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=6)
        for rb, b, off in text_blocks(batches, "text"):
            raw, o = b.tobytes(), off.tolist()
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array([press.compress(raw[a:z]) for a, z in zip(o[:-1], o[1:])], pa.binary())],
                ["doc_id", "text_key", "packed"])

    return df.select(*row_key(id_col, text), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, packed binary")


def _unpacked(batches, column: str, limit: int = 4 << 20):
    """(first row, rows, bytes, offsets) for bounded runs of rows of a batch."""
    press = zstandard.ZstdDecompressor()
    for rb in batches:
        texts, lo, size = [], 0, 0
        col = rb.column(rb.schema.get_field_index(column))
        for i in range(rb.num_rows):
            t = press.decompress(col[i].as_py())
            texts.append(t)
            size += len(t)
            if size >= limit or i == rb.num_rows - 1:
                off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                yield rb.slice(lo, i + 1 - lo), texts, np.frombuffer(b"".join(texts), np.uint8), off
                texts, lo, size = [], i + 1, 0


_COVER = "row long, at long, size long"


def covers(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, at, size): covered word ranges of ``docs`` (row, ord, packed,
    grams), one row of the result per batch run or subtree leaf."""
    def suffixes(batches):
        for rb, _, b, off in _unpacked(batches, "packed"):
            blk = _Block(b, off, window)
            if not len(blk.first):
                continue
            grams, go = _longs(rb.column(rb.schema.get_field_index("grams")))
            row = rb.column(rb.schema.get_field_index("row")).to_numpy()
            ids = rb.column(rb.schema.get_field_index("ord")).to_numpy()
            least, doc = blk.least_grams(window), blk.doc[blk.first]
            mine = np.zeros(len(least), bool)
            edge = np.searchsorted(doc, np.arange(len(row) + 1))
            for k in range(len(row)):
                mine[edge[k]:edge[k + 1]] = np.isin(least[edge[k]:edge[k + 1]], grams[go[k]:go[k + 1]])
            prefix, tail = blk.suffix_keys(window)
            lead = (np.cumsum(blk.n) - blk.n)[doc]
            prefix, tail, doc, at = prefix[mine], tail[mine], doc[mine], (blk.first - lead)[mine]
            if not len(doc):
                continue
            order, late = covered_leaves(prefix, tail, ids[doc], window)
            go_on = np.sort(order[~late])
            yield _rows(prefix[go_on], tail[go_on], ids[doc[go_on]], row[doc[go_on]], at[go_on], np.zeros(len(go_on), np.int64))
            known = np.sort(order[late])             # runs of positions known to be covered
            if len(known):
                r, a = row[doc[known]], at[known]
                cutat = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (a[1:] != a[:-1] + 1)]))
                size = np.diff(np.concatenate([cutat, [len(r)]])) + window - 1
                spread = mix64(r[cutat].view(np.uint64) + a[cutat].view(np.uint64) * _STEP) >> np.uint64(1)
                yield _rows(spread.view(np.int64), tail[known][cutat], ids[doc[known]][cutat], r[cutat], a[cutat], size)

    def subtrees(batches):
        parts = [[c.to_numpy() for c in rb.columns] for rb in batches if rb.num_rows]
        if not parts:
            return
        prefix, tail, ids, row, at, size = (np.concatenate(x) for x in zip(*parts))
        k = size > 0
        yield pa.RecordBatch.from_arrays([pa.array(row[k]), pa.array(at[k]), pa.array(size[k])], ["row", "at", "size"])
        prefix, tail, ids, row, at = (x[~k] for x in (prefix, tail, ids, row, at))
        order, late = covered_leaves(prefix, tail, ids, window)
        hit = order[late]
        yield pa.RecordBatch.from_arrays([pa.array(row[hit]), pa.array(at[hit]),
                                          pa.array(np.full(len(hit), window, np.int64))], ["row", "at", "size"])

    spark = docs.sparkSession
    grams = docs.agg(F.sum(F.size("grams"))).first()[0] or 0
    most = grams * (window - GRAM + 1)               # a gram is least in at most so many windows around it
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // GROUP_SUFFIXES))
    rows = docs.select("row", "ord", "packed", "grams") \
        .mapInArrow(suffixes, "prefix long, tail long, ord long, row long, at long, size long")
    return rows.repartitionByRange(groups, "prefix", "tail").mapInArrow(subtrees, _COVER)


def _rows(*cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["prefix", "tail", "ord", "row", "at", "size"])


def _longs(col: pa.Array) -> tuple[np.ndarray, list]:
    return col.values.to_numpy(), col.offsets.to_numpy().tolist()


def _merged(n: int, at, size) -> np.ndarray:
    """Words of a document of ``n`` words that some cover holds."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _kept_words(df: DataFrame, id_col: str, text: str, window: int, schema: str, make) -> tuple[DataFrame, DataFrame]:
    """(facts, changed): facts of all rows with ``first_id``; per content with
    covers, what ``make`` returns for (sha, kept words)."""
    facts = cut(word_facts(df, id_col, text, window).withColumn("ord", F.coalesce("doc_id", F.lit(NO_ID))), "word-facts")
    reps = cut(facts.groupBy("sha").agg(F.min(F.struct("ord", "text_key", "doc_id", "content")).alias("f"))
               .select("sha", "f.*"), "contents")
    grams = repeated_grams(df, text, window)
    wanted = reps.join(grams, "content").select("doc_id", "text_key", "ord", "sha", "grams")
    docs = cut(null_safe(packed_texts(df, id_col, text), wanted, ["doc_id", "text_key"])
               .withColumn("row", F.monotonically_increasing_id()), "repeat-docs")
    spans = covers(docs, window).groupBy("row").agg(F.collect_set(F.struct("at", "size")).alias("spans"))

    def run(batches):
        for rb, texts, b, off in _unpacked(batches, "packed"):
            sha = rb.column(rb.schema.get_field_index("sha")).to_pylist()
            spans_of = rb.column(rb.schema.get_field_index("spans"))
            at, size = (spans_of.values.field(k).to_numpy() for k in (0, 1))
            o = spans_of.offsets.to_numpy().tolist()
            out = []
            for k, t in enumerate(texts):
                words = t.split()
                gone = _merged(len(words), at[o[k]:o[k + 1]], size[o[k]:o[k + 1]])
                out.append((sha[k], int(gone.sum()), make(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))],
                                             ["sha", "n_removed", "kept"])

    changed = docs.select("row", "sha", "packed").join(spans, "row").select("sha", "packed", "spans") \
        .mapInArrow(run, schema).dropDuplicates(["sha"])
    return facts.join(reps.select("sha", F.col("ord").alias("first_ord")), "sha"), cut(changed, "kept-words")


def substring_digests(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row: doc_id, text_key, n_words, n_removed, kept_sha256.

    Windows are judged on the input: a word goes if some window over it also
    starts in a row with a smaller doc_id. Rows without a doc_id come last and
    never cover each other; nor do rows that share a doc_id. Null texts and texts
    of fewer than ``window`` words lose nothing (null: 0 words). An empty table
    gives no rows."""
    facts, changed = _kept_words(df, id_col, text, window, "sha binary, n_removed long, kept string",
                                 lambda kept: hashlib.sha256(kept).hexdigest())
    copy = (F.col("ord") > F.col("first_ord")) & (F.col("n_words") >= window)
    return facts.join(changed, "sha", "left").select(
        "doc_id", "text_key", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept", F.lower(F.hex("sha")))).alias("kept_sha256"))


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with ``text`` reduced to its kept words joined by one space where
    words were removed, and left as it is elsewhere."""
    facts, changed = _kept_words(df, id_col, text, window, "sha binary, n_removed long, kept string",
                                 lambda kept: kept.decode("utf-8"))
    copy = (F.col("ord") > F.col("first_ord")) & (F.col("n_words") >= window)
    doc, key, kept = free_names(df, "__doc", "__key", "__kept")
    new = facts.join(changed, "sha", "left") \
        .select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.when(copy, F.lit("")).otherwise(F.col("kept")).alias(kept)) \
        .where(F.col(kept).isNotNull()).dropDuplicates([doc, key])
    extra = {doc: F.col(id_col), key: F.xxhash64(F.col(text))}
    body = F.coalesce(F.col(kept), F.col(text))
    return null_safe(df.withColumns(extra), new, [doc, key], "left") \
        .select(*[body.alias(c) if c == text else x for c, x in zip(df.columns, columns_of(df))])
