"""Operator 12 — n-gram Jaccard join over parity sketches.

A document is the set of its hashed shingles. Its *parity sketch* has 2^64 bit
positions; each shingle flips one, so two sketches differ in at most as many
positions as the sets do, and sets of sizes a and b whose Jaccard similarity is
at least 0.8 differ in at most (a + b) / 9 shingles.

Classes: rows with equal sets are one class, so copies never meet.

Pigeonhole: in a size band the sketch is cut into parts (held sparsely, as the
exclusive-or of the hashed positions). A difference spoils one part, so a set
that keeps its D + 1 first non-zero parts (D: the largest difference to any
partner; first: by an order that all documents share) has one of them in common
with every partner. The order puts parts of widely shared shingles last; a
bounded list of the HEAVY most frequent shingles, counted over all documents,
serves for that and decides nothing else. A set near the top of a band also
enters the next one, where its larger partners are.

Groups: a part value that several classes hold. Tasks name one head per value
and chunk before the shuffle, so a value held by a third of all rows sends one
row per chunk. Each group gets a hub, and members are checked against it, not
against each other:

* Hamming distance of folded sketches first (a lower bound of the difference),
  then the exact intersection of the sets;
* the difference is a metric, so a member further from the hub than the two
  radii together links to no direct neighbour of the hub;
* what is left of a group (members not at the hub, and the hub's neighbours only
  where some member is within reach of them) gets ROUNDS further hubs, which
  join most of a family of near copies, and is then compared in tiles with
  numpy exclusive-or and bit counts; only pairs of different components that
  pass leave the task, and those are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (components, cut, flat, mix64, null_safe, text_blocks, window_hashes, word_hashes,
                                words_of)
from tessera.session import ship_package

SHINGLE = 5
HEAVY = 1 << 18                      # shingles in the list of frequent ones
LOCAL = 3                            # different sets of one chunk that make a shingle a candidate for it
CHUNK = 1 << 21                      # part values combined in a task before the shuffle; twice as many shingles counted
ROUNDS = 2                           # further hubs tried in a group that one hub has not joined, before tiles
TILE = 256
SMALL_ROWS = 1 << 19                 # rows of three numbers that a join may broadcast, after counting them
_LOW2 = np.uint64(3)


def allowed(a, b):
    """Largest symmetric difference of linked sets of sizes a and b (arrays or
    numbers); -1 where the sizes alone forbid a link."""
    s = a + b
    inter = -(-4 * s // 9)
    return np.where(inter <= np.minimum(a, b), s - 2 * inter, -1)


def reach(a):
    """Largest difference of a set of size ``a`` to any partner."""
    return (a + 5 * a // 4) // 9


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = 100_000, size: int = 4 << 20):
    """Arrow batches of the jobs run inside are bounded by bytes, so rows of
    two numbers travel many at a time and long texts few; the session's own
    settings come back."""
    want = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ----------------------------------------------------------------------- sets
class Sets:
    """Distinct shingle hashes of a block's documents: ``h`` by document and
    value, ``doc`` of each, ``size`` per document."""

    def __init__(self, b: np.ndarray, off: np.ndarray, shingle: int = SHINGLE):
        upper = (b >= 65) & (b <= 90)
        b = np.where(upper, b + np.uint8(32), b)
        start, end, doc = words_of(b, off)
        word = word_hashes(b, start, end)
        docs = len(off) - 1
        count = np.bincount(doc, minlength=docs)
        first = np.cumsum(count) - count
        g = window_hashes(word, shingle)
        whole = np.flatnonzero(doc[:len(g)] == doc[shingle - 1:]) if len(g) else np.zeros(0, np.int64)
        h, d = [g[whole]], [doc[whole]]
        for k in range(1, shingle):                      # shorter texts: the whole sequence
            short = np.flatnonzero(count == k)
            if len(short):
                h.append(mix64(window_hashes(word, k)[first[short]] ^ np.uint64(k)))
                d.append(short)
        h, d = np.concatenate(h), np.concatenate(d)
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.h, self.doc = h[new], d[new]
        self.size = np.bincount(self.doc, minlength=docs)
        self.edge = np.concatenate([[0], np.cumsum(self.size)])
        self.mixed = mix64(self.h + np.uint64(0x632BE59BD9B4E019))

    def classes(self) -> np.ndarray:
        """A number per document, equal for equal sets; 0 without words."""
        out = np.zeros(len(self.size), np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            at = self.edge[full]
            total = np.add.reduceat(self.mixed, at)
            parity = np.bitwise_xor.reduceat(mix64(self.mixed), at)
            out[full] = mix64(mix64(total + self.size[full].astype(np.uint64)) + parity) | np.uint64(1)
        return out.view(np.int64)

    def sketches(self) -> list[bytes]:
        """The parity sketch of each document folded to two to four bits a shingle."""
        bits = sketch_bits(self.size)
        off = np.concatenate([[0], np.cumsum(bits)])
        pos = off[self.doc] + (self.mixed & (bits[self.doc] - 1).astype(np.uint64)).astype(np.int64)
        raw = np.packbits((np.bincount(pos, minlength=off[-1]) & 1).astype(np.uint8)).tobytes()
        o = (off // 8).tolist()
        return [raw[a:z] for a, z in zip(o[:-1], o[1:])]

    def parts(self, heavy: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(key, document) of the parts that each document keeps."""
        level = _band(self.size) // 2                    # sizes 4^level to 4^(level + 1) - 1
        grows = 5 * self.size // 4 >= 4 << (2 * level)
        some = self.size >= 4                            # smaller sets link to equal ones only
        who = np.concatenate([np.flatnonzero(some), np.flatnonzero(some & grows)])
        level = np.concatenate([level[some], level[some & grows] + 1])
        n = self.size[who]
        if not len(who):
            return np.zeros(0, np.uint64), who
        entry = np.repeat(np.arange(len(who)), n)
        token = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.edge[who], n)
        part = ((self.mixed[token] >> np.uint64(32)) * part_count(level)[entry]) >> np.uint64(32)
        order = np.lexsort((part, entry))
        entry, part, token = entry[order], part[order], token[order]
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        value = np.bitwise_xor.reduceat(mix64(self.mixed ^ np.uint64(0xA5A5))[token], at)
        seen = np.zeros(len(self.h), np.int64)
        if len(heavy[0]):
            slot = np.minimum(np.searchsorted(heavy[0], self.h), len(heavy[0]) - 1)
            seen = np.where(heavy[0][slot] == self.h, heavy[1][slot], 0)
        heat = np.minimum.reduceat(seen[token], at)
        entry = entry[at]
        name = mix64(value + mix64(part[at] + (level[entry].astype(np.uint64) << np.uint64(40))))
        key = name & ~_LOW2
        order = np.lexsort((key, heat, entry))
        entry, key = entry[order], key[order]
        first = np.searchsorted(entry, np.arange(len(who)))
        keep = (np.arange(len(entry)) - first[entry] <= reach(n)[entry]) & (key != 0)
        return key[keep], who[entry[keep]]


def part_count(level: np.ndarray) -> np.ndarray:
    """Parts of the sketch in each size band: three shingles a part at the top
    of a band, one in the band of 16 to 63, one position a part below. Then a
    set keeps more non-zero parts than differences may spoil; that it does not
    is less likely than an accident of the hashes."""
    return np.choose(np.minimum(level, 3), [1 << 32, 1 << 32, 64, (4 << (2 * level)) // 3]).astype(np.uint64)


def _band(size: np.ndarray) -> np.ndarray:
    """floor(log2(size)), 0 for empty sets."""
    return np.frexp(np.maximum(size, 1).astype(float))[1].astype(np.int64) - 1


def sketch_bits(size: np.ndarray) -> np.ndarray:
    return np.maximum(64, 4 << _band(np.asarray(size)))


def fold(sketch: np.ndarray, width: int) -> np.ndarray:
    """A sketch (bytes) folded to ``width`` bytes by exclusive-or of halves."""
    while len(sketch) > width:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


# ------------------------------------------------------------------ Spark steps
def _scan(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """One row per document (doc_id, text_key, n, cls, sketch) and one per
    shingle that LOCAL different sets of a chunk hold (token, seen)."""
    names = ["doc_id", "text_key", "n", "cls", "sketch", "token", "seen"]

    def often(held):
        token, seen = np.unique(np.concatenate(held), return_counts=True)
        token, seen = token[seen >= LOCAL], seen[seen >= LOCAL]
        z = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([z, z, z, z, pa.nulls(len(token), pa.binary()), pa.array(token.view(np.int64)),
                                           pa.array(seen.astype(np.int64))], names)

    def run(batches):
        held, known, count = [], np.zeros(0, np.int64), 0
        for rb, b, off in text_blocks(batches, "text"):
            s = Sets(b, off, shingle)
            cls = s.classes()
            z = pa.nulls(len(cls), pa.int64())
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(s.size.astype(np.int64)), pa.array(cls),
                                              pa.array(s.sketches(), pa.binary()), z, z], names)
            first = np.zeros(len(cls), bool)                 # copies count once
            first[np.unique(cls, return_index=True)[1]] = True
            first &= ~np.isin(cls, known)
            known = np.concatenate([known, cls[first]])
            held.append(s.h[first[s.doc]])
            count += len(held[-1])
            if count >= 2 * CHUNK:
                yield often(held)
                held, known, count = [], known[:0], 0
        if held:
            yield often(held)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, n long, cls long, sketch binary, token long, seen long")


def frequent_shingles(scan: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The HEAVY most frequent shingles, ascending, with their counts; a bounded
    list that only orders parts."""
    found = scan.where("seen IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")) \
        .orderBy(F.desc("seen"), "token").limit(HEAVY).collect()
    token = np.array([r["token"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], np.array([r["seen"] for r in found], np.int64)[order]


def _combined(key: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's (key, cls) rows once each, with the row's role in the key's two
    low bits: 0 alone, 2 head of several classes, 1 the others."""
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls = key[new], cls[new]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    follows = np.zeros(len(key), bool)
    follows[:-1] = ~head[1:]
    role = np.where(head, np.where(follows, 2, 0), 1).astype(np.uint64)
    return key | role, cls


def _postings(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], text: str, shingle: int) -> DataFrame:
    """(key, cls): the parts that each class keeps, combined by chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        frequent, keys, owners, rows = shared.value, [], [], 0

        def flush():
            key, cls = _combined(np.concatenate(keys), np.concatenate(owners))
            for lo in range(0, len(key), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + (1 << 17)].view(np.int64)), pa.array(cls[lo:lo + (1 << 17)])],
                                                 ["key", "cls"])
            keys.clear()
            owners.clear()

        for _, b, off in text_blocks(batches, "text"):
            s = Sets(b, off, shingle)
            key, doc = s.parts(frequent)
            keys.append(key)
            owners.append(s.classes()[doc])
            rows += len(key)
            if rows >= CHUNK:
                yield from flush()
                rows = 0
        if keys:
            yield from flush()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key long, cls long")


def _repeated(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and class: those whose key several classes hold."""
    k, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out(key, cls):
        name = key & ~_LOW2
        new = np.ones(len(key), bool)
        new[1:] = (name[1:] != name[:-1]) | (cls[1:] != cls[:-1])
        edge = np.ones(len(key), bool)
        edge[1:] = name[1:] != name[:-1]
        group = np.cumsum(edge) - 1
        shared = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=(key & _LOW2) > 0) > 0)
        keep = new & shared[group]
        return pa.RecordBatch.from_arrays([pa.array(name[keep].view(np.int64)), pa.array(cls[keep])], ["key", "cls"])

    for rb in batches:
        k = np.concatenate([k, rb.column(0).to_numpy().view(np.uint64)])
        c = np.concatenate([c, rb.column(1).to_numpy()])
        if len(k):
            last = int(np.searchsorted(-(((k & ~_LOW2) != (k[-1] & ~_LOW2)).astype(np.int8)), 0))   # start of the open group
            if last:
                yield out(k[:last], c[:last])
                k, c = k[last:], c[last:]
    if len(k):
        yield out(k, c)


def part_groups(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], text: str, shingle: int) -> DataFrame:
    """(key, cls) of every part value that at least two classes keep."""
    posts = _postings(docs, heavy, text, shingle)
    role = F.col("key").bitwiseAND(F.lit(3))
    name = F.col("key").bitwiseAND(F.lit(-4))
    dealt = F.when(role == 1, F.xxhash64(name, "cls")).otherwise(F.xxhash64(name))     # followers need no meeting
    return posts.repartition(dealt).sortWithinPartitions(name, "cls").mapInArrow(_repeated, "key long, cls long")


def hamming(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """(a, b, na, nb, low): pairs of classes with their set sizes and the
    Hamming distance of their sketches folded to the shorter one."""
    def run(batches):
        for rb in batches:
            sa, sb = rb.column(4).to_pylist(), rb.column(5).to_pylist()
            low = []
            for x, y in zip(sa, sb):
                w = min(len(x), len(y))
                low.append(int(np.bitwise_count(fold(np.frombuffer(x, np.uint8), w) ^ fold(np.frombuffer(y, np.uint8), w)).sum()))
            yield pa.RecordBatch.from_arrays([*rb.columns[:4], pa.array(low, pa.int64())], ["a", "b", "na", "nb", "low"])

    side = lambda c: info.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb") \
        .mapInArrow(run, "a long, b long, na long, nb long, low long")


_ALLOWED = "na + nb - 2 * ((4 * (na + nb) + 8) div 9)"
_FITS = "(4 * (na + nb) + 8) div 9 <= least(na, nb)"


def verified(docs: DataFrame, info: DataFrame, pairs: DataFrame, text: str, shingle: int) -> DataFrame:
    """(a, b, apart): the pairs with the exact size of their sets' difference."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    reps = cut(info.join(ends, "cls").select("doc_id", "text_key", "cls"), "parity-reps")
    if reps.count() <= SMALL_ROWS:                       # else a sort-merge join moves the texts
        reps = F.broadcast(reps)
    keyed = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))

    def sets(batches):
        for rb, b, off in text_blocks(batches, "text"):
            s = Sets(b, off, shingle)
            o, raw = (s.edge * 8).tolist(), s.h.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array([raw[a:z] for a, z in zip(o[:-1], o[1:])], pa.binary())], ["cls", "hashes"])

    table = cut(null_safe(keyed, reps, ["doc_id", "text_key"]).dropDuplicates(["cls"]).select("cls", "text")
                .mapInArrow(sets, "cls long, hashes binary"), "parity-sets")
    side = lambda c: table.select(F.col("cls").alias(c), F.col("hashes").alias(f"h{c}"))

    def run(batches):
        for rb in batches:
            (ba, oa), (bb, ob) = flat(rb.column(2)), flat(rb.column(3))
            oa, ob, apart = oa.tolist(), ob.tolist(), []
            for i in range(rb.num_rows):
                x, y = (np.frombuffer(v[o[i]:o[i + 1]].tobytes(), np.uint64) for v, o in ((ba, oa), (bb, ob)))
                apart.append(len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([*rb.columns[:2], pa.array(apart, pa.int64())], ["a", "b", "apart"])

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ha", "hb")
    return cut(both.mapInArrow(run, "a long, b long, apart long"), "parity-verified")


def _tile_pairs(rows: DataFrame, info: DataFrame, tile: int) -> DataFrame:
    """(a, b, na, nb): pairs of different components inside a key whose sketches are
    near enough; ``rows`` holds (key, cls), ``info`` comp, n and sketch of a
    class. Pieces with equal members (one passage, many keys) are compared
    once, and sketches travel once per different piece."""
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    pieces = cut(rows.join(counts, "key").withColumn("piece", F.pmod(F.xxhash64("cls"), F.ceil(F.col("m") / tile)).cast("int"))
                 .groupBy("key", "piece").agg(F.sort_array(F.collect_list("cls")).alias("members"))
                 .withColumn("id", F.xxhash64("members")), "parity-tiles")
    light = pieces.select("key", "piece", "id")
    meet = light.join(light.select("key", F.col("piece").alias("other"), F.col("id").alias("with")), "key") \
        .where("piece < other").select("id", "with").distinct()
    one = pieces.groupBy("id").agg(F.min("members").alias("members"))
    body = cut(one.select("id", F.explode("members").alias("cls")).join(info, "cls")
               .groupBy("id").agg(F.collect_list(F.struct("cls", "comp", "n", "sketch")).alias("rows")), "parity-bodies")
    cross = meet.join(body, "id").withColumnRenamed("rows", "left") \
        .join(body.select(F.col("id").alias("with"), F.col("rows").alias("right")), "with").select("left", "right")

    def run(batches):
        for rb in batches:
            for i in range(rb.num_rows):
                tiles = []
                for col in rb.columns:
                    v = col[i].values
                    tiles.append([v.field("cls").to_numpy(), v.field("comp").to_numpy(), v.field("n").to_numpy(), v.field("sketch").to_pylist()])
                width = min(len(s) for t in tiles for s in t[3])
                (ca, pa_, na, sa), (cb, pb, nb, sb) = tiles[0], tiles[-1]
                right = np.stack([fold(np.frombuffer(s, np.uint8), width) for s in sb])
                for k in range(len(ca)):
                    near = np.bitwise_count(fold(np.frombuffer(sa[k], np.uint8), width) ^ right).sum(1, dtype=np.int64) <= allowed(na[k], nb)
                    hit = np.flatnonzero(near & (pb != pa_[k]))
                    if len(hit):
                        swap = cb[hit] < ca[k]
                        a, n = np.full(len(hit), ca[k]), np.full(len(hit), na[k])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.where(swap, cb[hit], a)), pa.array(np.where(swap, a, cb[hit])),
                             pa.array(np.where(swap, nb[hit], n)), pa.array(np.where(swap, n, nb[hit]))], ["a", "b", "na", "nb"])

    kind = "a long, b long, na long, nb long"
    found = body.select("rows").mapInArrow(run, kind).union(cross.mapInArrow(run, kind))
    return cut(found.distinct(), "parity-pairs")


def jaccard_links(docs: DataFrame, rows: DataFrame, groups: DataFrame, text: str, shingle: int, tile: int) -> DataFrame:
    """(node, comp): the components of the links between classes of ``groups``."""
    hubs = groups.groupBy("key").agg(F.min("cls").alias("hub"))
    members = cut(groups.join(hubs, "key"), "parity-members")
    info = cut(rows.join(groups.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"]), "parity-info")
    star = members.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    near = cut(hamming(star, info), "parity-star")
    exact = verified(docs, info, near.where(f"{_FITS} AND low <= {_ALLOWED}"), text, shingle)
    checked = cut(near.join(exact, ["a", "b"], "left").select(
        F.col("a").alias("hub"), F.col("b").alias("cls"), F.expr(f"apart IS NOT NULL AND apart <= {_ALLOWED}").alias("linked"),
        # what keeps a member from every direct neighbour y of the hub: y <= 1.25 min(na, nb)
        F.expr("coalesce(apart, low) > (na + 5 * least(na, nb) div 4) div 9 + (nb + 5 * least(na, nb) div 4) div 9").alias("far")),
        "parity-checked")
    links = checked.where("linked").select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    comp = cut(components(links, "parity"), "parity-components")

    state = members.join(checked, ["hub", "cls"], "left") \
        .select("key", "cls", F.coalesce("linked", F.lit(True)).alias("ball"), F.coalesce("far", F.lit(False)).alias("far"))
    within = state.where("NOT ball AND NOT far").select("key").distinct().withColumn("open", F.lit(True))
    sizes = info.select("cls", "n", "sketch")
    named = lambda c: cut(sizes.join(c.withColumnRenamed("node", "cls"), "cls", "left")
                          .withColumn("comp", F.coalesce("comp", "cls")), "parity-named")
    rest = cut(state.join(within, "key", "left").where("NOT ball OR open").select("key", "cls"), "parity-rest")
    tried = near.select("a", "b")
    for turn in range(ROUNDS + 1):
        label = named(comp)
        rows = cut(rest.join(label.select("cls", "comp"), "cls"), f"parity-open-{turn}")
        split = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        rest = cut(rows.join(split, "key"), f"parity-split-{turn}")
        if turn == ROUNDS or rest.limit(1).count() == 0:
            break
        pick = rest.groupBy("key").agg(F.max(F.struct(F.xxhash64("comp", F.lit(turn)), "comp", F.xxhash64("cls", F.lit(turn)), "cls")).alias("p")) \
            .select("key", F.col("p.cls").alias("hub"), F.col("p.comp").alias("home"))
        pairs = rest.join(pick, "key").where("comp <> home") \
            .select(F.least("hub", "cls").alias("a"), F.greatest("hub", "cls").alias("b")).distinct() \
            .join(tried, ["a", "b"], "left_anti")
        close = cut(hamming(pairs, info).where(f"{_FITS} AND low <= {_ALLOWED}"), f"parity-close-{turn}")
        links = links.union(_linked(docs, info, close, text, shingle))
        comp = cut(components(links, f"parity-{turn}"), "parity-components")
        tried = tried.union(close.select("a", "b"))
        rest = rest.select("key", "cls")
    fresh = _tile_pairs(rest.select("key", "cls"), label, tile).join(tried, ["a", "b"], "left_anti")
    return components(links.union(_linked(docs, info, fresh, text, shingle)), "parity-all")


def _linked(docs: DataFrame, info: DataFrame, pairs: DataFrame, text: str, shingle: int) -> DataFrame:
    """(a, b): the pairs (a, b, na, nb) that are links."""
    return verified(docs, info, pairs, text, shingle).join(pairs, ["a", "b"]).where(f"apart <= {_ALLOWED}").select("a", "b")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       tile: int = TILE) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id = smallest
    doc_id reachable over links of Jaccard similarity at least 0.8.

    A document's set: distinct ``shingle``-word runs of its whole text, A-Z
    lower-cased; with fewer words the whole sequence; without words or text it
    is empty, links to nothing and names itself. Rows with equal sets are
    linked, repeated rows too. Rows without a doc_id take part but never name a
    component: a component of such rows only has a null component_id. An empty
    table gives no rows; other columns are not read.

    Sets, classes and part values are compared by 64-bit hashes."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ship_package(df.sparkSession)
    with arrow_batches(df.sparkSession):
        scan = cut(_scan(docs, "doc_id", "text", shingle), "parity-scan")
        rows = scan.where("seen IS NULL").select("doc_id", "text_key", "n", "cls", "sketch")
        groups = cut(part_groups(docs, frequent_shingles(scan), "text", shingle), "parity-groups")
        comp = jaccard_links(docs, rows, groups, "text", shingle, tile)
    known = rows.select("doc_id", "n", "cls").join(comp.select(F.col("node").alias("cls"), "comp"), "cls", "left") \
        .withColumn("comp", F.coalesce("comp", "cls"))
    least = known.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return known.join(least, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
