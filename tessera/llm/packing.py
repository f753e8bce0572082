"""Operator 10 — best-fit packing into bins of several permitted lengths.

Documents are measured in tokens; one longer than the largest permitted length
is cut into pieces of that length and a rest, so no token is lost. Items are
dealt at random into groups of about GROUP_ITEMS and every group is packed by
one task: items go by falling size into the open bin with the least room that
still holds them. When none does, a bin is opened whose length is the one with
the least cost per token once filled with the items still waiting (all
permitted lengths are tried on the group's size histogram). At the end each bin
shrinks to the smallest permitted length that holds its contents.

Only sizes travel; texts stay where they are. Dealing costs at most a few
partly filled bins a group, i.e. a few in GROUP_ITEMS.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_SEPARATORS, cut, prepare

LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP_ITEMS = 20_000
OVERHEAD = 32                # cost of a sequence besides its tokens
ATTENTION = 65_536           # tokens at which attention costs as much as the rest


def cost(length: int) -> float:
    """Cost of running one sequence of ``length`` tokens."""
    return OVERHEAD + length * (1 + length / ATTENTION)


def word_tokens(text: str = "text") -> Column:
    """Words and an end mark: at least 1, so every row is placed."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (F.size(F.filter(F.split(t, WORD_SEPARATORS, -1), lambda w: w != "")) + 1).cast("long")


def _smallest(lengths, used: int) -> int:
    return lengths[bisect_left(lengths, used)]


def _open(size: int, waiting: list[int], count: dict[int, int], lengths) -> int:
    """The permitted length of least cost per token for a bin that starts with
    ``size`` and is filled, largest first, with waiting items."""
    best = None
    for length in lengths[bisect_left(lengths, size):]:
        room, k = length - size, len(waiting)
        while room and k:
            k = bisect_left(waiting, room + 1, 0, k)       # largest waiting size that fits is waiting[k - 1]
            if not k:
                break
            k -= 1
            room -= waiting[k] * min(count[waiting[k]], room // waiting[k])
        used = length - room
        price = cost(_smallest(lengths, used)) / used
        if best is None or price < best[0]:
            best = (price, length)
    return best[1]


def pack(sizes: list[int], lengths=LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Per item: bin, offset in the bin, final length of the bin. Sizes are 1 to
    max(lengths); equal sizes keep their order, of equally tight bins the one
    opened first is taken."""
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    count: dict[int, int] = {}
    for s in sizes:
        count[s] = count.get(s, 0) + 1
    waiting = sorted(count)
    rooms: list[int] = []                      # distinct rooms of open bins
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    limit: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in order:
        s = sizes[i]
        count[s] -= 1
        if not count[s]:
            waiting.pop()                      # sizes fall, so it is the last
        k = bisect_left(rooms, s)
        if k < len(rooms):
            room = rooms[k]
            b = heappop(by_room[room])
            if not by_room[room]:
                del by_room[room]
                rooms.pop(k)
        else:
            b = len(used)
            used.append(0)
            limit.append(_open(s, waiting, count, lengths))
        bins[i], offsets[i] = b, used[b]
        used[b] += s
        room = limit[b] - used[b]
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            heappush(by_room[room], b)
    final = [_smallest(lengths, u) for u in used]
    return bins, offsets, [final[b] for b in bins]


def pieces(df: DataFrame, carry: list[Column], n_tokens: Column, longest: int) -> DataFrame:
    """``carry``, piece, start, n_tokens: documents cut to at most ``longest``."""
    base = df.select(*carry, F.greatest(F.coalesce(n_tokens, F.lit(0)), F.lit(1)).cast("long").alias("__n"))
    names = base.columns[:-1]
    last = F.expr(f"(__n - 1) div {longest}")
    return base.select(*names, "__n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")) \
        .select(*names, "piece", (F.col("piece") * longest).alias("start"),
                F.least(F.lit(longest), F.col("__n") - F.col("piece") * longest).alias("n_tokens"))


def best_fit_packing(df: DataFrame, carry: list[Column], n_tokens: Column, lengths=LENGTHS,
                     group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per piece: ``carry``, piece, start (token offset in the row),
    n_tokens, bin (long, unique), capacity (a permitted length), offset (token
    offset in the bin).

    Pieces of a row cover its tokens without gap or overlap; a bin's pieces fill
    it from 0 without gap and never beyond its capacity. A row with a null or
    zero token count takes one token (its end mark). Repeated rows are packed
    each; an empty table gives no rows."""
    spark = df.sparkSession
    prepare(spark)
    items = cut(pieces(df, carry, n_tokens, max(lengths)).withColumn("__item", F.monotonically_increasing_id()), "pack-items")
    groups = max(1, -(-items.count() // group_items))
    dealt = items.withColumn("__group", F.pmod(F.xxhash64("__item"), F.lit(groups)).cast("long"))
    names = [c for c in items.columns if c != "__item"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__item", ignore_index=True)
        b, o, c = pack(pdf["n_tokens"].tolist(), lengths)
        out = pdf[["__item"]].copy()
        out["bin"] = (int(pdf["__group"].iloc[0]) << 24) + pd.Series(b, dtype="int64")
        out["capacity"], out["offset"] = pd.Series(c, dtype="int64"), pd.Series(o, dtype="int64")
        return out

    placed = dealt.select("__item", "__group", "n_tokens").groupBy("__group") \
        .applyInPandas(run, "__item long, bin long, capacity long, offset long")
    return items.join(placed, "__item").select(*names, "bin", "capacity", "offset")
