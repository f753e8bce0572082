"""Operator 11 — periodic run detection by seed and extend on diagonals.

A *run* is a stretch of consecutive words with smallest period q whose length
is at least ``max(least, times * q)`` and that no neighbouring word extends. A
run of length L agrees with itself shifted by q on L - q words in a row, so on
the *diagonal* of lag q it holds equal k-grams for every k up to L - q.

Index: the lags are taken in bands [b, 2b); inside a band every run has at
least ``(times - 1) * b`` agreeing words, which is the gram length of the band
(the minimum guaranteed overlap). Grams get exact integer names by doubling
(the name of 2k words is the rank of a pair of k-word names), positions are
sorted by name, and two binary searches list each position's partners whose
distance lies in the band: the same-document occurrence pairs.

Extension: pairs are walked by lag and position; a table holds, per lag, the
furthest position that an extension has covered, and seeds below it are skipped.

Bound: a gram that lies inside a stretch of a period below the band's lags is
no seed. Nothing is lost: if all seeds of a run of period q lay in such
stretches, they would overlap in enough words to be one stretch, and the run
would have that smaller period. Any other gram has at most one partner in the
band, because two partners closer than half the gram give it such a period. So
one word repeated a million times costs a few passes, not all pairs.

Spread: rows are independent. Blocks of whole texts are first scanned with
hashed grams; only documents that repeat a gram (equal grams have equal hashes,
so none is missed) are named exactly. Nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix64, prepare, text_blocks, window_hashes, word_hashes, words_of

LEAST, TIMES = 24, 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _first_band(least: int, times: int) -> tuple[int, int]:
    """(end of the first band of lags, gram length in it): below that period
    ``least`` decides a run's length, from there on ``times``."""
    end = max(2, least // times)
    return end, min(max(least - q, (times - 1) * q) for q in range(1, end + 1))


def _names(words: list[bytes]) -> np.ndarray:
    """A number per word, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A dense number per pair, equal for equal pairs."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].ravel()


def _grams(name: np.ndarray, size: int, k: int) -> np.ndarray:
    """Names of the k-word grams from names of ``size``-word grams, size <= k <= 2 * size."""
    m = len(name) + size - k
    return _pair_names(name[:m], name[k - size:k - size + m])


def _seeds(name: np.ndarray, live: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) of equal grams at a distance in [low, high), by lag and
    position; ``live`` marks the positions that may be the left one."""
    n = len(name)
    order = np.argsort(name, kind="stable")
    key = name[order] * np.int64(2 * n) + order
    left = np.flatnonzero(live)
    a = np.searchsorted(key, name[left] * np.int64(2 * n) + left + low)
    z = np.searchsorted(key, name[left] * np.int64(2 * n) + np.minimum(left + high, 2 * n - 1))
    count = z - a
    pos = np.repeat(left, count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
    lag = order[at] - pos
    by = np.lexsort((pos, lag))
    return lag[by], pos[by]


def _agree(ids: np.ndarray, i: int, lag: int, step: int) -> int:
    """How many words from ``i`` on (step 1) or before ``i`` (step -1) equal the
    word ``lag`` further on; the strips double, so the cost follows the answer."""
    done, strip = 0, 32
    end = len(ids) - lag - i if step > 0 else i
    while done < end:
        take = min(strip, end - done)
        a = i + done if step > 0 else i - done - take
        same = ids[a:a + take] == ids[a + lag:a + lag + take]
        if not same.all():
            return done + int(np.argmin(same if step > 0 else same[::-1]))
        done, strip = done + take, strip * 2
    return done


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    n = len(ids)
    if n < least:
        return []
    low, name, size = 1, ids, 1
    first, k = _first_band(least, times)
    stretches: list[tuple[int, int, int]] = []
    found: dict[tuple[int, int], int] = {}
    while low * times <= n and k < n:
        while size < k:
            grown = min(2 * size, k)
            name, size = _grams(name, size, grown), grown
        if len(name) < 2 or int(name.max()) + 1 == len(name):
            break                              # no gram of this or any greater length occurs twice
        high = first if low == 1 else 2 * low
        live = np.zeros(len(name) + 1, np.int64)
        for a, z, q in stretches:
            if q < low and z - a >= k:
                live[a] += 1
                live[z - k + 1] -= 1
        lags, places = _seeds(name, np.cumsum(live[:-1]) == 0, low, min(high, n // times + 1))
        heads = np.ones(len(lags), bool)       # a seed next to the last one lies in the same extension
        heads[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        covered: dict[int, int] = defaultdict(int)
        for lag, i in zip(lags[heads].tolist(), places[heads].tolist()):
            if i < covered[lag]:
                continue
            a = i - _agree(ids, i, lag, -1)
            z = i + k + _agree(ids, i + k, lag, 1)
            covered[lag] = z
            stretches.append((a, z + lag, lag))
            found.setdefault((a, z + lag), lag)
        low, k = high, max(k, (times - 1) * high)
    return sorted((a, z - a, q) for (a, z), q in found.items() if z - a >= max(least, times * q))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Marks of the words that some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _suspects(b: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Marks of the block's documents in which a k-word gram occurs twice."""
    start, end, doc = words_of(b, off)
    hit = np.zeros(len(off) - 1, bool)
    g = window_hashes(word_hashes(b, start, end), k)
    if len(g):
        inside = np.flatnonzero(doc[:len(g)] == doc[k - 1:])
        key = mix64(g[inside] ^ mix64(doc[inside].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        hit[doc[inside[order[1:][same]]]] = True
    return hit


def periodic_runs(df: DataFrame, carry: list[Column], text: str = "text",
                  least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row of ``df``: the ``carry`` columns (at least one), ``runs``
    (array of start, length, period; word numbers from 0, by start and period),
    ``best`` (the run of greatest exact length / period; ties: smallest start,
    then period; null without runs) and ``collapsed`` (the words that no run
    holds after its first period, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. A null, empty or blank
    text has no runs and an empty ``collapsed``. Repeated rows each give their
    row, an empty table none. Other columns of ``df`` are not read; carried
    columns keep their names, so they must differ from the three above."""
    if least < times or times < 3:
        raise ValueError("a run holds its period at least three times and is at least that long")
    prepare(df.sparkSession)
    _, k = _first_band(least, times)
    names = [f"__c{i}" for i in range(len(carry))]
    rows = df.select(*[c.alias(n) for n, c in zip(names, carry)], F.col(text).alias("__text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for rb, b, off in text_blocks(batches, "__text"):
            raw, o, hit = b.tobytes(), off.tolist(), _suspects(b, off, k)
            runs, best, kept = [], [], []
            for d in range(rb.num_rows):
                words = raw[o[d]:o[d + 1]].split()
                got = runs_of(_names(words), least, times) if hit[d] else []
                if got:
                    words = [words[i] for i in np.flatnonzero(~dropped(len(words), got)).tolist()]
                runs.append([dict(zip(("start", "length", "period"), r)) for r in got])
                top = strongest(got)
                best.append(top and dict(zip(("start", "length", "period"), top)))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*rb.columns[:-1], pa.array(runs, kind), pa.array(best, kind.value_type), pa.array(kept, pa.string())],
                [*names, "runs", "best", "collapsed"])

    out = rows.mapInArrow(run, f"{kinds}, runs array<{RUN}>, best {RUN}, collapsed string")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, df.select(*carry).columns)], "runs", "best", "collapsed")


def looped_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> Column:
    """The text whose tail repeats, for one document in ten: with h = crc32 of
    the decimal id, g = h div 10 and n words, documents with h mod 10 = 0 keep
    their first a = g mod n words, and the rest repeats the next
    p = 1 + (n - a) div (3 + g mod 8) words up to n words. Other texts (a null
    id or text, no words) stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words).cast("long")
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    rest = (n - a).cast("int")
    p = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    times = F.ceil(rest / p).cast("int")
    loop = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), rest)
    looped = F.concat_ws(" ", F.concat(F.slice(words, F.lit(1), a), loop))
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(F.col(text))


def run_digests(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli)
    and SHA-256 digests of the run list and of the collapsed text."""
    found = periodic_runs(df, [F.col(id_col).alias("doc_id")], text)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
