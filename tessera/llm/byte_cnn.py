"""Operator 4 — language ID with a byte convolutional network.

Network: a window of WINDOW bytes -> filters of several widths over one-hot
bytes (a filter is a table [width, 256] of weights) -> ReLU -> max pooling over
the window -> softmax. Trained in numpy on labelled text, applied in Arrow
batches: whole texts are cut into fixed-length windows, every window is scored
and a document's class probabilities are the byte-weighted mean over its windows.

Inference turns each filter into sums of byte-pair table look-ups (65,536
entries a table), so a width-4 filter costs two gathers per byte.

Only the training sample is bounded (parameters ``per_label`` documents a label,
``windows_per_doc`` windows a document); prediction covers whole texts.

With ``reject`` the network has one class more, trained on generated windows
that are no language (see :func:`noise_windows`). A document whose mean
probability of that class exceeds REJECT_ABOVE is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut, prepare, text_blocks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12                 # per width
UNKNOWN = "und"
REJECT_ABOVE = 0.5           # the reject class outweighs all languages together
MIN_NOISE = 300              # generated windows, at least


@dataclass
class ByteCNN:
    labels: list[str]
    tables: list[np.ndarray]          # per width: [width, 256, FILTERS]
    bias: list[np.ndarray]            # per width: [FILTERS]
    dense: np.ndarray                 # [len(WIDTHS) * FILTERS, labels (+ 1: the reject class)]
    dense_bias: np.ndarray
    reject: bool = False              # whether the last class is the reject class


def _pool(x: np.ndarray, tables, bias):
    """Max-pooled activations [windows, filters] and the arg-max positions."""
    feats, where = [], []
    for t, c in zip(tables, bias):
        w = len(t)
        n = x.shape[1] - w + 1
        z = t[0][x[:, :n]]
        for j in range(1, w):
            z = z + t[j][x[:, j:j + n]]
        at = z.argmax(axis=1)
        feats.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0, :] + c)
        where.append(at)
    return np.concatenate(feats, 1), where


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = 25, batch: int = 64,
          rate: float = 0.01, seed: int = 0) -> ByteCNN:
    """Adam on cross-entropy. x: [windows, WINDOW] bytes, y: label positions."""
    rng = np.random.default_rng(seed)
    k, nf = len(labels), FILTERS
    tables = [rng.normal(0, 0.3, (w, 256, nf)).astype(np.float32) for w in WIDTHS]
    bias = [np.zeros(nf, np.float32) for _ in WIDTHS]
    dense = rng.normal(0, 0.2, (nf * len(WIDTHS), k)).astype(np.float32)
    dense_bias = np.zeros(k, np.float32)
    params = [*tables, *bias, dense, dense_bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    share = np.bincount(y, minlength=k).astype(np.float64)
    weight = (len(y) / (k * np.maximum(share, 1))).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            pick = order[lo:lo + batch]
            xb, yb = x[pick], y[pick]
            pre, where = _pool(xb, tables, bias)
            act = np.maximum(pre, 0)
            logit = act @ dense + dense_bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = p.copy()
            g[np.arange(len(yb)), yb] -= 1
            g *= weight[yb][:, None] / len(yb)
            d_pre = (g @ dense.T) * (pre > 0)
            grads_t, grads_c = [], []
            for m, (t, at) in enumerate(zip(tables, where)):
                d = d_pre[:, m * nf:(m + 1) * nf]
                gt = np.zeros_like(t)
                rows, cols = np.arange(len(xb))[:, None], np.arange(nf)[None, :]
                for j in range(len(t)):
                    np.add.at(gt[j], (xb[rows, at + j], np.broadcast_to(cols, at.shape)), d)
                grads_t.append(gt)
                grads_c.append(d.sum(0))
            grads = [*grads_t, *grads_c, act.T @ g + 1e-4 * dense, g.sum(0)]
            step += 1
            for q, gr, m1, m2 in zip(params, grads, first, second):
                m1 *= 0.9
                m1 += 0.1 * gr
                m2 *= 0.999
                m2 += 0.001 * gr * gr
                q -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return ByteCNN(labels, tables, bias, dense, dense_bias)


class Scorer:
    """A trained network unfolded into byte-pair tables."""

    def __init__(self, net: ByteCNN):
        self.net = net
        pair = np.arange(65536)
        hi, lo = pair >> 8, pair & 255
        self.filters = []                     # (list of (offset, table), width)
        for t in net.tables:
            w = len(t)
            for f in range(t.shape[2]):
                parts = []
                for j in range(0, w - 1, 2):
                    parts.append((j, (t[j][hi, f] + t[j + 1][lo, f]).astype(np.float32)))
                if w % 2:                     # the last byte on its own, looked up by its pair
                    parts.append((w - 2, t[w - 1][lo, f].astype(np.float32)))
                self.filters.append((parts, w))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of windows [n, WINDOW]."""
        pair = (x[:, :-1].astype(np.intp) << 8) | x[:, 1:]
        cols = np.empty((len(x), len(self.filters)), np.float32)
        for m, (parts, w) in enumerate(self.filters):
            n = x.shape[1] - w + 1
            j, table = parts[0]
            z = table.take(pair[:, j:j + n])
            for j, table in parts[1:]:
                z += table.take(pair[:, j:j + n])
            cols[:, m] = z.max(axis=1)
        act = np.maximum(cols + np.concatenate(self.net.bias), 0)
        logit = act @ self.net.dense + self.net.dense_bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def windows_of(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All fixed-length windows of a block: (bytes [n, WINDOW], document, bytes
    used). The last window of a document is padded with zero bytes."""
    size = np.diff(off)
    per = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = off[:-1][doc] + nth * WINDOW
    used = np.minimum(WINDOW, off[1:][doc] - start)
    padded = np.concatenate([b, np.zeros(WINDOW, np.uint8)])
    x = padded[start[:, None] + np.arange(WINDOW)[None, :]]
    x[np.arange(WINDOW)[None, :] >= used[:, None]] = 0
    return x, doc, used


_HEX, _UPPER_HEX = b"0123456789abcdef", b"0123456789ABCDEF"
_BASE64 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_DUMP = b"0123456789abcdefABCDEF-:{}, \n"
_TAGS = (b"div", b"span", b"td", b"a", b"li", b"p", b"br", b"tr")


def noise_windows(clean: list[bytes], n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` windows that are no language: runs of hex (either case) and base64
    with and without breaks, markup without text, printable bytes, dumps, and
    random characters of scripts that ``clean`` does not use."""
    used = {ord(c) >> 6 for raw in clean for c in raw.decode("utf-8", "ignore")}
    scripts = [k for k in range(0x370 >> 6, 0xD000 >> 6) if k not in used]
    out = np.zeros((n, WINDOW), np.uint8)
    pick = lambda signs, size: rng.choice(np.frombuffer(signs, np.uint8), size)
    for i in range(n):
        size, kind = int(rng.integers(24, WINDOW + 1)), i % 7
        if kind < 3:
            b = pick((_HEX, _UPPER_HEX, _BASE64)[kind], size)
            if rng.random() < 0.5:
                every = int(rng.choice([2, 4, 8, 16, 32, 64, 76]))
                b[every::every + 1] = rng.choice([32, 10])
        elif kind == 3:
            parts, length = [], 0
            while length < size:
                t = _TAGS[rng.integers(len(_TAGS))]
                parts.append((b"<%s>" % t, b"</%s>" % t, b'<%s class="c%d">' % (t, rng.integers(99)),
                              b'<%s id="x%d"/>' % (t, rng.integers(999)), b"&nbsp;", b"&#%d;" % rng.integers(999))[rng.integers(6)])
                length += len(parts[-1])
            b = np.frombuffer(b"".join(parts)[:size], np.uint8)
        elif kind == 4:
            b = rng.integers(33, 127, size).astype(np.uint8)
        elif kind == 5 or not scripts:
            b = pick(_DUMP, size)
        else:
            code = (scripts[rng.integers(len(scripts))] << 6) + rng.integers(0, 64, size)
            code[rng.random(size) < 0.15] = 32
            b = np.frombuffer("".join(map(chr, code)).encode()[:size], np.uint8)
        out[i, :size] = b
    return out


def mixed_windows(clean: list[bytes], noise: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Per clean window a short piece of it beside a piece of noise: a few
    words next to a key or a number are still a language."""
    out = np.zeros((len(clean), WINDOW), np.uint8)
    for row, raw in zip(out, clean):
        size = min(len(raw), int(rng.integers(24, 64)))
        at = int(rng.integers(0, len(raw) - size + 1))
        parts = [raw[at:at + size], noise[rng.integers(len(noise))].tobytes()[:int(rng.integers(12, 48))].rstrip(b"\0")]
        both = b" ".join(parts if rng.random() < 0.5 else parts[::-1])
        row[:len(both)] = np.frombuffer(both, np.uint8)
    return out


# -------------------------------------------------------------------- on Spark
def training_sample(df: DataFrame, label: str, text: str, per_label: int, windows_per_doc: int) -> list:
    """[(label, window bytes)]: up to ``per_label`` different texts a label, chosen
    by a hash of the text, and evenly spaced windows of each. The draw is a
    filter inside the scan at four times the rate needed, taken from the number
    of different texts with a letter, so copies and texts without a letter do
    not thin it out: min(per_label, different texts) a label are reached. That
    number is an aggregate over hashes; of the texts only the bounded sample is
    shuffled and reaches the driver."""
    lettered = df.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")) \
        .select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    count = {r["label"]: r["n"] for r in lettered.select("label", "hash").distinct()
             .groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}      # one number per class of the network
    if not count:
        return []
    share = F.create_map(*[F.lit(x) for k, n in count.items() for x in (k, (4 * per_label + 20) / n)])
    draw = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = lettered.withColumn("draw", draw).where(F.col("draw") < share[F.col("label")])
    ranked = few.dropDuplicates(["label", "hash"]) \
        .withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("draw", "hash"))) \
        .where(F.col("i") <= per_label)
    raw = F.col("text").cast("binary")
    size = F.octet_length("text")
    spread = F.greatest(size - WINDOW, F.lit(0)) / F.lit(max(1, windows_per_doc - 1))
    starts = F.transform(F.sequence(F.lit(0), F.lit(windows_per_doc - 1)), lambda i: F.floor(i * spread).cast("int"))
    cutouts = F.transform(F.array_distinct(starts), lambda s: F.substring(raw, s + 1, F.lit(WINDOW)))
    return [(r["label"], bytes(r["w"])) for r in
            ranked.select("label", F.explode(cutouts).alias("w")).orderBy("label", "w").collect()]


def fit(df: DataFrame, label: str = "lang", text: str = "text", per_label: int = 400,
        windows_per_doc: int = 3, epochs: int = 25, reject: bool = False) -> ByteCNN | None:
    """Train on a bounded sample of the labelled rows of ``df``; None when no
    row has both a label and a letter. Every window also trains as a short
    piece, so that short texts are in the training distribution. ``reject``
    adds the reject class, with as many windows as the sample."""
    sample = training_sample(df, label, text, per_label, windows_per_doc)
    if not sample:
        return None
    labels = sorted({s[0] for s in sample})
    rng = np.random.default_rng(7)
    x, y = [], []
    for name, raw in sample:
        row = np.zeros(WINDOW, np.uint8)
        row[:len(raw)] = np.frombuffer(raw, np.uint8)
        part = np.zeros(WINDOW, np.uint8)
        size = min(len(raw), int(rng.integers(24, 96)))
        at = int(rng.integers(0, len(raw) - size + 1))
        part[:size] = np.frombuffer(raw[at:at + size], np.uint8)
        x += [row, part]
        y += [labels.index(name)] * 2
    if not reject:
        return train(np.array(x), np.array(y), labels, epochs=epochs)
    noise = noise_windows([raw for _, raw in sample], max(MIN_NOISE, len(sample)), rng)
    mixed = mixed_windows([raw for _, raw in sample], noise, rng)
    y += [labels.index(name) for name, _ in sample] + [len(labels)] * len(noise)
    net = train(np.concatenate([np.array(x), mixed, noise]), np.array(y), [*labels, UNKNOWN], epochs=epochs)
    return replace(net, labels=labels, reject=True)


def predict(df: DataFrame, net: ByteCNN | None, text: str = "text", carry: list[Column] = ()) -> DataFrame:
    """``carry`` columns plus lang_pred and score (mean probability of the
    predicted label, 0 to 1). A null text, a text without a letter, no trained
    network, or a text that the reject class takes gives ``und`` with score 0;
    ties go to the label that sorts first. Rows are independent, so repeated
    rows agree."""
    prepare(df.sparkSession)
    slim = df.select(*carry, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"),
                     F.col(text).alias("__text"))
    kept = slim.columns[:-2]
    schema = slim.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        score = Scorer(net) if net else None
        for rb, b, off in text_blocks(batches, "__text", 1 << 20):
            n = rb.num_rows
            letter = rb.column(len(kept)).to_numpy(zero_copy_only=False)
            p = np.zeros((n, len(net.dense_bias) if net else 1))
            if net and len(b):
                x, doc, used = windows_of(b, off)
                for lo in range(0, len(x), 512):
                    q = score(x[lo:lo + 512]) * used[lo:lo + 512, None]
                    np.add.at(p, doc[lo:lo + 512], q)
                p /= np.maximum(np.diff(off), 1)[:, None]
            known = letter & bool(net)
            if net and net.reject:
                known &= p[:, -1] <= REJECT_ABOVE
                p = p[:, :-1]
            best = p.argmax(1)
            names = [net.labels[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            sure = np.where(known, np.minimum(p.max(1), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([*rb.columns[:len(kept)], pa.array(names, pa.string()), pa.array(sure)],
                                             [*kept, "lang_pred", "score"])

    return slim.mapInArrow(run, schema)


def keep_known(df: DataFrame, net: ByteCNN | None, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``df`` whose language is known with a score of at least
    ``least``; a network with a reject class decides which those are, one
    without keeps every text with a letter. All columns pass through whatever
    their names."""
    names = df.columns
    carry = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)]
    return predict(df, net, text, carry).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)) \
        .select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)])


def held_out(id_col: str = "doc_id") -> Column:
    """Fixed rule of the fold: crc32 of the id as text, modulo 4, equals 2."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(4)) == 2, F.lit(False))
