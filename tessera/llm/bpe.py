"""Operator 8 — BPE encoding and decoding in batched numpy merge rounds.

The words of a block of texts are encoded together: their symbols lie in one
flat array, every adjacent pair inside a word becomes a 64-bit key, keys are
found by binary search in the sorted merge table, each word's lowest-rank pair
is merged at all its places, and words without a mergeable pair leave the
array. A merge can only create pairs of higher rank, so a round per rank gives
the same result as merging one place at a time.

The tokenizer file (vocabulary, merges, special tokens) is read once on the
driver from a path parameter and broadcast: its size does not depend on the
data. Words already encoded are remembered per worker up to WORD_MEMORY words.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, text_blocks

WORD_MEMORY = 400_000
WORD_END = "</w>"
NO_RANK = np.int64(1 << 60)
# The word pattern of the tokenizer's format, white space written out.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else
    the next code point from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}
    return [chr(rest.get(b, b)) for b in range(256)]


class WordBPE:
    """A word-level BPE with word-end symbols, over lower-cased NFC text."""

    def __init__(self, vocab: dict, merges: list, specials: dict):
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in specials.items()}
        self.specials = specials
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs], np.int64)
        self.final = np.array([vocab[s + WORD_END] for s in signs], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort((left << 32) | right, kind="stable")
        self.keys = ((left << 32) | right)[order]
        self.rank = order.astype(np.int64)
        self.made = made[order]
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") \
            if specials else None
        self.memory: dict[str, tuple[int, str, str]] = {}

    @classmethod
    def load(cls, path: str) -> "WordBPE":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return cls(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]})

    def __getstate__(self):
        return {**self.__dict__, "memory": {}}

    def words(self, text: str) -> list[str]:
        """Normalised words; a special token's string stands for itself."""
        if self.split and "<" in text:
            out = []
            for part in self.split.split(text):
                out += [part] if part in self.specials else self._plain(part)
            return out
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "\u03a3" in text:          # lower case by character: no final sigma
                return WORDS.findall("".join([c.lower() for c in text]))
        return WORDS.findall(text.lower())

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word, all words merged together."""
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        last = np.cumsum(size) - 1
        sym[last] = self.final[flat[last]]
        word = np.repeat(np.arange(len(raw)), size)
        out: list = [None] * len(raw)
        while len(sym):
            pair = np.flatnonzero(word[:-1] == word[1:])
            key = (sym[pair] << 32) | sym[pair + 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.rank[at], NO_RANK)
            best = np.full(len(raw), NO_RANK)
            owner = word[pair]
            if len(pair):
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                best[owner[first]] = np.minimum.reduceat(rank, first)
            live = best[word] < NO_RANK
            if not live.all():                       # these words are finished
                w, s = word[~live], sym[~live]
                edge = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                for k, part in zip(w[edge].tolist(), np.split(s, edge[1:])):
                    out[k] = part
            hit = (rank < NO_RANK) & (rank == best[owner])
            place, new = pair[hit], self.made[at[hit]]
            # overlapping places (aaa): take every other one from the left
            start = np.concatenate([[True], place[1:] != place[:-1] + 1]) if len(place) else np.zeros(0, bool)
            nth = np.arange(len(place)) - np.maximum.accumulate(np.where(start, np.arange(len(place)), 0))
            take = nth % 2 == 0
            sym[place[take]] = new[take]
            live[place[take] + 1] = False
            sym, word = sym[live], word[live]
        return out

    def decode(self, ids) -> str:
        """The tokens of ``ids`` joined by one space."""
        return " ".join([self.token[i] for i in ids])

    def learn(self, words: set) -> None:
        """Remember the encodings of words not seen yet."""
        if len(self.memory) > WORD_MEMORY:
            self.memory.clear()
        new = [w for w in words if w not in self.memory]
        plain = [w for w in new if w not in self.specials]
        for w, ids in zip(plain, self.encode_words(plain)):
            ids = ids.tolist()
            self.memory[w] = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        for w in new:
            if w in self.specials:
                self.memory[w] = (1, str(self.specials[w]), w)

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.memory[w][1].split()]


_WORKER: dict = {}


def tokens(df: DataFrame, path: str, text: str = "text", carry: list[Column] = ()) -> DataFrame:
    """``carry`` columns plus n_tokens, ids (decimal ids joined by one space)
    and decoded. Null and empty texts give no tokens; rows are independent."""
    return _apply(df, path, text, carry, "n_tokens long, ids string, decoded string", digest=False)


def token_digests(df: DataFrame, path: str, text: str = "text", carry: list[Column] = ()) -> DataFrame:
    """Like :func:`tokens` with ids_sha256 and decoded_sha256 for the texts."""
    return _apply(df, path, text, carry, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest=True)


def _apply(df, path, text, carry, schema, digest):
    spark = df.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(WordBPE.load(path))
    slim = df.select(*carry, F.col(text).alias("__text"))
    kept = slim.columns[:-1]
    out_schema = slim.select(*kept).schema
    for f in schema.split(", "):
        out_schema = out_schema.add(*f.split(" "))

    def run(batches):
        bpe = _WORKER.setdefault(path, shared.value)
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for rb, _, _ in text_blocks(batches, "__text"):
            docs = [bpe.words(t or "") for t in rb.column(len(kept)).to_pylist()]
            bpe.learn(set().union(*docs))
            n, ids, dec = [], [], []
            for words in docs:
                parts = [bpe.memory[w] for w in words]
                n.append(sum([p[0] for p in parts]))
                a, z = " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
                ids.append(sha(a) if digest else a)
                dec.append(sha(z) if digest else z)
            yield pa.RecordBatch.from_arrays([*rb.columns[:len(kept)], pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(dec, pa.string())], out_schema.fieldNames())

    return slim.mapInArrow(run, out_schema)
