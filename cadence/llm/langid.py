"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of orders 0 to ``ORDER``: how often each byte followed each context.
A byte's code length under a language is found at the longest context that has seen it, with the
escape costs of the longer contexts that exist but have not (method C: a context of n occurrences and
d different bytes escapes with probability d / (n + d)); a byte never seen costs 8 bits after the
last escape. A text's language is the one with the shortest total code.

Statistics are frozen after training, so the code length of a byte depends only on the ORDER + 1
bytes that end with it. The trees are therefore laid out as tables from these bytes to one code length
per language, exact for every language, and whole batches of texts are scored by table look-ups.

Training counts come from a documented sample of the labelled rows: about ``TRAIN_BYTES`` of text per
language (less each if there are many languages: ``ALL_BYTES`` in total), in pieces of ``PIECE`` bytes
that are chosen by a hash of their bytes from all over every text, equal pieces once, counted in Spark.
A language with less text than that is learned whole. Texts are lower-cased (A-Z) and ASCII characters
that aren't letters count as a space.

Defined cases: a text that is null or without a letter is ``und`` with score 0, as is every text if
nothing could be learned; a null lang is never learned; a null doc_id is neither learned from nor held
out; repeated rows are scored each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import ship, small, text_bytes

ORDER = 4
#: Bytes of sampled text per language and in all, about, and of a piece of it.
TRAIN_BYTES, ALL_BYTES, PIECE = 1_500_000, 96_000_000, 4096
#: Bytes of text scored at a time.
CHUNK = 1 << 19

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[ord("a") : ord("z") + 1] = _FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def remainder(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte of the texts, it and the ORDER bytes before it in its text (zeros before the text), packed."""
    n = len(offsets) - 1
    padded = np.zeros(len(data) + ORDER * n, np.uint8)
    at = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded[at] = _FOLD[data]
    out = np.zeros(len(data), np.int64)
    for k in range(ORDER, -1, -1):
        out = out << 8 | padded[at - k]
    return out


class Lookup:
    """Open-addressing table from whole numbers to row numbers, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.keys, self.rows = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            put = first[free[first]]
            self.keys[slot[put]], self.rows[slot[put]] = keys[left[put]], left[put]
            stay = np.ones(len(left), bool)
            stay[put] = False
            taken = self.keys[slot[stay]] != keys[left[stay]]
            left, slot = left[stay], (slot[stay] + taken) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it isn't in the table."""
        slot = self._slot(keys)
        found, out = self.keys[slot], self.rows[slot]
        open_ = np.flatnonzero((found != keys) & (found != -1))
        out[found != keys] = -1
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.rows[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class Model:
    """Code lengths by order: ``codes[k]`` for contexts of k bytes and a byte, ``escapes[k]`` for contexts."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        self.tables: list[tuple[Lookup, np.ndarray]] = []
        self.contexts: list[tuple[Lookup, np.ndarray]] = []
        below = None
        for k in range(ORDER + 1):
            mask = (1 << 8 * (k + 1)) - 1
            own = [_summed(g & mask, c) for g, c in counts]
            keys = np.unique(np.concatenate([g for g, _ in own])) if k else np.arange(256)
            heads = np.unique(keys >> 8)
            code, escape = np.zeros((len(keys), len(own)), np.float32), np.zeros((len(heads), len(own)), np.float32)
            for j, (g, c) in enumerate(own):
                head, total = _summed(g >> 8, c)
                kinds = _summed(g >> 8, np.ones(len(g), np.int64))[1]
                escape[np.searchsorted(heads, head), j] = -np.log2(kinds / (total + kinds))
                code[:, j] = escape[np.searchsorted(heads, keys >> 8), j] + (below[1][below[0].rows_of(keys & (mask >> 8)), j] if k else 8.0)
                of = np.searchsorted(head, g >> 8)
                code[np.searchsorted(keys, g), j] = -np.log2(c / (total + kinds)[of])
            below = (Lookup(keys), code)
            self.tables.append(below)
            self.contexts.append((Lookup(heads), escape))

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[texts, languages]: bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        at = 0
        while at < len(offsets) - 1:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
            for s in range(int(offsets[at]), int(offsets[to]), CHUNK):  # a long text in pieces, each with the bytes before it
                e, seen = min(int(offsets[to]), s + CHUNK), min(ORDER, s - int(offsets[at]))
                cuts = np.clip(offsets[at : to + 1], s, e) - s
                bits = self._bits(data[s - seen : e], np.append(0, cuts[1:] + seen))[seen:]
                some = np.diff(cuts) > 0
                out[at:to][some] += np.add.reduceat(bits, cuts[:-1][some], axis=0, dtype=float)
            at = to
        return out

    def _bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[bytes, languages]: bits of each byte under each language."""
        gram = grams(data, offsets)
        bits = np.zeros((len(gram), len(self.languages)), np.float32)
        left = np.arange(len(gram))
        for k in range(ORDER, -1, -1):
            key = gram[left] & ((1 << 8 * (k + 1)) - 1)
            lookup, code = self.tables[k]
            row = lookup.rows_of(key)
            hit = row >= 0
            bits[left[hit]] += code[row[hit]]
            left, key = left[~hit], key[~hit]
            lookup, escape = self.contexts[k]
            row = lookup.rows_of(key >> 8)
            bits[left[row >= 0]] += escape[row[row >= 0]]
        return bits


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)


def train(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """Context trees from a sample of ``labelled`` (doc_id, text, lang)."""
    spark = ship(labelled.sparkSession)
    labelled = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    different = labelled.groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.max(F.octet_length("text")).alias("bytes"))
    sizes = different.groupBy("lang").agg(F.sum("bytes").alias("bytes")).filter("bytes > 0").collect()  # a row per language
    if not sizes:
        return None
    per = min(train_bytes, ALL_BYTES // len(sizes))
    share = {r["lang"]: min(1.0, per / r["bytes"]) * (1 << 32) for r in sizes}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            data, at = text_bytes(b.column("text"))
            names, out = [], []
            for lang, s, e in zip(b.column("lang").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                for k in range(s, e, PIECE):
                    piece = data[k : min(e, k + PIECE)].tobytes()
                    if zlib.crc32(piece) < share.get(lang, 0):
                        names.append(lang)
                        out.append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.binary())], ["lang", "text"])

    sample = labelled.mapInArrow(pieces, "lang string, text binary").dropDuplicates(["lang", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            lang = np.array(b.column("lang").to_pylist(), object)
            for name in sorted(set(lang)):
                gram, n = np.unique(grams(*text_bytes(b.column("text").filter(pa.array(lang == name)))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    got = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toArrow()  # bounded by the sample
    lang = np.array(got.column("lang").to_pylist(), object)
    gram, n = got.column("gram").to_numpy(), got.column("n").to_numpy()
    names = sorted(set(lang))
    return Model(names, [(gram[lang == x], n[lang == x]) for x in names]) if names else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text)."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in small(batches, most=2 << 20):
            if model is None:
                names, best = ["und"] * b.num_rows, np.zeros(b.num_rows)
            else:
                bits = model.code_lengths(*text_bytes(b.column("text")))
                odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000))
                odds /= odds.sum(1, keepdims=True)
                top, best = odds.argmax(1), odds.max(1)
                letter = b.column("has_letter").to_numpy(zero_copy_only=False)
                names = [model.languages[k] if ok else "und" for k, ok in zip(top, letter)]
                best = np.where(letter, best, 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(best)], ["doc_id", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), letter.alias("has_letter")).mapInArrow(
        score, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows whose crc32 isn't divisible by ``folds``."""
    model = train(docs.filter((remainder(folds) != 0) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", F.coalesce(remainder(folds) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
