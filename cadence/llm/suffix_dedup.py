"""Repeated byte strings, marked by matching statistics over run-compressed Burrows-Wheeler indexes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
doc_id. Texts are dealt so that equal strings meet, and an index never holds more than its share:

* Documents are laid out in blocks (whole texts, compressed). The *key* of a string is the least hash
  of its ``GRAM``-byte parts, a function of its bytes alone. Consecutive strings of a text with one key
  are a *segment*.
* Keys are dealt by their value. Those that a single document holds are dropped there; every block
  hears which of its keys are held elsewhere or twice in it.
* Each block deals the segments of these keys, different ones once, each with the least doc_id that
  holds it. A key of more than ``HOT`` documents doesn't go to one task: its strings are dealt singly, by their
  own hash.
* A key with one segment left has its strings nowhere else: the answer is the segment's own document. The
  segments of the other keys of a share become one index: suffix order, Burrows-Wheeler transform, of which only the
  runs are kept, with the suffix positions sampled at both ends of each run, and the least doc_id of
  every row range whose suffixes share LENGTH bytes. The segments then stream through it from their
  last byte to their first: matching statistics say where LENGTH bytes match, the row says which range
  that is, and the range whether a smaller document than the block's holds the string.
* The answers (a bit per string) go back to the blocks, which mark the bytes and cut them out.

Defined cases: a null text is empty; matches never cross documents; a null doc_id is smaller than none
and none is smaller than it, so its text stays whole; rows that repeat a doc_id aren't smaller than each
other; texts under LENGTH bytes stay; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import materialize, runs_of, ship

LENGTH, GRAM = 50, 20
#: Bytes of text of a block, about (a longer text is a block of its own), and bytes hashed at a time.
BLOCK_BYTES, CHUNK = 4 << 20, 1 << 17
#: Bytes of text whose keys make one share, and bytes of segments that make one index, about.
KEY_SHARE, INDEX_SHARE = 16 << 20, 2 << 20
#: Strings of a segment, at most.
MOST = 64
#: A key that more documents hold is dealt by whole strings.
HOT = 10_000

BLOCKS = "block long, n long, meta binary, payload binary"
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# --- keys of a block ----------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed hash of every GRAM consecutive bytes, read as three overlapping words of eight."""
    n = len(data) - GRAM + 1
    word = [np.ndarray(n, "<u8", data.data, at, (1,)) for at in (0, 8, GRAM - 8)]
    h = word[0] * _ODD
    for w, mix, shift in ((word[1], _MIX, 32), (word[2], _ODD, 29)):
        h ^= h >> np.uint64(shift)
        h += w
        h *= mix
    h ^= h >> np.uint64(32)
    return h


def _window_keys(data: np.ndarray) -> np.ndarray:
    """The key of the string that starts at each byte (but the last LENGTH - 1)."""
    least, span, wide = gram_hashes(data), 1, LENGTH - GRAM + 1
    n = len(data) - LENGTH + 1
    while span * 2 <= wide:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    return np.minimum(least[:n], least[wide - span : wide - span + n])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of strings, key) of each run of strings with one key within one text."""
    starts, counts, keys = [], [], []
    begins = np.unique(offsets[:-1])
    for at in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        key = _window_keys(data[at : at + CHUNK + LENGTH - 1])
        cuts = begins[np.searchsorted(begins, at) : np.searchsorted(begins, at + len(key))] - at
        first = np.union1d(runs_of(key), cuts)
        end = offsets[np.searchsorted(offsets, first + at, "right")] - at - LENGTH + 1  # no string that leaves its text
        size = np.minimum(np.append(first[1:], len(key)), end) - first
        first, size = first[size > 0], size[size > 0]
        parts = -(-size // MOST)  # a long run, as of one repeated letter, is cut
        row = np.repeat(np.arange(len(first)), parts)
        step = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * MOST
        starts.append(at + first[row] + step)
        counts.append(np.minimum(size[row] - step, MOST))
        keys.append(key[first][row])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(keys)


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _open(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class Block:
    """One block as its row holds it; null doc_ids have ``named`` False."""

    def __init__(self, n: int, meta: bytes, payload: bytes):
        raw, self.text = _open(meta), _open(payload)
        self.ids, self.named = np.frombuffer(raw[: 8 * n], "<i8"), np.frombuffer(raw[8 * n : 9 * n], np.uint8).astype(bool)
        self.offsets = np.frombuffer(raw[9 * n :], "<i8")
        self.data = np.frombuffer(self.text, np.uint8)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, number of strings, key, document) of the segments of named documents."""
        start, count, key = segments(self.data, self.offsets)
        doc = np.searchsorted(self.offsets, start, "right") - 1
        own = self.named[doc]
        return start[own], count[own], key[own], doc[own]

    def dealt(self, parts: np.ndarray, lows: np.ndarray, hot: np.ndarray, shares: int) -> "Dealt":
        """The different segments of the keys that others hold (parts, lows; ``hot`` ones string by string)."""
        start, count, key, doc = self.segments()
        known = np.sort(parts.astype(np.uint64) << np.uint64(33) | lows.astype(np.uint64) << np.uint64(1) | hot.astype(np.uint64))
        mine = (key_part(key, shares).astype(np.uint64) << np.uint64(32) | key_low(key)) << np.uint64(1)
        at = np.minimum(np.searchsorted(known, mine), max(0, len(known) - 1))
        held = (known[at] >> np.uint64(1) == mine >> np.uint64(1)) if len(known) else np.zeros(len(mine), bool)
        warm = (known[at] & np.uint64(1)).astype(bool) if len(known) else held
        start, count, key, doc, warm = start[held], count[held], key[held], doc[held], warm[held]
        # a hot key's segments become single strings
        reps = np.where(warm, count, 1)
        row = np.repeat(np.arange(len(start)), reps)
        step = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
        start, count = start[row] + step, np.where(warm, 1, count)[row]
        return Dealt(self, start, count, key[row], doc[row], warm[row])


class Dealt:
    """A block's segments: ``which`` different one each occurrence is, and of these bytes, least doc_id and key."""

    def __init__(self, block: Block, start: np.ndarray, count: np.ndarray, key: np.ndarray, doc: np.ndarray, hot: np.ndarray):
        self.start, self.count, self.doc, text = start, count, block.ids[doc], block.text
        seen: dict[bytes, int] = {}
        self.which = np.array([seen.setdefault(text[s : s + n], len(seen)) for s, n in zip(start.tolist(), (count + LENGTH - 1).tolist())], np.int64)
        self.texts = list(seen)
        self.least = np.full(len(seen), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.which, self.doc)
        first = np.zeros(len(seen), np.int64)
        first[self.which[::-1]] = np.arange(len(start))[::-1]
        self.hash = (key[first] ^ key[first] >> np.uint64(31)) * _MIX
        for k in np.flatnonzero(hot[first]).tolist():
            self.hash[k] = np.uint64(zlib.crc32(self.texts[k])) * _ODD
        self.hash ^= self.hash >> np.uint64(33)


def key_part(key: np.ndarray, shares: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(shares)).astype(np.int64)


def key_low(key: np.ndarray) -> np.ndarray:
    return key & np.uint64(0xFFFFFFFF)


# --- the index ----------------------------------------------------------------------------------------

def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (numbers under 511) in order, and the rank of each suffix by its first 32 numbers."""
    n, depth, rank32 = len(text), 4, None
    bits = max(1, n.bit_length())
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = key << 9 | padded[k : k + n]
    while True:
        if 3 * bits <= 63 and 36 + bits <= 63:  # key and place fit into one number, which sorts much faster
            both = np.sort(key << bits | np.arange(n))
            order, ranked = both & ((1 << bits) - 1), both >> bits
        else:
            order = np.argsort(key)
            ranked = key[order]
        new = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if depth == 32:
            rank32 = rank
        if rank32 is not None and new[-1] == n - 1:
            return order, rank32
        key = rank << bits
        key[: max(0, n - depth)] |= rank[depth:] + 1
        depth *= 2


def _advance(k: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The interval of each row, at or after interval ``k``: intervals start at ``bounds``."""
    live = np.arange(len(k))
    for _ in range(8):
        at = k[live] + 1
        on = at < len(bounds)
        on[on] = bounds[at[on]] <= rows[live[on]]
        live = live[on]
        if not len(live):
            return k
        k[live] += 1
    k[live] = np.searchsorted(bounds, rows[live], "right") - 1
    return k


class RunIndex:
    """Runs of the Burrows-Wheeler transform of ``texts``, suffix positions at the ends of runs, and the least
    value of every row range whose suffixes share LENGTH bytes within a text."""

    def __init__(self, texts: list[bytes], values: np.ndarray):
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        text = np.empty(len(joined) + len(texts), np.uint16)  # 0 after each text, byte + 1 elsewhere
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.frombuffer(joined, np.uint8).astype(np.uint16) + 1
        text[ends] = 0
        order, rank32 = suffix_order(text)
        self.text, n = text, len(text)
        last = text[order - 1]
        self.start = runs_of(last).astype(np.int32)
        self.char = last[self.start]
        stop = np.append(self.start[1:], n)
        self.head, self.tail, self.stop = order[self.start], order[stop - 1], stop
        # where a run's rows go when its character is put before them
        by = np.argsort(self.char, kind="stable")
        size = (stop - self.start)[by]
        goes = np.cumsum(size) - size
        self.base = np.empty(len(by), np.int32)
        self.base[by] = goes
        self.by_char, self.char_sorted = by, self.char[by]
        # the run that holds a run's first row after that step
        self.to = np.empty(len(by), np.int32)
        self.to[by] = np.searchsorted(self.start, goes, "right") - 1
        # ranges of rows that share LENGTH bytes: equal in 32 and, 18 later, again in 32
        left = np.repeat(ends, sizes + 1) - np.arange(n)
        whole = left[order] >= LENGTH
        a, b = rank32[order], rank32[np.minimum(order + LENGTH - 32, n - 1)]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | ~whole[1:] | ~whole[:-1]])
        self.range_start = np.flatnonzero(new).astype(np.int32)
        of = np.repeat(np.asarray(values, np.int64), sizes + 1)
        self.range_least = np.minimum.reduceat(np.where(whole, of[order], np.iinfo(np.int64).max), self.range_start)
        self.range_of = (np.searchsorted(self.range_start, self.start, "right") - 1).astype(np.int32)

    def least(self, runs: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.range_least[_advance(self.range_of[runs], self.range_start, rows)]

    def _lcp(self, at: np.ndarray, query: np.ndarray, q_at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal numbers of the text from ``at`` and the query from ``q_at``, up to ``most``."""
        out, live = np.zeros(len(at), np.int32), np.flatnonzero(most > 0)
        for k in range(int(most.max(initial=0))):
            a, q = at[live] + k, q_at[live] + k
            ok = (a < len(self.text)) & (k < most[live])
            ok[ok] = self.text[a[ok]] == query[q[ok]]
            live = live[ok]
            if not len(live):
                break
            out[live] += 1
        return out

    def stream(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Matching statistics of all texts, side by side from their last byte: (text, position, length matched, run, row).

        A text is extended in its row's run while the run's character fits; else the nearest run of that
        character, above or below, takes over at its sampled end, whichever matches longer. The run of
        the next row is found from where the run's first row goes, without a search. Lengths over
        LENGTH are exact only as being over it.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        query = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
        begin = np.cumsum(sizes) - sizes
        lanes = np.argsort(-sizes, kind="stable")
        run, row, at, matched = (np.zeros(len(texts), np.int32) for _ in range(4))  # in the order of lanes
        at[:] = self.head[0]
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes[lanes], -step, "left"))  # texts longer than the step
            lanes, run, row, at, matched = lanes[:live], run[:live], row[:live], at[:live], matched[:live]
            place = sizes[lanes] - 1 - step
            want = query[begin[lanes] + place]
            jump = np.flatnonzero(self.char[run] != want)
            if len(jump):
                self._jump(jump, want, run, row, at, matched, query, begin[lanes] + place + 1)
            found = matched >= 0
            row = np.where(found, self.base[run] + row - self.start[run], 0)
            run = _advance(np.where(found, self.to[run], 0), self.start, row)
            at, matched = np.where(found, at - 1, self.head[0]), matched + 1
            yield lanes, place, matched, run, row

    def _jump(self, jump, want, run, r, p, m, query, q_at) -> None:
        """Move the lanes ``jump`` to a run of the wanted character; -1 matched if there is none."""
        key = want[jump].astype(np.int64) << 40 | run[jump]
        place = np.searchsorted(self.char_sorted.astype(np.int64) << 40 | self.by_char, key)
        best, most = np.full(len(jump), -1, np.int32), np.minimum(m[jump], LENGTH)
        for step, rows, samples in ((-1, self.stop - 1, self.tail), (0, self.start, self.head)):
            k = np.clip(place + step, 0, len(self.by_char) - 1)
            ok = (place + step >= 0) & (place + step < len(self.by_char)) & (self.char_sorted[k] == want[jump])
            other = self.by_char[k]
            lcp = np.full(len(jump), -1, np.int32)
            lcp[ok] = self._lcp(samples[other[ok]], query, q_at[jump[ok]], most[ok])
            better = np.flatnonzero(lcp > best)
            best[better] = lcp[better]
            run[jump[better]], r[jump[better]], p[jump[better]] = other[better], rows[other[better]], samples[other[better]]
        m[jump] = best


def earlier(texts: list[bytes], values: np.ndarray) -> np.ndarray:
    """The least value of a text that holds it, for each string of LENGTH bytes of all texts in a row."""
    count = np.array([len(t) - LENGTH + 1 for t in texts], np.int64)
    out, first = np.full(count.sum(), np.iinfo(np.int64).max), np.cumsum(count) - count
    if len(texts):
        index = RunIndex(texts, values)
        for lane, place, matched, run, row in index.stream(texts):
            if place.max() >= 0:
                long = np.flatnonzero(matched >= LENGTH)
                out[first[lane[long]] + place[long]] = index.least(run[long], row[long])
    return out


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


# --- Spark ----------------------------------------------------------------------------------------

def lay_out(docs: DataFrame) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text): written once, as later stages name them."""
    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rows, size, made = TaskContext.get().partitionId() << 32, [], 0, 0

        def block() -> pa.RecordBatch:
            ids = np.array([i or 0 for i, _ in rows], "<i8").tobytes() + bytes(i is not None for i, _ in rows)
            ends = np.concatenate([[0], np.cumsum([len(t) for _, t in rows])]).astype("<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([first + made], pa.int64()), pa.array([len(rows)], pa.int64()), pa.array([_press(ids + ends)], pa.binary()),
                                               pa.array([_press(b"".join(t for _, t in rows))], pa.binary())], ["block", "n", "meta", "payload"])

        for b in batches:
            for i in range(b.num_rows):
                text = b.column("text")[i].as_py() or b""
                if rows and size + len(text) > BLOCK_BYTES:
                    yield block()
                    rows, size, made = [], 0, made + 1
                rows.append((b.column("doc_id")[i].as_py(), text))
                size += len(text)
        if rows:
            yield block()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return materialize(given.mapInArrow(pack, BLOCKS), "dedup-blocks")


def _block_rows(b: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    for k in range(b.num_rows):
        yield b.column("block")[k].as_py(), Block(b.column("n")[k].as_py(), b.column("meta")[k].as_py(), b.column("payload")[k].as_py())


def shared_keys(blocks: DataFrame, shares: int) -> DataFrame:
    """block, part, lows, hot: the keys of each block that two documents hold, here or in other blocks."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, block in _block_rows(b):
                _, _, key, doc = block.segments()
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                held = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]) if len(key) else np.zeros(0, bool)
                key, ids = key[held], block.ids[doc[held]]
                first = runs_of(key)
                if not len(first):
                    continue
                # documents of a key, and whether they have different ids
                n = np.diff(np.append(first, len(key)))
                low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
                key = key[first]
                part = key_part(key, shares)
                order = np.lexsort((key_low(key), part))
                key, part, n, differ = key[order], part[order], n[order], (low != high)[order]
                cuts = runs_of(part)
                for s, e in zip(cuts, np.append(cuts[1:], len(part))):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name], pa.int64()), pa.array([part[s]], pa.int32()), pa.array([key_low(key[s:e]).astype("<u4").tobytes()], pa.binary()),
                        pa.array([_press((np.minimum(n[s:e], (1 << 30) - 1) << 1 | differ[s:e]).astype("<u4").tobytes())], pa.binary())], ["block", "part", "lows", "counts"])

    def answer(t: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, "<u4") for x in t.column("lows").to_pylist()]
        counts = np.concatenate([np.frombuffer(_open(x), "<u4") for x in t.column("counts").to_pylist()]).astype(np.int64)
        row, low = np.repeat(np.arange(len(lows)), [len(x) for x in lows]), np.concatenate(lows)
        order = np.argsort(low, kind="stable")
        first = runs_of(low[order])
        size = np.diff(np.append(first, len(order)))
        known = (size > 1) | np.bitwise_or.reduceat(counts[order] & 1, first).astype(bool)
        hot = np.add.reduceat(counts[order] >> 1, first) > HOT
        keep, warm = np.zeros(len(low), bool), np.zeros(len(low), bool)
        keep[order], warm[order] = np.repeat(known, size), np.repeat(hot, size)
        names, part = t.column("block").to_pylist(), t.column("part")[0].as_py()
        out = []
        bounds = np.searchsorted(row, np.arange(len(lows) + 1))
        for k, name in enumerate(names):
            own = slice(bounds[k], bounds[k + 1])
            if keep[own].any():
                out.append((name, low[own][keep[own]], warm[own][keep[own]]))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "part": pa.array([part] * len(out), pa.int32()),
                         "lows": pa.array([o[1].astype("<u4").tobytes() for o in out], pa.binary()), "hot": pa.array([np.packbits(o[2]).tobytes() for o in out], pa.binary())})

    keys = blocks.mapInArrow(deal, "block long, part int, lows binary, counts binary")
    return materialize(keys.groupBy("part").applyInArrow(answer, "block long, part int, lows binary, hot binary"), "dedup-keys")


def _known(replies: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lows = [np.frombuffer(r["lows"], "<u4") for r in replies]
    hot = [np.unpackbits(np.frombuffer(r["hot"], np.uint8))[: len(x)] for r, x in zip(replies, lows)]
    parts = np.repeat(np.array([r["part"] for r in replies], np.int64), [len(x) for x in lows])
    return parts, np.concatenate(lows or [np.zeros(0, "<u4")]), np.concatenate(hot or [np.zeros(0, np.uint8)])


def deal_segments(blocks: DataFrame, replies: DataFrame, shares: int, indexes: int) -> DataFrame:
    """block, share, texts: each block's different segments, by the index that takes them."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (name, block) in enumerate(_block_rows(b)):
                dealt = block.dealt(*_known(b.column("replies")[k].as_py()), shares)
                for share, own in dealt_to(dealt, indexes):
                    texts = [dealt.texts[i] for i in own.tolist()]
                    raw = np.array([len(t) for t in texts], "<u4").tobytes() + dealt.hash[own].astype("<u4").tobytes() + dealt.least[own].astype("<i8").tobytes() + b"".join(texts)
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([share], pa.int32()), pa.array([len(own)], pa.int64()),
                                                      pa.array([_press(raw)], pa.binary())], ["block", "share", "n", "texts"])

    return blocks.join(replies, "block").mapInArrow(deal, "block long, share int, n long, texts binary")


def dealt_to(dealt: Dealt, indexes: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, numbers of the block's segments that go there, ascending)."""
    share = (dealt.hash % np.uint64(indexes)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    cuts = runs_of(share[order])
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        yield int(share[order[s]]), order[s:e]


def match(segments_: DataFrame) -> DataFrame:
    """block, share, bits: for each string of each segment whether a document smaller than the block's least holds it."""
    def run(t: pa.Table) -> pa.Table:
        merged: dict[bytes, int] = {}
        asked, least, keys = [], [], []
        for n, raw in zip(t.column("n").to_pylist(), t.column("texts").to_pylist()):
            raw = _open(raw)
            sizes, ids, at, own = np.frombuffer(raw[: 4 * n], "<u4").tolist(), np.frombuffer(raw[8 * n : 16 * n], "<i8"), 16 * n, []
            for size, key, doc in zip(sizes, np.frombuffer(raw[4 * n : 8 * n], "<u4").tolist(), ids.tolist()):
                k = merged.setdefault(raw[at : at + size], len(merged))
                if k == len(least):
                    least.append(doc)
                    keys.append(key)
                elif doc < least[k]:
                    least[k] = doc
                own.append(k)
                at += size
            asked.append((np.array(own), np.array(sizes) - LENGTH + 1, ids))
        texts, least = list(merged), np.array(least, np.int64)
        count = np.array([len(t) - LENGTH + 1 for t in texts], np.int64)
        first = np.cumsum(count) - count
        held = np.repeat(least, count)
        _, group, size = np.unique(np.array(keys, np.int64), return_inverse=True, return_counts=True)
        several = np.flatnonzero(size[group] > 1)
        held[spread(first[several], count[several])] = earlier([texts[k] for k in several.tolist()], least[several])
        bits = [np.packbits(held[spread(first[own], count)] < np.repeat(ids, count)).tobytes() for own, count, ids in asked]
        return pa.table({"block": t.column("block"), "share": t.column("share"), "bits": pa.array([_press(x) for x in bits], pa.binary())})

    return segments_.groupBy("share").applyInArrow(run, "block long, share int, bits binary")


def covered(block: Block, dealt: Dealt, bits: dict[int, bytes], indexes: int) -> np.ndarray:
    """Which bytes of the block's texts go."""
    size = np.array([len(t) - LENGTH + 1 for t in dealt.texts], np.int64)
    first = np.cumsum(size) - size
    flat = np.zeros(size.sum(), bool)
    for share, own in dealt_to(dealt, indexes):
        flat[spread(first[own], size[own])] = np.unpackbits(np.frombuffer(_open(bits[share]), np.uint8))[: size[own].sum()]
    edge = np.zeros(len(block.data) + 1, np.int32)
    if len(dealt.which):
        row = np.repeat(np.arange(len(dealt.start)), dealt.count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(dealt.count) - dealt.count, dealt.count)
        hit = flat[first[dealt.which[row]] + step] | (dealt.doc > dealt.least[dealt.which])[row]
        at = (dealt.start[row] + step)[hit]
        edge += np.bincount(at, minlength=len(edge)).astype(np.int32)
        edge -= np.bincount(at + LENGTH, minlength=len(edge)).astype(np.int32)
    return np.cumsum(edge[:-1]) > 0


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text)."""
    blocks = lay_out(docs)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shares = max(1, -(-size // KEY_SHARE))
    replies = shared_keys(blocks, shares).groupBy("block").agg(F.collect_list(F.struct("part", "lows", "hot")).alias("replies"))
    indexes = max(1, -(-size // INDEX_SHARE))
    segments_ = deal_segments(blocks, replies, shares, indexes)
    answers = materialize(match(segments_), "dedup-answers").groupBy("block").agg(F.collect_list(F.struct("share", "bits")).alias("answers"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (_, block) in enumerate(_block_rows(b)):
                bits = {r["share"]: r["bits"] for r in b.column("answers")[k].as_py() or ()}
                dealt = block.dealt(*_known(b.column("replies")[k].as_py() or []), shares)
                gone = covered(block, dealt, bits, indexes)
                begin = gone & ~np.concatenate([[False], gone[:-1]])
                begin[block.offsets[:-1][np.diff(block.offsets) > 0]] |= gone[block.offsets[:-1][np.diff(block.offsets) > 0]]
                sums, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begin))
                a, e = block.offsets[:-1], block.offsets[1:]
                kept = block.data[~gone].tobytes()
                left = np.arange(len(sums)) - sums  # kept bytes before each place
                hashes = [hashlib.sha256(kept[x:y]).hexdigest() for x, y in zip(left[a].tolist(), left[e].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.ids, pa.int64(), mask=~block.named), pa.array(e - a, pa.int64()), pa.array(sums[e] - sums[a], pa.int64()), pa.array(spans[e] - spans[a], pa.int64()),
                    pa.array(hashes, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    given = blocks.join(replies, "block", "left").join(answers, "block", "left")
    return given.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
