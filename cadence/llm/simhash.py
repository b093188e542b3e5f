"""SimHash near-duplicates: fingerprints, links within a few bits, and connected groups.

A text is lower-cased (A-Z), split at ASCII white space into words and into shingles of three words
(fewer words: all of them; none: fingerprint zero). A fingerprint's bit is 1 if it is set in over
half of the shingles' XXH64 hashes (seed 42).

Links are exact. Fingerprints within ``radius`` bits agree on at least ``agree`` of
``radius + agree`` parts, so each distinct fingerprint is dealt once to every choice of ``agree``
parts and only meets those with the same bits there. What meets is compared bit-sliced: bit plane p holds bit p of 64
fingerprints in one word; planes are XORed with a query's bits and added into carry-save counters
for all 64 at once, and a word is abandoned as soon as all its 64 distances exceed the radius. A
task emits one link per member beyond the first of each group that it finds, not all pairs; keys
with many fingerprints are cut into blocks, and the pairs of blocks go to different tasks.

Groups are connected components of the links: smallest labels spread along the links and jump to
their label's label until nothing changes; every round is a written table.

Defined cases: a null text is empty (fingerprint zero, linked like any other), a null doc_id takes
part in links but never names a group unless the group has no other, repeated rows are returned as
often as they occur, an empty table gives no row, columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import materialize, row_key, runs_of, ship

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Parts that must agree beyond the pigeonhole's least; more of them make smaller buckets and more keys.
AGREE = 3
#: Fingerprints of one key that one task compares; a key with more is cut into blocks of so many.
BLOCK = 512
#: Rows compared at a time: whole keys of neighbouring values are gathered up to so many.
GATHER = 1024


# --- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8").lower().split()  # bytes: lowers A-Z, splits at space and \\t to \\r
    if not words:
        return 0
    whole = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(whole[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row_key, fp (the 64 bits as a signed long)."""
    ship(docs.sparkSession)

    def fp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.fromiter([fingerprint(t or "", shingle) for t in b.column("text").to_pylist()], np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key"), pa.array(bits.view(np.int64))], ["doc_id", "row_key", "fp"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(fp, "doc_id long, row_key binary, fp long")


# --- links ------------------------------------------------------------------------------------------

def part_keys(fp: Column, radius: int, agree: int) -> Column:
    """One key per choice of ``agree`` of the ``radius + agree`` parts."""
    n = radius + agree
    edges = [64 * k // n for k in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[F.struct(F.lit(k).cast("short").alias("choice"), fp.bitwiseAND(F.lit(signed(sum(masks[i] for i in own)))).alias("bits"))
                     for k, own in enumerate(combinations(range(n), agree))])


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """[64, words]: bit i of word w of plane p is bit p of fingerprint 64 w + i."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(-1, 64)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64).reshape(64, -1)


def bit_sliced_links(fps: np.ndarray, radius: int = RADIUS, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j), i < j, of fingerprints within ``radius`` bits, by carry-save counters."""
    planes = bit_planes(fps)
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    depth = max(1, int(radius + 1).bit_length())  # counter planes; the last one stays set once reached
    start = (1 << depth) - 1 - radius  # counters begin here, so that radius + 1 overflows them
    left, right = [], []
    for at in range(0, len(fps), chunk):
        query = np.arange(at, min(at + chunk, len(fps)))
        q, w = (x.ravel() for x in np.meshgrid(query, np.arange(at // 64, planes.shape[1]), indexing="ij"))  # i < j only
        count = [np.full(len(q), every if start >> d & 1 else np.uint64(0)) for d in range(depth)]
        over = np.zeros(len(q), np.uint64)
        for p in range(64):
            carry = planes[p][w] ^ np.where(fps[q] >> np.uint64(p) & np.uint64(1), every, np.uint64(0))
            for d in range(depth):
                count[d], carry = count[d] ^ carry, count[d] & carry
            over |= carry
            if p % 8 == 7:
                live = np.flatnonzero(over != every)  # words with all distances past the radius are abandoned
                if len(live) < len(q):
                    q, w, over, count = q[live], w[live], over[live], [c[live] for c in count]
        near = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
        row, lane = np.nonzero(near)
        i, j = q[row], w[row] * 64 + lane
        ok = (i < j) & (j < len(fps))
        left.append(i[ok])
        right.append(j[ok])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each of n items' groups."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        np.minimum.at(after, label[left], low)
        np.minimum.at(after, label[right], low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def links(distinct: DataFrame, radius: int = RADIUS, agree: int = AGREE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints ``fp`` connected by steps of ``radius`` bits."""
    ship(distinct.sparkSession)
    keys = materialize(distinct.select("fp", F.explode(part_keys(F.col("fp"), radius, agree)).alias("key"))
                       .select("fp", F.xxhash64("key.choice", "key.bits").alias("key")), "simhash-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("blocks")).cast("int")
    met = keys.join(shared, "key").withColumn("blocks", blocks).withColumn("own", own).select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = met.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"), "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((2, 0), np.int64)
        for b in batches:
            rows = np.concatenate([kept, [b.column("meeting").to_numpy(), b.column("fp").to_numpy()]], axis=1)
            begins = runs_of(rows[0])
            at = 0
            for end in begins[1:]:  # the last meeting may go on in the next batch
                if end - at >= GATHER:
                    yield found(rows[1, at:end])
                    at = end
            kept = rows[:, at:]
            last = runs_of(kept[0])[-1] if kept.shape[1] else 0
            if last >= GATHER:
                yield found(kept[1, :last])
                kept = kept[:, last:]
        if kept.shape[1]:
            yield found(kept[1])

    def found(fps: np.ndarray) -> pa.RecordBatch:
        fps = np.unique(fps)
        label = spanning(len(fps), *bit_sliced_links(fps.view(np.uint64), radius))
        linked = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[label[linked]]), pa.array(fps[linked])], ["a", "b"])

    return (dealt.repartition("meeting").sortWithinPartitions("meeting")
                 .mapInArrow(compare, "a long, b long").groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"))


# --- groups -----------------------------------------------------------------------------------------

def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """fp, label for every linked fingerprint; equal labels mean connected."""
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "simhash-edges")
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("fp"), "label"), "simhash-labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("fp")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("fp") == F.col("a")).select("fp", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = materialize(spread, "simhash-labels")
        jump = spread.select(F.col("fp").alias("at"), F.col("label").alias("next"))
        after = materialize(spread.join(jump, spread["label"] == jump["at"], "left").select(
            "fp", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "simhash-labels")
        if not after.filter("old <> label").limit(1).count():
            return after.select("fp", "label")
        labels = after.select("fp", "label")
    raise RuntimeError("labels did not settle")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its group), row_key."""
    fps = materialize(fingerprints(docs, shingle), "simhash-fp")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    groups = components(links(distinct, radius))
    named = groups.join(distinct, "fp")
    firsts = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = groups.join(firsts, "label").select("fp", "component_id")
    all_of = materialize(distinct.join(of, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "simhash-groups")
    return fps.join(all_of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "row_key")
