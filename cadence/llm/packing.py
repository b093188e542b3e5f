"""Best-fit packing by linear grouping: documents into as few sequences of ``capacity`` ids as can be.

1. Every document is encoded once; one longer than the capacity is cut into whole pieces and a rest.
2. Lengths are whole numbers up to the capacity, so the corpus shrinks to a histogram of at most
   ``capacity`` counts. Only that histogram reaches the driver, whatever the corpus holds.
3. Large lengths are sorted, cut into groups of equal cardinality and rounded up to the largest of
   their group. Over these few sizes the configurations (which sizes fill one sequence) are
   optimised as a linear programme by column generation; the whole part of the solution is used.
4. The documents themselves take the slots of their group, longest first, so that a sequence keeps
   the room that rounding up had reserved. What is left over and all small lengths are then placed
   best-fit, longest first, into that room, and into new sequences where nothing fits.

Steps 3 and 4 handle runs of equal lengths and runs of alike sequences as one item each: the plan
maps (length, ranks from a to b) to consecutive sequences. Its size depends on the capacity and the
number of groups, not on the corpus. Spark then ranks the pieces within their length — each task
counts its own, a sum over tasks gives the first rank — and looks every piece up in the plan.

Defined cases: a null text is empty (its only id is the end id), repeated rows and null doc_ids are
documents of their own, an empty table gives no row, columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import materialize, ship, small
from cadence.llm.wordcache import encoder

#: Groups of large lengths; lengths above this share of the capacity are large.
GROUPS, LARGE_SHARE = 192, 1 / 3

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, run int, run_rank long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


# --- the plan, over a histogram -----------------------------------------------------------------

def group_sizes(counts: np.ndarray, groups: int, large: int) -> list[tuple[int, dict[int, int]]]:
    """Large lengths as (rounded size, {length: count}), of equal cardinality, longest group first."""
    lengths = [n for n in range(len(counts) - 1, large, -1) if counts[n]]
    total = int(sum(counts[n] for n in lengths))
    share = -(-total // groups) if total else 0
    out: list[tuple[int, dict[int, int]]] = []
    room = 0
    for n in lengths:
        left = int(counts[n])
        while left:
            if not room:
                out.append((n, {}))
                room = share
            k = min(left, room)
            out[-1][1][n] = out[-1][1].get(n, 0) + k
            left, room = left - k, room - k
    return out


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes of the largest value that fits the capacity (a knapsack without limits)."""
    best, levels = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):  # one more item in each round
        after, took = best.copy(), np.full(capacity + 1, -1)
        for k, (size, value) in enumerate(zip(sizes, values)):
            worth = best[: capacity + 1 - size] + value
            better = worth > after[size:] + 1e-12
            after[size:][better], took[size:][better] = worth[better], k
        best = after
        levels.append(took)
    use, room = np.zeros(len(sizes), np.int64), capacity
    for took in reversed(levels):
        if took[room] >= 0:
            use[took[room]] += 1
            room -= int(sizes[took[room]])
    return float(best[capacity]), use


def optimal_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Whole parts of the linear programme's solution: (uses of each size, number of sequences)."""
    n = len(sizes)
    if not n:
        return []
    base = np.diag(capacity // sizes).astype(float)  # columns: one size alone, as often as it fits
    for _ in range(rounds):
        x = np.linalg.solve(base, demand)
        prices = np.linalg.solve(base.T, np.ones(n))
        value, use = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-5:
            break
        change = np.linalg.solve(base, use.astype(float))
        ratio = np.where(change > 1e-9, x / np.maximum(change, 1e-9), np.inf)
        base[:, int(ratio.argmin())] = use
    x = np.linalg.solve(base, demand)
    return [(base[:, k].astype(np.int64), int(x[k] + 1e-6)) for k in range(n) if x[k] + 1e-6 >= 1]


class Plan:
    """Runs of (length, first rank, count) placed into runs of alike sequences."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.counts = capacity, counts
        self.used = np.zeros(len(counts), np.int64)  # ranks handed out, by length
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first rank, sequence, copies, offset
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs (first sequence, count)
        self.rooms: list[int] = []

    def put(self, length: int, sequences: tuple[int, int], copies: int, offset: int) -> None:
        first, n = sequences
        self.rows.append((length, int(self.used[length]), first, copies, offset))
        self.used[length] += n * copies

    def leave(self, room: int, run: tuple[int, int]) -> None:
        if room > 0 and run[1]:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append(run)

    def new(self, n: int) -> tuple[int, int]:
        self.sequences += n
        return self.sequences - n, n

    def configurations(self, groups: list[tuple[int, dict[int, int]]], chosen: list[tuple[np.ndarray, int]]) -> None:
        """Substitute the documents: each slot takes the next longest of its group."""
        left = [[[n, c] for n, c in sorted(g.items(), reverse=True)] for _, g in groups]
        for use, many in chosen:
            runs = [(*self.new(many), 0)]  # (first, count, ids in each so far)
            for k in np.flatnonzero(use):
                for _ in range(int(use[k])):
                    after = []
                    for first, n, filled in runs:
                        while n and left[k]:
                            part = min(n, left[k][0][1])
                            self.put(left[k][0][0], (first, part), 1, filled)
                            after.append((first, part, filled + left[k][0][0]))
                            left[k][0][1] -= part
                            if not left[k][0][1]:
                                left[k].pop(0)
                            first, n = first + part, n - part
                        if n:  # the group is used up: the slot stays free
                            after.append((first, n, filled))
                    runs = after
            for first, n, filled in runs:
                self.leave(self.capacity - filled, (first, n))

    def best_fit(self, length: int) -> None:
        left = int(self.counts[length] - self.used[length])
        while left:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                fit = self.capacity // length
                self.leave(self.capacity, self.new(-(-left // fit)))
                continue
            room = self.rooms[at]
            first, n = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(at)
            fit = room // length
            offset = self.capacity - room
            whole = min(n, left // fit)
            if whole:
                self.put(length, (first, whole), fit, offset)
                self.leave(room - fit * length, (first, whole))
                left -= whole * fit
                first, n = first + whole, n - whole
            if n and 0 < left < fit:
                self.put(length, (first, 1), left, offset)
                self.leave(room - left * length, (first, 1))
                first, n, left = first + 1, n - 1, 0
            self.leave(room, (first, n))

    def arrays(self) -> tuple[np.ndarray, ...]:
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        return tuple(rows.T)


def plan_packing(counts: np.ndarray, capacity: int, groups: int = GROUPS, large_share: float = LARGE_SHARE) -> Plan:
    """The plan for ``counts[length]`` pieces of each length from 0 to the capacity."""
    plan = Plan(counts, capacity)
    if counts[capacity]:  # pieces that fill a sequence alone
        plan.put(capacity, plan.new(int(counts[capacity])), 1, 0)
    rest = counts.copy()
    rest[capacity] = 0
    grouped = group_sizes(rest, groups, int(capacity * large_share))
    sizes = np.array(sorted({s for s, _ in grouped}, reverse=True), np.int64)
    merged = [(int(s), _merge([g for t, g in grouped if t == s])) for s in sizes]
    demand = np.array([sum(g.values()) for _, g in merged], float)
    plan.configurations(merged, optimal_configurations(sizes, demand, capacity))
    for length in range(capacity - 1, 0, -1):
        plan.best_fit(length)
    return plan


def _merge(parts: list[dict[int, int]]) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for p in parts:
        for n, c in p.items():
            out[n] += c
    return out


# --- Spark ----------------------------------------------------------------------------------------

def cut(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document with their rank among the task's pieces of the same length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, ranks = TaskContext.get().partitionId(), defaultdict(int)
        encode, end, step = encoder(vocabulary).encode, struct.pack("<I", end_id), 4 * capacity
        for b in small(batches):
            rows, ids = [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                data = encode(text or "") + end
                for k in range(0, len(data), step):
                    part = data[k : k + step]
                    n = len(part) // 4
                    rows.append((doc, k // step, k // 4, n, zlib.crc32(part), run, ranks[n]))
                    ranks[n] += 1
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4"))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))] * keep_ids, names + ["ids"] * keep_ids)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "run", "run_rank"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(pieces, PIECES + ", ids array<long>" * keep_ids)


def assign(pieces: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """Give every piece its sequence and its place there."""
    spark = ship(pieces.sparkSession)
    per_run = pieces.groupBy("length", "run").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_run.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = spark.sparkContext.broadcast(plan_packing(counts, capacity, groups).arrays())
    before = F.sum("n").over(Window.partitionBy("length").orderBy("run")) - F.col("n")
    firsts = per_run.select("length", "run", before.alias("first"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, sequences, copies, offsets = plan.value
        begins = np.searchsorted(lengths, np.arange(capacity + 2))
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                row[own] = begins[n] + np.searchsorted(ranks[begins[n] : begins[n + 1]], rank[own], "right") - 1
            k = rank - ranks[row]
            sequence, offset = sequences[row] + k // copies[row], offsets[row] + k % copies[row] * length
            keep = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(sequence), pa.array(offset)], keep + ["sequence_id", "offset"])

    ranked = pieces.join(firsts, ["length", "run"]).withColumn("rank", F.col("first") + F.col("run_rank"))
    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if "ids" in pieces.columns else []), "rank")
    schema = ", ".join(f"{c} {t}" for c, t in kept.drop("rank").dtypes) + ", sequence_id bigint, offset bigint"
    return kept.mapInArrow(look_up, schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096, groups: int = GROUPS, keep_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text); one row per piece, with its ids if ``keep_ids``."""
    return assign(materialize(cut(docs, vocabulary, end_id, capacity, keep_ids), "pieces"), capacity, groups)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from a packing with ids: sequence_id, ids (of at most the capacity)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
