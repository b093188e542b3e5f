"""Centroid clustering in exact whole numbers over a VA-file.

* Vectors are whole numbers, floor(scale * x). Every dimension is cut into ``CELLS`` cells; the
  VA-file holds one byte per dimension instead of the vector, apart from the vectors.
* In a round, tables [centroid, dimension, cell] hold the least and the greatest squared distance of
  a cell to a centroid. Their sums bound each vector's distance to each centroid. A vector whose
  centroid is certain from that is never fetched; the others are joined with the vectors' table by row
  number and measured exactly against the centroids whose intervals overlap the best one.
* Sums are kept exactly by difference: only vectors that change their cluster are fetched to be moved
  from one sum to another (in the first round all are).

The vectors' table is bucketed by row number, so that a fetch shuffles the few requests and not the
vectors. What reaches the driver is a row per centroid and dimension, whatever the table holds.

Defined cases: a vector that is null, holds a null or non-finite component or hasn't ``dimensions``
components takes no part; a null vec_id takes part but starts no centroid; rows that repeat a vec_id
count each; equal start hashes are ordered by components; fewer vectors than centroids give as many
centroids as there are; an empty table gives no row; other columns are ignored. Whole numbers beyond
``LIMIT`` raise, as their squared distances wouldn't fit into 64 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm.common import hash_share, materialize, ship, work_path

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Cells of a dimension; vectors (about) whose quantiles are the cells' borders: any borders give right results.
CELLS, SAMPLE = 16, 4096
LIMIT = 1 << 27
#: Rows of the vectors' table in a bucket, about, and vectors handled at a time.
BUCKET_ROWS, STEP = 1 << 20, 4096


def whole_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long) of the vectors that take part."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dimensions) & fine)
                .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("x")))


def matrix(column) -> np.ndarray:
    """[rows, dimensions] of a list column or of packed 32-bit rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def packed(x: np.ndarray, kind: str) -> pa.Array:
    return pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())


class Cells:
    """The cells of every dimension: ``inner`` borders, and the least and greatest number of each cell."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, most: np.ndarray):
        cuts = np.arange(1, CELLS) * len(sample) // CELLS
        self.inner = np.sort(sample, axis=0)[cuts].T  # [dimensions, CELLS - 1]
        self.low = np.maximum(np.column_stack([least, self.inner]), least[:, None])
        self.high = np.minimum(np.column_stack([self.inner - 1, most]), most[:, None])

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(b, x[:, d], "right") for d, b in enumerate(self.inner)]).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[dimension, cell, centroid]: least and greatest squared distance of the cell's numbers to the centroid's."""
        c = centroids.T[:, None, :]
        low, high = self.low[:, :, None], self.high[:, :, None]
        inside = np.maximum(np.maximum(low - c, c - high), 0)
        return inside**2, np.maximum(np.abs(low - c), np.abs(high - c)) ** 2


def intervals(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bounds [rows, centroids] of the squared distances."""
    low, high = (np.zeros((len(cells), tables[0].shape[2]), np.int64) for _ in range(2))
    for d in range(cells.shape[1]):
        low += tables[0][d, cells[:, d]]
        high += tables[1][d, cells[:, d]]
    return low, high


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.column_stack([((x - c) ** 2).sum(1) for c in centroids]) if len(x) else np.zeros((0, len(centroids)), np.int64)


def first_centroids(vectors: DataFrame, clusters: int, seed: str = "1:") -> np.ndarray:
    """The vectors with the smallest hash of seed and vec_id, in that order."""
    key = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter("vec_id is not null").select(key.alias("key"), "x").orderBy("key", "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


class VaFile:
    """The tables of one clustering: ``vectors`` (row, vec_id, x), bucketed by row, and ``cells`` (row, cells)."""

    def __init__(self, vectors: DataFrame):
        self.spark: SparkSession = ship(vectors.sparkSession)
        given = materialize(vectors.select("vec_id", "x", F.monotonically_increasing_id().alias("row")), "va-given")
        self.start = given
        self.rows = given.count()
        self.name = f"va_{uuid.uuid4().hex[:12]}"
        if not self.rows:
            return
        least, most = self._extent(given)
        if max(abs(int(least.min())), abs(int(most.max()))) > LIMIT:
            raise ValueError(f"a component lies beyond {LIMIT}: squared distances don't fit into 64 bits")
        taken = given.filter(hash_share(SAMPLE / self.rows, "row")).select("x").limit(2 * SAMPLE).toArrow().column("x")
        sample = matrix(taken) if len(taken) else np.stack([least, most])
        self.cells = Cells(sample, least, most)
        shared = self.spark.sparkContext.broadcast(self.cells)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), packed(matrix(b.column("x")), "<i4")], ["row", "vec_id", "x"])

        def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("row"), packed(shared.value.of(matrix(b.column("x"))), "u1")], ["row", "cells"])

        buckets = min(20_000, max(self.spark.sparkContext.defaultParallelism, -(-self.rows // BUCKET_ROWS)))
        (given.mapInArrow(pack, "row long, vec_id long, x binary").repartition(buckets, "row").write
              .bucketBy(buckets, "row").option("path", work_path(self.spark, "va-vectors")).saveAsTable(self.name))
        self.vectors = self.spark.table(self.name)
        self.approximations = materialize(given.select("row", "x").mapInArrow(approximate, "row long, cells binary"), "va-cells")

    def _extent(self, given: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest number of each dimension, over all vectors."""
        def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low = high = None
            for b in batches:
                if b.num_rows:
                    x = matrix(b.column("x"))
                    low = x.min(0) if low is None else np.minimum(low, x.min(0))
                    high = x.max(0) if high is None else np.maximum(high, x.max(0))
            if low is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(low)), pa.int32()), pa.array(low), pa.array(high)], ["d", "low", "high"])

        got = given.select("x").mapInArrow(extent, "d int, low long, high long").groupBy("d").agg(F.min("low"), F.max("high")).orderBy("d").collect()
        return np.array([r[1] for r in got], np.int64), np.array([r[2] for r in got], np.int64)

    def assign(self, state: DataFrame, centroids: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """One assignment of ``state`` (row, cells, cluster): the new state, and the fetched part of it with ``x`` and the old cluster.

        Rows are fetched whose centroid isn't certain from the cells, or that move.
        """
        shared = self.spark.sparkContext.broadcast((self.cells.tables(centroids), centroids))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables, _ = shared.value
            for b in batches:
                for at in range(0, b.num_rows, STEP):
                    part = b.slice(at, STEP)
                    cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    low, high = intervals(cells, tables)
                    open_ = low <= high.min(1, keepdims=True)
                    cluster = np.where(open_.sum(1) == 1, open_.argmax(1), -1)
                    mask = np.packbits(open_, axis=1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cluster, pa.int32()), pa.array([m.tobytes() for m in mask], pa.binary())],
                                                     [*part.schema.names, "certain", "open"])

        looked = materialize(state.select("row", "cells", F.col("cluster").alias("old")).mapInArrow(look, "row long, cells binary, old int, certain int, open binary"), "va-looked")
        wanted = (F.col("certain") < 0) | (F.col("certain") != F.col("old"))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, centroids = shared.value
            for b in batches:
                for at in range(0, b.num_rows, STEP):
                    part = b.slice(at, STEP)
                    x = matrix(part.column("x"))
                    open_ = np.unpackbits(np.frombuffer(b"".join(part.column("open").to_pylist()), np.uint8).reshape(part.num_rows, -1), axis=1)[:, : len(centroids)]
                    best, cluster = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int32)
                    for c, centroid in enumerate(centroids):  # ascending, and only less replaces: ties go to the smaller number
                        own = np.flatnonzero(open_[:, c])
                        d = ((x[own] - centroid) ** 2).sum(1)
                        better = d < best[own]
                        best[own[better]], cluster[own[better]] = d[better], c
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "cells", "old", "x")), pa.array(cluster)], ["row", "cells", "old", "x", "cluster"])

        requests = looked.filter(wanted).select("row", "cells", "old", "open")
        fetched = materialize(requests.join(self.vectors.select("row", "x"), "row").mapInArrow(measure, "row long, cells binary, old int, x binary, cluster int"), "va-fetched")
        kept = looked.filter(~wanted).select("row", "cells", F.col("certain").alias("cluster"))
        return kept.unionByName(fetched.select("row", "cells", "cluster")), fetched

    def moves(self, fetched: DataFrame, clusters: int) -> tuple[np.ndarray, np.ndarray]:
        """What the moved rows add to every cluster's sums [clusters, dimensions] and counts."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = counts = None
            for b in batches:
                x = matrix(b.column("x"))
                if sums is None:
                    sums, counts = np.zeros((clusters, x.shape[1] if b.num_rows else 0), np.int64), np.zeros(clusters, np.int64)
                for column, sign in (("cluster", 1), ("old", -1)):
                    c = b.column(column).to_numpy()
                    own = c >= 0
                    np.add.at(sums, c[own], sign * x[own])
                    np.add.at(counts, c[own], sign)
            if sums is not None:
                c, d = np.divmod(np.arange(sums.size), sums.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(sums.ravel()), pa.array(counts[c])], ["c", "d", "s", "n"])

        moved = fetched.filter("old <> cluster").select("old", "cluster", "x").mapInArrow(add, "c int, d int, s long, n long")
        got = moved.groupBy("c", "d").agg(F.sum("s"), F.sum("n")).collect()  # a row per centroid and dimension
        sums, counts = np.zeros((clusters, DIMENSIONS if not got else 1 + max(r["d"] for r in got)), np.int64), np.zeros(clusters, np.int64)
        for c, d, s, n in got:
            sums[c, d], counts[c] = s, n
        return sums, counts

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def clustering(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, report: list | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every row of ``vectors`` (vec_id, x).

    ``report`` gets the share of rows fetched in each assignment.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    va = VaFile(vectors)
    centroids = first_centroids(va.start, clusters) if va.rows else np.zeros((0, 0), np.int64)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    state = va.approximations.withColumn("cluster", F.lit(-1))
    sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
    for k in range(rounds + 1):
        state, fetched = va.assign(state, centroids)
        if report is not None:
            report.append(fetched.count() / va.rows)
        if k < rounds:
            more, members = va.moves(fetched, len(centroids))
            sums, counts = sums + (more if more.shape == sums.shape else 0), counts + members
            some = counts > 0
            centroids = centroids.copy()
            centroids[some] = np.floor_divide(sums[some], counts[some, None])
    final = spark.sparkContext.broadcast(centroids)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column("cluster").to_numpy()
            d = ((matrix(b.column("x")) - final.value[c]) ** 2).sum(1) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("cluster"), pa.array(d)], ["vec_id", "cluster", "distance"])

    out = materialize(state.select("row", "cluster").join(va.vectors, "row").select("vec_id", "cluster", "x").mapInArrow(measure, "vec_id long, cluster int, distance long"), "va-out")
    per = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    total = sum(per.values())
    facts = spark.createDataFrame([(c, per[c], total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(per)],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
