"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors are whole numbers, floor(scale * x). Pivots come from a bounded sample; every vector belongs
to its nearest pivot's cell, whose summary is its size and radius. For a query q and a cell (pivot p,
radius r) no member scores over q.p + |q| r.

Each query is first solved in its own cell, which gives a least score that its answer must reach. It
is then dealt only to the cells whose bound reaches that score. Cells are cut into chunks by a hash of
the id, queries of a cell into blocks, so neither a hot cell nor a hot query group makes one large
task. A chunk and a block are multiplied locally, in exact integers, and only scores that reach the
query's bound leave the task. The last step keeps the k best of each query.

Defined cases: a vector that is null or holds a null or non-finite component takes no part; shorter
vectors count as padded with zeros; ties go to the smaller id; a null id takes no part; rows that
repeat an id are candidates each, but not for a query with the same id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import hash_share, materialize, ship

SCALE, K = 1024, 10
#: Vectors from which pivots are chosen, about; most pivots; vectors of a pivot, about.
SAMPLE, MOST_PIVOTS, PER_PIVOT = 4096, 256, 1024
#: Least and most rows of a chunk; queries of a block.
LEAST_CHUNK, MOST_CHUNK, QUERY_BLOCK = 256, 65_536, 4096
#: Bounds are floating-point; they are widened by this share, so that none is too low.
SLACK = 1e-9

CELLS = "vec_id long, cell int, dist double, x binary"
SCORES = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long) of the vectors that take part."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
                .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(v.cast("double") * scale)).alias("x")))


def choose_pivots(sample: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """Means of a few rounds of nearest-pivot assignment, from evenly spaced sample rows."""
    sample = np.unique(sample, axis=0).astype(float)
    pivots = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)]
    for _ in range(rounds):
        near = _distances(sample, pivots).argmin(1)
        pivots = np.stack([sample[near == k].mean(0) if (near == k).any() else pivots[k] for k in range(len(pivots))])
    return pivots


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T, 0))


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where they are exact, else in 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, x) where ``is_query``."""
    spark = ship(vectors.sparkSession)
    vectors = materialize(vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))), "knn-vectors")
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    sample = [r[0] + [0] * (width - len(r[0])) for r in vectors.filter(hash_share(SAMPLE / n, "vec_id")).select("x").limit(2 * SAMPLE).collect()]
    pivots = choose_pivots(np.array(sample or [[0] * width], np.int64), max(1, min(MOST_PIVOTS, n // PER_PIVOT)))
    chunk = max(LEAST_CHUNK, min(MOST_CHUNK, n // (16 * len(pivots))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.zeros((b.num_rows, width), np.int64)
            for row, v in zip(x, b.column("x").to_pylist()):
                row[: len(v)] = v
            d = _distances(x.astype(float), pivots)
            cell = d.argmin(1)
            exact = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cell, pa.int32()), pa.array(exact), pa.array([v.tobytes() for v in x], pa.binary()), b.column("is_query")],
                                             ["vec_id", "cell", "dist", "x", "is_query"])

    cells = materialize(vectors.mapInArrow(assign, CELLS + ", is_query boolean"), "knn-cells")
    radius, size = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for c, r, m in cells.groupBy("cell").agg(F.max("dist"), F.count(F.lit(1))).collect():  # a row per pivot
        radius[c], size[c] = r, m
    chunks = np.maximum(1, -(-size // chunk))

    def solve(targets: DataFrame) -> DataFrame:
        """Scores of the queries (query_id, x, cell, least) against the cells they are dealt to."""
        asked = {r[0]: r[1] for r in targets.groupBy("cell").agg(F.count(F.lit(1))).collect()}
        blocks = F.array(*[F.lit(max(1, -(-asked.get(c, 0) // QUERY_BLOCK))) for c in range(len(pivots))])
        parts = F.array(*[F.lit(int(m)) for m in chunks])
        of = lambda a: F.element_at(a, F.col("cell") + 1)
        data = (cells.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), of(parts)).cast("int"))
                     .withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks) - 1)))
                     .select("cell", "chunk", "block", "vec_id", "x"))
        asks = (targets.withColumn("block", F.pmod(F.xxhash64("query_id"), of(blocks)).cast("int"))
                       .withColumn("chunk", F.explode(F.sequence(F.lit(0), of(parts) - 1)))
                       .select("cell", "chunk", "block", "query_id", "x", "least"))
        by = ["cell", "chunk", "block"]

        def local(queries: pa.Table, near: pa.Table) -> pa.Table:
            out: list[list[np.ndarray]] = [[], [], []]
            if queries.num_rows and near.num_rows:
                x, ids = _matrix(near.column("x"), width), near.column("vec_id").to_numpy()
                for at in range(0, queries.num_rows, 256):
                    some = queries.slice(at, 256)
                    names, least = some.column("query_id").to_numpy(), some.column("least").to_numpy()
                    scores = exact_scores(_matrix(some.column("x"), width), x)
                    for name, low, row in zip(names, least, scores):
                        ok = np.flatnonzero((row >= low) & (ids != name))
                        best = ok[np.lexsort((ids[ok], -row[ok]))[:k]]
                        for o, v in zip(out, (np.full(len(best), name), ids[best], row[best])):
                            o.append(v)
            return pa.table({c: pa.array(np.concatenate(o) if o else [], pa.int64()) for c, o in zip(("query_id", "vec_id", "score"), out)})

        return asks.groupBy(by).cogroup(data.groupBy(by)).applyInArrow(local, SCORES)

    queries = cells.filter("is_query").select(F.col("vec_id").alias("query_id"), "x", "cell").dropDuplicates(["query_id", "x"])
    lowest = -(2**63)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    own = materialize(solve(queries.withColumn("least", F.lit(lowest))), "knn-own")
    reached = own.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    known = queries.join(reached, "query_id", "left").select("query_id", "x", "cell", F.coalesce("least", F.lit(lowest)).alias("least"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column("x"), width).astype(float)
            reach = np.sqrt((q**2).sum(1))[:, None] * radius
            bound = q @ pivots.T + reach
            bound += SLACK * (np.abs(q) @ np.abs(pivots).T + reach) + 1e-6
            may = (bound >= b.column("least").to_numpy()[:, None]) & (size > 0)
            may[np.arange(len(q)), b.column("cell").to_numpy()] = False
            row, cell = np.nonzero(may)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("query_id").take(row), b.column("x").take(row), pa.array(cell, pa.int32()), b.column("least").take(row)], ["query_id", "x", "cell", "least"])

    others = materialize(known.mapInArrow(deal, "query_id long, x binary, cell int, least long"), "knn-dealt")
    scored = own.unionByName(solve(others))
    return (scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
                  .select("query_id", "rank", "vec_id", "score"))
