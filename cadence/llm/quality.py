"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

* Words are runs of letters and digits, or runs of other marks, of one text, hashed to ``BUCKETS``
  numbers. Every number has a fixed sparse random index vector of +1 and -1.
* A word's vector is the sum of the index vectors of the words up to two places before and after it,
  over all documents, labelled or not. Tasks add up their own table, rounds of tasks add the tables, and the driver gets
  one: BUCKETS x DIMENSIONS numbers, whatever the corpus holds. Vectors are scaled to length 1.
* A document pools its words' vectors, each weighted less the more frequent the word is: their mean,
  and the mean product of neighbours, number by number, which tells repeated words from varied ones.
* A two-layer numpy network is fitted on about ``TRAIN_DOCS`` labelled rows (never more than twice as many),
  by a hash of their id and text, rows that repeat both once. Some of them are kept aside to choose the temperature that divides the network's
  output before the logistic function, so that scores are calibrated probabilities.

Defined cases: a null or empty text has the zero vector and the network's score for it; if nothing is
labelled, every score is 0.5; a null label or doc_id isn't learned from; a null doc_id isn't held out;
repeated rows are scored each; an empty table gives no row; other columns are ignored. A long text is
handled in pieces that end between words, so only a single word has to fit into memory several times.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import hash_share, ship, small, text_bytes

BUCKETS, DIMENSIONS, NONZERO, WINDOW, SEED = 1 << 14, 64, 2, 2, 7
POOLED = 2 * DIMENSIONS
TRAIN_DOCS, HIDDEN, EPOCHS = 20_000, 32, 60
#: Bytes of text handled at a time.
CHUNK = 1 << 18

_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 letters, digits and bytes of longer characters, 2 marks
_KIND[:33] = 0
_KIND[128:] = 1
for _c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _KIND[ord(_c)] = 1
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def remainder(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each word of a chunk of texts, in order."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    begin = np.ones(len(data), bool)
    begin[1:] = kind[1:] != kind[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    length = np.diff(np.append(starts, len(data)))
    place = np.minimum(np.arange(len(data)) - np.repeat(starts, length), 63)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS[place], starts)
    h ^= h >> np.uint64(29)
    bucket = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(50)).astype(np.int64)
    real = kind[starts] > 0
    return bucket[real], (np.searchsorted(offsets, starts[real], "right") - 1)


def chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of the words, about CHUNK bytes at a time; a cut stands at an end of a word."""
    at = 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        if to < len(data):
            back = _KIND[data[at : to + 1]]
            cut = np.flatnonzero(back[1:] != back[:-1])
            ends = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, to, "right")]
            last = max(at + 1 + int(cut[-1]) if len(cut) else at, int(ends[-1]) if len(ends) else at)
            if last > at:
                to = last
            else:  # one word of CHUNK bytes: on to its end
                end = int(offsets[np.searchsorted(offsets, at, "right")])
                for step in range(to, end, CHUNK):
                    here = np.flatnonzero(_KIND[data[step : step + CHUNK]] != _KIND[data[at]])
                    if len(here):
                        end = step + int(here[0])
                        break
                to = end
        first, last = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, to, "left")
        bucket, text = words(data[at:to], np.clip(offsets[first : last + 1], at, to) - at)
        yield bucket, text + first
        at = to


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector."""
    rng = np.random.default_rng(SEED)
    places = np.stack([rng.permutation(DIMENSIONS)[:NONZERO] for _ in range(BUCKETS)])
    return places, rng.choice([-1, 1], (BUCKETS, NONZERO))


def add_contexts(table: np.ndarray, counts: np.ndarray, bucket: np.ndarray, text: np.ndarray, index: tuple[np.ndarray, np.ndarray],
                 before: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))) -> None:
    """Add the words' contexts; ``before`` are the WINDOW words before them, which a cut may have parted from them."""
    places, signs = index
    counts += np.bincount(bucket, minlength=BUCKETS)
    old, bucket, text = len(before[0]), np.concatenate([before[0], bucket]), np.concatenate([before[1], text])
    for step in range(1, WINDOW + 1):
        near = np.flatnonzero(text[step:] == text[:-step])
        near = near[near + step >= old]  # pairs of two earlier words are counted
        for word, other in ((bucket[near], bucket[near + step]), (bucket[near + step], bucket[near])):
            for k in range(NONZERO):
                np.add.at(table, word * DIMENSIONS + places[other, k], signs[other, k])


def tree_sum(parts: RDD, add: Callable, depth: int = 3) -> RDD:
    """The sum of all rows as the only one, added up in about ``depth`` rounds of tasks; none of them reaches the driver."""
    groups = parts.getNumPartitions()
    scale = max(2, math.ceil(groups ** (1 / depth)))
    while groups > 1:
        groups = -(-groups // scale)
        parts = parts.mapPartitionsWithIndex(lambda i, rows, n=groups: ((i % n, r) for r in rows)).reduceByKey(add, groups).values()
    return parts


def word_vectors(docs: DataFrame) -> np.ndarray:
    """[BUCKETS, DIMENSIONS]: unit vectors, times the weight that pooling gives the word."""
    ship(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        table, counts = np.zeros(BUCKETS * DIMENSIONS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            before = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            for bucket, text in chunks(*text_bytes(b.column("text"))):
                add_contexts(table, counts, bucket, text, index, before)
                before = (np.concatenate([before[0], bucket])[-WINDOW:], np.concatenate([before[1], text])[-WINDOW:])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([table.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return a[0] + b[0], a[1] + b[1]

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "sums binary, counts binary").rdd.map(
        lambda r: (np.frombuffer(r["sums"], np.int64), np.frombuffer(r["counts"], np.int64)))  # whole numbers: the order of tasks changes nothing
    got = tree_sum(parts, add).map(lambda p: scaled(*p).tobytes()).collect()
    if not got:
        return scaled(np.zeros(BUCKETS * DIMENSIONS, np.int64), np.zeros(BUCKETS, np.int64))
    return np.frombuffer(got[0], np.float32).reshape(BUCKETS, DIMENSIONS)


def scaled(table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    table = table.reshape(BUCKETS, DIMENSIONS).astype(float)
    share = counts / max(1, counts.sum())
    weight = 0.01 / (0.01 + share)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9) * weight[:, None]).astype(np.float32)


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[texts, POOLED]: mean of each text's word vectors, and mean product of each two that stand together."""
    out = np.zeros((len(offsets) - 1, POOLED))
    n = np.zeros(len(offsets) - 1)
    before, parted = np.zeros((0, DIMENSIONS), np.float32), -1  # the last word before a cut, and its text
    for bucket, text in chunks(data, offsets):
        if len(bucket):
            first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            n[text[first]] += np.diff(np.append(first, len(text)))
            of = vectors[bucket]
            last = of[-1:].copy()
            out[text[first], :DIMENSIONS] += np.add.reduceat(of, first, axis=0)
            if parted == text[0]:
                out[parted, DIMENSIONS:] += (before * of[:1])[0]
            of[:-1] *= of[1:]
            of[np.append(first[1:] - 1, len(text) - 1)] = 0  # the last word of a text has no neighbour after it
            out[text[first], DIMENSIONS:] += np.add.reduceat(of, first, axis=0)
            before, parted = last, text[-1]
    return out / np.maximum(n, 1)[:, None]


class Network:
    """Input -> tanh layer -> one output, divided by the temperature.

    The driver holds the sample as it came (float32) and scales only the rows at hand.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        aside = rng.random(len(x)) < 0.2
        self.mean, self.spread = x.mean(0, dtype=float), x.std(0, dtype=float) + 1e-6
        self.w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        self._fit(x[~aside] if (~aside).any() else x, y[~aside] if (~aside).any() else y, rng)
        if aside.any():
            self._calibrate(x[aside], y[aside])

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                a, b = (x[order[at : at + 256]] - self.mean) / self.spread, y[order[at : at + 256]]
                hidden = np.tanh(a @ self.w[0] + self.w[1])
                wrong = (1 / (1 + np.exp(-(hidden @ self.w[2] + self.w[3]))) - b) / len(b)
                back = np.outer(wrong, self.w[2]) * (1 - hidden**2)
                grads = [a.T @ back + 1e-4 * self.w[0], back.sum(0), hidden.T @ wrong + 1e-4 * self.w[2], wrong.sum(keepdims=True)]
                t += 1
                for k, g in enumerate(grads):  # Adam
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 0.005 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z = self.output(x)
        loss = lambda t: np.logaddexp(0, np.where(y > 0, -z, z) / t).mean()
        self.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))

    def output(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.output(x) / self.temperature, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, train_docs: int = TRAIN_DOCS) -> Network | None:
    """A network from ``docs`` (doc_id, text) with ``labels`` (doc_id, label 0 or 1)."""
    spark = ship(docs.sparkSession)
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).select("doc_id", "label").distinct()
    n = labels.count()
    chosen = labels.filter(hash_share(train_docs / max(1, n), "doc_id")).select("doc_id", F.col("label").cast("int").alias("label"))
    shared = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            x = pooled(shared.value, *text_bytes(b.column("text"))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "label", "x"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # about train_docs rows of two numbers
    many = rows.count()  # many more than the labels where a doc_id is repeated
    rows = rows.filter(hash_share(train_docs / max(1, many), "doc_id", "text")).dropDuplicates(["doc_id", "label", "text"])
    pooled_rows = rows.select("doc_id", "label", "text").mapInArrow(pool, "doc_id long, label int, x binary")
    got = pooled_rows.orderBy(F.xxhash64("doc_id", "x"), "doc_id", "label", "x").limit(2 * train_docs).toArrow()
    if not got.num_rows:
        return None
    x = text_bytes(got.column("x"))[0].view(np.float32).reshape(-1, POOLED)
    y, ids = got.column("label").to_numpy().astype(float), got.column("doc_id").to_numpy()
    del got
    order = np.lexsort((*x.T[:3], y, ids))  # the same order whatever the partitions were
    return Network(x[order], y[order])


def score(docs: DataFrame, vectors: np.ndarray, network: Network | None) -> DataFrame:
    """``docs`` with all its columns, and ``_stage_quality`` (0 to 1)."""
    shared = ship(docs.sparkSession).sparkContext.broadcast((vectors, network))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for b in small(batches):
            if network is None:
                s = np.full(b.num_rows, 0.5)
            else:
                s = network.score(pooled(vectors, *text_bytes(b.column("text").cast(pa.string()))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, "_stage_quality"])

    schema = docs.select("*", F.lit(0.0).alias("_stage_quality")).schema
    return docs.mapInArrow(scores, schema)


def classify(docs: DataFrame, labels: DataFrame, out: int = 1, of: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted: labels come only from rows whose crc32 remainder isn't ``out``."""
    vectors = word_vectors(docs)
    network = train(docs, labels.filter(remainder(of) != out).select("doc_id", F.col("quality").alias("label")), vectors)
    scored = score(docs.select("doc_id", "text"), vectors, network)
    return scored.select("doc_id", F.coalesce(remainder(of) == out, F.lit(False)).alias("held_out"), F.col("_stage_quality").alias("score"),
                         (F.col("_stage_quality") >= 0.5).cast("int").alias("predicted"))
