"""Token ids in binary files: one shared zstandard dictionary, one frame per document, an offset index.

A file is a run of blocks, ended by Spark's text writer with ``TRAILER``. A block:

    MAGIC (8 bytes) | dictionary SHA-256 (32) | documents n, bytes of frames (2 unsigned 64-bit)
    | present (n bytes, 0 for a null id) | doc_id (n signed 64-bit) | n_tokens (n unsigned 64-bit)
    | frame ends (n unsigned 64-bit) | frames

All numbers are little-endian; a frame holds one document's ids as unsigned 32-bit integers. The
index lets a reader take one short document out of a block without touching the other frames.
Blocks stand in ascending doc_id order within a file, and files in the order of their part number.
Beside the files stand the dictionary, ``dictionary/<its SHA-256>``, and the table ``index`` (doc_id -> file, place and size of the
frame, written when the files are read back): another session needs no more than the folder, and one
document is read by its byte range.

Defined cases: a null text is empty (its ids are the end id alone), a null doc_id sorts first,
rows with one doc_id are ordered by their ids, an empty table gives no block, and columns beside
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.common import materialize, sampled, ship, small, work_path
from cadence.llm.wordcache import encoder

MAGIC, TRAILER = b"TOKBLK01", "TOKEND01\n"
HEAD = struct.Struct("<8s32sQQ")
#: Documents (about so many, by a hash of their id) whose ids train the dictionary, the bytes taken of
#: each, and the dictionary's size.
DICT_DOCS, DICT_SAMPLE_BYTES, DICT_BYTES = 2_000, 16_384, 112_640
#: Compressed bytes of a block and of a file, about.
BLOCK_BYTES, FILE_BYTES = 4 << 20, 32 << 20

FRAMES = "doc_id long, n_tokens long, ids_crc32 long, frame binary"


INDEX = "file int, path string, doc_id long, local_start long, n_tokens long, ids_crc32 long, at long, size long"


def _encoded(batch: pa.RecordBatch, path: str, end: bytes) -> list[bytes]:
    encode = encoder(path).encode
    return [encode(t or "") + end for t in batch.column("text").to_pylist()]


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, n_docs: int = DICT_DOCS) -> bytes:
    """A dictionary from the id arrays of about ``n_docs`` documents; empty for an empty table."""
    rows = docs.count()
    if not rows:
        return b""
    end = struct.pack("<I", end_id)

    def samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            yield pa.RecordBatch.from_pydict({"ids": pa.array([x[:DICT_SAMPLE_BYTES] for x in _encoded(b, vocabulary, end)], pa.binary())})

    got = [bytes(r[0]) for r in sampled(docs, n_docs / rows, "text", "doc_id").select("text").mapInArrow(samples, "ids binary").collect()]
    got = sorted(got) or [end]
    try:
        return zstandard.train_dictionary(DICT_BYTES, got).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their bytes serve as they are
        return b"".join(got)[:DICT_BYTES]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> bytes:
    """Encode ``docs`` (doc_id, text) and write the files and the dictionary to ``path``; returns the dictionary."""
    spark = ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(docs, vocabulary, end_id)
    end = struct.pack("<I", end_id)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for b in small(batches):
            ids = _encoded(b, vocabulary, end)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary()),
            ], ["doc_id", "n_tokens", "ids_crc32", "frame"])

    done = materialize(docs.mapInArrow(frames, FRAMES), "token-frames")
    size = done.agg(F.sum(F.length("frame"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))
    name = hashlib.sha256(dictionary).digest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(b.column("doc_id").to_pylist(), b.column("n_tokens").to_pylist(), b.column("frame").to_pylist()):
                rows.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pydict({"block": pa.array([pack_block(rows, name)], pa.binary())})
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict({"block": pa.array([pack_block(rows, name)], pa.binary())})

    # the row's number parts rows that are equal in the others
    (done.repartitionByRange(files, "doc_id", "ids_crc32", F.monotonically_increasing_id()).sortWithinPartitions("doc_id", "ids_crc32", "n_tokens", "frame")
         .select("doc_id", "n_tokens", "frame").mapInArrow(blocks, "block binary")
         .select(F.col("block").cast("string").alias("value"))  # the bytes as they are
         .write.option("lineSep", TRAILER).text(path))
    _put(spark, f"{path}/dictionary/{name.hex()}", dictionary)
    return dictionary


def pack_block(rows: list[tuple], name: bytes) -> bytes:
    ids, counts, frames = zip(*rows)
    n, body = len(rows), b"".join(frames)
    return b"".join([
        HEAD.pack(MAGIC, name, n, len(body)), bytes(i is not None for i in ids),
        np.array([i or 0 for i in ids], "<i8").tobytes(), np.array(counts, "<u8").tobytes(),
        np.cumsum([len(f) for f in frames], dtype="<u8").tobytes(), body,
    ])


class Block:
    """One block: ``doc_id`` (None for null), ``n_tokens`` and single documents on request."""

    def __init__(self, data: memoryview, dictionary: bytes):
        magic, name, n, body = HEAD.unpack_from(data)
        if magic != MAGIC or name != hashlib.sha256(dictionary).digest():
            raise ValueError("not a token block, or written with another dictionary")
        at = HEAD.size + n
        here = np.frombuffer(data[HEAD.size : at], np.uint8)
        ids, self.n_tokens, self.ends = (np.frombuffer(data[at + 8 * n * k : at + 8 * n * (k + 1)], t) for k, t in enumerate(("<i8", "<u8", "<u8")))
        self.doc_id = [int(i) if ok else None for i, ok in zip(ids, here)]
        self.frames = data[at + 24 * n : at + 24 * n + body]
        self.size = at + 24 * n + body
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(self.bytes(k), "<u4")

    def bytes(self, k: int) -> bytes:
        start = int(self.ends[k - 1]) if k else 0
        return self.press.decompress(self.frames[start : int(self.ends[k])])


def blocks_of(content: bytes, dictionary: bytes) -> Iterator[Block]:
    data, at = memoryview(content), 0
    while at < len(data):
        block = Block(data[at:], dictionary)
        at += block.size
        if bytes(data[at : at + len(TRAILER)]) != TRAILER.encode():
            raise ValueError("a token block is cut short")
        at += len(TRAILER)
        yield block


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_range(spark: SparkSession, path: str, at: int, size: int) -> bytes:
    """``size`` bytes of a file from ``at`` on, by a seek."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        source.seek(at)
        return bytes(source.readNBytes(size))
    finally:
        source.close()


def load_dictionary(spark: SparkSession, path: str) -> bytes:
    """The dictionary beside the files in ``path``."""
    fs, p = _fs(spark, f"{path}/dictionary")
    found = [f for f in fs.listStatus(p) if not f.getPath().getName().startswith(".")]
    content = read_range(spark, found[0].getPath().toString(), 0, found[0].getLen())
    if hashlib.sha256(content).hexdigest() != found[0].getPath().getName():
        raise ValueError("the dictionary isn't the one it is named for")
    return content


def part_number(path: str) -> int:
    """The number of a file of Spark's text writer, however many digits it has."""
    return int(path.rsplit("/part-", 1)[1].split("-", 1)[0])


def read_tokens(spark: SparkSession, path: str, dictionary: bytes | None = None) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32. Writes the index beside them."""
    ship(spark)
    dictionary = load_dictionary(spark, path) if dictionary is None else dictionary

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content")):
                at, place = 0, 0
                for block in blocks_of(content.as_buffer(), dictionary):
                    starts = at + np.concatenate([[0], np.cumsum(block.n_tokens)]).astype(np.int64)
                    at, n = int(starts[-1]), len(block.doc_id)
                    ends = place + block.size - len(block.frames) + np.concatenate([[0], block.ends]).astype(np.int64)
                    place += block.size + len(TRAILER)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part_number(name)] * n, pa.int32()), pa.array([name] * n, pa.string()), pa.array(block.doc_id, pa.int64()), pa.array(starts[:-1]),
                        pa.array(block.n_tokens.astype(np.int64)), pa.array([zlib.crc32(block.bytes(k)) for k in range(n)], pa.int64()),
                        pa.array(ends[:-1]), pa.array(np.diff(ends)),
                    ], ["file", "path", "doc_id", "local_start", "n_tokens", "ids_crc32", "at", "size"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files.select("path", "content").mapInArrow(parsed, INDEX).write.mode("overwrite").parquet(f"{path}/index")
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    # one row per file: the only total order needed
    before = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return index.join(before, "file").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, dictionary: bytes | None, doc_id: int) -> list[np.ndarray]:
    """The ids of every row with this doc_id: the index says where its frames stand, and only these bytes are read."""
    dictionary = load_dictionary(spark, path) if dictionary is None else dictionary
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    rows = spark.read.schema(INDEX).parquet(f"{path}/index").filter(F.col("doc_id") == doc_id).orderBy("file", "at").collect()
    return [np.frombuffer(press.decompress(read_range(spark, r["path"], r["at"], r["size"])), "<u4") for r in rows]


def tokens(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and return what the files hold."""
    path = work_path(docs.sparkSession, "tokens")
    dictionary = write_tokens(docs, path, vocabulary, end_id)
    return read_tokens(docs.sparkSession, path, dictionary)
