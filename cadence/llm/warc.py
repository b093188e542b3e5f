"""WARC archives of pages, and one capture index merged from the archives' own sorted indexes.

Writing: each task sorts its pages by (URL key, date, page id) and writes them as WARC 1.1 records —
one archive file is one locally sorted capture run. Records go through Spark's text writer, whose
line separator is the two line ends that close a record, so a file is a gzip-compressed WARC file on
any store Spark writes to (offsets in the index count uncompressed bytes). Of records with equal payloads of ``REVISIT_BYTES`` or more, the one with the
smallest page id is a response and the others are revisits that refer to it and carry no payload.

Reading: archives are parsed by their Content-Length; a response's payload is checked against its
digest. Every archive yields its run of the index. The runs are dealt by ranges of (URL key, date,
page id), so that a key range holds one sorted slice of each run, and each range is merged by a
k-way loser tree. Ranges are in order, hence so are the capture histories over all partitions; a URL
with very many captures is spread over several ranges by date and page id.

Defined cases: null html is empty, null url is empty, equal smallest page ids are all responses, a
null page_id is never referred to, an empty table gives an empty index, other columns are ignored.
A page's date is taken from ``date`` if given, else its page id (up to 10^9) in seconds after ``EPOCH``.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions import format_ts, instant_wallclock
from cadence.llm.common import materialize, ship, work_path

REVISIT_BYTES, EPOCH = 100, 1_700_000_000
END, RECORD_END = "\r\n", "\r\n\r\n"
#: Index rows that one task merges, about.
MERGE_ROWS = 100_000

INDEX = ("run string, offset long, length long, url string, date string, page_id long, record_type string, "
         "payload_bytes long, payload_digest string, refers_to long")


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, in lower case, without the fragment."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.lower(F.when(host != "", key).otherwise(url))


# --- writing --------------------------------------------------------------------------------------

def records(pages: DataFrame) -> DataFrame:
    """key, date, page_id, record (without its closing line ends) of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    date = F.col("date").cast("timestamp") if "date" in pages.columns else F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9)))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A").alias("url"),
        F.concat(F.replace(format_ts(instant_wallclock(date)), F.lit(" "), F.lit("T")), F.lit("Z")).alias("date"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    copies = rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    told = rows.join(copies.select("digest", "first"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Date: "), F.col("date"), F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(RECORD_END))
    return told.select(url_key(F.col("url")).alias("key"), "date", "page_id", F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str) -> None:
    (records(pages).sortWithinPartitions("key", "date", "page_id").select("record")
        .write.option("lineSep", RECORD_END).option("compression", "gzip").text(path))


# --- reading --------------------------------------------------------------------------------------

def unpacked(content) -> memoryview:
    """An archive's bytes, out of gzip where it is compressed."""
    content = memoryview(content)
    return memoryview(gzip.decompress(content)) if bytes(content[:2]) == b"\x1f\x8b" else content


def parse_archive(content: memoryview) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(offset, length, header fields in lower case, block) of each record."""
    at = 0
    while at < len(content):
        stop, step = -1, 4096
        while stop < 0:  # headers are short: the block behind them is never copied
            stop = bytes(content[at : at + step]).find(RECORD_END.encode())
            if stop < 0 and at + step >= len(content):
                raise ValueError("a WARC record's header has no end")
            step *= 4
        lines = bytes(content[at : at + stop]).decode("utf-8", "replace").split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        begin = at + stop + 4
        size = int(fields["content-length"])
        if bytes(content[begin + size : begin + size + 4]) != RECORD_END.encode():
            raise ValueError("a WARC record is cut short")
        yield at, begin + size + 4 - at, fields, content[begin : begin + size]
        at = begin + size + 4


def _page(name: str | None) -> int | None:
    part = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(part) if part not in ("", "null") else None


def index_rows(run: str, content: memoryview) -> Iterator[tuple]:
    for offset, length, fields, block in parse_archive(content):
        head = bytes(block[:4096]).split(RECORD_END.encode(), 1)[0]
        size = next(int(x[15:]) for x in head.decode().split(END) if x.lower().startswith("content-length:"))
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response":
            payload = block[len(head) + 4 :]
            if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"the payload of {fields['warc-record-id']} isn't what its digest says")
        yield (run, offset, length, fields["warc-target-uri"], fields["warc-date"], _page(fields["warc-record-id"]), fields["warc-type"], size, digest, _page(fields.get("warc-refers-to")))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The archives' own indexes: one row per record, in each run's order."""
    ship(spark)
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in INDEX.split(", ")]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content")):
                rows = list(index_rows(name.rsplit("/", 1)[1], unpacked(content.as_buffer())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parsed, INDEX)


# --- merging --------------------------------------------------------------------------------------

class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root's winner comes next."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.head = [next(r, None) for r in runs]
        self.losers = [-1] * max(1, len(runs))  # node 0 holds the winner
        for k in range(len(runs)):
            self._play(k)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, k: int) -> None:
        """Carry run k's head up: at each node the loser stays, the winner goes on."""
        node, winner = (k + len(self.runs)) // 2, k
        while node:
            if self.losers[node] < 0:  # while the tree is filled: wait here for the other side
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.head[self.losers[0]] is not None:
            k = self.losers[0]
            yield self.head[k]
            self.head[k] = next(self.runs[k], None)
            self._play(k)


def merge_runs(index: DataFrame, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """The index in global order of (key, date, page_id), with ``key`` first."""
    ship(index.sparkSession)
    index = materialize(index.withColumn("key", url_key(F.col("url"))), "warc-index")
    ranges = max(1, -(-index.count() // merge_rows))
    order = ("key", "date", "page_id")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        key, date, page, run = (rows.column(c).to_pylist() for c in (*order, "run"))
        runs, at = [], 0
        for end in range(1, len(run) + 1):
            if end == len(run) or run[end] != run[at]:
                runs.append(((key[i], date[i], -1 if page[i] is None else page[i], i) for i in range(at, end)))
                at = end
        yield from rows.take(pa.array([x[3] for x in LoserTree(runs)], pa.int64())).to_batches()

    dealt = index.repartitionByRange(ranges, *order).sortWithinPartitions("run", *order)
    return dealt.mapInArrow(merged, index.schema)


def capture_histories(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, merge their indexes."""
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    write_archives(pages, path)
    return merge_runs(read_index(spark, path))
