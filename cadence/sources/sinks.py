"""Result-table sinks and table contracts.

Both sinks replace a micro-batch as a whole when it is written again, so a
retry never duplicates rows, whatever the clock says by then and even when
the retry has no rows for a table. :class:`TableSink` overwrites the batch's
own folder; :class:`JdbcSink` deletes the batch's rows before it inserts.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import CONTRACTS, MAX_TEXT, TEXT_LENGTHS, UNBOUNDED_TABLES


def contract(name: str):
    """The StructType of a result table."""
    return CONTRACTS[name]["schema"]


def conform(df: DataFrame, name: str, extra: list[str] | None = None) -> DataFrame:
    """Select the contract's columns in order, cast to its types (decimals at the sink),
    fill its defaults. Columns the frame lacks become null (or their default)."""
    spec = CONTRACTS[name]
    cols = []
    for f in spec["schema"].fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in spec["defaults"]:
            c = F.coalesce(c, F.lit(spec["defaults"][f.name]))
        cols.append(c.cast(f.dataType).alias(f.name))
    cols += [F.col(c) for c in (extra or [])]
    return df.select(*cols)


NULL_REASON, LONG_REASON = "null in a required column", "text too long"


def violation(name: str, columns: list[str]) -> Column:
    """The rule of the contract that a row with these columns breaks (the first of them), or null."""
    missing, long = F.lit(False), F.lit(False)
    for c in CONTRACTS[name]["not_null"]:
        missing = missing | F.col(c).isNull()
    if name not in UNBOUNDED_TABLES:
        for f in contract(name).fields:
            if f.name in columns and isinstance(f.dataType, T.StringType):
                long = long | F.coalesce(F.length(f.name) > TEXT_LENGTHS.get((name, f.name), MAX_TEXT), F.lit(False))
    return F.when(missing, F.lit(NULL_REASON)).when(long, F.lit(LONG_REASON))


def split_violations(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract's NOT NULL and length rules, rows that break one)."""
    reason = violation(name, df.columns)
    return df.where(reason.isNull()), df.where(reason.isNotNull())


# Time column of each result table; its date becomes the ``dt`` partition.
TIME_COLUMNS = {
    "realtime_streaming_events": "timestamp",
    "realtime_leaderboard": "window_start_time",
    "realtime_mood_metrics": "window_start_time",
    "engagement_metrics": "window_start_time",
    "mood_matrix_samples": "timestamp",
    "system_metrics": "timestamp",
}


# Columns that name the reports of one run of one query, outermost folder first.
REPORT_KEYS = ["query_id", "run_id", "batch_id"]


class TableSink:
    """Parquet result tables under ``root``/<table>/batch_id=<n>/dt=<date>.

    ``batch_id`` makes each micro-batch's write replaceable as a whole; ``dt``
    lets lookback panels skip whole folders (partition pruning).
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def write(self, df: DataFrame, name: str, batch_id: int | None = None) -> None:
        """Write one batch's rows; writing the same ``batch_id`` again replaces all of them.

        Without ``batch_id`` a frame with ``query_id``, ``run_id`` and ``batch_id`` columns
        replaces just those reports; any other frame replaces the table.
        """
        out, parts = df, [c for c in REPORT_KEYS if c in df.columns] if batch_id is None else []
        tcol = TIME_COLUMNS.get(name)
        if tcol and tcol in out.columns:
            out = out.withColumn("dt", F.to_date(F.col(tcol)))
            if not parts:
                out = out.hint("rebalance", F.col("dt"))
        path = self.path(name) if batch_id is None else os.path.join(self.path(name), f"batch_id={int(batch_id)}")
        folders = [*parts, *(["dt"] if "dt" in out.columns else [])]
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if parts else "static")
        if folders:
            w = w.partitionBy(*folders)
        w.parquet(path)

    def create(self, spark: SparkSession, name: str) -> bool:
        """S12 ``CREATE TABLE IF NOT EXISTS``: write an empty table of the contract; False if it exists."""
        try:
            spark.read.parquet(self.path(name)).schema  # noqa: B018 (lists the files only)
            return False
        except AnalysisException:
            self.recreate(spark, name)
            return True

    def recreate(self, spark: SparkSession, name: str) -> None:
        """S12 ``DROP TABLE`` + ``CREATE TABLE``: replace the table by an empty one of its contract."""
        schema = T.StructType(list(contract(name).fields))
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(self.path(name))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table, or an empty frame of its contract when it does not exist yet.

        Contract tables are read with their declared schema (+ ``batch_id``),
        so an all-empty table needs no schema inference. Errors other than a
        missing table are raised, not hidden.
        """
        schema = None
        if name in CONTRACTS:
            schema = T.StructType(list(contract(name).fields))
            if name in TIME_COLUMNS:
                schema = schema.add("dt", T.DateType())
            for c in REPORT_KEYS[:2] if name == "system_metrics" else []:
                schema = schema.add(c, T.StringType())
            schema = schema.add("batch_id", T.LongType())
        try:
            r = spark.read.schema(schema) if schema is not None else spark.read
            return r.parquet(self.path(name))
        except AnalysisException as e:
            if schema is not None and ("PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e)):
                return spark.createDataFrame([], schema)
            raise


class JdbcSink:
    """Relational sink (PostgreSQL in the reference; any JDBC driver on the classpath)."""

    def __init__(self, url: str, properties: dict[str, str] | None = None, batchsize: int = 500):
        self.url = url
        self.properties = dict(properties or {})
        self.properties.setdefault("batchsize", str(batchsize))

    def _connection(self, spark: SparkSession):
        jvm = spark._jvm
        if "driver" in self.properties:  # registers the driver with the DriverManager Spark itself uses
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        p = jvm.java.util.Properties()
        for k, v in self.properties.items():
            p.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, p)

    def exists(self, spark: SparkSession, name: str) -> bool:
        c = self._connection(spark)
        try:
            found = c.getMetaData().getTables(None, None, None, None)
            while found.next():
                if found.getString("TABLE_NAME").lower() == name.lower():
                    return True
            return False
        finally:
            c.close()

    def delete_batch(self, spark: SparkSession, name: str, batch_id: int) -> None:
        c = self._connection(spark)
        try:
            s = c.prepareStatement(f'DELETE FROM {name} WHERE "batch_id" = ?')
            s.setLong(1, int(batch_id))
            s.executeUpdate()
        finally:
            c.close()

    def write(self, df: DataFrame, name: str, batch_id: int | None = None) -> None:
        """Insert one batch's rows after deleting what an earlier try of the batch left."""
        out = df if batch_id is None else df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        if batch_id is not None and self.exists(df.sparkSession, name):
            self.delete_batch(df.sparkSession, name, batch_id)
        out.write.mode("append").jdbc(self.url, name, properties=self.properties)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table with its contract's types, or an empty frame of the contract when there is none."""
        if name not in CONTRACTS:
            return spark.read.jdbc(self.url, name, properties=self.properties)
        if not self.exists(spark, name):
            return spark.createDataFrame([], T.StructType(list(contract(name).fields)).add("batch_id", T.LongType()))
        table = spark.read.option("preferTimestampNTZ", "true").jdbc(self.url, name, properties=self.properties)
        kept = ["batch_id"] if "batch_id" in [c.lower() for c in table.columns] else []
        return conform(table, name, extra=kept)
