"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Required fields of stored flows. The protocol may be missing.
NETFLOW_REQUIRED = ["srcip", "dstip", "start_time", "end_time", "packets", "bytes"]
APP_FLOW_REQUIRED = ["srcip", "dstip", "appproto", "method"]


def netflow_table(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored flows recorded in [start, end), without incomplete rows."""
    return complete_netflow(in_time_range(spark.read.parquet(path), start, end))


def in_time_range(flows: DataFrame, start: str | None, end: str | None, ts: str = "record_time") -> DataFrame:
    """Rows of a time range; a plain comparison, so it prunes partitions and row groups."""
    if start is not None:
        flows = flows.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        flows = flows.where(F.col(ts) < F.lit(end).cast("timestamp"))
    return flows


def complete_netflow(flows: DataFrame) -> DataFrame:
    return flows.dropna(subset=NETFLOW_REQUIRED)


def app_flow_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).dropna(subset=APP_FLOW_REQUIRED)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def query_logs(logs: DataFrame, sql: str, view: str = "original_log") -> DataFrame:
    """SQL over stored logs, which the statement names as {original_log}."""
    return logs.sparkSession.sql(sql, **{view: logs})


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int | None = None,
    identity: str | None = None,
) -> DataFrame:
    """Stream of files; ``files_per_batch`` is the rate limit.

    ``identity`` adds a column that names each row by its file and its place there, so that equal
    messages stay apart in any batch and replay. Only Parquet files know their rows' places.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(path)
    if identity is None:
        return rows
    return rows.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias(identity))


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None, starting: str = "latest"
) -> DataFrame:
    """Topic as (value, source_id); the id names the message for deterministic record ids.

    Needs the Kafka connector on the class path. ``offsets_per_batch`` is the rate limit.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting))
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.concat_ws("-", "topic", "partition", "offset").alias("source_id"))
