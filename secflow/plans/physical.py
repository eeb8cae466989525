"""Size checks before anything is broadcast or compiled into a plan, and lineage cuts."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# A dimension up to this size is broadcast; beyond it Spark picks the join.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def collect_bounded(df: DataFrame, max_rows: int) -> list[Row] | None:
    """Rows of a small table, or None when it holds more than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def collect_to_compile(df: DataFrame, max_rows: int) -> list[Row]:
    """Rows of a rule table that the caller wants in the plan as literals; too many are an error."""
    rows = collect_bounded(df, max_rows)
    if rows is None:
        raise ValueError(f"more than {max_rows} rules to compile into the plan")
    return rows


def broadcast_if_bounded(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """A side to broadcast when its measured size allows it; otherwise the plain frame.

    The rows are fetched once, up to the limit, and the join then reads them as a local table: a
    broadcast would pass them through the driver too, and the frame is not computed a second time.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a local one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master.partition("[")[0] != "local":  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join("/tmp", f"secflow-checkpoints-{os.getpid()}")
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so that lost executors cannot reorder the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def evaluated_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column behind a one-element explode.

    Filters on the column then stay above it; on a plain projection they would be pushed below and
    evaluate the expression a second time.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
