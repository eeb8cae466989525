"""Helpers that several of these operators share."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.plans.physical import ensure_checkpoint_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: later steps start from these files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_hash() -> Column:
    """64 bits that, beside the id, name a row by its text in tables that do not hold the texts."""
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def same_row(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null; the right side's copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def hand_back() -> None:
    """Give the system what the allocators of this worker hold and no longer use; workers stay between stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def per_process(key: Any, make: Callable[[], Any]) -> Any:
    """A value made once per Python worker process.

    Worker functions travel by value, so their module's globals are new in every task; the value
    hangs on a module of this process instead. Workers outlive a query: values of one kind (the key, or
    its first part) make way when another kind is asked for, so that stages do not add up in memory.
    """
    store = sys.modules.setdefault("_secflow_held", types.ModuleType("_secflow_held"))
    kind = key[0] if isinstance(key, tuple) else key
    if getattr(store, "kind", None) != kind:
        store.kind, store.values = kind, {}
        hand_back()
    if key not in store.values:
        store.values[key] = make()
    return store.values[key]


#: SQL of a one-row table of crc32's 256 steps, and of the crc32 of a list of bytes by that table.
CRC_STEPS_SQL = """
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b::BIGINT, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS steps"""


def crc32_sql(byte_list: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), "
        "lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295)")
