"""Token-id files: documents in id order, encoded, range-coded and written as Parquet rows.

A row is a segment: whole documents in order, with their ids and lengths and the coded blocks of
``coder``. Segments are bounded by ids, so memory is too, except that a document is never divided;
the last of a partition is not left small, as few blocks at once are coded slowly.
Range partitions follow one another in id order; the places of their documents in the whole stream
are added when reading, from one total per partition. Parquet commits whole files, so a lost
executor's attempt leaves nothing behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.llm.coder import BLOCK, decode_blocks, encode_blocks
from secflow.llm.common import hand_back
from secflow.llm.tokens import vocabulary

END_ID = 2
SEGMENT_IDS = 1 << 22

_SEGMENT = (
    "part int, seg int, seg_start long, n_ids long, doc_ids array<long>, n_tokens array<long>, blocks array<binary>")


def _segment(part: int, seg: int, start: int, doc_ids: list, streams: list[bytes]) -> pa.RecordBatch:
    ids, lengths = np.frombuffer(b"".join(streams), "<u4"), [len(s) // 4 for s in streams]
    streams.clear()  # coding needs the room
    columns = [
        pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([start], pa.int64()),
        pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int64())),
        pa.array([encode_blocks(ids, BLOCK)], pa.list_(pa.binary()))]
    return pa.RecordBatch.from_arrays(
        columns, names=["part", "seg", "seg_start", "n_ids", "doc_ids", "n_tokens", "blocks"])


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, partitions: int | None = None,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode the texts with the vocabulary at ``path``, append ``end_id`` to each, and write the files.

    Rows go by ascending doc_id, nulls first; rows that share an id stand in the order of a hash of
    their text. A null text is encoded as the empty one.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, ids=True)
        part = TaskContext.get().partitionId()
        doc_ids: list = []
        streams: list[bytes] = []
        held, seg, start, cut, cut_ids = 0, 0, 0, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                coded = known.encode_all(some.column(1).to_pylist())
                for doc_id, stream in zip(some.column(0).to_pylist(), coded, strict=True):
                    doc_ids.append(doc_id)
                    streams.append(stream + end)
                    held += len(streams[-1]) // 4
                    if held >= segment_ids and not cut:
                        cut, cut_ids = len(streams), held
                    # a segment leaves when at least half a one stays
                    if cut and len(streams) > cut and held >= cut_ids + segment_ids // 2:
                        full_ids, full = doc_ids[:cut], streams[:cut]
                        doc_ids, streams = doc_ids[cut:], streams[cut:]
                        yield _segment(part, seg, start, full_ids, full)
                        start, seg, held = start + cut_ids, seg + 1, held - cut_ids
                        cut, cut_ids = (len(streams), held) if held >= segment_ids else (0, 0)
        if doc_ids:
            yield _segment(part, seg, start, doc_ids, streams)
        doc_ids, streams = [], []
        hand_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    placed = rows.repartitionByRange(n, "doc_id").sortWithinPartitions(*order)
    placed.mapInArrow(encode, _SEGMENT).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, from its decoded ids.

    ``start`` counts the ids of all documents before it. ``with_ids`` adds the ids themselves.
    """
    segments = spark.read.schema(_SEGMENT).parquet(folder)
    # one row per range partition
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks = decode_blocks(row["blocks"])
                ids = np.concatenate(blocks) if blocks else np.zeros(0, "<u4")
                if len(ids) != row["n_ids"]:
                    raise ValueError(f"segment {row['part']}/{row['seg']} has {len(ids)} ids, not {row['n_ids']}")
                ends = np.cumsum(row["n_tokens"], dtype=np.int64)
                starts = ends - np.array(row["n_tokens"], np.int64)
                texts = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array([row["part"]] * len(texts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["seg_start"], pa.int64()), pa.array(row["n_tokens"], pa.int64()),
                    pa.array([zlib.crc32(t.tobytes()) for t in texts], pa.int64())]
                names = ["part", "doc_id", "local", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([t.astype(np.int64) for t in texts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        hand_back()

    schema = "part int, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    decoded = segments.mapInArrow(decode, schema)
    joined = decoded.join(F.broadcast(bases), F.col("part") == F.col("_part"))
    return joined.select(
        "doc_id", (F.col("local") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
