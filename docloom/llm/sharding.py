"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docloom.llm.shared import class_ranks, unsigned_crc
from docloom.session import stage

ROW_BYTES = 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rendezvous(keys: np.ndarray, weights: Mapping[int, float]) -> np.ndarray:
    """The shard of each 64-bit key hash: the largest of the shards' scores ``-weight / ln(u)``.

    ``u`` depends on the key and the shard's number alone. So a new shard takes rows only into itself, a removed one
    gives up only its own, and a larger weight only draws rows in. Shards of weight 0 get nothing. Ties go to the
    smaller number.
    """
    best = np.full(len(keys), -1.0)
    shard = np.full(len(keys), -1, dtype=np.int32)
    for number in sorted(n for n, w in weights.items() if w > 0):
        salt = _mixed(np.array([number + 0x9E3779B97F4A7C15], dtype=np.uint64))[0]
        u = ((_mixed(keys ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        score = -weights[number] / np.log(u)
        ahead = score > best
        best[ahead], shard[ahead] = score[ahead], number
    return shard


def assign_shards(
    documents: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One narrow row for each document: key, size, text_crc32, shard, slot, and the shard under ``grown``.

    ``size`` is the text's UTF-8 bytes plus 16; null text has none and the checksum 0. Rows of one key share a shard,
    rows without a key share one of their own. Slots are gapless in each shard; they are ranks from counts per task
    and shard, so no shard is gathered anywhere. Repeated rows get a slot each. An empty table gives no rows.
    """
    if not any(w > 0 for w in weights.values()):
        raise ValueError("no shard has a weight")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            hashes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            texts = [b"" if t is None else t for t in batch.column(2).to_pylist()]
            shard = rendezvous(hashes, weights)
            wider = rendezvous(hashes, grown) if grown else None
            local = np.empty(len(shard), dtype=np.int64)
            for number in np.unique(shard).tolist():
                at = np.flatnonzero(shard == number)
                local[at] = seen.get(number, 0) + np.arange(len(at))
                seen[number] = seen.get(number, 0) + len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(t) + ROW_BYTES for t in texts], pa.int64()),
                    pa.array([unsigned_crc(t) for t in texts], pa.int64()), pa.array(shard, pa.int32()),
                    pa.array(wider, pa.int32()) if grown else pa.nulls(len(shard), pa.int32()),
                    pa.array(np.full(len(shard), block), pa.int64()), pa.array(local, pa.int64()),
                ],
                names=[key_col, "size", "text_crc32", "shard", "grown_shard", "_block", "_local"],
            )

    key_type = documents.schema[key_col].dataType.simpleString()
    rows = documents.select(F.col(key_col), F.xxhash64(key_col).alias("h"), F.col(text_col).cast("binary").alias("t"))
    narrow = stage(
        rows.mapInArrow(
            placed,
            f"`{key_col}` {key_type}, size long, text_crc32 long, shard int, grown_shard int, _block long, _local long",
        ),
        "shards",
    )
    return class_ranks(narrow, "shard", "_block", "_local", "slot").drop("_block", "_local")


def write_shards(documents: DataFrame, weights: Mapping[int, float], path: str, key_col: str = "doc_id") -> None:
    """Write whole documents as one folder for each shard, straight from the tasks that read them."""

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            shard = pa.array(rendezvous(hashes.view(np.uint64), weights), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], shard], names=[*batch.schema.names[:-1], "_shard"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    hashed = documents.withColumn("_hash", F.xxhash64(key_col))
    hashed.mapInArrow(shard_of, f"{fields}, _shard int").write.partitionBy("_shard").parquet(path)
