"""Vectors that take part in a search, and the grid of vector blocks and query blocks that a search runs on."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.shared import blocks_of

# Vectors and queries of one cell of the grid, and the blocks that a small table still makes.
ROWS, QUERIES, LEAST = 4096, 2048, 32


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, infinite or not a number."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def searched(vectors: DataFrame, id_col: str, vector_col: str, least: int = 1) -> DataFrame:
    """``id`` and ``vec`` (array of doubles) of the vectors that take part, one for each id.

    Rows without an id, with fewer than ``least`` components or with unusable ones are left out. Of several rows of one id the smallest
    vector counts.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    return rows.filter(F.col("id").isNotNull() & usable(F.col("vec")) & (F.size("vec") >= least)).groupBy("id").agg(
        F.min("vec").alias("vec")
    )


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones count as ending in zeros."""
    lists = vectors.combine_chunks()
    found = np.zeros((len(lists), width))
    values, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(lists)), sizes)
    found[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return found


def over_grid(
    rows: DataFrame, queries: DataFrame, row_id: str, query_id: str, cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """``cell`` of each block of rows with each block of queries, both of bounded size and dealt out by hash."""
    row_blocks, query_blocks = blocks_of(rows.count(), ROWS, LEAST), blocks_of(queries.count(), QUERIES)
    left = rows.select(
        "*", F.pmod(F.xxhash64(row_id), F.lit(row_blocks)).alias("_rb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("_qb"),
    )
    right = queries.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("_rb"),
        F.pmod(F.xxhash64(query_id), F.lit(query_blocks)).cast("int").alias("_qb"),
    )
    return left.groupBy("_rb", "_qb").cogroup(right.groupBy("_rb", "_qb")).applyInArrow(cell, schema)


def largest(scored: DataFrame, group: list[str], score: str, tie: str, k: int, rank: str = "rank") -> DataFrame:
    """The ``k`` rows of largest score in each group; Spark keeps ``k`` for each task before it shuffles."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), tie)
    return scored.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)
