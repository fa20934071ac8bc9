"""Helpers of several operators: tables, learning folds, and ranks without one task per class."""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# White space and letters of the contracts, ASCII only.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(key: Column) -> Column:
    """Rows that no label is learned from. A null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def unsigned_crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def class_ranks(rows: DataFrame, cls: str, block: str, local: str, rank: str) -> DataFrame:
    """Gapless ranks from 0 within each class.

    ``local`` is the rank within (``block``, ``cls``), where a block is what one task wrote. Only counts per block
    and class are put in order, so a class that holds a third of all rows is still spread over its blocks.
    """
    counts = rows.groupBy(F.col(block).alias("_b"), F.col(cls).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_b", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = rows.join(starts, (F.col(block) == F.col("_b")) & (F.col(cls) == F.col("_c")))
    return joined.select(*rows.columns, (F.col("_start") + F.col(local)).alias(rank))


def blocks_of(rows: int, per_block: int, least: int = 1) -> int:
    """How many blocks hold ``rows`` rows with about ``per_block`` each."""
    return max(least, math.ceil(rows / per_block))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], longest: int, id_col: str = "doc_id",
) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: of each class the rows of smallest hash, at most ``per_class`` of them.

    Rows that are held out and texts of more than ``longest`` characters are left out of learning, so that what the
    driver holds is bounded. Rows without an id or a label do not count.
    """
    known = labels.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")
    )
    chosen = None
    for value, most in per_class.items():
        some = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(most)
        chosen = some if chosen is None else chosen.union(some)
    rows = (
        documents.select(F.col(id_col).alias("_id"), F.col("text").alias("_text")).filter(F.length("_text") <= longest)
        .join(F.broadcast(chosen), "_id").select("_id", "_label", "_text").toArrow().to_pylist()
    )
    rows.sort(key=lambda r: (zlib.crc32(str(r["_id"]).encode()), r["_id"], r["_label"], r["_text"]))
    return [r["_text"] for r in rows], [r["_label"] for r in rows]
