"""Joins against rows that were made unique by an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(rows: DataFrame, unique: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` joined to at most one row of ``unique`` each; ``how`` is ``left`` or ``left_anti``.

    The adaptive skew join splits a hot key of ``rows`` only if both sides come straight from a shuffle,
    which an aggregated side does not. Joining on a hash of the keys as well makes Spark shuffle the small
    aggregated side once more; the keys themselves stay in the condition, so filters on them still reach
    both sides.
    """
    mark = F.xxhash64(*keys).alias("key_hash")
    marked = rows.select("*", mark)
    return marked.join(unique.select("*", mark), ["key_hash", *keys], how).select(
        *rows.columns, *([] if how == "left_anti" else [name for name in unique.columns if name not in keys])
    )
