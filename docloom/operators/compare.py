"""What two extraction runs over the same files have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ["file_path", "coverage_name", "coverage_section"]


def compare_coverages(first: DataFrame, second: DataFrame) -> DataFrame:
    """Coverages by file, name and section with the rows each run has.

    Both runs are counted in one aggregation instead of a full outer join: copies are combined before
    the shuffle, null sections match, and no key can blow up into pairs. Coverages without a name match nothing and
    count for no run, but keep their file in the result.
    """
    def side(run: DataFrame, in_first: int) -> DataFrame:
        named = F.col("coverage_name").isNotNull().cast("int")
        return run.select(*KEYS, (named * in_first).alias("a"), (named * (1 - in_first)).alias("b"))

    both = side(first, 1).unionByName(side(second, 0))
    return both.groupBy(*KEYS).agg(F.sum("a").alias("first_rows"), F.sum("b").alias("second_rows"))


def compare_files(compared: DataFrame) -> DataFrame:
    """Per file: coverages found by the first run alone, the second alone, and both."""
    first, second = F.col("first_rows") > 0, F.col("second_rows") > 0
    return compared.groupBy("file_path").agg(
        F.count_if(first & ~second).alias("first_only"),
        F.count_if(second & ~first).alias("second_only"),
        F.count_if(first & second).alias("in_both"),
    )


def difference(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """Each distinct row of ``columns`` with its copies in each run and what became of them.

    ``kept`` is its multiplicity in INTERSECT ALL, ``removed`` and ``added`` in the two EXCEPT ALL, all from one
    aggregation that combines copies before the shuffle; nulls equal nulls.
    """
    side = lambda run, a, b: run.select(*columns, F.lit(a).alias("a"), F.lit(b).alias("b"))
    counts = side(first, 1, 0).unionByName(side(second, 0, 1)).groupBy(*columns).agg(
        F.sum("a").alias("first_rows"), F.sum("b").alias("second_rows")
    )
    more = F.col("second_rows") - F.col("first_rows")
    zero = F.lit(0).cast("long")
    return counts.select(
        "*", F.least("first_rows", "second_rows").alias("kept"), F.greatest(-more, zero).alias("removed"), F.greatest(more, zero).alias("added")
    )


def changes(compared: DataFrame, keys: list[str]) -> DataFrame:
    """Per key what ``difference`` found: rows kept, changed (one removed for one added), and left over on either side."""
    sums = compared.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("kept", "removed", "added")])
    changed = F.least("removed", "added")
    return sums.select(
        *keys, "kept", changed.alias("changed"), (F.col("removed") - changed).alias("removed"), (F.col("added") - changed).alias("added")
    )
