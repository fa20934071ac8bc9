"""Policy terms and dates: terms in force on a date, the newest term by a date, unbroken cover and its gaps.

A term runs from its first day to the day before its end; one without both dates, or that ends on or before its first day,
covers nothing and takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.functions.joins import lookup_join

# Days of a bin of the interval join.
BIN_DAYS = 128


def read_terms(policies: DataFrame, insured: str = "named_insured") -> DataFrame:
    """insured, policy_number, starts, ends of policies whose dates can be read and are in order."""
    day = lambda name: F.to_date(F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd")))
    terms = policies.select(
        F.col(insured).alias("insured"), "policy_number", day("effective_date").alias("starts"), day("expiration_date").alias("ends")
    )
    return terms.filter("insured IS NOT NULL AND starts < ends")


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS)


def in_force(dated: DataFrame, terms: DataFrame, insured: str = "insured", day: str = "day") -> DataFrame:
    """Each row of ``dated`` with each term of its insured in force on its day; rows without one do not show.

    Both sides meet by insured and bin of days, so a term meets only what falls into the bins that it touches, and an
    insured with a large share of the rows is spread over its bins. Columns of ``dated`` stay, and must not be named as the
    term's. Null insured or days match nothing.
    """
    touched = F.sequence(_bin(F.col("starts")), _bin(F.date_sub("ends", 1)))
    binned = terms.select("insured", "policy_number", "starts", "ends", F.explode(touched).alias("term_bin"))
    rows = dated.withColumn("term_bin", _bin(F.col(day))).withColumn("term_of", F.col(insured))
    met = rows.join(binned.withColumnRenamed("insured", "term_of"), ["term_of", "term_bin"])
    return met.filter((F.col("starts") <= F.col(day)) & (F.col(day) < F.col("ends"))).drop("term_of", "term_bin")


def newest_term(dated: DataFrame, terms: DataFrame, insured: str = "insured", day: str = "day") -> DataFrame:
    """Each row of ``dated`` once, with the term of its insured that began last on or before its day, else nulls.

    Of terms that begin on one day the one with the largest (ends, policy_number) counts. Terms and wanted days are
    made one row for each insured and day before they are put in order, so no insured brings more rows to a task than
    there are days; the answers then go back to the rows by equality.
    """
    begun = terms.groupBy("insured", F.col("starts").alias("on_day")).agg(
        F.max(F.struct("ends", "policy_number")).alias("last")
    ).select("insured", "on_day", F.struct("on_day", "last").alias("term"), F.lit(False).alias("wanted"))
    named = dated.withColumns({"term_of": F.col(insured), "term_on": F.col(day)})
    asked = named.filter("term_of IS NOT NULL AND term_on IS NOT NULL").groupBy("term_of", "term_on").agg(F.lit(True).alias("wanted"))
    both = begun.unionByName(
        asked.select(F.col("term_of").alias("insured"), F.col("term_on").alias("on_day"), F.lit(None).cast(begun.schema["term"].dataType).alias("term"), "wanted")
    )
    # Terms of a day stand before the question of that day.
    order = Window.partitionBy("insured").orderBy("on_day", "wanted").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = both.withColumn("found", F.last("term", ignorenulls=True).over(order)).filter("wanted")
    answers = told.select(F.col("insured").alias("term_of"), F.col("on_day").alias("term_on"), "found")
    return lookup_join(named, answers, ["term_of", "term_on"], "left").select(
        *dated.columns, F.col("found.last.policy_number").alias("policy_number"),
        F.col("found.on_day").alias("starts"), F.col("found.last.ends").alias("ends"),
    )


def unbroken_cover(terms: DataFrame) -> DataFrame:
    """A row for each unbroken stretch of cover: insured, cover_starts, cover_ends, term_count, covered_days,
    overlap_days (days of terms beyond the stretch's own) and gap_days since the stretch before (null for the first).

    Terms that touch or overlap are one stretch. Terms are first combined by insured and first day, so that the window
    over an insured holds no more rows than there are days.
    """
    days = F.datediff("ends", "starts").cast("long")
    begun = terms.groupBy("insured", "starts").agg(
        F.max("ends").alias("ends"), F.count(F.lit(1)).alias("term_count"), F.sum(days).alias("term_days")
    )
    in_order = Window.partitionBy("insured").orderBy("starts")
    reach = F.max("ends").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    marked = begun.withColumn("reach", reach).withColumn(
        "first", F.coalesce(F.col("starts") > F.col("reach"), F.lit(True)).cast("long")
    )
    numbered = marked.withColumn("stretch", F.sum("first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = numbered.groupBy("insured", "stretch").agg(
        F.min("starts").alias("cover_starts"), F.max("ends").alias("cover_ends"), F.sum("term_count").alias("term_count"),
        F.sum("term_days").alias("term_days"), F.max(F.when(F.col("first") == 1, F.datediff("starts", "reach"))).alias("gap_days"),
    )
    covered = F.datediff("cover_ends", "cover_starts").cast("long")
    return whole.select(
        "insured", "cover_starts", "cover_ends", "term_count", covered.alias("covered_days"),
        (F.col("term_days") - covered).alias("overlap_days"), "gap_days",
    )
