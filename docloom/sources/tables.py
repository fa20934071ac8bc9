"""Saved tables, views and parameterised reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, fmt: str = "parquet", overwrite_schema: bool = True, path: str | None = None) -> DataFrame:
    """Overwrite a table, in ``path`` if that is given, and return it as read back.

    Parquet tables take a changed schema on overwrite; Delta needs the option for it.
    """
    writer = df.write.format(fmt).mode("overwrite")
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def run_query(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """A query with named parameters (``:name``), so that values are never spliced into the text."""
    return spark.sql(sql, args=params)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to as many partitions as the session's setting ``docloom.partitions`` says; unset, do nothing.

    For small inputs in one file, on one machine. A cluster leaves it unset.
    """
    partitions = df.sparkSession.conf.get("docloom.partitions", None)
    return df.repartition(int(partitions)) if partitions else df
