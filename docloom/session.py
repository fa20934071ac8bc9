"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app_name: str = "docloom", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("docloom.partitions", str(shuffle_partitions))
        # Call sites in error messages cost a third of the time it takes to build a large query.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir``, or a folder below the warehouse.

    Both are reachable from every executor. Nothing is changed on the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def staging_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A new path in the shared folder."""
    return f"{(root or staging_root(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used where recomputing a lost partition would repeat paid work (model calls) or where
    several outputs share one input. The files outlive the executors that wrote them.
    """
    spark = df.sparkSession
    target = staging_path(spark, name, root)
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)
