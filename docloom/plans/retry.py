"""Saved model output in partitions by file, and a second run that asks only for what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators import requests, responses
from docloom.operators.completion import Completer, complete
from docloom.plans.runs import RunOptions
from docloom.session import stage

BUCKETS = 64
_KEY = ["file_path", "part_no"]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("file_path"), F.lit(buckets)).cast("int").alias("path_bucket")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # Partitions are dealt out by size: a file with very many parts is written by several tasks.
    rows.hint("rebalance", "path_bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("path_bucket").parquet(path)


def save_output(output: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Model output with part numbers, in ``buckets`` partitions by a hash of the file path. An earlier table is an error."""
    _write(output.select("*", _bucket(buckets)), path, "errorifexists")


def failed_parts(saved: DataFrame) -> DataFrame:
    """The parts of files that have no usable answer."""
    return saved.filter("extraction_status = 'FAILED'").select(*_KEY).distinct()


def retry_failed(
    spark: SparkSession, path: str, texts: DataFrame, completer: Completer, model_name: str, options: RunOptions, buckets: int = BUCKETS,
) -> DataFrame:
    """Ask again for the failed parts of the output saved at ``path`` and return the whole output.

    Requests are built for files with failed parts only, and only failed parts are sent. Only partitions that hold
    such parts are overwritten; a part that fails again keeps its new message, and one whose text is no longer
    there keeps its row. Without failed parts nothing is called or written. Answers and new partitions
    are staged, so that a lost executor repeats no call, and partitions are replaced when all of them are written.
    ``options`` and ``buckets`` must be those of the first run. Rows without a file path are not retried.
    """
    saved = spark.read.parquet(path)
    failed = stage(failed_parts(saved), "failed-parts")
    if failed.isEmpty():
        return saved.drop("path_bucket")
    wanted = texts.join(failed.select("file_path").distinct(), "file_path", "left_semi")
    built = requests.build_requests(wanted, {"run": options.prompt}, options.rules, options.max_chars)
    asked = built.join(failed, _KEY, "left_semi")
    answered = stage(complete(asked, completer, options.parallelism, "retry"), "retried")
    cleaned = responses.clean_responses(answered, model_name, options.processed_at, options.rules)
    again = stage(responses.model_output(cleaned).select("*", _bucket(buckets)), "retried-output")
    touched = again.select("path_bucket").distinct()
    kept = saved.join(touched, "path_bucket", "left_semi").join(again.select(*_KEY), _KEY, "left_anti")
    replaced = stage(kept.select(*again.columns).unionByName(again), "replaced")
    _write(replaced, path, "overwrite")
    spark.catalog.refreshByPath(path)
    return spark.read.schema(saved.schema).parquet(path).drop("path_bucket")
