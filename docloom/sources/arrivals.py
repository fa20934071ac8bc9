"""Pages that arrive in files over time, as a stream; pages sent twice are kept once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PAGE = ["file_path", "page_no"]
# How long the stream remembers a page.
REMEMBERED = "7 days"


def take_arrivals(
    spark: SparkSession, arriving: str, schema: str, saved: str, progress: str, files_at_once: int | None = None, remembered: str = REMEMBERED
) -> None:
    """Add pages of the Parquet files in ``arriving`` that no earlier call took to ``saved``, and return when all are in.

    ``schema`` includes ``file_path`` and ``page_no``; a column ``arrived`` is added. That is the time at which a batch
    is taken and not a time in the data, so no page is ever late. The state holds one entry for each page of the time
    ``remembered``. ``progress`` names the stream's own folder: a call that failed goes on where it stopped, and the sink
    counts a batch once. All three folders must be shared by the executors.
    """
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    pages = reader.parquet(arriving).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", remembered)
    once = pages.dropDuplicatesWithinWatermark(PAGE)
    writer = once.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True)
    writer.start(saved).awaitTermination()


def first_arrivals(pages: DataFrame) -> DataFrame:
    """One row for each page: the first to arrive, of those that arrived together the smallest.

    Also takes out a page that was sent again after the stream had forgotten it. Rows of a document without pages have
    no page number, which counts as one page.
    """
    others = [c for c in pages.columns if c not in (*PAGE, "arrived")]
    first = pages.groupBy(*PAGE).agg(F.min(F.struct("arrived", *others)).alias("first"))
    return first.select(*PAGE, *[F.col(f"first.{c}").alias(c) for c in others])
