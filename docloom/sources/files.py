"""Listing and reading document files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.functions.text import file_name_of, plain_path


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Binary scan of the ``.pdf`` files of a folder, whatever the case of the ending."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[pP][dD][fF]")
        .load(folder)
        .select(F.col("path"), F.col("length"), F.col("modificationTime"), F.col("content"))
    )


def list_documents(files: DataFrame, max_files: int | None = None) -> DataFrame:
    """Document rows of a listing with a ``path`` column; other columns are kept.

    The cap is a feature of its own, for trials: the first files by path, as a top-k. Whole runs leave it out.
    """
    documents = files.filter(F.lower("path").endswith(".pdf"))
    if max_files is not None:
        documents = documents.orderBy("path").limit(max_files)
    return documents.select(
        file_name_of(F.col("path")).alias("file_name"),
        plain_path(F.col("path")).alias("file_path"),
        *[name for name in files.columns if name != "path"],
    )


def require_documents(documents: DataFrame, folder: str) -> DataFrame:
    """Stop early on an empty input."""
    if documents.isEmpty():
        raise ValueError(f"No PDF files found in {folder}")
    return documents


def parsed_json(parsed: DataFrame, column: str = "parsed_doc") -> DataFrame:
    """A parser's VARIANT output as a JSON string column ``parsed_doc_json``."""
    return parsed.select("file_name", "file_path", F.to_json(column).alias("parsed_doc_json"))
