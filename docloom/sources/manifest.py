"""A manifest of files with digests of their contents, so that a later run reads only what is new."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

CHUNK = 4 << 20
# What became of a path between two listings.
UNCHANGED, CHANGED, NEW, MOVED, GONE = "unchanged", "changed", "new", "moved", "gone"

Digests = Callable[[DataFrame], DataFrame]


def _digest(path: str) -> str:
    local = path.removeprefix("file:") if path.startswith("file:/") else path
    system, inside = fs.FileSystem.from_uri(local)
    found = hashlib.sha256()
    with system.open_input_stream(inside) as stream:
        while chunk := stream.read(CHUNK):
            found.update(chunk)
    return found.hexdigest()


def digest_files(paths: DataFrame) -> DataFrame:
    """``path`` and ``digest`` (SHA-256) of the files named in ``path``; tasks read them in chunks, of any size."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column("path")
            yield pa.RecordBatch.from_arrays([named, pa.array([_digest(p) for p in named.to_pylist()], pa.string())], names=["path", "digest"])

    return paths.select("path").mapInArrow(digests, "path string, digest string")


def file_changes(listing: DataFrame, manifest: DataFrame, digests: Digests = digest_files) -> DataFrame:
    """One row for each path of either side: path, status, length, modified, digest, moved_from.

    ``listing`` has path, length and modified, ``manifest`` also digest. Files of the same length and time are taken
    to be unchanged and are not read; ``digests`` reads the others. A file whose content is that of a path that is
    gone has moved (``moved_from`` is the smallest such path); one that only has another time is unchanged. Of a path
    that is listed twice the latest entry counts; rows without a path are left out. An empty manifest makes all new.
    """
    was = manifest.select("path", F.struct("modified", "length", "digest").alias("was"), F.lit(None).alias("now"))
    now = listing.select("path", F.lit(None).alias("was"), F.struct("modified", "length").alias("now"))
    both = was.unionByName(now).filter("path is not null").groupBy("path").agg(F.max("was").alias("was"), F.max("now").alias("now"))
    same = F.col("was").isNotNull() & F.col("now").isNotNull() & (
        F.col("was.modified").eqNullSafe(F.col("now.modified")) & F.col("was.length").eqNullSafe(F.col("now.length"))
    )
    look = both.filter(F.col("now").isNotNull() & ~same).select("path")
    read = digests(look).select(F.col("path").alias("read_path"), F.col("digest").alias("read_digest"))
    joined = both.join(read, F.col("path") == F.col("read_path"), "left").select(
        "path", "was", "now", F.when(same, F.col("was.digest")).otherwise(F.coalesce("read_digest", "was.digest")).alias("digest")
    )
    # One row for each content that is gone, so that copies in any number do not multiply.
    left = both.filter("now is null").groupBy(F.col("was.digest").alias("left_digest")).agg(F.min("path").alias("left_path"))
    status = (
        F.when(F.col("now").isNull(), F.lit(GONE))
        .when(F.col("was").isNotNull(), F.when(F.col("was.digest").eqNullSafe(F.col("digest")), F.lit(UNCHANGED)).otherwise(F.lit(CHANGED)))
        .when(F.col("left_path").isNotNull(), F.lit(MOVED))
        .otherwise(F.lit(NEW))
    )
    found = joined.join(left, F.col("digest") == F.col("left_digest"), "left").withColumn("status", status)
    return found.select(
        "path", "status", F.coalesce("now.length", "was.length").alias("length"), F.coalesce("now.modified", "was.modified").alias("modified"),
        "digest", F.when(F.col("status") == MOVED, F.col("left_path")).alias("moved_from"),
    )


def files_to_read(changes: DataFrame) -> DataFrame:
    """Files whose content no earlier run has seen under any path that is known."""
    return changes.filter(F.col("status").isin(NEW, CHANGED))


def next_manifest(changes: DataFrame) -> DataFrame:
    """What to save for the next run."""
    return changes.filter(F.col("status") != GONE).select("path", "length", "modified", "digest")
