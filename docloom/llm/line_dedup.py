"""Lines that many documents share are dropped from all but one of them, with DataFrame functions only.

Lines are exploded with their positions, normalised and hashed; the distinct documents of each hash are counted;
lines over the threshold are dropped by position and the rest of the document is joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.shared import SPACE, ascii_lower, let, text_of
from docloom.session import stage

# Lines of a document are looked at in spans of this many, so that a document of a million lines costs no square.
SPAN = 512
NO_ID = 2**63 - 1


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _lines(documents: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """A row for each line that can be dropped: 128 bits of hash, document, row and position."""
    rows = documents.select(
        F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_of(text_col)).alias("row"),
        F.posexplode(F.split(text_of(text_col), "\n", -1)).alias("pos", "line"),
    )
    keyed = rows.select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "row", "pos"
    )


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes of lines found in at least ``min_docs`` documents, with the smallest document of each."""
    return (
        lines.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("docs"), F.min("doc").alias("keeper"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines whose positions are not in ``dropped``, an array of (span, positions in it)."""

    def span_of(number: Column) -> Column:
        part = F.slice(lines, number * SPAN + 1, F.lit(SPAN))
        found = F.filter(dropped, lambda d: d["span"] == number)
        return F.when(F.size(found) == 0, part).otherwise(
            let(found[0]["at"], lambda at: F.filter(part, lambda _, i: ~F.array_contains(at, i.cast("int"))))
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / SPAN).cast("int"))
    return F.flatten(F.transform(numbers, span_of))


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """All columns of ``documents``, with the text replaced, and ``_n_lines`` and ``_n_dropped`` added.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents stays
    only in the smallest id that holds it, there with all its repeats. Null text counts as one empty line and becomes
    empty. Rows with the same id count as one document; rows without an id together count as one that comes last.
    Other columns pass through whatever their names. An empty table gives an empty one. The hashes of shared lines
    are written to the staging folder once: the join with all lines can then be split where one line is in a third
    of all documents.
    """
    lines = _lines(documents, id_col, text_col, min_chars)
    shared = stage(shared_lines(lines, min_docs), "shared-lines")
    drops = (
        lines.join(shared, ["h1", "h2"])
        .filter(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "row", F.floor(F.col("pos") / SPAN).cast("int").alias("span"))
        .agg(F.collect_set((F.col("pos") % SPAN).cast("int")).alias("at"))
        .groupBy(F.col("doc").alias("_drop_doc"), F.col("row").alias("_drop_row"))
        .agg(F.collect_list(F.struct("span", "at")).alias("_drops"))
    )
    joined = documents.join(
        drops,
        (F.coalesce(F.col(id_col), F.lit(NO_ID)) == F.col("_drop_doc"))
        & (F.xxhash64(text_of(text_col)) == F.col("_drop_row")),
        "left",
    )
    split = F.split(text_of(text_col), "\n", -1)
    kept = F.when(F.col("_drops").isNull(), text_of(text_col)).otherwise(
        F.array_join(let(split, lambda all_lines: _kept(all_lines, F.col("_drops"))), "\n")
    )
    dropped = F.coalesce(
        F.aggregate("_drops", F.lit(0).cast("long"), lambda n, d: n + F.size(d["at"])), F.lit(0).cast("long")
    )
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(c) for c in documents.columns],
        F.size(split).cast("long").alias("_n_lines"), dropped.alias("_n_dropped"),
    )
