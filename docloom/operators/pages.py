"""Page texts to one marked text per document.

Two input shapes: an array of pages in the document's row (no shuffle), and a page table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.functions.text import page_close, page_open, strip

# Pages joined in one task before the document is put together.
SPAN = 256

def page_block(number: Column, text: Column, error: Column) -> Column:
    """One marked page. A page that failed keeps its place and shows the message."""
    shown = F.when(error.isNotNull(), F.concat(F.lit("[PAGE ERROR: "), error, F.lit("]"))).otherwise(
        F.coalesce(text, F.lit(""))
    )
    return F.concat(F.lit("\n\n"), page_open(number), shown, page_close(number))


def raw_text_row(text: Column, page_count: Column, error: Column) -> list[Column]:
    """The columns of the raw-text table; a failed document keeps only its message."""
    good = error.isNull()
    return [
        F.col("file_name"),
        F.col("file_path"),
        F.when(good, page_count).cast("int").alias("page_count"),
        F.when(good, text).alias("policy_text"),
        F.when(good, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("extraction_status"),
        error.alias("error_message"),
    ]


def assemble_page_arrays(documents: DataFrame) -> DataFrame:
    """``pages ARRAY<STRUCT<page_text, error>>`` and ``error`` per document to raw-text rows; row-local."""
    blocks = F.transform("pages", lambda page, i: page_block(i + 1, page["page_text"], page["error"]))
    text = strip(F.array_join(blocks, "\n"))
    return documents.select(*raw_text_row(text, F.size("pages"), F.col("error")))


def _in_order(entries: str) -> Column:
    """Structs of a position and a text, joined by position."""
    return F.array_join(F.transform(F.sort_array(entries), lambda item: item["text"]), "\n")


def assemble_pages(pages: DataFrame) -> DataFrame:
    """A page table with pages 1..n per document to raw-text rows.

    A row without a page number stands for a document as a whole: with an error, for one that could not be read,
    else for one that may have no pages. Pages are first joined in spans of a fixed number of pages, so that sorting
    and joining the pages of a very long document is shared by many tasks. The last step meets one text per span, and
    its result is the document's text cell; ``page_parts`` makes parts of bounded size instead.
    """
    block = page_block(F.col("page_no"), F.col("page_text"), F.col("error"))
    paged = F.col("page_no").isNotNull()
    spans = (
        pages.groupBy("file_name", "file_path", F.floor((F.col("page_no") - 1) / SPAN).alias("span"))
        .agg(
            F.count("page_no").alias("span_pages"),
            F.collect_list(F.when(paged, F.struct("page_no", block.alias("text")))).alias("blocks"),
            F.max(F.when(~paged, F.col("error"))).alias("problem"),
        )
        .select("file_name", "file_path", "span", "span_pages", "problem", _in_order("blocks").alias("text"))
    )
    documents = spans.groupBy("file_name", "file_path").agg(
        F.sum("span_pages").alias("page_total"),
        F.collect_list(F.when(F.col("span").isNotNull(), F.struct("span", "text"))).alias("spans"),
        F.max("problem").alias("problem"),
    )
    return documents.select(*raw_text_row(strip(_in_order("spans")), F.col("page_total"), F.col("problem")))


def page_parts(pages: DataFrame, max_chars: int) -> DataFrame:
    """The texts of readable documents in parts of at most ``max_chars`` characters, straight from the page table.

    Joined, the parts of a document are exactly its text as ``assemble_pages`` makes it. Where a page begins in the
    text is a running sum of lengths, numbers only; each page is then cut at the limits of the parts. So no group
    holds more than the pieces of one part, however long the document is.
    """
    keys = ["file_name", "file_path"]
    block = page_block(F.col("page_no"), F.col("page_text"), F.col("error"))
    # The first block loses its two leading newlines, the others are joined by one.
    text = F.when(F.col("page_no") == 1, F.substr(block, F.lit(3))).otherwise(F.concat(F.lit("\n"), block))
    blocks = pages.filter(F.col("page_no").isNotNull()).select(*keys, "page_no", text.alias("text"))
    before = Window.partitionBy(*keys).orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    sizes = blocks.select(*keys, "page_no", F.length("text").cast("long").alias("size"))
    places = sizes.select(
        *keys, "page_no", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(whole).alias("total"), F.count(F.lit(1)).over(whole).cast("int").alias("page_count"),
    )
    first, last = F.floor(F.col("start") / max_chars), F.floor((F.col("start") + F.length("text") - 1) / max_chars)
    pieces = blocks.join(places, [*keys, "page_no"]).select(
        *keys, "page_count", "total", "page_no", "start", "text", F.explode(F.sequence(first, last)).alias("part")
    )
    skipped = F.greatest(F.col("part") * max_chars - F.col("start"), F.lit(0))
    taken = (F.col("part") + 1) * max_chars - F.col("start") - skipped
    piece = F.substr("text", (skipped + 1).cast("int"), F.least(taken, F.lit(max_chars)).cast("int"))
    parts = pieces.select(*keys, "page_count", "total", "part", F.struct("page_no", piece.alias("text")).alias("piece"))
    return parts.groupBy(*keys, "page_count", "total", "part").agg(F.collect_list("piece").alias("pieces")).select(
        *keys, "page_count", (F.col("part") + 1).cast("int").alias("part_no"),
        F.ceil(F.col("total") / max_chars).cast("int").alias("part_count"),
        F.array_join(F.transform(F.sort_array("pieces"), lambda item: item["text"]), "").alias("body"),
    )


def successful(raw_text: DataFrame) -> DataFrame:
    """Only documents whose text was read."""
    return raw_text.filter(F.col("extraction_status") == "SUCCESS").select(
        "file_name", "file_path", "page_count", "policy_text"
    )


def every_document(raw_text: DataFrame) -> DataFrame:
    """All documents, failed ones with a null text."""
    return raw_text.select("file_name", "file_path", "policy_text")
