"""Layout elements of a document parser to one marked text per document; row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.jsontext import probe_json, probed_value, recheck_json
from docloom.functions.text import page_close, page_open, strip
from docloom.functions.variant import NUMBERS, at, kind, text_of, truthy
from docloom.operators.pages import raw_text_row

# Element types that carry no document text.
SKIPPED_TYPES = ("page_header", "page_footer", "page_number")

# Messages of failed documents.
PARSE_FAILURE = "Failed to parse ai_parse_document JSON: "
PARSER_FAILURE = "ai_parse_document error_status: "
NO_CONTENT = "No text-like content returned by ai_parse_document"


def page_number_of(element: Column) -> Column:
    """Page of the first box; absent, unreadable or below one counts as page one."""
    box = at(element, "$.bbox[0].page_id")
    body = text_of(box)
    whole = F.regexp_replace(F.when(strip(body).rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), strip(body)), "_", "")
    number = F.when(
        kind(box).isin(*NUMBERS), F.try_variant_get(box, "$", "double").try_cast("int")
    ).when(kind(box) == "STRING", whole.try_cast("int"))
    return F.greatest(F.coalesce(number, F.lit(1)), F.lit(1))


def content_of(element: Column) -> Column:
    body = at(element, "$.content")
    return strip(F.when(kind(body) == "BOOLEAN", F.initcap(text_of(body))).otherwise(text_of(body)))


def is_text_element(element: Column) -> Column:
    skipped = F.coalesce(F.lower(strip(text_of(element, "$.type"))), F.lit("")).isin(*SKIPPED_TYPES)
    return (kind(element) == "OBJECT") & ~skipped


def document_error(json_error: Column, status: Column, items: Column) -> Column:
    """Why a document has no text, or null. ``items`` is the number of its contents."""
    return (
        F.when(json_error.isNotNull(), F.concat(F.lit(PARSE_FAILURE), json_error))
        .when(truthy(status), F.concat(F.lit(PARSER_FAILURE), text_of(status)))
        .when(F.coalesce(items, F.lit(0)) <= 0, F.lit(NO_CONTENT))
    )


def _text_items(document: Column) -> Column:
    """Array of (page, pos, content) in reading order."""
    elements = F.try_variant_get(document, "$.document.elements", "array<variant>")
    usable = F.filter(elements, is_text_element)
    items = F.transform(
        usable,
        lambda e, i: F.struct(page_number_of(e).alias("page"), i.alias("pos"), content_of(e).alias("content")),
    )
    return F.sort_array(F.filter(items, lambda item: item["content"] != ""))


def _marked_text(items: Column) -> Column:
    """Contents joined by blank lines, with markers wherever the page changes."""

    def piece(item: Column, i: Column) -> Column:
        before = F.get(items, i - 1)["page"]
        lead = (
            F.when(i == 0, page_open(item["page"]))
            .when(before != item["page"], F.concat(page_close(before), F.lit("\n\n"), page_open(item["page"])))
            .otherwise(F.lit("\n\n"))
        )
        return F.concat(lead, item["content"])

    return F.concat(F.array_join(F.transform(items, piece), ""), page_close(F.get(items, F.size(items) - 1)["page"]))


def assemble_elements(parsed: DataFrame) -> DataFrame:
    """``parsed_doc_json`` per document to raw-text rows.

    Everything happens inside the row, so no shuffle is needed; only texts that Spark's parser turns
    down cross to Python for the exact message.
    """
    source = F.when(F.coalesce(F.col("parsed_doc_json"), F.lit("")) == "", F.lit("{}")).otherwise(
        F.col("parsed_doc_json")
    )
    keys = ["file_name", "file_path"]
    probed = parsed.select(*keys, source.alias("source")).withColumn("probe", probe_json(F.col("source")))
    checked = probed.select(*keys, "source", probed_value(F.col("probe"), F.col("source")).alias("doc"))
    rechecked = checked.withColumn("second", recheck_json(F.when(F.col("doc").isNull(), F.col("source"))))
    documents = rechecked.select(
        *keys,
        F.col("second.error").alias("json_error"),
        F.coalesce(F.col("doc"), F.try_parse_json("second.json")).alias("doc"),
    )
    items = documents.select(
        *keys, "json_error", at(F.col("doc"), "$.error_status").alias("status"), _text_items(F.col("doc")).alias("items")
    )
    error = document_error(F.col("json_error"), F.col("status"), F.size("items"))
    judged = items.select(*keys, "items", error.alias("error"))
    last_page = F.get(F.col("items"), F.size("items") - 1)["page"]
    return judged.select(*raw_text_row(_marked_text(F.col("items")), last_page, F.col("error")))
