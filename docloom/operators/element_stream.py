"""Parser output of any size to marked text: elements leave the JSON one by one and meet again by aggregation.

``assemble_elements`` holds a document as one VARIANT value, which has a size limit. Here an Arrow stage walks over the
JSON text and yields a row for each element; pages are put together from spans of elements, documents from pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.jsonscan import ParsedDocument, plain_json
from docloom.functions.text import page_close, page_open
from docloom.operators.elements import assemble_elements, content_of, document_error, is_text_element, page_number_of
from docloom.operators.pages import raw_text_row

# Documents up to this many bytes of JSON are assembled in their row; VARIANT holds at most 128 MiB.
ROW_BYTES = 64 << 20
# Elements joined in one group before a page is put together, and characters of elements in a batch.
SPAN, BATCH_CHARS = 4096, 4 << 20

_READ = pa.schema([
    ("row", pa.int64()), ("file_name", pa.string()), ("file_path", pa.string()), ("pos", pa.int64()), ("element", pa.string()),
    ("status", pa.string()), ("json_error", pa.string()),
])
_READ_SQL = "row long, file_name string, file_path string, pos long, element string, status string, json_error string"


def _read_one(row: int, name: str | None, path: str | None, text: str) -> Iterator[tuple]:
    """A row for the document, without a position, and one for each element."""
    try:
        document = ParsedDocument(text)
    except (ValueError, RecursionError) as problem:
        yield row, name, path, None, None, None, str(problem)
        return
    status = plain_json(text[slice(*document.status)]) if document.status else None
    yield row, name, path, None, None, status, None
    for pos, element in enumerate(document.element_texts()):
        yield row, name, path, pos, element, None, None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    held: list[tuple] = []
    chars = 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)

    for batch in batches:
        names, paths, texts = (batch.column(c) for c in ("file_name", "file_path", "source"))
        for i in range(batch.num_rows):
            for read in _read_one(number, names[i].as_py(), paths[i].as_py(), texts[i].as_py()):
                held.append(read)
                chars += 64 + len(read[4] or "")
                if chars > BATCH_CHARS:
                    yield batch_of(held)
                    held, chars = [], 0
            number += 1
    if held:
        yield batch_of(held)


def read_elements(parsed: DataFrame) -> DataFrame:
    """``row``, file_name, file_path, ``pos`` and ``element`` (JSON text) of every element, in the order of the text.

    Each document also gives a row without ``pos``, with ``status`` (the JSON of its error status) and ``json_error``
    (Python's message where the text is not JSON). ``row`` tells documents apart, repeated ones too. Null and empty
    texts count as an empty object. A task holds one document's text and one element at a time.
    """
    source = F.when(F.coalesce(F.col("parsed_doc_json"), F.lit("")) == "", F.lit("{}")).otherwise(F.col("parsed_doc_json"))
    return parsed.select("file_name", "file_path", source.alias("source")).mapInArrow(_read, _READ_SQL)


def _joined(entries: Column, between: str) -> Column:
    return F.array_join(F.transform(F.sort_array(entries), lambda e: e["text"]), between)


def assemble_element_stream(parsed: DataFrame) -> DataFrame:
    """The rows of ``assemble_elements``, whatever the size of a document's JSON.

    Contents are joined in spans of ``SPAN`` elements, spans to pages, pages to the document, so that only the last
    step meets a whole document, whose text is one cell of its result. Every document gives one row; an empty
    table gives none.
    """
    value = F.try_parse_json("element")
    read = read_elements(parsed).select("row", "file_name", "file_path", "pos", "status", "json_error", value.alias("value"))
    content = F.when(is_text_element(F.col("value")), content_of(F.col("value")))
    keys = ["row", "file_name", "file_path"]
    contents = read.select(
        *keys, "pos", "status", "json_error", F.nullif(content, F.lit("")).alias("content"), page_number_of(F.col("value")).alias("number")
    ).filter(F.col("pos").isNull() | F.col("content").isNotNull())
    spans = contents.groupBy(
        *keys, F.when(F.col("pos").isNotNull(), F.col("number")).alias("page"), F.floor(F.col("pos") / SPAN).alias("span")
    ).agg(
        F.collect_list(F.when(F.col("content").isNotNull(), F.struct("pos", F.col("content").alias("text")))).alias("texts"),
        F.max("status").alias("status"), F.max("json_error").alias("json_error"),
    )
    pages = spans.groupBy(*keys, "page").agg(
        F.collect_list(F.struct("span", _joined(F.col("texts"), "\n\n").alias("text"))).alias("texts"),
        F.max("status").alias("status"), F.max("json_error").alias("json_error"),
    )
    block = F.concat(page_open(F.col("page")), _joined(F.col("texts"), "\n\n"), page_close(F.col("page")))
    documents = pages.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", block.alias("text")))).alias("texts"),
        F.max("page").alias("last_page"), F.max("status").alias("status"), F.max("json_error").alias("json_error"),
    )
    error = document_error(F.col("json_error"), F.try_parse_json("status"), F.size("texts"))
    judged = documents.select("file_name", "file_path", "texts", "last_page", error.alias("error"))
    return judged.select(*raw_text_row(_joined(F.col("texts"), "\n\n"), F.col("last_page"), F.col("error")))


def assemble_documents(parsed: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """``assemble_elements`` where a document's JSON has at most ``row_bytes``, the element stream beyond: the same rows."""
    large = F.coalesce(F.octet_length("parsed_doc_json"), F.lit(0)) > row_bytes
    return assemble_elements(parsed.filter(~large)).unionByName(assemble_element_stream(parsed.filter(large)))
