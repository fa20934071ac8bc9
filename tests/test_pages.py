"""Page and element assembly on hand-worked cases and against brute force."""

import json

import pytest
from pyspark.sql import functions as F

from docloom.operators.elements import assemble_elements
from docloom.operators.pages import SPAN, assemble_page_arrays, assemble_pages, every_document, page_parts, successful
from docloom.schemas import PAGE_TABLE, RAW_TEXT


def element(kind, content, page=None):
    made = {"type": kind, "content": content}
    if page is not None:
        made["bbox"] = [{"page_id": page}]
    return made


def parse(spark, *docs):
    rows = [(f"d{i}", f"/x/d{i}", doc) for i, doc in enumerate(docs)]
    df = spark.createDataFrame(rows, "file_name string, file_path string, parsed_doc_json string")
    return assemble_elements(df).orderBy("file_name").collect()


def wrap(elements, **more):
    return json.dumps({"document": {"elements": elements}, **more})


def test_elements_by_page(spark):
    elements = [
        element("page_header", "H", 0), element("text", " A ", 0), 5, None, element("text", "B", 1),
        element("table", "T", 2), element("text", "  ", 2), element("text", None, 2), {"content": "N"},
    ]
    (row,) = parse(spark, wrap(elements))
    assert row.policy_text == (
        "=== PAGE 1 START ===\nA\n\nB\n\nN\n=== PAGE 1 END ===\n\n=== PAGE 2 START ===\nT\n=== PAGE 2 END ==="
    )
    assert (row.page_count, row.extraction_status, row.error_message) == (2, "SUCCESS", None)


def test_element_failures(spark):
    rows = parse(
        spark, None, "", "{bad", json.dumps({"error_status": "E1"}), wrap([]), wrap([element("text", "x", 1)], error_status=[]),
        '{"document": 1} z',
    )
    assert [r.error_message for r in rows[:5]] == [
        "No text-like content returned by ai_parse_document",
        "No text-like content returned by ai_parse_document",
        "Failed to parse ai_parse_document JSON: Expecting property name enclosed in double quotes: line 1 column 2 (char 1)",
        "ai_parse_document error_status: E1",
        "No text-like content returned by ai_parse_document",
    ]
    assert {r.extraction_status for r in rows[:5]} == {"FAILED"}
    assert all(r.policy_text is None and r.page_count is None for r in rows[:5])
    assert rows[5].extraction_status == "SUCCESS"
    assert rows[6].error_message.startswith("Failed to parse ai_parse_document JSON: Extra data")


def test_page_numbers(spark):
    pages = [7, "3", 2.7, "2.7", -4, "x", True, " 5 ", None, 0]
    elements = [element("text", f"c{i}", page) for i, page in enumerate(pages)]
    (row,) = parse(spark, wrap(elements))
    found = {}
    for block in row.policy_text.split("\n\n=== PAGE "):
        head, body = block.removeprefix("=== PAGE ").split(" START ===\n")
        found[int(head)] = body.split("\n=== PAGE ")[0].split("\n\n")
    assert found == {1: ["c3", "c4", "c5", "c6", "c8", "c9"], 2: ["c2"], 3: ["c1"], 5: ["c7"], 7: ["c0"]}
    assert row.page_count == 7


def test_duplicate_keys_are_read_like_python(spark):
    (row,) = parse(spark, '{"document": {}, "document": {"elements": [{"content": "last"}]}}')
    assert row.policy_text == "=== PAGE 1 START ===\nlast\n=== PAGE 1 END ==="


def marked(pages):
    parts = []
    for number, (text, error) in enumerate(pages, 1):
        shown = f"[PAGE ERROR: {error}]" if error else text or ""
        parts.append(f"\n\n=== PAGE {number} START ===\n{shown}\n=== PAGE {number} END ===")
    return "\n".join(parts).strip()


DOCS = {
    "two.pdf": [("a", None), (None, None)],
    "bad.pdf": [("", "bad")],
    "long.pdf": [("x" * n, None) for n in (0, 3, 50, 1, 0, 900, 2)],
    "many.pdf": [("", None)] * (2 * SPAN + 3),
}


def test_page_table_and_arrays_agree(spark):
    rows = [(n, f"/p/{n}", i, t, e) for n, pages in DOCS.items() for i, (t, e) in enumerate(pages, 1)]
    table = spark.createDataFrame(rows, PAGE_TABLE).repartition(3)
    arrays = spark.createDataFrame(
        [(n, f"/p/{n}", [dict(page_text=t, error=e) for t, e in pages], None) for n, pages in DOCS.items()],
        "file_name string, file_path string, pages array<struct<page_text string, error string>>, error string",
    )
    whole = {name: (marked(pages), len(pages)) for name, pages in DOCS.items()}
    for result in (assemble_pages(table), assemble_page_arrays(arrays)):
        assert result.schema.simpleString() == RAW_TEXT.simpleString()
        assert {r.file_name: (r.policy_text, r.page_count) for r in result.collect()} == whole


@pytest.mark.parametrize("most", [1, 10, 43, 500, 100000])
def test_parts_of_the_page_table_join_to_the_text(spark, most):
    rows = [(n, f"/p/{n}", i, t, e) for n, pages in DOCS.items() for i, (t, e) in enumerate(pages, 1)]
    rows += [("gone.pdf", "/p/gone.pdf", None, None, "damaged"), ("none.pdf", "/p/none.pdf", None, None, None)]
    table = spark.createDataFrame(rows, PAGE_TABLE)
    found = {}
    for row in page_parts(table, most).orderBy("file_name", "part_no").collect():
        found.setdefault(row.file_name, []).append(row)
    for name, pages in DOCS.items():
        parts = found.pop(name)
        assert "".join(r.body for r in parts) == marked(pages)
        assert [r.part_no for r in parts] == list(range(1, parts[0].part_count + 1))
        assert all(len(r.body) == most for r in parts[:-1]) and 0 < len(parts[-1].body) <= most
        assert {r.page_count for r in parts} == {len(pages)}
    assert not found
    whole = {r.file_name: r for r in assemble_pages(table).collect()}
    assert (whole["gone.pdf"].extraction_status, whole["gone.pdf"].error_message) == ("FAILED", "damaged")
    assert (whole["none.pdf"].extraction_status, whole["none.pdf"].policy_text, whole["none.pdf"].page_count) == ("SUCCESS", "", 0)


def test_failed_documents(spark):
    df = spark.createDataFrame(
        [("a", "/a", [dict(page_text="t", error=None)], None), ("b", "/b", None, "broken")],
        "file_name string, file_path string, pages array<struct<page_text string, error string>>, error string",
    )
    raw = assemble_page_arrays(df)
    failed = raw.filter(F.col("file_name") == "b").first()
    assert (failed.extraction_status, failed.error_message, failed.policy_text, failed.page_count) == (
        "FAILED", "broken", None, None,
    )
    assert [r.file_name for r in successful(raw).collect()] == ["a"]
    assert every_document(raw).count() == 2
