"""Documents of any size, saved manifests, and runs that repeat only what failed."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.jsonscan import ParsedDocument
from docloom.operators import element_stream
from docloom.operators.element_stream import assemble_documents, assemble_element_stream
from docloom.operators.elements import NO_CONTENT, assemble_elements
from docloom.plans import retry
from docloom.plans.runs import RunOptions
from docloom.operators import requests
from docloom.schemas import MODEL_OUTPUT
from docloom.session import stage
from docloom.sources.files import read_files
from docloom.sources.manifest import digest_files, file_changes, files_to_read, next_manifest

ELEMENTS = [
    {"type": "title", "content": "Head", "bbox": [{"page_id": 2}]}, {"type": " Page_Footer ", "content": "no"}, 5, None,
    {"type": "text", "content": " é\n\"q\" ", "bbox": [{"page_id": "3"}]}, {"content": 1.50}, {"content": True}, {"content": ""},
    {"type": "text", "content": "again on two", "bbox": [{"page_id": 2}]}, {"type": None, "content": {"a": [1]}},
]
WHOLE = json.dumps({"document": {"elements": ELEMENTS}, "error_status": []})
SHAPES = [
    WHOLE, json.dumps({"document": {"elements": ELEMENTS}, "error_status": "E1"}), None, "", "{}", "[]", "3", "not json", WHOLE + " x", WHOLE[:-1],
    '{"document":{"elements":[]}}', '{"document":{"elements":{}}}', '{"document":[1]}', '{"document":null}', '{"error_status":{"code":3}}',
    '{"document":{"elements":[{"content":"one"}]},"document":{"elements":[{"content":"two"}]}}',
    '{"document":{"elements":[{"content":"one"}],"elements":[{"content":"two"},{"content":"a","content":"b"}]}}',
    '{"document":{"elements":[{"content":NaN},{"content":"x"}]}}', '{"document":{"elements":[{"content":1},]}}', '{"a":1,}', '{"a" 1}', "﻿{}",
    ' {"document" : { "elements" : [ {"content":"spaced"} , {"content":"out"} ] } } ', '{"document":{"elements":[{"content":"x"}]},"document":7}',
]


def test_verdicts_are_those_of_json():
    rnd = random.Random(11)
    texts = [s for s in SHAPES if s] + ['{"document":{"elements":[{"a":[1,2]},{"b":"x\\u0041"}]},"k":[{}],"error_status":null}']
    for _ in range(4000):
        text = rnd.choice(texts)
        at = rnd.randrange(len(text))
        texts_of = (text[:at] + text[at + 1 :], text[:at] + rnd.choice('{}[]",: 1x\n') + text[at:], text[:at])
        for changed in texts_of:
            try:
                value, problem = json.loads(changed), None
            except ValueError as caught:
                problem = str(caught)
            try:
                read = ParsedDocument(changed)
                items = [json.loads(t) for t in read.element_texts()]
            except ValueError as caught:
                assert str(caught) == problem, changed
                continue
            assert problem is None, changed
            inner = value.get("document") if isinstance(value, dict) else None
            wanted = inner.get("elements") if isinstance(inner, dict) else None
            assert json.dumps(items).replace("NaN", '"NaN"').replace('""', '"') == json.dumps(wanted if isinstance(wanted, list) else []).replace(
                "NaN", '"NaN"'
            ).replace('""', '"')


def test_stream_equals_rows(spark, monkeypatch):
    monkeypatch.setattr(element_stream, "SPAN", 2)
    rows = [(f"f{i}.pdf", f"/x/f{i}.pdf", text) for i, text in enumerate(SHAPES)] + [("f0.pdf", "/x/f0.pdf", WHOLE)]
    parsed = spark.createDataFrame(rows, "file_name string, file_path string, parsed_doc_json string").repartition(3)
    wanted = sorted(map(tuple, assemble_elements(parsed).collect()), key=repr)
    assert sorted(map(tuple, assemble_element_stream(parsed).collect()), key=repr) == wanted
    assert sorted(map(tuple, assemble_documents(parsed, row_bytes=100).collect()), key=repr) == wanted
    assert assemble_element_stream(parsed.limit(0)).count() == 0


def test_a_document_beyond_the_limit_of_one_value(spark):
    """140 MiB of parser output in 140 elements on 70 pages."""
    element = "concat('{\"type\":\"text\",\"content\":\"', repeat(char(97 + i % 26), 1048576), '\",\"bbox\":[{\"page_id\":', (i + 1) div 2, '}]}')"
    body = f"concat('{{\"document\":{{\"elements\":[', array_join(transform(sequence(1, 140), i -> {element}), ','), ']}}}}')"
    parsed = spark.range(1).select(F.lit("big.pdf").alias("file_name"), F.lit("/big.pdf").alias("file_path"), F.expr(body).alias("parsed_doc_json"))
    row = assemble_documents(parsed).select("extraction_status", "page_count", "error_message", F.md5("policy_text").alias("md5")).first()
    pages = [
        f"=== PAGE {p} START ===\n" + "\n\n".join(chr(97 + i % 26) * 1048576 for i in (2 * p - 1, 2 * p)) + f"\n=== PAGE {p} END ===" for p in range(1, 71)
    ]
    assert tuple(row) == ("SUCCESS", 70, None, hashlib.md5("\n\n".join(pages).encode()).hexdigest())
    assert NO_CONTENT not in (row.error_message or "")


def test_manifest_of_real_files(spark, tmp_path):
    def listing():
        return read_files(spark, str(tmp_path)).select("path", "length", F.unix_micros("modificationTime").alias("modified"))

    for name, body in (("a", b"one"), ("b", b"two"), ("c", b"three"), ("d", b"four"), ("copy", b"one")):
        (tmp_path / f"{name}.pdf").write_bytes(body)
    empty = spark.createDataFrame([], "path string, length long, modified long, digest string")
    first = file_changes(listing(), empty)
    assert first.count() == files_to_read(first).count() == 5
    saved = stage(next_manifest(first), "manifest")
    assert {r.digest for r in saved.collect()} == {hashlib.sha256(x).hexdigest() for x in (b"one", b"two", b"three", b"four")}
    os.rename(tmp_path / "a.pdf", tmp_path / "z.pdf")
    os.remove(tmp_path / "b.pdf")
    (tmp_path / "c.pdf").write_bytes(b"other")
    os.utime(tmp_path / "d.pdf", (1, 1))
    (tmp_path / "n.pdf").write_bytes(b"new one")
    looked = []

    def reading(paths):
        looked.extend(r.path.rsplit("/", 1)[1] for r in paths.collect())
        return digest_files(paths)

    second = file_changes(listing(), saved, reading)
    got = {r.path.rsplit("/", 1)[1]: (r.status, r.moved_from and r.moved_from.rsplit("/", 1)[1]) for r in second.collect()}
    assert got == {
        "a.pdf": ("gone", None), "b.pdf": ("gone", None), "c.pdf": ("changed", None), "copy.pdf": ("unchanged", None), "d.pdf": ("unchanged", None),
        "n.pdf": ("new", None), "z.pdf": ("moved", "a.pdf"),
    }
    assert sorted(looked) == ["c.pdf", "d.pdf", "n.pdf", "z.pdf"]
    assert {r.path.rsplit("/", 1)[1] for r in files_to_read(second).collect()} == {"c.pdf", "n.pdf"}
    assert next_manifest(second).count() == 5


def _saved(spark, rows):
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MODEL_OUTPUT) + ", part_no int"
    made = [
        tuple({"file_name": p, "file_path": p, "extraction_status": s, "model_output_json": j, "part_no": n}.get(c) for c in [*MODEL_OUTPUT.names, "part_no"])
        for p, n, s, j in rows
    ]
    return spark.createDataFrame(made, kinds)


def test_retry_asks_only_for_failed_parts(spark, tmp_path):
    rows = [(f"/f{i}", 1, "FAILED" if i % 10 == 0 else "SUCCESS", None if i % 10 == 0 else '{"old":1}') for i in range(60)]
    rows += [("/f1", 2, "FAILED", None), ("/lost", 1, "FAILED", None), (None, 1, "FAILED", None)]
    path, calls = str(tmp_path / "out"), str(tmp_path / "calls")
    retry.save_output(_saved(spark, rows), path, buckets=8)
    before = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(path) for n in ns) if f.endswith(".parquet")}
    os.mkdir(calls)

    def completer(request):
        body = request["messages"][-1]["content"]
        open(os.path.join(calls, f"{abs(hash(body))}-{os.urandom(4).hex()}"), "w").write(body)
        if body == "text of f20":
            raise RuntimeError("still none")
        return {"choices": [{"message": {"content": '{"new":1}'}}]}

    texts = spark.createDataFrame(
        [(f"/f{i}", f"/f{i}", 1, f"text of f{i}" + "x" * (12 if i == 1 else 0)) for i in range(60)],
        "file_name string, file_path string, page_count int, policy_text string",
    )
    options = RunOptions(prompt=requests.PLACEHOLDER, max_chars=12, processed_at="t")
    got = {(r.file_path, r.part_no): (r.extraction_status, r.model_output_json, r.error_message) for r in
           retry.retry_failed(spark, path, texts, completer, "m", options, buckets=8).collect()}
    asked = sorted(open(os.path.join(calls, c)).read() for c in os.listdir(calls))
    assert asked == sorted([f"text of f{i}" for i in range(0, 60, 10)] + ["xxxxxxxxxx"])
    want = {(p, n): (s, j, None) for p, n, s, j in rows}
    want |= {(f"/f{i}", 1): ("SUCCESS", '{"new":1}', None) for i in range(0, 60, 10)} | {("/f1", 2): ("SUCCESS", '{"new":1}', None)}
    want[("/f20", 1)] = ("FAILED", None, "still none")
    assert got == want
    after = {f for d, _, ns in os.walk(path) for f in (os.path.join(d, n) for n in ns) if f.endswith(".parquet")}
    touched = {r.b for r in spark.createDataFrame([(f"/f{i}",) for i in [*range(0, 60, 10), 1]], "file_path string").select(retry._bucket(8).alias("b")).collect()}
    same = {f for f in before if int(f.split("path_bucket=")[1].split("/")[0]) not in touched}
    assert same <= after


def test_nothing_to_retry(spark, tmp_path):
    path = str(tmp_path / "out")
    retry.save_output(_saved(spark, [("/a", 1, "SUCCESS", "{}")]), path)

    def completer(request):
        raise AssertionError

    texts = spark.createDataFrame([], "file_name string, file_path string, page_count int, policy_text string")
    assert retry.retry_failed(spark, path, texts, completer, "m", RunOptions(processed_at="t")).count() == 1
    assert pytest.raises(Exception, retry.save_output, _saved(spark, []), path)
