"""Files, tables, completion and whole runs."""

import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from docloom.operators import dashboard as dash
from docloom.operators.completion import ModelSettings, complete, complete_mock, complete_replay
from docloom.operators.pages import assemble_page_arrays
from docloom.operators.requests import PROMPTS, build_requests
from docloom.operators.usage import account
from docloom.plans.runs import RunOptions, TableNames, run_extraction
from docloom.session import stage
from docloom.sources.files import list_documents, parsed_json, read_files, require_documents
from docloom.sources.tables import save_table


@pytest.fixture()
def names(spark):
    tag = uuid.uuid4().hex[:8]
    made = TableNames(*[f"t_{tag}_{part}" for part in ("raw", "out", "pol", "cov", "exp", "view")])
    yield made
    spark.sql(f"DROP VIEW IF EXISTS {made.view}")
    for table in (made.raw_text, made.output, made.policies, made.coverages, made.exposures):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_files(spark, tmp_path):
    for name in ("b.pdf", "a.PDF", "c.Pdf", "d.txt"):
        (tmp_path / name).write_bytes(name.encode())
    files = read_files(spark, str(tmp_path))
    assert sorted(r.file_name for r in list_documents(files).collect()) == ["a.PDF", "b.pdf", "c.Pdf"]
    capped = list_documents(files, 2)
    assert [r.file_name for r in capped.orderBy("file_name").collect()] == ["a.PDF", "b.pdf"]
    assert bytes(capped.filter("file_name = 'b.pdf'").first().content) == b"b.pdf"
    assert require_documents(capped, "x").count() == 2
    with pytest.raises(ValueError, match="No PDF files found in x"):
        require_documents(files.filter("false").select(F.col("path").alias("file_path")), "x")


def test_paths_and_variants(spark):
    listing = spark.createDataFrame([("dbfs:/Volumes/a/x.pdf",), ("/b/y.pdf",)], "path string")
    assert [tuple(r) for r in list_documents(listing).orderBy("file_name").collect()] == [
        ("x.pdf", "/Volumes/a/x.pdf"), ("y.pdf", "/b/y.pdf"),
    ]
    parsed = spark.createDataFrame([("x", "/x", '{"b": [1], "a": null}')], "file_name string, file_path string, j string")
    variant = parsed.withColumn("parsed_doc", F.parse_json("j"))
    assert json.loads(parsed_json(variant).first().parsed_doc_json) == {"b": [1], "a": None}


def test_requests(spark):
    texts = spark.createDataFrame(
        [("a", "/a", 2, "text {policy_text} \\1 $2"), ("b", "/b", None, None)],
        "file_name string, file_path string, page_count int, policy_text string",
    )
    whole = {"a": "text {policy_text} \\1 $2", "b": ""}
    rows = build_requests(texts, PROMPTS, max_chars=6).orderBy("file_name", "variant", "part_no").collect()
    assert [(r.file_name, r.variant, r.part_no, r.part_count, r.request_chars) for r in rows] == [
        (f, v, p + 1, n, len(whole[f][6 * p : 6 * p + 6])) for f, n in (("a", 4), ("b", 1)) for v in sorted(PROMPTS) for p in range(n)
    ]
    for row in rows:
        part = whole[row.file_name][6 * row.part_no - 6 : 6 * row.part_no]
        assert row.prompt == PROMPTS[row.variant].replace("{policy_text}", part)
        request = json.loads(row.request_json)
        assert [m["role"] for m in request["messages"]] == ["system", "user"]
        assert request["messages"][1]["content"] == row.prompt
        assert (request["temperature"], request["max_tokens"], row.page_count) == (0, 16000, None)
    row = build_requests(texts, rules="v2", json_mode=True).orderBy("file_name").first()
    request = json.loads(row.request_json)
    assert [m["role"] for m in request["messages"]] == ["user"] and "max_tokens" not in request
    assert request["response_format"] == {"type": "json_object"} and row.page_count == 2
    assert "text {policy_text} \\1 $2" in row.prompt


def one_request(spark, *prompts):
    texts = spark.createDataFrame(
        [(f"f{i}", f"/f{i}", 1, p) for i, p in enumerate(prompts)],
        "file_name string, file_path string, page_count int, policy_text string",
    )
    return build_requests(texts, {"only": "{policy_text}"})


def test_fixed_answer_is_counted_by_estimates(spark):
    fixture = {"policy_number": "TEST-001", "carrier": "Test Carrier"}
    calls = complete_mock(one_request(spark, "any prompt", "short", "x" * 10000), fixture, "declarations")
    rows = account(calls, ModelSettings(mock=True)).orderBy("file_name").collect()
    assert [r.input_tokens for r in rows] == [2, 1, 2500]
    assert {r.output_tokens for r in rows} == {14} and {r.model_used for r in rows} == {"mock"}
    assert rows[2].cost_estimate_usd == 0.00625 and rows[0].stage == "declarations"
    assert json.loads(rows[0].response_json) == fixture
    assert json.loads(complete_mock(one_request(spark, "p")).first().response_json) == {}


def test_settings_need_an_endpoint_unless_fixed():
    with pytest.raises(ValueError, match="endpoint"):
        ModelSettings(mock=False)
    assert ModelSettings(endpoint="https://example.org").model_used == "gpt-4o"


@pytest.fixture()
def fake_model():
    def answer(request):
        text = request["messages"][-1]["content"]
        if "explode" in text:
            raise RuntimeError("no capacity")
        coverages = [{"coverage_name": "c"}] * len(text)
        body = json.dumps({"policy": {"policy_number": text[:3], "carrier": "é"}, "coverages": coverages})
        return {"choices": [{"message": {"content": body}}], "usage": {"prompt_tokens": 1000, "completion_tokens": 7}}

    return answer


@pytest.mark.parametrize("parallelism", [None, 3])
def test_completion_keeps_failed_calls(spark, fake_model, parallelism):
    requests = one_request(spark, "abc", "explode", "wxyz")
    calls = stage(complete(requests, fake_model, parallelism, "s"), "calls")
    rows = account(calls, ModelSettings(endpoint="e")).orderBy("file_name").collect()
    assert [r.call_error for r in rows] == [None, "no capacity", None]
    assert rows[1].response_json is None and rows[1].output_tokens == 0
    assert (rows[0].input_tokens, rows[0].output_tokens, rows[0].cost_estimate_usd) == (1000, 7, 0.00257)
    assert json.loads(rows[2].response_json) == fake_model({"messages": [{"content": "wxyz"}]})


def test_replay(spark):
    stored = spark.createDataFrame([("/f0", "only", '{"text": "{}"}')], "file_path string, variant string, response_json string")
    rows = complete_replay(one_request(spark, "a", "b"), stored).orderBy("file_name").collect()
    assert [(r.response_json, r.call_error) for r in rows] == [('{"text": "{}"}', None), (None, "no stored response")]


@pytest.fixture()
def raw_text(spark):
    pages = "file_name string, file_path string, pages array<struct<page_text string, error string>>, error string"
    page = [{"page_text": "t", "error": None}]
    return assemble_page_arrays(
        spark.createDataFrame([("a.pdf", "/x/a.pdf", page, None), ("b.pdf", "/x/b.pdf", None, "broken")], pages)
    )


@pytest.mark.parametrize("rules,files", [("v1", ["a.pdf", "b.pdf"]), ("v2", ["a.pdf"])])
def test_stub_run(spark, names, raw_text, rules, files):
    view = run_extraction(raw_text, names, RunOptions(rules=rules), ModelSettings(mock=True))
    rows = dash.dashboard_rows(view).collect()
    assert [(r.file_name, r.coverage_count) for r in rows] == [(f, 1) for f in files]
    output = spark.table(names.output).orderBy("file_name").first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}", output.processed_at)
    assert (output.model_name, output.page_count) == ("STUB", 1 if rules == "v2" else None)
    assert spark.table(names.raw_text).count() == 2 and spark.table(names.texts).count() == len(files)
    assert spark.table(names.exposures).count() == len(files)
    assert ("coverage_type" in spark.table(names.coverages).columns) == (rules == "v2")


def test_model_run_and_reads(spark, names, raw_text, fake_model):
    options = RunOptions(prompt="{policy_text}!", processed_at="now")
    view = run_extraction(raw_text, names, options, ModelSettings(endpoint="e", deployment_name="m"), fake_model)
    text = "=== PAGE 1 START ===\nt\n=== PAGE 1 END ===!"
    rows = dash.dashboard_rows(dash.require_policies(view, names.view)).collect()
    assert [(r.file_name, r.policy_number, r.coverage_count) for r in rows] == [("a.pdf", "===", len(text)), ("b.pdf", "!", 1)]
    assert [r.file_name for r in dash.file_options(view).collect()] == ["a.pdf", "b.pdf"]
    detail = dash.coverage_detail_query(spark, names.coverages, "a.pdf")
    assert detail.columns == dash.DETAIL_COLUMNS and detail.count() == len(text)
    assert dash.coverage_detail_query(spark, names.coverages, "x' OR '1'='1").count() == 0
    with pytest.raises(ValueError, match="No policy data found in v"):
        dash.require_policies(view.filter("false"), "v")


def test_overwrite_changes_schema(spark, names):
    save_table(spark.range(2), names.raw_text)
    assert save_table(spark.range(1).withColumn("x", F.lit("y")), names.raw_text).columns == ["id", "x"]


def entity_tables(spark):
    head = "file_name string, file_path string, policy_number string, carrier string, named_insured string, "
    head += "effective_date string, expiration_date string, policy_type string, claims_made_or_occurrence string, policy_confidence double"
    tail = ("c", None, "d", "e", "t", None, 0.5)
    policies = [
        ("a", "/1/a", "P1", *tail), ("a", "/1/a", "P1", *tail), ("a", "/1/a", "P2", *tail), ("a", "/2/a", "P3", *tail),
        (None, "/3/x", "P4", *tail), (None, "/3/x", "P4", *tail), ("z", "/4/z", "P5", *tail),
    ]
    coverages = [("a", "/1/a", "c1"), ("a", "/1/a", "c2"), ("a", "/1/a", None), ("a", "/2/a", "c1"), (None, "/3/x", "c1"), ("q", "/9", "c")]
    return spark.createDataFrame(policies, head), spark.createDataFrame(coverages, "file_name string, file_path string, coverage_name string")


def test_dashboard_forms_agree_on_copies_and_nulls(spark, names):
    policies, coverages = entity_tables(spark)
    expected = sorted([("P1", 4), ("P2", 2), ("P3", 1), ("P4", 0), ("P5", 0)])
    for form in (dash.dashboard, dash.dashboard_joined):
        assert sorted((r.policy_number, r.coverage_count) for r in form(policies, coverages).collect()) == expected
    save_table(policies, names.policies)
    save_table(coverages, names.coverages)
    view = dash.create_dashboard_view(spark, names.view, names.policies, names.coverages)
    assert view.columns == [*dash.COLUMNS, "coverage_count"]
    assert sorted((r.policy_number, r.coverage_count) for r in view.collect()) == expected
    detail = spark.table(names.coverages).filter("file_name = 'a'")
    assert detail.count() == 4  # both paths of the name


def test_dashboard_from_output_counts_copies(spark):
    from docloom.operators import entities

    def body(number, count):
        return json.dumps({"policy": {"policy_number": number}, "coverages": [{"coverage_name": "c"}] * count + [None]})

    rows = [("a", "/a", body("P1", 2)), ("a", "/a", body("P1", 1)), ("a", "/a", body("P2", 0)), (None, "/n", body("P3", 4)), ("e", "/e", '{"policy": {}}')]
    output = spark.createDataFrame(
        [(n, p, "SUCCESS", j) for n, p, j in rows] + [("f", "/f", "FAILED", None)],
        "file_name string, file_path string, extraction_status string, model_output_json string",
    )
    parsed = entities.parse_output(output)
    direct = dash.dashboard_from_output(parsed)
    joined = dash.dashboard_joined(entities.policies(parsed), entities.coverages(parsed))
    assert sorted(map(str, direct.collect())) == sorted(map(str, joined.collect()))
    assert {r.policy_number: r.coverage_count for r in direct.collect()} == {"P1": 6, "P2": 3, "P3": 0, None: 0}
