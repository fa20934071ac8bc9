"""Content, truncation, isolation and repair."""

import json

import pytest

from docloom.functions.envelope import plain_form
from docloom.functions.jsontext import SPARK_BYTES, close_truncated
from docloom.functions.text import ascii_json_length, drop_fences, strip
from docloom.operators.responses import BAD_ENVELOPE, NO_TEXT, clean_responses, model_output
from docloom.schemas import MODEL_OUTPUT, RESPONSES
from pyspark.sql import functions as F


def run(spark, responses, rules="v1"):
    rows = [
        (f"f{i:03}", f"/p/f{i:03}", 3, 10, body if body is None or isinstance(body, str) else json.dumps(body), None)
        for i, body in enumerate(responses)
    ]
    df = spark.createDataFrame(rows, RESPONSES)
    return clean_responses(df, "m", "2026-01-01T00:00:00", rules).orderBy("file_name").collect()


def chat(content, finish="stop", tokens=10):
    return {
        "choices": [{"message": {"content": content}, "finish_reason": finish}],
        "usage": {"completion_tokens": tokens},
    }


ISOLATION = [
    ('```json\n{"a":1}\n```', '{"a":1}', None),
    ('```JSON\n{"a":1}\n```', '{"a":1}', None),
    ('Sure! {"a":1} thanks', '{"a":1}', None),
    ('{"a":1} {"b":2}', None, "Extra data"),
    ("5", "5", None),
    (" \x1c　\n", None, "Could not isolate valid JSON from model output: "),
    ('{"a":1,"a":2}', '{"a":1,"a":2}', None),
    ("NaN", "NaN", None),
    ('{"a": "b\nc"}', None, "Invalid control character"),
    ('[NaN, {"b":1}]', '[NaN, {"b":1}]', None),
    ('x [1, {"b":1}]', '{"b":1}', None),
    ('{"a":1}} z', None, "Extra data"),
    ("} {", None, "Could not isolate valid JSON from model output: } {"),
    ('{"a":01} ', None, "Expecting ',' delimiter"),
    ("``````", None, "Could not isolate"),
    ('```{"a":1}```', '{"a":1}', None),
]


@pytest.mark.parametrize("rules", ["v1", "v2"])
def test_isolation(spark, rules):
    rows = run(spark, [chat(content) for content, _, _ in ISOLATION], rules)
    for row, (content, expected, error) in zip(rows, ISOLATION):
        assert row.model_output_json == expected, content
        assert row.extraction_status == ("SUCCESS" if expected is not None else "FAILED")
        assert row.raw_model_response == content
        assert (row.error_message or "").startswith(error or ""), content
        assert (row.error_message is None) == (error is None)


CUTS = [
    (
        '{"policy": {"policy_number": "P1"}, "coverages": [{"coverage_name": "A", "limit_amount": 5},',
        '{"policy": {"policy_number": "P1"}, "coverages": [{"coverage_name": "A", "limit_amount": 5}]}',
    ),
    ('{"a": 1, "b": [1, 2', '{"a": 1, "b": [1, 2]}'),
    ('{"a": 1, "', '{"a": 1}'),
    ('Here: {"a": [{"b": 1}, {"c": 2', '{"a": [{"b": 1}, {"c": 2}]}'),
    ('{"a": 1, "b": "', None),
    ('{"a": 1, "b": "hel', None),
    ('{"a": 1, "b"', None),
    ('{"a": 1, "b":', None),
    ('{"a": tru', None),
    ('{"a": "x\\"', None),
    ('{"a": 1.', None),
    ('{"limit": 50', '{"limit": 50}'),
    ("no object", None),
    ('{"a": "br{ace [", "b": [{"c": "\\"]}"', None),  # an odd count, as escaped quotes are counted too
    ('{"a": "br{ace [", "b": [{"c": "\\"]}\\""', '{"a": "br{ace [", "b": [{"c": "\\"]}\\""}]}'),
    ('```json\n{"a": [1, 2],  ', '{"a": [1, 2]}'),
]


@pytest.mark.parametrize("rules", ["v1", "v2"])
def test_repair_only_when_truncated(spark, rules):
    rows = run(spark, [chat(text, "length") for text, _ in CUTS], rules)
    for row, (text, expected) in zip(rows, CUTS):
        assert row.model_output_json == expected, text
        assert row.was_truncated and row.was_repaired == (expected is not None)
    assert rows[12].error_message == "No JSON object found in text"
    for row in run(spark, [chat(text) for text, _ in CUTS], rules):
        assert row.extraction_status == "FAILED" and not row.was_truncated


def test_repair_text_by_rule_set(spark):
    cut = [chat('{"a":1,"b":[1,2', "length")]
    assert run(spark, cut, "v1")[0].model_output_json == '{"a": 1, "b": [1, 2]}'
    assert run(spark, cut, "v2")[0].model_output_json == '{"a":1,"b":[1,2]}'
    assert close_truncated('{"a":1,"b":[1,2') == '{"a":1,"b":[1,2]}'


def test_content_v1(spark):
    body = '{"a": 1}'
    cases = [
        chat(body), {"output_text": body}, {"text": [body]}, {"predictions": [{"text": body}]},
        {"candidates": [{"text": "", "content": body}]}, {"error": "boom"}, {"choices": [], "prediction": body},
        chat([{"type": "text", "text": "{}"}]), {"choices": [{"message": None}], "text": body}, {"output_text": ""},
        {"choices": ["x"], "text": body}, {"choices": [{"message": {"content": body}}], "usage": {"completion_tokens": None}},
        {"choices": [{"message": {"content": ""}}], "text": body},
        {"predictions": [{"text": 7}]}, {"choices": {"message": 1}},
    ]
    rows = run(spark, cases)
    assert [r.model_output_json for r in rows] == [
        body, body, body, body, body, '{"error": "boom"}', body, None, body, None, None, None, body, None,
        '{"choices": {"message": 1}}',
    ]
    assert rows[7].error_message == "'list' object has no attribute 'strip'"
    assert rows[9].error_message == "Could not isolate valid JSON from model output: "
    assert rows[10].error_message == "'str' object has no attribute 'get'"
    assert rows[11].error_message == "'>=' not supported between instances of 'NoneType' and 'int'"
    assert rows[11].raw_model_response == body
    assert rows[13].error_message == "'int' object has no attribute 'strip'"
    assert {r.page_count for r in rows} == {None}


def test_content_v2(spark):
    parts = [{"type": "text", "text": '{"a":'}, {"type": "image"}, 4, {"type": "text", "text": ""}, {"type": "text", "text": "1}"}]
    cases = [
        chat('{"a":1}'), chat(parts), {"output_text": "t"}, {"error": "boom"}, chat(""), chat([]), chat(None),
        {"choices": [{"message": None}]}, {"choices": [5]}, {"choices": [{}]},
    ]
    rows = run(spark, cases, "v2")
    assert [r.model_output_json for r in rows] == ['{"a":1}', '{"a":\n1}'] + [None] * 8
    assert rows[3].error_message == 'No choices returned by model: {"error": "boom"}'
    assert rows[3].raw_model_response is None
    assert rows[4].error_message == "Could not isolate valid JSON from model output: "
    assert rows[5].error_message.startswith("Unable to extract text content from model response: ")
    assert rows[7].error_message == "'NoneType' object has no attribute 'get'"
    assert rows[8].error_message == "'int' object has no attribute 'get'"
    assert rows[9].error_message.startswith("Unable to extract text content")
    assert {r.page_count for r in rows} == {3}


def test_truncation_flags(spark):
    cases = [
        chat("{}", "length"), chat("{}", "max_tokens", 100), chat("{}", "stop", 15900), chat("{}", "stop", 15899),
        {"choices": [{"message": {"content": "{}"}}]}, {"usage": {"completion_tokens": 16000.0}, "text": "{}"},
    ]
    assert [r.was_truncated for r in run(spark, cases, "v1")] == [True, False, True, False, False, True]
    assert [r.was_truncated for r in run(spark, cases, "v2")] == [True, True, False, False, False, False]


def test_failed_calls_stay_rows(spark):
    df = spark.createDataFrame(
        [("a", "/a", 1, 5, None, "timeout"), ("b", "/b", 1, 5, None, None), ("c", "/c", 1, 5, "{oops", None)], RESPONSES
    )
    cleaned = clean_responses(df, "m", "now")
    assert [r.error_message for r in cleaned.orderBy("file_name").collect()] == [
        "timeout", "stored response is not valid JSON", "stored response is not valid JSON",
    ]
    assert model_output(cleaned).schema.simpleString() == MODEL_OUTPUT.simpleString()


def test_string_helpers_match_python(spark):
    samples = ["\x1c a b \x85", "", " \n", "é\"\\\n\x7f\x00", "😀 x", "```json {} ```", "a``````", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    out = df.select("s", strip(F.col("s")).alias("t"), ascii_json_length(F.col("s")).alias("n"), drop_fences(strip(F.col("s"))).alias("f"))
    for row in out.collect():
        assert row.t == row.s.strip()
        assert row.n == len(json.dumps(row.s))
    assert [r.f for r in out.collect()][5:7] == ["{}", "a```"]


def test_spark_and_python_agree_on_what_is_json(spark):
    """Texts settled by Spark's parser come out as Python alone would settle them."""
    import random

    from docloom.functions.jsontext import _settle_one, clean_json

    pick = random.Random(5)
    pieces = ["{", "}", "[", "]", '"', ":", ",", " ", "\n", "a", "1", "-0", "1.5e3", "NaN", "null", "true", "\\", "\\u0041", '"k":', '{"k":1}', "\x01", "é"]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randrange(1, 9))) for _ in range(6000)]
    whole = json.dumps({"policy": {"n": 'a"b\\c'}, "coverages": [{"x": [1, 2.5, None, True], "y": "]}"}] * 2})
    texts += [whole[: pick.randrange(1, len(whole))] + pick.choice(["", "}", "]}", " z", '"}']) for _ in range(1500)]
    texts = [text.strip() for text in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    natively = {r.i: r.c for r in df.select("i", clean_json(F.col("t")).alias("c")).collect() if r.c is not None}
    assert len(natively) > 300
    for i, found in natively.items():
        assert _settle_one(texts[i], False, False) == (found, False, None), texts[i]

LONG_TEXT = "long " * 40_000

ODD_ENVELOPES = [
    ('{"choices":[],"choices":[{"message":{"content":"{}"}}]}', "SUCCESS", "SUCCESS", "{}"),
    ('{"choices":[{"message":{"content":"{}"}}],"usage":{"completion_tokens":NaN}}', "SUCCESS", "SUCCESS", "{}"),
    ('{"choices":[{"message":{"content":"{}"}}]} junk', "FAILED", "FAILED", None),
    ('{"choices":[{"message":{"content":NaN}}]}', "FAILED", "FAILED", None),
    ('{"choices":[{"message":{"content":"{}"}}', "FAILED", "FAILED", None),
    ("", "FAILED", "FAILED", None),
    (None, "FAILED", "FAILED", None),
]


@pytest.mark.parametrize("rules", ["v1", "v2"])
def test_envelopes_are_judged_as_python_does(spark, rules):
    rows = run(spark, [body for body, *_ in ODD_ENVELOPES], rules)
    for row, (body, first, second, output) in zip(rows, ODD_ENVELOPES):
        assert row.extraction_status == (first if rules == "v1" else second), body
        assert row.model_output_json == output, body
    messages = [row.error_message for row in rows]
    assert messages[2] == messages[4] == messages[5] == messages[6] == BAD_ENVELOPE
    if rules == "v1":
        assert messages[3] == "'float' object has no attribute 'strip'" and rows[3].raw_model_response == "NaN"
    else:
        assert messages[3] == NO_TEXT + ODD_ENVELOPES[3][0]


def test_infinite_budget_is_full(spark):
    body = '{"choices":[{"message":{"content":"{\\"a\\":[1,"}}],"usage":{"completion_tokens":Infinity}}'
    (row,) = run(spark, [body])
    assert row.was_truncated and row.model_output_json == '{"a": [1]}'


def test_plain_form_sets_long_strings_aside():
    content = json.dumps({"a": LONG_TEXT})
    text = json.dumps({"choices": [{"message": {"content": [{"type": "text", "text": content}]}}, 2], "other": [LONG_TEXT], "usage": {"n": 1}})
    accepted, form, marks, strings = plain_form(text, ("choices", "usage"), longest=1000, aside=100)
    assert accepted and len(form) < 1000 and strings == [content]
    part = {"type": "text", "text": marks[0]}
    assert json.loads(form) == {"choices": [{"message": {"content": [part]}}], "usage": {"n": 1}}
    assert plain_form(text, ("choices",)) == (True, text, [], [])


def test_response_beyond_a_variant(spark):
    """A response that Spark's parser is not asked about, in two parts, is cleaned like a small one."""
    size = SPARK_BYTES // 2 + 1000
    half = F.concat(F.lit('\\"'), F.repeat(F.lit("x"), size))
    part = lambda text: F.concat(F.lit('{"type":"text","text":"'), text, F.lit('"}'))
    whole = F.concat(
        F.lit('{"choices":[{"finish_reason":"stop","message":{"content":['), part(F.concat(F.lit('{\\"a\\":'), half, F.lit('\\"'))), F.lit(","),
        part(F.concat(F.lit(',\\"b\\":'), half, F.lit('\\"}'))), F.lit("]}}]}"),
    )
    row = spark.range(1).select(
        F.lit("f").alias("file_name"), F.lit("/f").alias("file_path"), F.lit(1).alias("page_count"), F.lit(1).alias("request_chars"),
        whole.alias("response_json"), F.lit(None).cast("string").alias("call_error"),
    )
    (found,) = clean_responses(row, "m", "t", "v2").select(
        "extraction_status", F.length("model_output_json").alias("n"), F.substr("model_output_json", F.lit(1), F.lit(8)).alias("head"), "error_message"
    ).collect()
    assert found.error_message is None and found.extraction_status == "SUCCESS"
    assert found.n == 2 * size + 16 and found.head == '{"a":"xx'
