"""Stored model responses to model-output rows: content, truncation flag, clean or repaired JSON.

Rule set ``v1`` tries several places for the content and treats a nearly full token budget as
truncated; ``v2`` accepts only message content, also in parts, and two finish reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.envelope import read_envelopes, shown_number, whole_text
from docloom.functions.jsontext import clean_json, settle_json
from docloom.functions.text import drop_fences, strip
from docloom.functions.variant import NUMBERS, at, kind, python_name, text_of, truthy
from docloom.schemas import MODEL_OUTPUT

# Fixed values.
FALLBACK_KEYS = ("output_text", "text", "prediction", "predictions", "candidates")
FULL_BUDGET = 15_900
CUT_REASONS = {"v1": ("length",), "v2": ("length", "max_tokens")}
NO_CHOICES = "No choices returned by model: "
NO_TEXT = "Unable to extract text content from model response: "

BAD_ENVELOPE = "stored response is not valid JSON"
UNREAD_ENVELOPE = "stored response holds more than can be read"
# Top-level keys that are read.
READ_KEYS = ("choices", "usage", *FALLBACK_KEYS)
FLAGS = ("was_truncated", "was_repaired")


def _no_attribute(owner: Column, attribute: str) -> Column:
    return F.concat(F.lit("'"), python_name(owner), F.lit(f"' object has no attribute '{attribute}'"))


def _fallback() -> Column:
    """The first usable value of ``doc`` besides the message content: a string, or a list's first string or text."""
    paths = [
        (key + part, nested)
        for key in FALLBACK_KEYS
        for part, nested in (("", False), ("[0]", False), ("[0].text", True), ("[0].content", True))
    ]
    found = ", ".join(
        f"named_struct('value', try_variant_get(doc, '$.{path}', 'variant'), 'nested', {nested})" for path, nested in paths
    )
    usable = F.filter(
        F.expr(f"array({found})"),
        lambda c: F.when(c["nested"], truthy(c["value"])).otherwise(kind(c["value"]) == "STRING"),
    )
    return F.get(usable, F.lit(0))["value"]


def _content_v1(envelopes: DataFrame) -> DataFrame:
    doc, picked = F.col("doc"), F.col("picked")
    main = envelopes.withColumn("main", at(doc, "$.choices[0].message.content"))
    chosen = main.withColumn("picked", F.when(truthy(F.col("main")), F.col("main")).otherwise(_fallback()))
    # The whole response stands in when nothing else is there.
    content = F.when(picked.isNull(), F.col("response_json")).when(
        kind(picked).isin(*NUMBERS), shown_number(text_of(picked))
    ).otherwise(text_of(picked))
    return chosen.select(
        "*",
        content.alias("content"),
        F.when(picked.isNotNull() & (kind(picked) != "STRING"), _no_attribute(picked, "strip")).alias("unusable"),
        F.lit(None).cast("string").alias("content_error"),
    )


def _content_v2(envelopes: DataFrame) -> DataFrame:
    doc, main = F.col("doc"), F.col("main")
    response = F.col("response_json")
    choice, message = at(doc, "$.choices[0]"), at(doc, "$.choices[0].message")
    parts = F.transform(
        F.filter(
            F.try_variant_get(main, "$", "array<variant>"),
            lambda part: (text_of(part, "$.type") == "text") & truthy(at(part, "$.text")),
        ),
        lambda part: at(part, "$.text"),
    )
    joined = F.array_join(F.transform(parts, lambda text: text_of(text)), "\n")
    all_text = ~F.exists(parts, lambda text: kind(text) != "STRING")
    content = F.when(kind(main) == "STRING", text_of(main)).when((kind(main) == "ARRAY") & all_text & (joined != ""), joined)
    problem = (
        F.when(~truthy(at(doc, "$.choices")), F.concat(F.lit(NO_CHOICES), response))
        .when(kind(choice).isNull(), F.concat(F.lit(NO_TEXT), response))
        .when(kind(choice) != "OBJECT", _no_attribute(choice, "get"))
        .when(message.isNotNull() & (kind(message) != "OBJECT"), _no_attribute(message, "get"))
        .when(F.col("content").isNull(), F.concat(F.lit(NO_TEXT), response))
    )
    return (
        envelopes.withColumn("main", at(doc, "$.choices[0].message.content"))
        .withColumn("content", content)
        .select("*", F.lit(None).cast("string").alias("unusable"), problem.alias("content_error"))
    )


def _truncation(doc: Column, rules: str) -> tuple[Column, Column]:
    """The flag, and the message where reading it fails."""
    choice = at(doc, "$.choices[0]")
    cut = F.coalesce(text_of(doc, "$.choices[0].finish_reason").isin(*CUT_REASONS[rules]), F.lit(False))
    if rules == "v2":
        return cut, F.lit(None).cast("string")
    used = at(doc, "$.usage.completion_tokens")
    full = kind(used).isin(*NUMBERS) & (F.try_variant_get(used, "$", "double") >= FULL_BUDGET)
    problem = F.when(choice.isNotNull() & (kind(choice) != "OBJECT"), _no_attribute(choice, "get")).when(
        ~cut & used.isNotNull() & ~kind(used).isin(*NUMBERS, "BOOLEAN"),
        F.concat(F.lit("'>=' not supported between instances of '"), python_name(used), F.lit("' and 'int'")),
    )
    return cut | F.coalesce(full, F.lit(False)), problem


def clean_responses(responses: DataFrame, model_name: str, processed_at: str, rules: str = "v1") -> DataFrame:
    """Response rows to model-output rows plus the flags ``was_truncated`` and ``was_repaired``.

    Input columns: file_name, file_path, page_count, request_chars, response_json, call_error. Every row
    yields a row; ``part_no`` is carried where it is given. One that cannot be used has status FAILED, its message and the content if it was read.
    Responses are JSON by Python's rules: NaN and repeated keys are accepted, text after the value is not, and size does not matter.
    """
    part = [c for c in ("part_no",) if c in responses.columns]
    keys = ["file_name", "file_path", "page_count", "request_chars", "response_json", "call_error", *part]
    envelopes = read_envelopes(responses.select(*keys), "response_json", READ_KEYS)
    contents = _content_v1(envelopes) if rules == "v1" else _content_v2(envelopes)
    cut, cut_problem = _truncation(F.col("doc"), rules)
    no_envelope = F.coalesce(
        F.col("call_error"),
        F.when(~F.coalesce("accepted", F.lit(False)), F.lit(BAD_ENVELOPE)).when(F.col("doc").isNull(), F.lit(UNREAD_ENVELOPE)),
    )
    read = contents.select(
        *keys[:4],
        *part,
        cut.alias("was_truncated"),
        no_envelope.alias("call_problem"),
        F.coalesce(no_envelope, F.col("content_error")).alias("read_problem"),
        F.coalesce(cut_problem, F.col("unusable")).alias("use_problem"),
        F.when(no_envelope.isNull(), whole_text(F.col("content"))).alias("content"),
    )
    usable = F.col("read_problem").isNull() & F.col("use_problem").isNull()
    bodies = read.withColumn("stripped", F.when(usable, strip(F.coalesce("content", F.lit(""))))).withColumn(
        "body", drop_fences(F.col("stripped"))
    )
    settled = bodies.withColumn("clean", clean_json(F.col("body"))).withColumn(
        "other",
        settle_json(F.when(F.col("clean").isNull(), F.col("body")), F.col("was_truncated"), reserialise=rules == "v1"),
    )
    output = F.coalesce(F.col("clean"), F.col("other.json"))
    pages = (F.col("page_count") if rules == "v2" else F.lit(None)).cast("int")
    return settled.select(
        "file_name",
        "file_path",
        pages.alias("page_count"),
        F.col("request_chars").cast("long").alias("request_chars"),
        F.lit(model_name).alias("model_name"),
        F.when(output.isNotNull(), F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("extraction_status"),
        output.alias("model_output_json"),
        F.when(F.col("read_problem").isNull(), F.col("content")).alias("raw_model_response"),
        F.coalesce(F.col("read_problem"), F.col("use_problem"), F.col("other.error")).alias("error_message"),
        F.lit(processed_at).alias("processed_at"),
        F.coalesce(F.col("was_truncated"), F.lit(False)).alias("was_truncated"),
        F.coalesce(F.col("other.repaired"), F.lit(False)).alias("was_repaired"),
        *part,
    )


def model_output(cleaned: DataFrame) -> DataFrame:
    """The ten columns of the model-output table, and ``part_no`` where the requests had parts."""
    return cleaned.select(*MODEL_OUTPUT.names, *[c for c in ("part_no",) if c in cleaned.columns])
