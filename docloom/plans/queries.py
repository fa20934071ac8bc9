"""Every job over the inputs derived from the given tables, as (session, folder) to DataFrame."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.operators import compare, contracts, dashboard, entities, normalize, pages, requests, responses, terms, usage
from docloom.operators.completion import complete, complete_mock, complete_replay
from docloom.operators.element_stream import assemble_element_stream
from docloom.operators.elements import assemble_elements
from docloom.plans import corpus, retry
from docloom.plans.runs import RunOptions
from docloom.session import stage, staging_path
from docloom.sources.arrivals import first_arrivals, take_arrivals
from docloom.sources.files import list_documents, parsed_json
from docloom.sources.manifest import file_changes
from docloom.sources.tables import save_table

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = "2026-01-01T00:00:00"
MODEL = "replay"
LISTED = 100
PART_CHARS = 700
CHOSEN_FILE = "policy_7.pdf"
_ALL: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _ALL[build.__name__] = build
    return build


def _joined(array: str) -> Column:
    """An array of page numbers as text, which both engines compare alike."""
    return F.array_join(F.col(array).cast("array<string>"), ",").alias(array)


# Ingest


@_query
def file_listing(spark, sf_dir):
    return list_documents(corpus.listing(spark, sf_dir))


@_query
def file_listing_capped(spark, sf_dir):
    return list_documents(corpus.listing(spark, sf_dir), LISTED)


@_query
def manifest_changes(spark, sf_dir):
    """What became of each file since the saved manifest; digests are read for files that look different only."""
    listed, saved = corpus.listing_now(spark, sf_dir), corpus.saved_manifest(spark, sf_dir)
    contents = listed.select("path", "digest")
    found = file_changes(listed.drop("digest"), saved, lambda paths: contents.join(paths, "path", "left_semi"))
    return found.select("path", "status", "length", "modified", "digest", "moved_from")


# Page assembly


@_query
def page_text_arrays(spark, sf_dir):
    return pages.assemble_page_arrays(corpus.page_arrays(spark, sf_dir))


@_query
def page_text_pages(spark, sf_dir):
    return pages.assemble_pages(corpus.page_table(spark, sf_dir))


@_query
def page_text_arrivals(spark, sf_dir):
    """The page table sent in files, a fifth of the documents twice, taken by a stream in several batches."""
    arriving, saved, progress = (staging_path(spark, name) for name in ("arriving", "arrived", "arrivals-progress"))
    sent = corpus.page_table(spark, sf_dir)
    again = F.regexp_extract("file_name", "[0-9]+", 0).cast("long") % 5 == 0
    sent.write.parquet(arriving)
    sent.filter(again).write.mode("append").parquet(arriving)
    take_arrivals(spark, arriving, sent.schema, saved, progress, files_at_once=16)
    return pages.assemble_pages(first_arrivals(spark.read.parquet(saved)))


@_query
def page_text_elements(spark, sf_dir):
    return assemble_elements(corpus.parsed_documents(spark, sf_dir))


@_query
def page_text_streamed(spark, sf_dir):
    """Every document through the element stream, whatever its size."""
    return assemble_element_stream(corpus.parsed_documents(spark, sf_dir))


@_query
def variant_documents(spark, sf_dir):
    """Parser output as VARIANT, through JSON text, to marked text."""
    parsed = corpus.parsed_documents(spark, sf_dir).withColumn("parsed_doc", F.try_parse_json("parsed_doc_json"))
    return assemble_elements(parsed_json(parsed)).withColumn("policy_text", F.md5("policy_text"))


@_query
def document_status(spark, sf_dir):
    texts = assemble_elements(corpus.parsed_documents(spark, sf_dir))
    return texts.groupBy("extraction_status", "error_message").agg(
        F.count(F.lit(1)).alias("document_count"), F.sum("page_count").alias("page_total")
    )


# Requests


def _request_summary(built: DataFrame) -> DataFrame:
    return built.select(
        "file_path", "page_count", "variant", "part_no", "part_count", "request_chars", F.md5("prompt").alias("prompt_md5"),
        F.length(F.get_json_object("request_json", "$.messages[0].content")).alias("first_message_chars"),
    )


@_query
def request_build(spark, sf_dir):
    texts = pages.every_document(pages.assemble_page_arrays(corpus.page_arrays(spark, sf_dir)))
    return _request_summary(requests.build_requests(texts))


@_query
def request_variants(spark, sf_dir):
    parts = pages.page_parts(corpus.page_table(spark, sf_dir), requests.MAX_CHARS)
    return _request_summary(requests.requests_of_parts(parts, requests.PROMPTS, rules="v2"))


@_query
def request_parts(spark, sf_dir):
    """Small parts, so that many documents have several."""
    texts = pages.every_document(pages.assemble_page_arrays(corpus.page_arrays(spark, sf_dir)))
    return _request_summary(requests.build_requests(texts, max_chars=PART_CHARS))


@_query
def request_parts_pages(spark, sf_dir):
    """The same parts made from the page table, without a document's text in one group."""
    return _request_summary(requests.requests_of_parts(pages.page_parts(corpus.page_table(spark, sf_dir), PART_CHARS), rules="v2"))


# Completion and cleaning


def _texts(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select(
        "file_name", "file_path", F.size("lines").alias("page_count"), F.col("text").alias("policy_text")
    )


@_query
def stub_run_v1(spark, sf_dir):
    return requests.stub_run(_texts(spark, sf_dir), RUN_TIME, "v1")


@_query
def stub_run_v2(spark, sf_dir):
    return requests.stub_run(_texts(spark, sf_dir), RUN_TIME, "v2")


@_query
def replay_run(spark, sf_dir):
    built = requests.build_requests(_texts(spark, sf_dir), rules="v2")
    stored = corpus.stored_responses(spark, sf_dir).withColumn("variant", F.lit("baseline"))
    answered = complete_replay(built, stored)
    cleaned = responses.clean_responses(answered, MODEL, RUN_TIME, "v2")
    return cleaned.select("file_path", "page_count", "part_no", "request_chars", "extraction_status", "was_repaired")


def _scripted(request: dict) -> dict:
    """A model that answers with the length of what it is asked, and has no capacity for every seventh length."""
    length = len(request["messages"][-1]["content"])
    if length % 7 == 0:
        raise RuntimeError("no capacity")
    body = json.dumps({"policy": {"policy_number": str(length)}})
    return {"choices": [{"message": {"content": body}}], "usage": {"prompt_tokens": length, "completion_tokens": 5}}


def _calls(spark, sf_dir):
    built = requests.build_requests(_texts(spark, sf_dir), {"only": requests.PLACEHOLDER}, max_chars=PART_CHARS)
    return complete(built, _scripted, stage="extraction")


@_query
def completion_run(spark, sf_dir):
    """Calls inside the tasks, some of which fail, to model output."""
    return responses.model_output(responses.clean_responses(_calls(spark, sf_dir), MODEL, RUN_TIME)).select(
        "file_path", "part_no", "request_chars", "extraction_status", "model_output_json", "error_message"
    )


def _scripted_again(request: dict) -> dict:
    """A model that has capacity by now; it must not be asked for what was answered before."""
    length = len(request["messages"][-1]["content"])
    if length % 7:
        raise RuntimeError("asked twice")
    return {"choices": [{"message": {"content": json.dumps({"policy": {"policy_number": f"again {length}"}})}}]}


@_query
def retry_run(spark, sf_dir):
    """Failed calls of a saved run asked again, with the rest of the saved table as it was."""
    path = staging_path(spark, "saved-output")
    retry.save_output(responses.model_output(responses.clean_responses(_calls(spark, sf_dir), MODEL, RUN_TIME)), path)
    options = RunOptions(prompt=requests.PLACEHOLDER, max_chars=PART_CHARS, processed_at=RUN_TIME)
    return retry.retry_failed(spark, path, _texts(spark, sf_dir), _scripted_again, MODEL, options).select(
        "file_path", "part_no", "request_chars", "extraction_status", "model_output_json", "error_message"
    )


@_query
def policy_of_parts(spark, sf_dir):
    """One policy row per document, from the answers to all its parts."""
    output = responses.model_output(responses.clean_responses(_calls(spark, sf_dir), MODEL, RUN_TIME))
    return entities.policies(entities.parse_output(output)).select("file_path", "policy_number")


@_query
def reported_usage(spark, sf_dir):
    """Tokens as the model reports them in place of estimates."""
    settings = usage.ModelSettings(endpoint="https://example.org", deployment_name=MODEL)
    return usage.account(_calls(spark, sf_dir), settings).select(
        "file_path", "part_no", "input_tokens", "output_tokens", "model_used", "cost_estimate_usd", "stage"
    )


@_query
def mock_run(spark, sf_dir):
    built = requests.build_requests(_texts(spark, sf_dir))
    calls = complete_mock(built, {"policy_number": "TEST-001", "carrier": "Test Carrier"}, "declarations")
    return usage.account(calls, usage.ModelSettings(mock=True)).select(
        "file_path", "part_no", "input_tokens", "output_tokens", "model_used", "cost_estimate_usd", "stage"
    )


def _cleaned(spark, sf_dir, rules):
    return responses.clean_responses(corpus.stored_responses(spark, sf_dir), MODEL, RUN_TIME, rules)


def _status(spark, sf_dir, rules):
    return _cleaned(spark, sf_dir, rules).select(
        "file_name", "file_path", "page_count", "request_chars", "model_name", "extraction_status",
        "was_truncated", "was_repaired",
    )


@_query
def response_status_v1(spark, sf_dir):
    return _status(spark, sf_dir, "v1")


@_query
def response_status_v2(spark, sf_dir):
    return _status(spark, sf_dir, "v2")


def _response_text(spark, sf_dir, rules):
    cleaned = responses.clean_responses(corpus.odd_responses(spark, sf_dir), MODEL, RUN_TIME, rules)
    hashed = [F.md5(c).alias(c) for c in ("model_output_json", "raw_model_response", "error_message")]
    return cleaned.select("file_path", "extraction_status", "was_truncated", *hashed)


@_query
def response_text_v1(spark, sf_dir):
    """Responses that only Python's JSON rules settle, with output, content and message hashed."""
    return _response_text(spark, sf_dir, "v1")


@_query
def response_text_v2(spark, sf_dir):
    return _response_text(spark, sf_dir, "v2")


@_query
def truncation_report(spark, sf_dir):
    def counted(rules: str) -> DataFrame:
        return _cleaned(spark, sf_dir, rules).groupBy(
            F.lit(rules).alias("rules"), "was_truncated", "was_repaired", "extraction_status"
        ).agg(F.count(F.lit(1)).alias("document_count"))

    return counted("v1").unionByName(counted("v2"))


# Entities


def _parsed(spark, sf_dir, rules):
    return entities.parse_output(_cleaned(spark, sf_dir, rules), rules)


@_query
def repaired_coverages(spark, sf_dir):
    repaired = _cleaned(spark, sf_dir, "v1").filter("was_repaired")
    return _flat_coverages(entities.coverages(entities.parse_output(repaired)))


def _flat_coverages(found: DataFrame) -> DataFrame:
    return found.withColumn("coverage_page_reference", _joined("coverage_page_reference"))


@_query
def policy_summary(spark, sf_dir):
    found = entities.policies(_parsed(spark, sf_dir, "v1"))
    return found.withColumn("policy_page_reference", _joined("policy_page_reference"))


@_query
def policy_summary_v2(spark, sf_dir):
    found = entities.policies(_parsed(spark, sf_dir, "v2"), "v2")
    return found.withColumn("policy_page_reference", _joined("policy_page_reference"))


@_query
def coverages(spark, sf_dir):
    return _flat_coverages(entities.coverages(_parsed(spark, sf_dir, "v1")))


@_query
def coverages_v2(spark, sf_dir):
    return _flat_coverages(entities.coverages(_parsed(spark, sf_dir, "v2"), "v2"))


@_query
def exposures(spark, sf_dir):
    found = entities.exposures(_parsed(spark, sf_dir, "v1"))
    return found.withColumn("exposure_page_reference", _joined("exposure_page_reference"))


@_query
def output_count(spark, sf_dir):
    return entities.output_count(_cleaned(spark, sf_dir, "v1"))


# Dashboard and reads


@_query
def dashboard_from_output(spark, sf_dir):
    """Two parts of the output meet in a join, so it is saved first, as in a whole run."""
    output = stage(responses.model_output(_cleaned(spark, sf_dir, "v1")), "output")
    return dashboard.dashboard_from_output(entities.parse_output(output))


def _view(spark, sf_dir):
    return dashboard.dashboard(corpus.policy_table(spark, sf_dir), corpus.coverage_table(spark, sf_dir))


@_query
def dashboard_view(spark, sf_dir):
    return _view(spark, sf_dir)


@_query
def dashboard_joined(spark, sf_dir):
    return dashboard.dashboard_joined(corpus.policy_table(spark, sf_dir), corpus.coverage_table(spark, sf_dir))


@_query
def dashboard_rows(spark, sf_dir):
    return dashboard.dashboard_rows(_view(spark, sf_dir))


@_query
def file_options(spark, sf_dir):
    return dashboard.file_options(_view(spark, sf_dir))


@_query
def dashboard_for_file(spark, sf_dir):
    return dashboard.rows_for_file(_view(spark, sf_dir), CHOSEN_FILE)


@_query
def coverage_detail(spark, sf_dir):
    return _flat_coverages(dashboard.coverage_detail(corpus.coverage_table(spark, sf_dir), CHOSEN_FILE))


def _saved(spark, df: DataFrame, name: str) -> str:
    """The name of a new saved table in the shared folder."""
    unique = f"{name}_{uuid.uuid4().hex}"
    save_table(df, unique, path=staging_path(spark, name))
    return unique


@_query
def saved_dashboard(spark, sf_dir):
    """The persistent view over saved tables."""
    policies = _saved(spark, corpus.policy_table(spark, sf_dir), "policies")
    coverage = _saved(spark, corpus.coverage_table(spark, sf_dir), "coverages")
    return dashboard.create_dashboard_view(spark, f"dashboard_{uuid.uuid4().hex}", policies, coverage)


@_query
def saved_coverage_detail(spark, sf_dir):
    """A saved table read back by a statement with the file as its parameter."""
    coverage = _saved(spark, corpus.coverage_table(spark, sf_dir), "coverages")
    return _flat_coverages(dashboard.coverage_detail_query(spark, coverage, CHOSEN_FILE))


# Usage and contracts


@_query
def usage_log(spark, sf_dir):
    return usage.turn_usage(corpus.table(spark, sf_dir, "conversations"))


@_query
def usage_rollup(spark, sf_dir):
    return usage.usage_rollup(usage_log(spark, sf_dir))


@_query
def contract_violations(spark, sf_dir):
    records = (
        (corpus.headers(spark, sf_dir), contracts.HEADER),
        (corpus.elements(spark, sf_dir), contracts.COVERAGE),
        (corpus.citations(spark, sf_dir), contracts.CITATION),
        (usage_log(spark, sf_dir).withColumn("duration_ms", F.lit(None).cast("int")), contracts.LOG),
    )
    reports = [contracts.findings(contracts.check(rows, contract), contract) for rows, contract in records]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def _good(rows, contract):
    return contracts.accepted(contracts.check(rows, contract))


@_query
def orphan_elements(spark, sf_dir):
    """Elements whose header was rejected."""
    parents = _good(corpus.headers(spark, sf_dir), contracts.HEADER)
    return contracts.orphans(corpus.elements(spark, sf_dir), parents, "policy_id").select(
        "element_id", "policy_id", "coverage_section"
    )


@_query
def orphan_citations(spark, sf_dir):
    """Citations whose element was rejected."""
    parents = _good(corpus.elements(spark, sf_dir), contracts.COVERAGE)
    return contracts.orphans(corpus.citations(spark, sf_dir), parents, "element_id").select("citation_id", "element_id")


@_query
def completeness(spark, sf_dir):
    return contracts.completeness_report(corpus.elements(spark, sf_dir))


# Normalisation


@_query
def normalized_coverages(spark, sf_dir):
    typed = normalize.normalize_coverages(corpus.textual_coverages(spark, sf_dir))
    return normalize.with_included_state(typed).select(
        "file_path", "coverage_name", "limit_amount", "aggregate_limit", "deductible_or_retention",
        "stated_deductible", "is_sublimit", "included_state", F.array_join("rules", ",").alias("rules"),
    )


@_query
def normalization_report(spark, sf_dir):
    return normalize.rule_report(corpus.textual_coverages(spark, sf_dir), "hours")


@_query
def confidence_bands(spark, sf_dir):
    return normalize.confidence_report(entities.coverages(_parsed(spark, sf_dir, "v1")))


@_query
def policy_term_check(spark, sf_dir):
    checked = normalize.check_terms(corpus.policy_table(spark, sf_dir))
    return checked.select("file_path", "effective_date", "expiration_date", "term_days", "term_status")


@_query
def page_reference_check(spark, sf_dir):
    checked = normalize.check_page_references(corpus.policy_table(spark, sf_dir))
    return checked.groupBy("pages_exist").agg(F.count(F.lit(1)).alias("policy_count"))


@_query
def policy_enums(spark, sf_dir):
    return (
        normalize.normalize_enums(corpus.policy_table(spark, sf_dir))
        .groupBy("policy_type", "claims_made_or_occurrence")
        .agg(F.count(F.lit(1)).alias("policy_count"))
    )


# Terms


def _terms(spark, sf_dir):
    return terms.read_terms(corpus.policy_table(spark, sf_dir))


@_query
def losses_in_force(spark, sf_dir):
    """Each loss with each policy of the insured in force on its day."""
    found = terms.in_force(corpus.dated_losses(spark, sf_dir), _terms(spark, sf_dir))
    return found.select("loss_id", "policy_number", F.datediff("day", "starts").alias("days_in"))


@_query
def newest_term_of_loss(spark, sf_dir):
    found = terms.newest_term(corpus.dated_losses(spark, sf_dir), _terms(spark, sf_dir))
    return found.select("loss_id", "policy_number", F.date_format("starts", "yyyy-MM-dd").alias("starts"))


@_query
def unbroken_cover(spark, sf_dir):
    found = terms.unbroken_cover(_terms(spark, sf_dir))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("cover_starts", "cover_ends")})


# Comparison


@_query
def variant_compare(spark, sf_dir):
    first = entities.coverages(_parsed(spark, sf_dir, "v1"))
    second = entities.coverages(_parsed(spark, sf_dir, "v2"), "v2")
    return compare.compare_files(compare.compare_coverages(first, second))


def _run_difference(spark, sf_dir):
    columns = [*compare.KEYS, "limit_amount"]
    return compare.difference(corpus.coverage_table(spark, sf_dir), corpus.coverage_table_later(spark, sf_dir), columns)


@_query
def run_difference(spark, sf_dir):
    """Coverages of two runs as multisets of whole rows."""
    return _run_difference(spark, sf_dir).filter("added > 0 OR removed > 0")


@_query
def run_changes(spark, sf_dir):
    return compare.changes(_run_difference(spark, sf_dir), ["file_path"])


def all_queries() -> dict[str, Query]:
    return dict(_ALL)
