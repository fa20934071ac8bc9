"""Contracts, usage, normalisation and comparison on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import contracts, normalize
from docloom.operators.compare import compare_coverages, compare_files
from docloom.operators.usage import cost, turn_usage, usage_rollup
from docloom.schemas import COVERAGE_ELEMENT, EXTRACTION_CITATION, POLICY_HEADER, PROCESSING_LOG

HEADER = (
    "POL-001", "test.pdf", "Chubb", "Acme Corp", "D95637139", "2025-01-01", "2026-01-01", "primary", "occurrence", 87,
    "gpt-4o", "2026-03-28T00:00:00Z", "Declarations page text here",
)
ELEMENT = (
    "COV-001", "POL-001", "General Aggregate", "Commercial General Liability", 2e6, 2e6, None, False, None, 0.97, "coverage",
)
CITATION = ("CIT-001", "COV-001", 14, "coverage_form", "General Aggregate Limit $2,000,000")
LOG = ("LOG-001", "POL-001", "declarations", 10000, 500, "gpt-4o", 0, 0.030, 1200, "SUCCESS")


def changed(schema, row, **values):
    return tuple(values.get(name, value) for name, value in zip(schema.names, row))


def checked(spark, schema, contract, *rows):
    return contracts.check(spark.createDataFrame(list(rows), schema), contract)


def test_valid_records(spark):
    for schema, contract, row in (
        (POLICY_HEADER, contracts.HEADER, HEADER), (COVERAGE_ELEMENT, contracts.COVERAGE, ELEMENT), (PROCESSING_LOG, contracts.LOG, LOG),
    ):
        df = checked(spark, schema, contract, row)
        assert df.first().violations == [] and df.first().warnings == []
        assert contracts.accepted(df).schema.names == schema.names
    citation = checked(spark, EXTRACTION_CITATION, contracts.CITATION, CITATION).first()
    assert citation.violations == [] and citation.warnings == ["length:passage"]


def test_defaults_and_violations(spark):
    df = checked(
        spark, POLICY_HEADER, contracts.HEADER,
        changed(POLICY_HEADER, HEADER, policy_type=None, claims_made_or_occurrence=None, policy_number=None),
        changed(POLICY_HEADER, HEADER, policy_type="marine", carrier=None),
    )
    good, bad = contracts.accepted(df).collect(), contracts.rejected(df).collect()
    assert (good[0].policy_type, good[0].claims_made_or_occurrence) == ("unknown", "unknown")
    assert bad[0].violations == ["missing:carrier", "unknown:policy_type"]
    element = checked(
        spark, COVERAGE_ELEMENT, contracts.COVERAGE,
        changed(COVERAGE_ELEMENT, ELEMENT, is_sublimit=None, included_state="MAYBE", section_type="annex"),
    ).first()
    assert element.is_sublimit is False and element.violations == ["unknown:included_state", "unknown:section_type"]
    citation = checked(spark, EXTRACTION_CITATION, contracts.CITATION, changed(EXTRACTION_CITATION, CITATION, passage="")).first()
    assert citation.violations == ["empty:passage"]
    log = checked(spark, PROCESSING_LOG, contracts.LOG, changed(PROCESSING_LOG, LOG, status="DONE"))
    assert contracts.findings(log, contracts.LOG).collect()[0].asDict() == {
        "record": "log", "finding": "unknown:status", "record_count": 1,
    }


def test_orphans_and_completeness(spark):
    elements = spark.createDataFrame(
        [ELEMENT, changed(COVERAGE_ELEMENT, ELEMENT, policy_id="POL-9"), changed(COVERAGE_ELEMENT, ELEMENT, policy_id=None)], COVERAGE_ELEMENT
    )
    parents = spark.createDataFrame([HEADER, HEADER], POLICY_HEADER)
    assert {r.policy_id for r in contracts.orphans(elements, parents, "policy_id").collect()} == {"POL-9", None}
    assert contracts.with_completeness(elements).first().completeness == 0.8


def test_cost_rounds_like_python(spark):
    pairs = [(10000, 500), (7, 0), (1, 0), (3, 1), (0, 0)] + [
        (random.Random(i).randrange(200000), random.Random(-i).randrange(16000)) for i in range(2000)
    ]
    df = spark.createDataFrame(pairs, "i int, o int").select("i", "o", cost(F.col("i"), F.col("o")).alias("c"), cost(F.col("i"), F.col("o"), True).alias("m"))
    for row in df.collect():
        assert row.c == round(row.i / 1_000_000 * 2.5 + row.o / 1_000_000 * 10.0, 6)
        assert row.m == round(row.i / 1_000_000 * 2.5, 6)


def test_turn_usage(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "x" * 40), (1, 2, "assistant", "y" * 80), (1, 3, "user", "z"), (2, 0, "user", "q"), (2, 1, "user", "w")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    log = turn_usage(turns)
    assert log.schema.names == PROCESSING_LOG.names
    rows = {r.log_id: (r.input_tokens, r.output_tokens, r.status) for r in log.collect()}
    assert rows == {"1-1": (10, 23, "SUCCESS"), "1-3": (1, 0, "FAILED"), "2-0": (1, 0, "FAILED"), "2-1": (1, 0, "FAILED")}
    total = usage_rollup(log).filter("prompt_stage is null").first()
    assert (total.calls, total.failures, total.input_tokens) == (4, 3, 13)


MONEY = [
    ("$1,250.50", 1250.5), ("5M", 5e6), ("$5M", 5e6), ("$ 250k", 250e3), ("5,000,000", 5e6), ("$1.5 M", 1.5e6), ("Included", None),
    ("5%", None), ("", None), (None, None), ("$5 per person", None), ("12 months", None),
]


def test_money(spark):
    df = spark.createDataFrame([(t,) for t, _ in MONEY], "t string").select(normalize.money(F.col("t")).alias("v"))
    assert [r.v for r in df.collect()] == [v for _, v in MONEY]


ROWS = [
    # limit, deductible, days_as hours -> limit, deductible, rules
    ("$5M xs $2M", None, 5e6, 2e6, ["layer"]),
    ("$5,000,000 excess of $5,000,000 each claim", None, 5e6, 5e6, ["layer"]),
    ("10M x/s 500K", "24 hours", 10e6, 500e3, ["layer", "waiting", "layer_and_deductible"]),
    ("$100", "72 hours", 100.0, 72.0, ["money", "waiting"]),
    ("$100", "3 days", 100.0, 72.0, ["money", "waiting"]),
    ("$100", "5%", 100.0, None, ["money", "percent_only"]),
    ("$100", "5% subject to a $50,000 minimum", 100.0, 50000.0, ["money"]),
    ("Included", "$25,000", None, 25000.0, ["no_limit"]),
    ("USD 1.5 million", "10,000 USD", 1.5e6, 10e3, ["money"]),
    ("$2MM", "30 days waiting", 2e6, None, ["money", "unreadable_deductible"]),
    ("See form CP-10", None, None, None, ["unreadable_limit"]),
    (None, None, None, None, ["no_limit"]),
]


def test_normalize_coverages(spark):
    raw = spark.createDataFrame(
        [(i, limit, None, deductible, "base") for i, (limit, deductible, *_) in enumerate(ROWS)],
        "i int, limit_text string, aggregate_text string, deductible_text string, coverage_type string",
    )
    rows = normalize.normalize_coverages(raw, "hours").orderBy("i").collect()
    assert [(r.limit_amount, r.deductible_or_retention, r.rules) for r in rows] == [tuple(row[2:]) for row in ROWS]
    assert normalize.normalize_coverages(raw).filter("i = 4").first().deductible_or_retention == 3.0
    report = {r.rule: r.coverage_count for r in normalize.rule_report(raw).collect()}
    assert report == {
        "money": 6, "layer": 3, "waiting": 3, "percent_only": 1, "no_limit": 2, "unreadable_limit": 1,
        "unreadable_deductible": 1, "layer_and_deductible": 1,
    }
    both = normalize.normalize_coverages(raw, "hours").filter("i = 2").first()
    assert (both.deductible_or_retention, both.stated_deductible) == (500e3, 24.0)
    assert [r.included_state for r in normalize.with_included_state(normalize.normalize_coverages(raw)).orderBy("i").collect()][-5::4] == [
        "COVERED_WITH_DEDUCTIBLE", "INHERIT_AGGREGATE",
    ]


def test_bands_terms_pages_and_words(spark):
    values = [0.95, 0.949, 0.75, 0.5, 0.1, None]
    df = spark.createDataFrame([(v,) for v in values], "c double").select(normalize.confidence_band(F.col("c")).alias("b"))
    assert [r.b for r in df.collect()] == ["explicit", "clear", "clear", "partial", "uncertain", None]
    terms = [("2025-01-01", "2026-01-01"), ("2025-01-01", "2025-06-01"), ("2025-01-01", "2024-01-01"), ("soon", "2026-01-01")]
    df = normalize.check_terms(spark.createDataFrame(terms, "effective_date string, expiration_date string"))
    assert [r.term_status for r in df.collect()] == ["annual", "other", "reversed", "unreadable"]
    pages = [([1, 3], 3), ([0], 3), ([4], 3), ([], 3), ([1], None)]
    df = normalize.check_page_references(spark.createDataFrame(pages, "policy_page_reference array<int>, page_count int"))
    assert [r.pages_exist for r in df.collect()] == [True, False, False, True, None]
    words = [("Excess ", "Claims Made"), ("Workers' Compensation", "occurrence-based"), ("marine", None)]
    df = normalize.normalize_enums(spark.createDataFrame(words, "policy_type string, claims_made_or_occurrence string"))
    assert [tuple(r) for r in df.collect()] == [("excess", "claims-made"), ("wc", "occurrence"), ("unknown", "unknown")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_compare(spark, partitions):
    schema = "file_path string, coverage_name string, coverage_section string"
    first = spark.createDataFrame([("/a", "x", "s"), ("/a", "x", "s"), ("/a", "y", None), ("/b", "z", "s"), ("/b", None, "s")], schema)
    second = spark.createDataFrame([("/a", "x", "s"), ("/a", "y", None), ("/a", "w", "s")], schema)
    compared = compare_coverages(first.repartition(partitions), second.repartition(partitions))
    assert {(r.coverage_name, r.first_rows, r.second_rows) for r in compared.collect()} == {
        ("x", 2, 1), ("y", 1, 1), ("w", 0, 1), ("z", 1, 0), (None, 0, 0),
    }
    files = {r.file_path: (r.first_only, r.second_only, r.in_both) for r in compare_files(compared).collect()}
    assert files == {"/a": (0, 1, 2), "/b": (1, 0, 0)}
