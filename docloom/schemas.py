"""Fixed table shapes of the jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_PAGES = T.ArrayType(_I)

RAW_TEXT = _struct(
    ("file_name", _S), ("file_path", _S), ("page_count", _I),
    ("policy_text", _S), ("extraction_status", _S), ("error_message", _S),
)

MODEL_OUTPUT = _struct(
    ("file_name", _S), ("file_path", _S), ("page_count", _I), ("request_chars", _L),
    ("model_name", _S), ("extraction_status", _S), ("model_output_json", _S),
    ("raw_model_response", _S), ("error_message", _S), ("processed_at", _S),
)

PAGE_TABLE = _struct(
    ("file_name", _S), ("file_path", _S), ("page_no", _I), ("page_text", _S), ("error", _S),
)

RESPONSES = _struct(
    ("file_name", _S), ("file_path", _S), ("page_count", _I), ("request_chars", _L),
    ("response_json", _S), ("call_error", _S),
)

# Field names and types of the extracted JSON.
POLICY_FIELDS = _struct(
    ("policy_number", _S), ("carrier", _S), ("named_insured", _S), ("effective_date", _S),
    ("expiration_date", _S), ("policy_type", _S), ("claims_made_or_occurrence", _S),
    ("confidence", _D), ("page_reference", _PAGES),
)
_COVERAGE_HEAD = (("coverage_name", _S), ("coverage_section", _S))
_COVERAGE_TAIL = (
    ("limit_amount", _D), ("aggregate_limit", _D), ("deductible_or_retention", _D),
    ("is_sublimit", _B), ("confidence", _D), ("page_reference", _PAGES),
)
COVERAGE_FIELDS = {
    "v1": _struct(*_COVERAGE_HEAD, *_COVERAGE_TAIL),
    "v2": _struct(*_COVERAGE_HEAD, ("coverage_type", _S), *_COVERAGE_TAIL),
}
EXPOSURE_FIELDS = _struct(
    ("exposure_type", _S), ("exposure_value", _D), ("basis", _S),
    ("confidence", _D), ("page_reference", _PAGES),
)


def extraction_schema(rules: str) -> T.StructType:
    """Shape of the extracted JSON; ``v2`` adds ``coverage_type``."""
    return _struct(
        ("policy", POLICY_FIELDS),
        ("coverages", T.ArrayType(COVERAGE_FIELDS[rules])),
        ("exposures", T.ArrayType(EXPOSURE_FIELDS)),
    )


POLICY_HEADER = _struct(
    ("policy_id", _S), ("file_name", _S), ("carrier", _S), ("named_insured", _S),
    ("policy_number", _S), ("effective_date", _S), ("expiration_date", _S), ("policy_type", _S),
    ("claims_made_or_occurrence", _S), ("page_count", _I), ("model_used", _S),
    ("processed_at", _S), ("declarations_source_text", _S),
)
COVERAGE_ELEMENT = _struct(
    ("element_id", _S), ("policy_id", _S), ("coverage_name", _S), ("coverage_section", _S),
    ("limit_amount", _D), ("aggregate_limit", _D), ("deductible_or_retention", _D),
    ("is_sublimit", _B), ("included_state", _S), ("confidence", _D), ("section_type", _S),
)
EXTRACTION_CITATION = _struct(
    ("citation_id", _S), ("element_id", _S), ("page_number", _I), ("section", _S), ("passage", _S),
)
PROCESSING_LOG = _struct(
    ("log_id", _S), ("policy_id", _S), ("prompt_stage", _S), ("input_tokens", _I),
    ("output_tokens", _I), ("model_tier", _S), ("retry_count", _I), ("cost_estimate_usd", _D),
    ("duration_ms", _I), ("status", _S),
)

# Allowed words of the enumerated columns.
INCLUDED_STATES = ("INHERIT_AGGREGATE", "SUBLIMIT_WITHIN_COVERAGE", "COVERED_WITH_DEDUCTIBLE")
SECTION_TYPES = ("declarations", "coverage", "endorsement")
POLICY_TYPES = ("primary", "excess", "umbrella", "wc", "auto", "cyber", "unknown")
CLAIMS_BASES = ("claims-made", "occurrence", "unknown")
LOG_STATUSES = ("SUCCESS", "FAILED", "TRUNCATED", "RETRIED")
COVERAGE_TYPES = ("base", "sublimit", "aggregate", "deductible", "endorsement", "extension")
