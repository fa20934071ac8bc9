"""Model-output rows to policy, coverage and exposure rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.schemas import COVERAGE_FIELDS, EXPOSURE_FIELDS, POLICY_FIELDS, extraction_schema

_SHARED = ("confidence", "page_reference")


def parse_output(output: DataFrame, rules: str = "v1") -> DataFrame:
    """Usable rows with the typed struct ``extracted``.

    A value of the wrong type becomes null and leaves its siblings alone. Each reader of the result
    parses only the part of the struct it uses.
    """
    usable = output.filter((F.col("extraction_status") == "SUCCESS") & F.col("model_output_json").isNotNull())
    return usable.withColumn("extracted", F.from_json("model_output_json", extraction_schema(rules)))


def _flat(source: str, fields, prefix: str) -> list[Column]:
    """The struct's fields as columns; the fields that all entities share get the entity's prefix."""
    return [
        F.col(f"{source}.{name}").alias(f"{prefix}_{name}" if name in _SHARED else name) for name in fields.names
    ]


def _whole_documents(rows: DataFrame) -> DataFrame:
    """One row per document: of each column the first value that is not null, by part.

    Each value travels with its part number through a minimum, so parts are combined before the shuffle.
    """
    found = [c for c in rows.columns if c not in ("file_name", "file_path", "part_no")]
    firsts = [
        F.min(F.when(F.col(c).isNotNull(), F.struct("part_no", F.col(c).alias("value"))))["value"].alias(c) for c in found
    ]
    return rows.groupBy("file_name", "file_path").agg(*firsts)


def policies(parsed: DataFrame, rules: str = "v1") -> DataFrame:
    """A policy row per row of output; output in parts gives one row per document."""
    if "part_no" in parsed.columns:
        body = _flat("extracted.policy", POLICY_FIELDS, "policy")
        more = ["page_count", "processed_at"] if rules == "v2" else []
        whole = _whole_documents(parsed.select("file_name", "file_path", "part_no", *more, *body))
        return whole.select("file_name", "file_path", *more[:1], *[c for c in whole.columns if c not in ("file_name", "file_path", *more)], *more[1:])
    body = _flat("extracted.policy", POLICY_FIELDS, "policy")
    if rules == "v2":
        return parsed.select("file_name", "file_path", "page_count", *body, "processed_at")
    return parsed.select("file_name", "file_path", *body)


def _unnest(parsed: DataFrame, array: str, fields, prefix: str) -> DataFrame:
    """One row per item; a document without items keeps one row of nulls."""
    items = parsed.select("file_name", "file_path", F.explode_outer(f"extracted.{array}").alias("item"))
    return items.select("file_name", "file_path", *_flat("item", fields, prefix))


def coverages(parsed: DataFrame, rules: str = "v1") -> DataFrame:
    return _unnest(parsed, "coverages", COVERAGE_FIELDS[rules], "coverage")


def exposures(parsed: DataFrame) -> DataFrame:
    return _unnest(parsed, "exposures", EXPOSURE_FIELDS, "exposure")


def output_count(output: DataFrame) -> DataFrame:
    return output.agg(F.count(F.lit(1)).alias("row_count"))
