"""Record contracts: required columns, enumerations, references between records, completeness."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.joins import lookup_join
from docloom.schemas import CLAIMS_BASES, INCLUDED_STATES, LOG_STATUSES, POLICY_TYPES, SECTION_TYPES


@dataclass(frozen=True)
class Contract:
    """Rules of one record type. In a table a missing value is a null, so a default fills nulls."""

    name: str
    required: tuple[str, ...]
    enums: dict[str, tuple[str, ...]]
    defaults: dict[str, object] = field(default_factory=dict)
    not_empty: tuple[str, ...] = ()
    # Column to (least, most) characters; outside is worth a warning, not a rejection.
    advised_length: dict[str, tuple[int, int]] = field(default_factory=dict)


HEADER = Contract(
    "header",
    required=(
        "policy_id", "file_name", "carrier", "named_insured", "page_count", "model_used", "processed_at",
        "declarations_source_text",
    ),
    enums={"policy_type": POLICY_TYPES, "claims_made_or_occurrence": CLAIMS_BASES},
    defaults={"policy_type": "unknown", "claims_made_or_occurrence": "unknown"},
)
# A null included_state stands for an explicit amount.
COVERAGE = Contract(
    "coverage",
    required=("element_id", "policy_id", "coverage_name", "coverage_section", "confidence", "section_type"),
    enums={"included_state": INCLUDED_STATES, "section_type": SECTION_TYPES},
    defaults={"is_sublimit": False},
)
CITATION = Contract(
    "citation",
    required=("citation_id", "element_id", "page_number", "section", "passage"),
    enums={},
    not_empty=("passage",),
    advised_length={"passage": (50, 100)},
)
LOG = Contract(
    "log",
    required=(
        "log_id", "policy_id", "prompt_stage", "input_tokens", "output_tokens", "model_tier", "retry_count",
        "cost_estimate_usd", "duration_ms", "status",
    ),
    enums={"status": LOG_STATUSES},
)


def _found(rules: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(code)) for broken, code in rules], F.lit(None).cast("string")))


def check(records: DataFrame, contract: Contract) -> DataFrame:
    """The records with defaults filled and the columns ``violations`` and ``warnings``."""
    filled = records.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in contract.defaults.items()}
    )
    broken = [(F.col(name).isNull(), f"missing:{name}") for name in contract.required]
    broken += [(~F.col(name).isin(*words), f"unknown:{name}") for name, words in contract.enums.items()]
    broken += [(F.col(name) == "", f"empty:{name}") for name in contract.not_empty]
    advised = [
        (~F.length(name).between(least, most), f"length:{name}") for name, (least, most) in contract.advised_length.items()
    ]
    return filled.select("*", _found(broken).alias("violations"), _found(advised).alias("warnings"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") == 0).drop("violations", "warnings")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") > 0)


def findings(checked: DataFrame, contract: Contract) -> DataFrame:
    """Counts per finding, combined before the shuffle."""
    codes = checked.select(F.explode(F.concat("violations", "warnings")).alias("finding"))
    return codes.groupBy(F.lit(contract.name).alias("record"), "finding").agg(F.count(F.lit(1)).alias("record_count"))


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose key no parent has. Copies of a parent key are combined before the shuffle."""
    return lookup_join(children, parents.select(key).distinct(), [key], "left_anti")


# Our own measure; the columns count alike.
SCORED = ("coverage_name", "coverage_section", "limit_amount", "aggregate_limit", "deductible_or_retention")


def filled_fields() -> Column:
    return sum((F.col(name).isNotNull().cast("int") for name in SCORED), F.lit(0))


def with_completeness(coverages: DataFrame) -> DataFrame:
    """Share of the scored columns that are filled, in place of a model-given confidence."""
    return coverages.withColumn("completeness", filled_fields() / F.lit(float(len(SCORED))))


def completeness_report(coverages: DataFrame) -> DataFrame:
    return coverages.groupBy("coverage_section").agg(
        F.count(F.lit(1)).alias("coverage_count"),
        F.sum(filled_fields()).alias("filled_fields"),
        (F.sum(filled_fields()) / (F.count(F.lit(1)) * float(len(SCORED)))).alias("completeness"),
    )
