"""Values returned as text to typed values, by the rules a prompt states to the model.

A typed parse turns ``"$1,000"`` into null without a word; these columns keep the text and say which
rule read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.variant import sql_map
from docloom.schemas import CLAIMS_BASES, POLICY_TYPES

# Wordings of amounts, layers, waiting periods and missing limits. An amount is one group.
NUMBER = r"([0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:[Mm][Ii][Ll][Ll][Ii][Oo][Nn]|[Mm][Mm]|[KMkm])\b)?)"
AMOUNT = r"(?:USD\s*)?\$?\s*" + NUMBER + r"(?:\s*USD)?"
LAYER = AMOUNT + r"\s+(?:excess of|xs|x/s)\s+" + AMOUNT
DOLLARS = r"\$\s*" + NUMBER
WAITING = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(hour|day)s?\s*$"
# Wordings that state that there is no limit of its own.
STATED_NONE = ("included", "none", "n/a", "not applicable", "nil", "no limit", "unlimited")
SUBLIMIT_TYPES = ("sublimit", "extension", "special limit")
# Lower bounds of the confidence bands.
BANDS = ((0.95, "explicit"), (0.75, "clear"), (0.50, "partial"))


def _group(text: Column, pattern: str, group: int) -> Column:
    """A group of the pattern; null where nothing matches, as casting an empty text is slow."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _amount(text: Column, pattern: str, group: int = 1) -> Column:
    """The amount in a group of the pattern, with its unit written as an exponent for the cast."""
    digits = F.translate(F.upper(_group(text, pattern, group)), ", \t\n\r", "")
    for unit, exponent in (("MILLION", "E6"), ("MM", "E6"), ("M", "E6"), ("K", "E3")):
        digits = F.replace(digits, F.lit(unit), F.lit(exponent))
    return digits.try_cast("double")


def money(text: Column) -> Column:
    """A plain amount such as ``$1,250.50`` or ``5M``; null for anything else."""
    return _amount(text, rf"^\s*{AMOUNT}\s*$")


def waiting_period(text: Column, days_as: str = "number") -> Column:
    """``72 hours`` as 72. Days stay a bare number, or become hours with ``days_as="hours"``."""
    number = _group(text, WAITING, 1).try_cast("double")
    if days_as == "hours":
        number = number * F.when(F.regexp_extract(text, WAITING, 2) == "day", 24.0).otherwise(1.0)
    return number


def _read_amounts(raw: DataFrame, days_as: str) -> DataFrame:
    """Each reading of the texts once, as a column, so that values and rules can share it."""
    limit, deductible = F.col("limit_text"), F.col("deductible_text")
    read = raw.select("*", _group(limit, LAYER, 0).alias("layer"), F.coalesce(deductible.contains("%"), F.lit(False)).alias("percent"))
    return read.select(
        "*",
        _amount(F.col("layer"), LAYER).alias("layer_limit"),
        _amount(F.col("layer"), LAYER, 2).alias("attachment"),
        F.when(F.col("layer").isNull(), money(limit)).alias("plain_limit"),
        F.when(~F.col("percent"), waiting_period(deductible, days_as)).alias("waiting"),
        F.when(F.col("percent"), _amount(deductible, DOLLARS)).otherwise(money(deductible)).alias("priced"),
    )


def _states_nothing(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin("", *STATED_NONE), F.lit(True))


def _rules() -> list[tuple[Column, str]]:
    unread = F.coalesce("layer_limit", "plain_limit").isNull()
    deductible, read = F.col("deductible_text"), F.coalesce("waiting", "priced")
    no_aggregate = money(F.col("aggregate_text")).isNull() & ~_states_nothing(F.col("aggregate_text"))
    return [
        (F.col("plain_limit").isNotNull(), "money"),
        (F.col("layer_limit").isNotNull(), "layer"),
        (F.col("waiting").isNotNull(), "waiting"),
        (F.col("percent") & F.col("priced").isNull(), "percent_only"),
        (unread & _states_nothing(F.col("limit_text")), "no_limit"),
        (unread & ~_states_nothing(F.col("limit_text")), "unreadable_limit"),
        (no_aggregate, "unreadable_aggregate"),
        (read.isNull() & ~F.col("percent") & ~_states_nothing(deductible), "unreadable_deductible"),
        (F.col("attachment").isNotNull() & read.isNotNull(), "layer_and_deductible"),
        (_is_sublimit(), "sublimit"),
    ]


def _is_sublimit() -> Column:
    return F.coalesce(F.lower("coverage_type").isin(*SUBLIMIT_TYPES), F.lit(False))


def normalize_coverages(raw: DataFrame, days_as: str = "number") -> DataFrame:
    """Typed limits, deductible and sublimit flag next to the texts, and the names of the rules used.

    Reads limit_text, aggregate_text, deductible_text and coverage_type. A text that no rule reads is said to be
    unreadable, not missing. Where a layer's attachment and a deductible are both stated, the attachment is the
    retention and ``stated_deductible`` keeps the other.
    """
    read = _read_amounts(raw, days_as)
    return read.select(
        *raw.columns,
        F.coalesce("layer_limit", "plain_limit").alias("limit_amount"),
        money(F.col("aggregate_text")).alias("aggregate_limit"),
        F.coalesce("attachment", "waiting", "priced").alias("deductible_or_retention"),
        F.coalesce("waiting", "priced").alias("stated_deductible"),
        _is_sublimit().alias("is_sublimit"),
        F.array_compact(F.array(*[F.when(used, F.lit(name)) for used, name in _rules()])).alias("rules"),
    )


def with_included_state(coverages: DataFrame) -> DataFrame:
    """Our own rule for coverages without an amount; null stands for an explicit amount."""
    return coverages.withColumn(
        "included_state",
        F.when(F.col("limit_amount").isNotNull() | F.col("aggregate_limit").isNotNull(), F.lit(None))
        .when(F.col("deductible_or_retention").isNotNull(), F.lit("COVERED_WITH_DEDUCTIBLE"))
        .when(F.col("is_sublimit"), F.lit("SUBLIMIT_WITHIN_COVERAGE"))
        .otherwise(F.lit("INHERIT_AGGREGATE")),
    )


def rule_report(raw: DataFrame, days_as: str = "number") -> DataFrame:
    """Coverages per rule that applied, counted in one pass without a row per use."""
    rules = _rules()
    counts = _read_amounts(raw, days_as).agg(*[F.count_if(used).alias(name) for used, name in rules])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("coverage_count")) for _, name in rules])
    return counts.select(F.inline(pairs)).filter(F.col("coverage_count") > 0)


def confidence_band(confidence: Column) -> Column:
    band = F.when(confidence.isNull(), F.lit(None))
    for bound, name in BANDS:
        band = band.when(confidence >= bound, F.lit(name))
    return band.otherwise(F.lit("uncertain"))


def confidence_report(coverages: DataFrame) -> DataFrame:
    """Coverages per band. The row of nulls that stands for a document without coverages is none."""
    band = confidence_band(F.col("coverage_confidence")).alias("band")
    own = [F.col(c).cast("string") for c in coverages.columns if c not in ("file_name", "file_path")]
    return coverages.filter(F.coalesce(*own).isNotNull()).groupBy(band).agg(F.count(F.lit(1)).alias("coverage_count"))


def check_terms(policies: DataFrame) -> DataFrame:
    """Date columns as dates with the length of the term; unreadable dates become null."""
    start, end = F.expr("try_to_date(effective_date, 'yyyy-MM-dd')"), F.expr("try_to_date(expiration_date, 'yyyy-MM-dd')")
    days = F.datediff(F.col("term_end"), F.col("term_start"))
    dated = policies.withColumns({"term_start": start, "term_end": end})
    return dated.withColumn("term_days", days).withColumn(
        "term_status",
        F.when(F.col("term_days").isNull(), F.lit("unreadable"))
        .when(F.col("term_days") <= 0, F.lit("reversed"))
        .when(F.col("term_days").between(365, 366), F.lit("annual"))
        .otherwise(F.lit("other")),
    )


def check_page_references(policies: DataFrame) -> DataFrame:
    """Whether every cited page exists in the document; null where the page count is unknown."""
    pages = F.col("policy_page_reference")
    good = (F.array_min(pages) >= 1) & (F.array_max(pages) <= F.col("page_count"))
    return policies.withColumn(
        "pages_exist", F.when(F.col("page_count").isNotNull(), F.when(F.size(pages) > 0, good).otherwise(F.lit(True)))
    )


# Other wordings of the enumerated words.
_POLICY_WORDS = {word: word for word in POLICY_TYPES} | {"workers-compensation": "wc", "automobile": "auto"}
_CLAIMS_WORDS = {word: word for word in CLAIMS_BASES} | {"occurrence-based": "occurrence"}


def _to_word(text: Column, words: dict[str, str]) -> Column:
    key = F.regexp_replace(F.lower(F.trim(text)), "[^a-z]+", "-")
    return F.coalesce(F.try_element_at(sql_map(words), key), F.lit("unknown"))


def normalize_enums(policies: DataFrame) -> DataFrame:
    """Policy type and claims basis as enumerated words; anything else is ``unknown``."""
    return policies.withColumns({
        "policy_type": _to_word(F.col("policy_type"), _POLICY_WORDS),
        "claims_made_or_occurrence": _to_word(F.col("claims_made_or_occurrence"), _CLAIMS_WORDS),
    })
