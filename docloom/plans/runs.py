"""A whole run: document texts to saved tables and the dashboard view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from docloom.operators import entities, pages, requests, responses
from docloom.operators.completion import Completer, ModelSettings, complete
from docloom.operators.dashboard import create_dashboard_view
from docloom.session import stage
from docloom.sources.tables import save_table


@dataclass(frozen=True)
class TableNames:
    """Names of the saved tables, of the dashboard view, and of the temporary view of the texts to send."""

    raw_text: str = "policy_raw_text"
    output: str = "policy_model_output"
    policies: str = "policy_summary"
    coverages: str = "policy_coverages"
    exposures: str = "policy_exposures"
    view: str = "policy_dashboard"
    texts: str = "policy_texts"


@dataclass(frozen=True)
class RunOptions:
    """``rules`` picks the request and response rules; without ``processed_at`` the run takes the current time."""

    rules: str = "v1"
    prompt: str = requests.PROMPTS["baseline"]
    max_chars: int = requests.MAX_CHARS
    parallelism: int | None = None
    fmt: str = "parquet"
    processed_at: str | None = None


def answer(texts: DataFrame, completer: Completer, options: RunOptions) -> DataFrame:
    """Model responses for the texts, staged so that a lost executor never repeats a call already made."""
    built = requests.build_requests(texts, {"run": options.prompt}, options.rules, options.max_chars)
    return stage(complete(built, completer, options.parallelism, "extraction"), "responses")


def run_extraction(
    raw_text: DataFrame,
    names: TableNames,
    options: RunOptions,
    settings: ModelSettings,
    completer: Completer | None = None,
) -> DataFrame:
    """Save raw text, model output and entities, create the view and return it.

    Without a completer the fixed sample outputs take the model's place. Every later step reads the table saved before it: the texts are assembled once, the model is asked
    once, and the three entity tables parse the saved output, each only its own part.
    """
    spark = raw_text.sparkSession
    moment = options.processed_at or spark.range(1).select(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ).first()[0]
    saved_text = save_table(raw_text, names.raw_text, options.fmt)
    # v1 also sends documents whose text could not be read, as empty texts.
    texts = pages.successful(saved_text) if options.rules == "v2" else pages.every_document(saved_text)
    texts.createOrReplaceTempView(names.texts)
    if completer is None:
        output = requests.stub_run(texts, moment, options.rules)
    else:
        answered = answer(texts, completer, options)
        cleaned = responses.clean_responses(answered, settings.model_used, moment, options.rules)
        output = responses.model_output(cleaned)
    parsed = entities.parse_output(save_table(output, names.output, options.fmt), options.rules)
    save_table(entities.policies(parsed, options.rules), names.policies, options.fmt)
    save_table(entities.coverages(parsed, options.rules), names.coverages, options.fmt)
    save_table(entities.exposures(parsed), names.exposures, options.fmt)
    return create_dashboard_view(spark, names.view, names.policies, names.coverages)
