"""Tokens and cost of model calls, the processing log and its rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docloom.functions.envelope import read_envelopes
from docloom.functions.text import ascii_json_length
from docloom.functions.variant import NUMBERS, at, kind
from docloom.operators.completion import ModelSettings

# Prices in USD per million tokens, and the characters one token stands for.
INPUT_PRICE = 2.50
OUTPUT_PRICE = 10.00
CHARS_PER_TOKEN = 4


def estimated_tokens(chars: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(chars / CHARS_PER_TOKEN)).cast("int")


def cost(input_tokens: Column, output_tokens: Column, mock: bool = False) -> Column:
    """USD at six digits; output is free in mock runs."""
    paid = F.lit(0) if mock else output_tokens
    return _six_digits(
        input_tokens / F.lit(1e6) * F.lit(INPUT_PRICE) + paid / F.lit(1e6) * F.lit(OUTPUT_PRICE)
    )


def _six_digits(amount: Column) -> Column:
    """Rounded as Python's ``round(x, 6)``: by the exact binary value, while Spark's ``round`` goes by the shown digits."""
    return F.call_function("format_number", amount, F.lit("0.000000")).cast("double")


def account(calls: DataFrame, settings: ModelSettings) -> DataFrame:
    """Token counts, cost and model name for completed calls.

    A response that reports its usage replaces the estimates; a failed call has no output. The stored
    response is Python's ASCII JSON text, so its length is the length the estimate is defined on.
    """
    def reported(name: str) -> Column:
        value = at(F.col("doc"), f"$.usage.{name}")
        return F.when(kind(value).isin(*NUMBERS), F.try_variant_get(value, "$", "int"))

    guess = F.when(F.col("response_json").isNotNull(), estimated_tokens(F.length("response_json"))).otherwise(F.lit(0))
    used_in, used_out = F.col("estimated_input"), guess
    if not settings.mock:
        used_in, used_out = F.coalesce(reported("prompt_tokens"), used_in), F.coalesce(reported("completion_tokens"), guess)
    counted = read_envelopes(calls, "response_json", ("usage",)).select(
        *calls.columns, used_in.alias("input_tokens"), used_out.alias("output_tokens")
    )
    return counted.drop("estimated_input").select(
        "*",
        F.lit(settings.model_used).alias("model_used"),
        cost(F.col("input_tokens"), F.col("output_tokens"), settings.mock).alias("cost_estimate_usd"),
    )


def _reply_chars(text: Column) -> Column:
    """Length of ``json.dumps({"reply": text})``."""
    return ascii_json_length(text) + len('{"reply": }')


def turn_usage(turns: DataFrame, stage: str = "conversation", model_tier: str = "mock") -> DataFrame:
    """A processing log with one row per user turn, answered by the assistant turn right after it.

    The turns are paired by equality on conversation and turn number, so a very long conversation is
    spread over the tasks like any other rows.
    """
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.length("text").alias("prompt_chars"))
    answers = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), _reply_chars(F.col("text")).alias("reply_chars")
    )
    paired = asked.join(answers, ["conv_id", "turn"], "left")
    answered = F.col("reply_chars").isNotNull()
    used_in = estimated_tokens(F.col("prompt_chars"))
    used_out = F.when(answered, estimated_tokens(F.col("reply_chars"))).otherwise(F.lit(0))
    return paired.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("log_id"),
        F.col("conv_id").cast("string").alias("policy_id"),
        F.lit(stage).alias("prompt_stage"),
        used_in.alias("input_tokens"),
        used_out.alias("output_tokens"),
        F.lit(model_tier).alias("model_tier"),
        F.lit(0).alias("retry_count"),
        cost(used_in, used_out).alias("cost_estimate_usd"),
        F.lit(0).alias("duration_ms"),
        F.when(answered, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
    )


def usage_rollup(log: DataFrame) -> DataFrame:
    """Totals by stage and status, with subtotals. Cost is summed as a decimal, so order does not matter."""
    return log.rollup("prompt_stage", "status").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("retry_count").alias("retries"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
        F.sum(F.col("cost_estimate_usd").cast("decimal(18,6)")).cast("double").alias("cost_usd"),
    )
