"""Requests to stored responses. The model is a function handed in; nothing here opens a connection."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docloom.operators.requests import MAX_TOKENS

Completer = Callable[[dict], dict]

_KEPT = ["file_name", "file_path", "page_count", "variant", "part_no", "part_count", "request_chars"]
_KEPT_TYPES = (
    "file_name string, file_path string, page_count int, variant string, part_no int, part_count int, request_chars bigint"
)
NO_RESPONSE = "no stored response"
# Answers that are handed on together, so that few calls are held at a time.
SLICE = 16


@dataclass(frozen=True)
class ModelSettings:
    """Which model a run talks to; checked on the driver before any job starts."""

    mock: bool = False
    endpoint: str | None = None
    deployment_name: str = "gpt-4o"
    max_tokens: int = MAX_TOKENS

    def __post_init__(self) -> None:
        if not self.mock and not self.endpoint:
            raise ValueError("endpoint is required for non-mock client")

    @property
    def model_used(self) -> str:
        return "mock" if self.mock else self.deployment_name


def _estimated_input():
    # Fixed value: four characters count as one token.
    return F.greatest(F.lit(1), F.floor(F.length("prompt") / 4)).cast("int").alias("estimated_input")


def complete(requests: DataFrame, completer: Completer, parallelism: int | None = None, stage: str = "unknown") -> DataFrame:
    """One call per request inside the tasks; a call that raises becomes a row with its message.

    ``parallelism`` bounds the calls in flight at the price of one shuffle of the requests; without it
    the input partitions are used as they are. Stage the result (``session.stage``) before reading it
    more than once: recomputing it would call the model again.
    """
    if parallelism:
        requests = requests.repartition(parallelism)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(request_json: str) -> tuple[str | None, str | None, int]:
            start = time.monotonic()
            try:
                answer, problem = json.dumps(completer(json.loads(request_json))), None
            except Exception as caught:  # noqa: BLE001 - any failure of a call belongs to its row
                answer, problem = None, str(caught)
            return answer, problem, int((time.monotonic() - start) * 1000)

        for batch in batches:
            for start in range(0, len(batch), SLICE):
                some = batch.iloc[start : start + SLICE].copy()
                answers = [one(body) for body in some.pop("request_json")]
                some[["response_json", "call_error", "duration_ms"]] = pd.DataFrame(
                    answers, index=some.index, columns=["response_json", "call_error", "duration_ms"]
                ).astype(object)
                yield some

    answered = requests.select(*_KEPT, _estimated_input(), "request_json").mapInPandas(
        call,
        f"{_KEPT_TYPES}, estimated_input int, response_json string, call_error string, duration_ms int",
    )
    return answered.withColumn("stage", F.lit(stage))


def complete_mock(requests: DataFrame, response: dict | None = None, stage: str = "unknown") -> DataFrame:
    """The given response, or ``{}``, for every request; no Python in the tasks."""
    return requests.select(
        *_KEPT,
        _estimated_input(),
        F.lit(json.dumps(response or {})).alias("response_json"),
        F.lit(None).cast("string").alias("call_error"),
        F.lit(0).alias("duration_ms"),
        F.lit(stage).alias("stage"),
    )


def complete_replay(requests: DataFrame, stored: DataFrame, stage: str = "unknown") -> DataFrame:
    """Stored responses (``file_path``, ``variant``, ``part_no``, ``response_json``) in place of calls.

    Stored rows are unique by path, variant and part; without part numbers they belong to first parts. A request
    without a stored response fails on its own.
    """
    part = F.col("part_no") if "part_no" in stored.columns else F.lit(1)
    answers = stored.select("file_path", "variant", part.cast("int").alias("part_no"), "response_json")
    return (
        requests.select(*_KEPT, _estimated_input())
        .join(answers, ["file_path", "variant", "part_no"], "left")
        .select(
            *_KEPT,
            "estimated_input",
            "response_json",
            F.when(F.col("response_json").isNull(), F.lit(NO_RESPONSE)).alias("call_error"),
            F.lit(0).alias("duration_ms"),
            F.lit(stage).alias("stage"),
        )
    )
