"""JSON validity, isolation and repair.

Spark's own parser settles every well-formed text. Only texts it turns down cross to Python, where
the exact verdict and error message of Python's ``json`` are needed; the others cross as null.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType, StructType

from docloom.functions.text import WHITESPACE, outer_braces

# Bytes up to which Spark's parser is asked; longer texts are Python's to judge. A VARIANT holds at most 128 MiB.
SPARK_BYTES = 64 << 20

_MARK = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_CLOSER = {"{": "}", "[": "]"}
_TAIL = ",:" + WHITESPACE
_SETTLED = StructType().add("json", StringType()).add("repaired", BooleanType()).add("error", StringType())
_RECHECKED = StructType().add("json", StringType()).add("error", StringType())


def _mark(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def probe_json(text: Column) -> Column:
    """The text parsed as the first item of an array whose second item is a hash of the text.

    ``try_parse_json`` ignores what follows the first value; the hash in second place shows that the text
    is exactly one value.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), _mark(text), F.lit('"]')))


def probed_value(probe: Column, text: Column) -> Column:
    """The parsed text, or null where it is not exactly one JSON value."""
    return F.when(_is_sole_value(probe, text), F.try_variant_get(probe, "$[0]", "variant"))


def _is_sole_value(probe: Column, text: Column) -> Column:
    return F.coalesce(F.try_variant_get(probe, "$[1]", "string") == _mark(text), F.lit(False))


def strict_json(text: Column) -> Column:
    """True where Spark's parser finds the text to be exactly one JSON value."""
    return _is_sole_value(probe_json(text), text)


def close_truncated(text: str) -> str:
    """Close what a cut-off JSON object left open; raises when the result is not valid."""
    start = text.find("{")
    if start < 0:
        raise ValueError("No JSON object found in text")
    body = text[start:].rstrip(_TAIL)
    if body.endswith('"') and body.count('"') % 2:
        body = body[:-1].rstrip(_TAIL)
    pending: list[str] = []
    quoted = False
    for mark in _MARK.findall(body):
        if mark == '"':
            quoted = not quoted
        elif quoted or mark[0] == "\\":
            continue
        elif mark in _CLOSER:
            pending.append(_CLOSER[mark])
        elif pending and pending[-1] == mark:
            pending.pop()
    body += "".join(reversed(pending))
    json.loads(body)
    return body


def isolate(text: str) -> str:
    """The text if it is JSON, else its outermost braces if those are; raises otherwise."""
    try:
        json.loads(text)
        return text
    except (ValueError, RecursionError):
        head, tail = text.find("{"), text.rfind("}") + 1
        if head < 0 or tail - head < 2:
            raise ValueError(f"Could not isolate valid JSON from model output: {text[:2000]}") from None
    json.loads(text[head:tail])
    return text[head:tail]


def _settle_one(text: str, truncated: bool, reserialise: bool) -> tuple[str | None, bool, str | None]:
    try:
        return isolate(text), False, None
    except (ValueError, RecursionError) as problem:
        if not truncated:
            return None, False, str(problem)
    try:
        closed = close_truncated(text)
        return (json.dumps(json.loads(closed)) if reserialise else closed), True, None
    except (ValueError, RecursionError) as problem:
        return None, False, str(problem)


def _settle_udf(reserialise: bool):
    @pandas_udf(_SETTLED)
    def settle(text: pd.Series, truncated: pd.Series) -> pd.DataFrame:
        rows = [
            (None, None, None) if body is None else _settle_one(body, bool(cut), reserialise)
            for body, cut in zip(text, truncated)
        ]
        return pd.DataFrame(rows, columns=["json", "repaired", "error"])

    return settle


def clean_json(text: Column) -> Column:
    """The JSON in a fence-free text where Spark's parser is enough to tell; null where Python must decide.

    A text starting with ``[`` or a quote may be JSON as a whole by Python's wider rules while only its
    braces pass here, so those are left to Python.
    """
    braces = outer_braces(text)
    sliceable = ~text.startswith("[") & ~text.startswith('"') & strict_json(braces)
    return F.when(F.octet_length(text) <= SPARK_BYTES, F.when(strict_json(text), text).when(sliceable, braces))


def settle_json(text: Column, truncated: Column, reserialise: bool) -> Column:
    """Python's verdict for the texts given; pass null for texts that are already settled.

    Marked as not deterministic so that filters on the verdict stay above it. Pushed down, they would
    repeat the call and every expression that leads to it.
    """
    return _settle_udf(reserialise).asNondeterministic()(text, truncated)


@pandas_udf(_RECHECKED)
def _recheck(text: pd.Series) -> pd.DataFrame:
    def verdict(body: str | None) -> tuple[str | None, str | None]:
        if body is None:
            return None, None
        try:
            return json.dumps(json.loads(body, parse_constant=str)), None
        except (ValueError, RecursionError) as problem:
            return None, str(problem)

    return pd.DataFrame([verdict(body) for body in text], columns=["json", "error"])


def recheck_json(text: Column) -> Column:
    """Texts Spark's parser turned down: plain JSON where Python accepts them, else Python's message.

    Not deterministic for the same reason as ``settle_json``.
    """
    return _recheck.asNondeterministic()(text)
