"""Stored responses read as Python's ``json`` reads them, whatever their size.

Spark's parser settles the common shapes. Texts it turns down (repeated keys, NaN, text after the value, more than a
VARIANT holds) cross to Python, which accepts or refuses them and hands back a plain, small form of what it accepts.
"""

from __future__ import annotations

import hashlib
import json
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType

from docloom.functions.jsontext import SPARK_BYTES, probe_json, probed_value

# Characters from which on a text is cut down to what is read of it, and from which on a string in it is set aside.
LONGEST, ASIDE = 16 << 20, 1 << 16
# Plain numbers that are true or false, and compare with a budget of tokens, as Python's constants do.
_CONSTANTS = {"NaN": 5e-324, "Infinity": sys.float_info.max, "-Infinity": -sys.float_info.max}
# The same numbers as Spark shows them.
_SHOWN = {"4.9E-324": "NaN", "1.7976931348623157E308": "Infinity", "-1.7976931348623157E308": "-Infinity"}
_READ = (
    StructType().add("accepted", BooleanType()).add("json", StringType())
    .add("marks", ArrayType(StringType())).add("strings", ArrayType(StringType()))
)


def plain_form(text: str, kept: tuple[str, ...], longest: int = LONGEST, aside: int = ASIDE):
    """Whether Python accepts the text, plain JSON for it, and marks in that JSON with the strings they stand for.

    Of a text beyond ``longest`` only the top-level keys ``kept`` stay, the first item of their lists, and marks in place
    of strings beyond ``aside``.
    """
    try:
        value = json.loads(text, parse_constant=_CONSTANTS.get)
    except (ValueError, RecursionError):
        return False, None, None, None
    marks: list[str] = []
    strings: list[str] = []

    def smaller(part):
        if isinstance(part, str) and len(part) > aside:
            marks.append(f"{len(marks)}:{hashlib.sha256(part.encode('utf-8', 'surrogatepass')).hexdigest()}")
            strings.append(part)
            return marks[-1]
        if isinstance(part, list):
            return [smaller(item) for item in part]
        return {key: smaller(item) for key, item in part.items()} if isinstance(part, dict) else part

    if len(text) > longest:
        if isinstance(value, dict):
            tops = {key: value[key] for key in kept if key in value}
            value = {key: top[:1] if isinstance(top, list) else top for key, top in tops.items()}
        value = smaller(value)
    return True, json.dumps(value), marks, strings


def read_envelopes(rows: DataFrame, text: str, kept: tuple[str, ...], longest: int = LONGEST) -> DataFrame:
    """``rows`` with ``doc`` (VARIANT), ``accepted``, and ``marks`` and ``strings`` for ``whole_text``.

    ``doc`` is null where the text is null or Python refuses it. Replaces columns of these names.
    """
    @pandas_udf(_READ)
    def read(texts: pd.Series) -> pd.DataFrame:
        forms = [(None,) * 4 if body is None else plain_form(body, kept, longest) for body in texts]
        return pd.DataFrame(forms, columns=_READ.names)

    own = [c for c in rows.columns if c not in ("doc", *_READ.names)]
    probed = rows.select(*own, F.when(F.octet_length(text) <= SPARK_BYTES, probe_json(F.col(text))).alias("probe"))
    judged = probed.select(*own, probed_value(F.col("probe"), F.col(text)).alias("first"))
    # Not deterministic, so that filters stay above it and the call is made once.
    second = judged.withColumn("second", read.asNondeterministic()(F.when(F.col("first").isNull(), F.col(text))))
    return second.select(
        *own, F.coalesce("first", F.try_parse_json("second.json")).alias("doc"),
        F.when(F.col(text).isNotNull(), F.coalesce("second.accepted", F.lit(True))).alias("accepted"),
        F.col("second.marks").alias("marks"), F.col("second.strings").alias("strings"),
    )


def whole_text(text: Column) -> Column:
    """``text``, read from ``doc``, with the strings that were set aside."""
    numbers = F.sequence(F.lit(0), F.size("marks") - 1)
    filled = F.aggregate(
        numbers, text, lambda done, i: F.replace(done, F.get(F.col("marks"), i), F.get(F.col("strings"), i))
    )
    return F.when(F.coalesce(F.size("marks"), F.lit(0)) > 0, filled).otherwise(text)


def shown_number(text: Column) -> Column:
    """The text of a number, with Python's constants under their names."""
    names = F.create_map(*[F.lit(word) for pair in _SHOWN.items() for word in pair])
    return F.coalesce(F.try_element_at(names, text), text)
