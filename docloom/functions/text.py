"""String helpers whose results match Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's ``str.strip`` and ``\s`` count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop white space at both ends, as Python's ``strip`` does (Spark's ``trim`` drops spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def drop_fences(stripped: Column) -> Column:
    """A stripped text without a leading ``` or ```json mark and a trailing ``` mark."""
    fenced = stripped.startswith("```") | stripped.endswith("```")
    bare = strip(F.regexp_replace(stripped, r"\A```(?:json)?|```\z", ""))
    return F.when(fenced, bare).otherwise(stripped)


def outer_braces(text: Column) -> Column:
    """The slice from the first ``{`` to the last ``}``; null where there is none."""
    first = F.instr(text, "{")
    last = F.length(text) - F.instr(F.reverse(text), "}") + 1
    found = (first > 0) & text.contains("}") & (last > first)
    return F.when(found, F.substr(text, first, last - first + 1))


def file_name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path: Column) -> Column:
    """``dbfs:/a/b`` as ``/a/b``."""
    return F.regexp_replace(path, "^dbfs:/", "/")


def page_open(number: Column) -> Column:
    return F.concat(F.lit("=== PAGE "), number.cast("string"), F.lit(" START ===\n"))


def page_close(number: Column) -> Column:
    return F.concat(F.lit("\n=== PAGE "), number.cast("string"), F.lit(" END ==="))


def ascii_json_length(text: Column) -> Column:
    """Length of the text as an ASCII JSON string with its quotes, as Python's ``json.dumps`` writes it."""
    # Two characters for a short escape, six for \\uXXXX, twelve for a surrogate pair.
    short = F.regexp_count(text, F.lit(r'["\\\n\r\t\x08\x0c]'))
    other = F.regexp_count(text, F.lit(r'[^ -~\n\r\t\x08\x0c]'))
    astral = F.regexp_count(text, F.lit(r"[\x{10000}-\x{10FFFF}]"))
    return F.length(text) + short + other * 5 + astral * 6 + 2
