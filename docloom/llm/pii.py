"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums and digit counts confirm them, and words nearby adjust the score of the
kinds that a pattern alone does not settle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.shared import let, text_of

BLOCK = 256
NEAR = 40
THRESHOLD = 0.6

# The weights of mod-97 letters are 10 to 35.
DIGITS_AND_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def octets_ok(found: Column) -> Column:
    """Each part is at most 255, whatever zeros lead it."""

    def small(part: Column) -> Column:
        return let(
            F.ltrim(part, F.lit("0")),
            lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)),
        )

    return F.forall(F.split(found, r"\."), small)


def luhn_ok(digits: Column) -> Column:
    def value(rev: Column, i: Column) -> Column:
        doubled = F.substr(rev, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    total = let(
        F.reverse(digits),
        lambda rev: F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda s, i: s + value(rev, i)),
    )
    return total % 10 == 0


def mod97_ok(found: Column) -> Column:
    """The four leading characters go to the end, letters count 10 to 35, and the number leaves 1 modulo 97."""

    def step(rest: Column, at: Column, turned: Column) -> Column:
        value = F.instr(F.lit(DIGITS_AND_LETTERS), F.substr(turned, at, F.lit(1))) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    def rest_of(turned: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(turned))
        return F.aggregate(places, F.lit(0), lambda rest, at: step(rest, at, turned))

    plain = F.replace(found, F.lit(" "), F.lit(""))
    turned = let(plain, lambda p: F.concat(F.substr(p, F.lit(5)), F.substr(p, F.lit(1), F.lit(4))))
    return let(turned, rest_of) == 1


def card_ok(found: Column) -> Column:
    return let(_digits(found), lambda d: F.when(F.length(d).between(16, 19), luhn_ok(d)).otherwise(False))


def short_card_ok(found: Column) -> Column:
    return let(_digits(found), lambda d: F.when(F.length(d).between(13, 15), luhn_ok(d)).otherwise(False))


def phone_ok(found: Column) -> Column:
    return F.length(_digits(found)).between(8, 15)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirm`` checks, ``score`` and ``near`` (added if one of ``words`` is nearby) decide.

    Patterns are written so that no text costs the square of its length: runs are possessive and start at their left
    end. They find the same leftmost matches as the plain forms of the contract, which stand beside them.
    """

    name: str
    pattern: str
    confirm: Callable[[Column], Column] | None = None
    score: float = 1.0
    near: float = 0.0
    words: str | None = None


def _near(words: str) -> str:
    """Any of the words, whatever their case, without letters beside it."""
    return "(?i)(?:^|[^a-z])(?:" + "|".join(words.split()) + ")(?:[^a-z]|$)"


_CARD = r"[0-9](?:[ -]?[0-9])++"
BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; a match may begin where the one before has ended
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", octets_ok),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", _CARD, card_ok),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", phone_ok),
)
EXTRA = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", mod97_ok, 0.8, 0.2, _near("iban account bank konto compte cuenta")),
    Kind("short_card", _CARD, short_card_ok, 0.4, 0.4, _near("card visa amex credit karte carte tarjeta")),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", None, 0.3, 0.5, _near("ssn social security tax")),
)


def _running(steps: Column) -> Column:
    """Running sums of a short array."""
    empty = F.array().cast("array<long>")
    return F.aggregate(
        steps, empty, lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)
    )


def running_sums(steps: Column) -> Column:
    """Running sums of an array of longs, by blocks, so that long arrays do not cost their square."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: _running(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))

    def shifted(sums: Column) -> Column:
        ends = _running(F.transform(sums, lambda s: F.element_at(s, -1)))
        return let(
            ends,
            lambda e: F.flatten(
                F.transform(sums, lambda s, i: F.transform(s, lambda x: x + F.when(i > 0, F.get(e, i - 1)).otherwise(0)))
            ),
        )

    return let(blocks, shifted)


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _matches(text: Column, kind: Kind) -> Column:
    return F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))


def _confirmed(kind: Kind, found: Column) -> Column:
    return F.lit(True) if kind.confirm is None else F.coalesce(kind.confirm(found), F.lit(False))


def _score(kind: Kind, gaps: Column, i: Column) -> Column:
    if kind.words is None:
        return F.lit(kind.score)
    around = F.concat_ws(
        "\n", F.right(F.get(gaps, i), F.lit(NEAR)), F.left(F.get(gaps, i + 1), F.lit(NEAR))
    )
    return F.lit(kind.score) + F.when(F.rlike(around, F.lit(kind.words)), kind.near).otherwise(0.0)


def spans_of(text: Column, kind: Kind) -> Column:
    """The confirmed spans of one kind, in code points, end exclusive, in the order of the text.

    The gaps between matches come from splitting at the same pattern, so a span's place is a running sum of lengths.
    """

    def placed(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long"))
        return let(
            steps,
            lambda s: let(
                running_sums(s),
                lambda ends: F.filter(
                    F.transform(
                        found,
                        lambda m, i: F.when(
                            _confirmed(kind, m),
                            F.struct(
                                F.lit(kind.name).alias("kind"), (F.get(ends, i) - F.length(m)).alias("start"),
                                F.get(ends, i).alias("end"), _score(kind, gaps, i).alias("score"),
                            ),
                        ),
                    ),
                    lambda span: span["score"] >= THRESHOLD,
                ),
            ),
        )

    return let(
        _matches(text, kind),
        lambda found: F.when(F.size(found) == 0, F.array().cast(SPAN_TYPE)).otherwise(
            let(F.split(text, kind.pattern, -1), lambda gaps: placed(found, gaps)).cast(SPAN_TYPE)
        ),
    )


def find_pii(documents: DataFrame, text_col: str = "text", extra: bool = True) -> DataFrame:
    """All columns of ``documents`` and ``_pii``: spans (kind, start, end, score) by kind as listed, then by start.

    Null and empty texts have no spans. Rows are looked at one by one, so repeated rows, ties and other columns
    change nothing. Kinds of ``BASE`` keep every confirmed match; those of ``EXTRA`` (account numbers with a mod-97
    checksum, shorter card numbers, social security numbers) need a score of 0.6, to which words within 40 code
    points add. There is no shuffle.
    """
    kinds = BASE + EXTRA if extra else BASE
    return documents.withColumn("_pii", F.concat(*[spans_of(text_of(text_col), kind) for kind in kinds]))


def _masked(text: Column, kind: Kind) -> Column:
    """``text``, a lambda's variable, with the kind's confirmed matches replaced."""

    def joined(found: Column, gaps: Column) -> Column:
        keep = F.transform(
            found,
            lambda m, i: F.concat(
                F.get(gaps, i),
                F.when(_confirmed(kind, m) & (_score(kind, gaps, i) >= THRESHOLD), F.lit(f"<{kind.name.upper()}>"))
                .otherwise(m),
            ),
        )
        return F.concat(F.array_join(keep, ""), F.element_at(gaps, -1))

    return let(
        _matches(text, kind),
        lambda found: F.when(F.size(found) == 0, text).otherwise(
            let(F.split(text, kind.pattern, -1), lambda gaps: joined(found, gaps))
        ),
    )


def _masking(kind: Kind) -> Callable[[Column], Column]:
    return lambda text: _masked(text, kind)


def mask_pii(documents: DataFrame, text_col: str = "text", extra: bool = True) -> DataFrame:
    """``documents`` with every confirmed match replaced by its kind in angle brackets.

    Kinds are replaced one after another in their order, each in what the one before has left. Null texts become
    empty; everything else passes through.
    """
    text = text_of(text_col)
    for kind in BASE + EXTRA if extra else BASE:
        text = let(text, _masking(kind))
    return documents.withColumn(text_col, text)
