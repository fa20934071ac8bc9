"""A walk over a JSON text that holds one member at a time, with the verdicts and messages of Python's ``json``."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from json import JSONDecodeError
from json.decoder import scanstring

_BLANK = re.compile(r"[ \t\n\r]*")

# What Python's ``json`` says of a text that is not JSON.
NO_COLON = "Expecting ':' delimiter"
NO_COMMA = "Expecting ',' delimiter"
NO_NAME = "Expecting property name enclosed in double quotes"
LATE_COMMA = "Illegal trailing comma before end of "
MORE = "Extra data"
BYTE_ORDER_MARK = "Unexpected UTF-8 BOM (decode using utf-8-sig)"


def _after_blanks(text: str, at: int) -> int:
    return _BLANK.match(text, at).end()


def _after_item(text: str, at: int, closer: str, owner: str) -> tuple[int, bool]:
    """Where the next item begins, or the end of the container, and whether it ends there."""
    at = _after_blanks(text, at)
    mark = text[at : at + 1]
    if mark == closer:
        return at + 1, True
    if mark != ",":
        raise JSONDecodeError(NO_COMMA, text, at)
    after = _after_blanks(text, at + 1)
    if text[after : after + 1] == closer:
        raise JSONDecodeError(LATE_COMMA + owner, text, at)
    return after, False


def walk_object(text: str, at: int, visit: Callable[[str, int], int]) -> int:
    """The end of the object that begins at ``at``; ``visit`` gets each key with the start of its value and returns its end."""
    at = _after_blanks(text, at + 1)
    if text[at : at + 1] == "}":
        return at + 1
    ended = False
    while not ended:
        if text[at : at + 1] != '"':
            raise JSONDecodeError(NO_NAME, text, at)
        key, at = scanstring(text, at + 1, True)
        at = _after_blanks(text, at)
        if text[at : at + 1] != ":":
            raise JSONDecodeError(NO_COLON, text, at)
        at, ended = _after_item(text, visit(key, _after_blanks(text, at + 1)), "}", "object")
    return at


def array_items(text: str, at: int, decoder: json.JSONDecoder) -> Iterator[tuple[int, int]]:
    """Start and end of each item of the array that begins at ``at``, and at last the array's own end twice."""
    at = _after_blanks(text, at + 1)
    ended = text[at : at + 1] == "]"
    if ended:
        at += 1
    while not ended:
        _, end = decoder.raw_decode(text, at)
        yield at, end
        at, ended = _after_item(text, end, "]", "array")
    yield at, at


class ParsedDocument:
    """Where a parser's output has its status and its elements. Raises as ``json.loads`` does on texts that are not JSON.

    Of repeated keys the last one counts. Elements are walked once for the verdict, without being kept.
    """

    def __init__(self, text: str):
        self.text = text
        self.decoder = json.JSONDecoder()
        self.status: tuple[int, int] | None = None
        self.elements: int | None = None
        if text.startswith("﻿"):
            raise JSONDecodeError(BYTE_ORDER_MARK, text, 0)
        start = _after_blanks(text, 0)
        end = walk_object(text, start, self._member) if text[start : start + 1] == "{" else self.decoder.raw_decode(text, start)[1]
        end = _after_blanks(text, end)
        if end != len(text):
            raise JSONDecodeError(MORE, text, end)

    def _member(self, key: str, start: int) -> int:
        if key == "document":
            self.elements = None
            if self.text[start : start + 1] == "{":
                return walk_object(self.text, start, self._document_member)
        _, end = self.decoder.raw_decode(self.text, start)
        if key == "error_status":
            self.status = start, end
        return end

    def _document_member(self, key: str, start: int) -> int:
        if key == "elements":
            self.elements = None
            if self.text[start : start + 1] == "[":
                self.elements = start
                for _, end in array_items(self.text, start, self.decoder):
                    pass
                return end
        return self.decoder.raw_decode(self.text, start)[1]

    def element_texts(self) -> Iterator[str]:
        """The JSON text of each element, one at a time."""
        if self.elements is None:
            return
        odd: list[bool] = []

        def members(pairs: list) -> dict:
            value = dict(pairs)
            if len(value) < len(pairs):
                odd.append(True)
            return value

        def constant(name: str) -> str:
            odd.append(True)
            return name

        decoder = json.JSONDecoder(object_pairs_hook=members, parse_constant=constant)
        for start, end in array_items(self.text, self.elements, decoder):
            if end > start:
                # Repeated keys and constants that only Python takes for JSON are written anew.
                yield plain_json(self.text[start:end]) if odd else self.text[start:end]
            odd.clear()


def plain_json(text: str) -> str:
    """JSON as every parser takes it: the last of repeated keys, NaN and infinities as text."""
    return json.dumps(json.loads(text, parse_constant=str))
