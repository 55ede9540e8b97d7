"""Split one file's text into JSON records (pure-Python helper run in tasks).

Handles, in one pass, the layouts found in the feeds:

* concatenated objects ``{..}{..}`` with any whitespace or commas between
  (this includes NDJSON and pretty-printed NDJSON);
* one top-level array ``[{..}, {..}]`` (its elements are the records);
* one object.

Each record comes back as its exact source text, so the JVM parses it with
the declared schema.  Problems are reported per record and never raise:

* ``malformed``: a balanced ``{..}`` that is not valid JSON; reading resumes
  after its closing brace (found string-aware, so braces inside string
  literals do not count);
* ``not_object``: a top-level or array element that is not an object;
* ``unterminated``: the text ends inside a record; the rest of the file is
  one error row and the file ends there.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

_DECODER = json.JSONDecoder()
# Up to the next bracket outside string literals (with escapes), to a quote
# that is never closed before the end of the text, or to the end.
_NEXT = re.compile(r'(?:[^"{}\[\]]++|"(?:[^"\\]++|\\.)*+")*+(["{}\[\]]|\Z)', re.S)
_OPENING = re.compile(r"[{\[]")
# A string, number or literal that ends where a value may end.
_SCALAR = re.compile(r'(?:"(?:[^"\\\x00-\x1f]|\\.)*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity)')
_SEPARATORS = " \t\r\n,﻿"

OK = None
MALFORMED = "malformed"
NOT_OBJECT = "not_object"
UNTERMINATED = "unterminated"


def _skip(text: str, i: int) -> int:
    n = len(text)
    while i < n and text[i] in _SEPARATORS:
        i += 1
    return i


def balanced_end(text: str, start: int) -> int:
    """Index after the bracket closing the one at ``start``; -1 if none."""
    depth = 0
    jump = _NEXT.match
    at = start
    while True:
        m = jump(text, at)
        tok, at = m.group(1), m.end()
        if tok == "{" or tok == "[":
            depth += 1
        elif tok == "}" or tok == "]":
            depth -= 1
            if depth == 0:
                return at
        else:
            return -1  # an unclosed string, or the end of the text


class _Reader:
    """Decodes one text value by value, in time linear in its length.

    Good values are decoded in place.  A failed decode costs a pass over the
    text before it (the decoder counts lines), so after the first failure
    values are decoded from a short slice, and from their own text if they are
    longer than that.
    """

    SLICE = 4096

    def __init__(self, text: str):
        self.text = text
        self.careful = False

    def one(self, i: int) -> tuple[str | None, int, str]:
        """One value at ``i``: (error, end, source_text)."""
        text = self.text
        if not self.careful:
            try:
                value, end = _DECODER.raw_decode(text, i)
                return (OK if isinstance(value, dict) else NOT_OBJECT), end, text[i:end]
            except (ValueError, RecursionError):
                self.careful = True
        part = text[i:i + self.SLICE]
        if part[0] in "{[":
            try:
                value, end = _DECODER.raw_decode(part)
                return (OK if isinstance(value, dict) else NOT_OBJECT), i + end, part[:end]
            except (ValueError, RecursionError):
                pass  # bad, or longer than the slice
            end = balanced_end(text, i)
            if end < 0:
                return UNTERMINATED, len(text), text[i:]
            src = text[i:end]
            if end <= i + self.SLICE:
                return MALFORMED, end, src
            try:
                return (OK if isinstance(json.loads(src), dict) else NOT_OBJECT), end, src
            except (ValueError, RecursionError):  # not JSON, or nested too deeply to decode
                return MALFORMED, end, src
        scalar = _SCALAR.match(text, i)
        if scalar:
            return NOT_OBJECT, scalar.end(), scalar.group()
        # Junk outside any record: up to the next opening bracket.
        opening = _OPENING.search(text, i + 1)
        end = opening.start() if opening else len(text)
        return MALFORMED, end, text[i:end]


def _values(text: str, in_array: bool, first: int) -> Iterator[tuple[str, str | None, int, bool]]:
    """(source, error, end, whether an array is open then) of every value; the last one may be cut short.

    ``first`` is the number of values before the text, in whole files 0.
    """
    n = len(text)
    reader = _Reader(text)
    opened_at, count = None, first
    i = _skip(text, 0)
    while i < n:
        if in_array and text[i] == "]":
            in_array = False
            i = _skip(text, i + 1)
            continue
        if not in_array and text[i] == "[":
            # A top-level array: records are its elements.
            in_array, opened_at = True, i
            i = _skip(text, i + 1)
            continue
        err, end, src = reader.one(i)
        yield src, err, end, in_array
        count += 1
        if err == UNTERMINATED:
            return
        i = _skip(text, end)
    if in_array:
        # The array never closes: everything already yielded stands,
        # the missing end is one error row.
        yield (text[opened_at:] if count == 0 and opened_at is not None else ""), UNTERMINATED, n, in_array


def split_records(text: str | None) -> Iterator[tuple[int, str, str | None]]:
    """Yield ``(position, record_text, error)`` for every record in ``text``."""
    for pos, (src, err, _, _) in enumerate(_values(text or "", False, 0)):
        yield pos, src, err


def split_part(text: str, in_array: bool, final: bool, before: int) -> tuple[list[tuple[str, str | None]], str, bool]:
    """Split the next part of a long text: (values, rest, whether an array is open).

    The rest goes in front of the next part: a value that the part ends in, or
    one that only the next part shows to be complete (a number, junk up to the
    next bracket).  ``final`` marks the last part; ``before`` counts the values
    of earlier parts.
    """
    found = list(_values(text, in_array, before))
    if final:
        return [v[:2] for v in found], "", False
    done, at = [], 0
    for src, err, end, array in found:
        if err == UNTERMINATED or (end == len(text) and not src.endswith(("}", "]"))) or end == len(text) and err == MALFORMED:
            break
        done.append((src, err))
        at, in_array = end, array
    # Brackets of top-level arrays stand between values: they are read again with the rest.
    return done, text[at:], in_array
