"""Shell globs as column predicates.

``*`` and ``?`` cross ``/``; matching is case-sensitive and covers the whole key. Globs with
at most two stars at the ends become plain string predicates, which a Parquet scan can use to
skip row groups; the others become anchored regular expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from .keys import _col

_NEEDS_ESCAPE_IN_CLASS = set("\\[]^&~|")


def _class_body(inner: str) -> str:
    """The inside of ``[...]`` for Java: ranges kept, everything special escaped."""
    negated = inner.startswith("!")
    chars = inner[1:] if negated else inner
    pieces: list[str] = []
    at = 0
    while at < len(chars):
        low = chars[at]
        if at + 2 < len(chars) and chars[at + 1] == "-":
            high = chars[at + 2]
            # A range that runs backwards holds no character.
            if low <= high:
                pieces.append(f"{_in_class(low)}-{_in_class(high)}")
            at += 3
        else:
            pieces.append(_in_class(low))
            at += 1
    if not pieces:
        return r"[\s\S]" if negated else r"(?!)"
    return f"[{'^' if negated else ''}{''.join(pieces)}]"


def _in_class(char: str) -> str:
    return "\\" + char if char in _NEEDS_ESCAPE_IN_CLASS or char == "-" else char


def glob_to_regex(pattern: str) -> str:
    out: list[str] = []
    at = 0
    while at < len(pattern):
        char = pattern[at]
        at += 1
        if char == "*":
            if not out or out[-1] != ".*":
                out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            # A "]" straight after "[" or "[!" belongs to the class.
            start = at + 1 if pattern[at:at + 1] == "!" else at
            close = pattern.find("]", start + 1)
            if close < 0:
                out.append(r"\[")
            else:
                out.append(_class_body(pattern[at:close]))
                at = close + 1
        elif char.isalnum() or char == "_" or ord(char) > 127:
            out.append(char)
        else:
            out.append("\\" + char)
    return r"(?s)\A" + "".join(out) + r"\z"


def _matches(key: Column, pattern: str) -> Column:
    """One glob as the cheapest predicate that says the same."""
    if not re.search(r"[?\[]", pattern):
        pieces = re.sub(r"\*+", "*", pattern).split("*")
        if len(pieces) == 1:
            return key == pattern
        first, last = pieces[0], pieces[-1]
        if len(pieces) == 2:
            tests = ([key.startswith(first)] if first else []) + (
                [key.endswith(last)] if last else [])
            if not tests:
                return key.isNotNull()
            if len(tests) == 1:
                return tests[0]
            # The two ends must not overlap.
            return tests[0] & tests[1] & (F.char_length(key) >= len(first) + len(last))
        if len(pieces) == 3 and not first and not last:
            return key.contains(pieces[1])
    return key.rlike(glob_to_regex(pattern))


def glob_match(key: Column | str, patterns: Iterable[str]) -> Column:
    """True where any pattern matches."""
    tests = [_matches(_col(key), p) for p in patterns]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def glob_included(
    key: Column | str, exclude: Iterable[str] = (), include: Iterable[str] = ()
) -> Column:
    """An exclude match rejects; then at least one include must match where there are any."""
    exclude, include = list(exclude or ()), list(include or ())
    kept = ~glob_match(key, exclude) if exclude else F.lit(True)
    return kept & glob_match(key, include) if include else kept
