"""Character classes derived by rule from Python's own Unicode predicates.

The reference's text rules are Python ``str`` semantics (``str.split``,
``str.isdigit``, ``\\s``, ``\\w``). Java regex and RE2 spell these classes
differently, so every class here is generated from the Python predicate over
all code points and written as ``\\x{..}`` ranges, which both Java (Spark) and
RE2 (the DuckDB oracle) accept. Built lazily, once per process.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

_SURROGATES = range(0xD800, 0xE000)


def _code_points(pred):
    for c in range(sys.maxunicode + 1):
        if c in _SURROGATES:
            continue
        if pred(chr(c)):
            yield c


def _ranges(cps):
    out = []
    for c in cps:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return out


def _class_body(cps) -> str:
    parts = []
    for lo, hi in _ranges(cps):
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "".join(parts)


@functools.cache
def ws_body() -> str:
    """Body of the Python whitespace class (``str.isspace``), no brackets."""
    return _class_body(_code_points(str.isspace))


@functools.cache
def ws_class() -> str:
    return f"[{ws_body()}]"


@functools.cache
def ws_chars() -> str:
    """The characters of the class."""
    return "".join(chr(c) for c in _code_points(str.isspace))


@functools.cache
def non_ws_class() -> str:
    return f"[^{ws_body()}]"


@functools.cache
def digit_chars() -> str:
    """All characters for which ``str.isdigit`` holds (for translate-counting)."""
    return "".join(chr(c) for c in _code_points(str.isdigit))


# The reference's punctuation set for punct_ratio and its
# second-person word set, as literal text.
PUNCT_CHARS = ".,;:!?\"'()[]{}"
SECOND_PERSON = ("you", "u", "ur", "ya", "youre", "you're")

# Word characters of Python's ``\w`` on str: letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"


def _stripped(ch: str) -> str:
    n = unicodedata.normalize("NFKD", ch)
    return "".join(c for c in n if not unicodedata.combining(c))


@functools.cache
def accent_maps() -> tuple[str, str, str, str]:
    """Per-character accent stripping tables (NFKD, then drop combining marks).

    Returns ``(one_from, one_to, drop, multi)``:
      * ``one_from``/``one_to``: characters NFKD changes into exactly one
        non-combining character, and that character;
      * ``drop``: characters NFKD changes into combining marks only, followed by
        the NFKD-stable combining marks;
      * ``multi``: characters NFKD expands into two or more characters.
    """
    one_from, one_to, drop_changed, marks, multi = [], [], [], [], []
    for c in range(sys.maxunicode + 1):
        if c in _SURROGATES:
            continue
        ch = chr(c)
        n = unicodedata.normalize("NFKD", ch)
        if n == ch:
            if unicodedata.combining(ch):
                marks.append(ch)
            continue
        s = _stripped(ch)
        if len(s) == 1:
            one_from.append(ch)
            one_to.append(s)
        elif not s:
            drop_changed.append(ch)
        else:
            multi.append(ch)
    return "".join(one_from), "".join(one_to), "".join(drop_changed + marks), "".join(multi)


def sql_literal(s: str) -> str:
    """Quote a Python string as an ANSI SQL literal."""
    return "'" + s.replace("'", "''") + "'"
