"""Word and character n-grams as array expressions (no shuffle, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def word_kgrams(tokens, k: int) -> Column:
    """Contiguous k-token windows joined by one space; fewer than k tokens
    gives [] (the guard also keeps ``sequence`` from counting down).

    Built as ``zip_with`` over k shifted slices: every step is linear, and
    no lambda refers to the token array itself, so the optimizer inlining the
    token expression (e.g. when it pushes a filter down) cannot make the
    per-position work re-run the tokenizer. (``slice`` inside a lambda would
    copy the whole array per position: quadratic.)"""
    tok = _col(tokens)
    if k == 1:
        return tok
    m = F.size(tok) - k + 1
    acc = F.slice(tok, 1, m)
    for j in range(1, k):
        acc = F.zip_with(acc, F.slice(tok, 1 + j, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(tok) >= k, acc).otherwise(_empty_strings())


def word_ngrams(tokens, n_lo: int = 1, n_hi: int = 2) -> Column:
    """All word n-grams for n in [n_lo, n_hi], shorter n first."""
    parts = [word_kgrams(tokens, k) for k in range(n_lo, n_hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_kgrams(text, k: int) -> Column:
    """Every substring of k characters (overlapping), by a look-ahead match
    per start position: linear in the text, unlike substring-per-position. No match
    starts in the second half of a surrogate pair, which Java's regex would try."""
    return F.regexp_extract_all(_col(text), F.lit(rf"(?s)(?![\x{{dc00}}-\x{{dfff}}])(?=(.{{{k}}}))"), 1)


def _prefix(n: int):
    return lambda g: F.substring(g, 1, n)


def char_ngrams(text, n_lo: int = 3, n_hi: int = 4, top=None) -> Column:
    """All character n-grams for n in [n_lo, n_hi] from one regex pass:
    the n_hi-grams are matched, every shorter n-gram is a prefix of one of
    them except the last few, which come from the text's short tail.
    ``top`` may name a column already holding ``char_kgrams(text, n_hi)``."""
    t = _col(text)
    top = _col(top) if top is not None else char_kgrams(t, n_hi)
    if n_lo == n_hi:
        return top
    tail = F.when(F.length(t) >= n_hi, F.substring(t, -(n_hi - 1), n_hi - 1)).otherwise(t)
    parts = [top]
    for n in range(n_lo, n_hi):
        parts.append(F.transform(top, _prefix(n)))
        parts.append(char_kgrams(tail, n))
    return F.concat(*parts)
