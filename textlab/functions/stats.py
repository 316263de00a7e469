"""The 14 hand-built raw-text statistics.

Computed on the raw text after ``" ".join(text.split())``; every ratio uses
``max(1, ...)`` denominators like the reference. An Arrow-batched function counts the
characters of many texts at once: their classes are looked up in one table, and runs,
tokens and repeats are compared as arrays, so no regex steps through a text. Strings
are made only for the few tokens that need their case or a web address looked at.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .charclass import PUNCT_CHARS, SECOND_PERSON, digit_chars, sql_literal
from .normalize import ALPHA_RUN_RE, REPEAT_PUNCT_RE, mention_re, ws_join_sql

# Column order of the raw-feature block (fixed, as the reference's).
STAT_COLUMNS = (
    "caps_ratio", "exclam_rate", "question_rate", "punct_ratio", "url_count",
    "elongation_rate", "allcaps_token_share", "digit_ratio", "repeated_punct_rate",
    "elongation_count", "lex_div", "avg_word_len", "second_person_ratio", "mention_count",
)

# On whitespace-joined text the only whitespace left is ' ', so \S is [^ ].
_URL_ON_JOINED = r"https?://[^ ]+|www\.[^ ]+"
#: Characters that are looked at together (a longer text is alone).
SLICE_CHARS = 1 << 20
# Bits of the class table.
_UPPER, _LETTER, _DIGIT, _PUNCT, _WORD, _ALPHA, _SMALL = (1 << i for i in range(7))


@functools.cache
def class_ranges() -> tuple[list[int], list[int]]:
    """Class bits of all code points as (bits, length) runs."""
    digits, punct = set(digit_chars()), set(PUNCT_CHARS)
    bits, lengths = [], []
    for i in range(sys.maxunicode + 1):
        c, kind = chr(i), unicodedata.category(chr(i))
        b = (_UPPER * (kind == "Lu") | _LETTER * (kind[0] == "L") | _DIGIT * (c in digits) | _PUNCT * (c in punct)
             | _WORD * (kind[0] in "LN" or c == "_") | _ALPHA * (c.isascii() and c.isalpha()) | _SMALL * ("a" <= c <= "z"))
        if bits and bits[-1] == b:
            lengths[-1] += 1
        else:
            bits.append(b)
            lengths.append(1)
    return bits, lengths


def _stats_arrow():
    """The statistics of a batch of texts, built as a closure so it ships by value."""
    ranges, names, second, url, most = class_ranges(), STAT_COLUMNS, frozenset(SECOND_PERSON), _URL_ON_JOINED, SLICE_CHARS
    upper, letter, digit, punct, word, alpha, small = _UPPER, _LETTER, _DIGIT, _PUNCT, _WORD, _ALPHA, _SMALL
    longest, begins = max(map(len, second)), sorted({ord(c) for t in second for c in t[0] + t[0].upper()})

    def slice_stats(texts, table, find_urls):
        import numpy as np
        import pyarrow as pa
        n_docs = len(texts)
        lens = np.fromiter(map(len, texts), np.int64, n_docs)
        whole = " ".join(texts) + " "  # a blank behind every text, so none is without a character
        cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        c = table[cp]

        def count(mask):
            return np.add.reduceat(mask, starts, dtype=np.int64)

        def per_doc(at):
            return np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=n_docs)

        blank = cp == 32
        before = np.concatenate([[True], blank[:-1]])
        first = np.flatnonzero(~blank & before)           # of each token
        last = np.flatnonzero(blank & ~before)            # the blank behind it
        doc = np.searchsorted(starts, first, "right") - 1  # of each token
        size = last - first
        n_tok = np.bincount(doc, minlength=n_docs)

        def token(at):
            return np.searchsorted(first, at, "right") - 1

        same = cp[1:] == cp[:-1]
        threes = np.flatnonzero(same[1:] & same[:-1] & ~blank[2:])
        elongated = np.bincount(doc[np.unique(token(threes))], minlength=n_docs)

        # All letters, none of a to z, and no other case: the case is asked of those only.
        other = np.cumsum(np.concatenate([[0], (c & (letter | small)) != letter]))
        able = np.flatnonzero((size >= 2) & (other[last] == other[first])) if len(first) else first
        capital = [i for i in able.tolist() if (t := whole[first[i]:last[i]]).upper() == t]
        able = np.flatnonzero((size <= longest) & np.isin(cp[first], begins)) if len(first) else first
        you = [i for i in able.tolist() if whole[first[i]:last[i]].lower() in second]

        # The first run of A-Z and a-z of each token.
        latin = (c & alpha) != 0
        prior = np.concatenate([[False], latin[:-1]])
        run, end = np.flatnonzero(latin & ~prior), np.flatnonzero(~latin & prior)
        of = token(run)
        own = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
        run, end, of = run[own], end[own], of[own]
        n_run = end - run
        n_alpha = np.bincount(doc[of], minlength=n_docs)
        run_chars = np.bincount(doc[of], n_run, n_docs)
        distinct = np.zeros(n_docs, np.int64)
        if len(run):
            ends = np.cumsum(n_run)
            at = np.repeat(run - ends + n_run, n_run) + np.arange(ends[-1])
            letters = (cp[at] | 32).astype(np.uint8)
            words = pa.StringArray.from_buffers(len(run), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)),
                                                pa.py_buffer(letters.tobytes()))
            ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            distinct = np.bincount(np.unique((doc[of] << 32) | ids) >> 32, minlength=n_docs)

        mark = (cp == 33) | (cp == 63)
        repeated = np.flatnonzero(mark[:-1] & mark[1:] & ~np.concatenate([[False], mark[:-2]]))
        mentions = np.flatnonzero((cp[:-1] == 64) & ((c[1:] & word) != 0))
        one = lambda x: np.maximum(1, x)
        n, tokens, runs = one(lens).astype(float), one(n_tok).astype(float), one(n_alpha).astype(float)
        stats = {
            "caps_ratio": count((c & upper) != 0) / one(count((c & letter) != 0)),
            "exclam_rate": count(cp == 33) / n,
            "question_rate": count(cp == 63) / n,
            "punct_ratio": count((c & punct) != 0) / n,
            "url_count": [len(find_urls(t)) if "http" in t or "www." in t else 0 for t in texts],
            "elongation_rate": elongated / tokens,
            "allcaps_token_share": np.bincount(doc[np.array(capital, np.int64)], minlength=n_docs) / tokens,
            "digit_ratio": count((c & digit) != 0) / n,
            "repeated_punct_rate": per_doc(repeated) / (n / 100.0),
            "elongation_count": elongated,
            "lex_div": distinct / runs,
            "avg_word_len": run_chars / runs,
            "second_person_ratio": np.bincount(doc[np.array(you, np.int64)], minlength=n_docs) / tokens,
            "mention_count": per_doc(mentions),
        }
        return pd.DataFrame({name: np.asarray(stats[name], float) for name in names})

    def batch(s: pd.Series) -> pd.DataFrame:
        import re

        import numpy as np
        table = np.repeat(np.array(ranges[0], np.uint8), ranges[1])
        find_urls = re.compile(url).findall
        parts, held, chars = [], [], 0
        for text in s:
            text = " ".join(text.split()) if text is not None else ""
            if held and chars + len(text) > most:
                parts.append(slice_stats(held, table, find_urls))
                held, chars = [], 0
            held.append(text)
            chars += len(text) + 1
        if held:
            parts.append(slice_stats(held, table, find_urls))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=names, dtype=float)

    return F.pandas_udf(batch, ", ".join(f"{name} double" for name in names))


def raw_text_stats(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns plus the 14 statistics of ``text_col``."""
    stats = _stats_arrow()(F.col(text_col).cast("string")).alias("stats__")
    return df.select(*keep, stats).select(*keep, *[F.col("stats__")[c].alias(c) for c in STAT_COLUMNS])


def _count_chars_sql(s: str, chars: str) -> str:
    return f"(length({s}) - length(translate({s}, {sql_literal(chars)}, '')))"


def raw_text_stats_sql(source: str, text: str = "text", keys: str = "doc_id",
                       digits: int = 6) -> str:
    """DuckDB statement of :func:`raw_text_stats` (values rounded)."""
    sp = ", ".join(sql_literal(w) for w in SECOND_PERSON)
    # RE2 has no back-references: a token is elongated if some character
    # equals its two predecessors (no newline survives the whitespace join).
    elong_tok = ("len(list_filter(string_split(t, ''), lambda x, i: i > 2 "
                 "AND x = string_split(t, '')[i - 1] AND x = string_split(t, '')[i - 2])) > 0")
    stats = {
        "caps_ratio": "len(regexp_extract_all(s2, '\\p{Lu}')) / greatest(1, len(regexp_extract_all(s2, '\\p{L}')))",
        "exclam_rate": f"{_count_chars_sql('s2', '!')} / n",
        "question_rate": f"{_count_chars_sql('s2', '?')} / n",
        "punct_ratio": f"{_count_chars_sql('s2', PUNCT_CHARS)} / n",
        "url_count": f"len(regexp_extract_all(s2, '{_URL_ON_JOINED}'))",
        "elongation_rate": "n_el / n_tok",
        "allcaps_token_share": ("len(list_filter(tok, lambda t: regexp_full_match(t, '\\p{L}+') "
                                "AND upper(t) = t AND length(t) >= 2)) / n_tok"),
        "digit_ratio": f"{_count_chars_sql('s2', digit_chars())} / n",
        "repeated_punct_rate": f"len(regexp_extract_all(s2, '{REPEAT_PUNCT_RE}')) / (n / 100.0)",
        "elongation_count": "n_el",
        "lex_div": "len(list_distinct(list_transform(alpha, lambda t: lower(t)))) / n_alpha",
        "avg_word_len": "coalesce(list_sum(list_transform(alpha, lambda t: length(t))), 0) / n_alpha",
        "second_person_ratio": f"len(list_filter(tok, lambda t: lower(t) IN ({sp}))) / n_tok",
        "mention_count": f"len(regexp_extract_all(s2, '{mention_re()}'))",
    }
    cols = ", ".join(f"round(CAST({stats[c]} AS DOUBLE), {digits}) AS {c}" for c in STAT_COLUMNS)
    return (
        f"WITH j AS (SELECT {keys}, {ws_join_sql(text)} AS s2 FROM {source}), "
        f"t AS (SELECT *, list_filter(string_split(s2, ' '), lambda t: t <> '') AS tok FROM j), "
        f"u AS (SELECT *, greatest(1, length(s2))::DOUBLE AS n, greatest(1, len(tok))::DOUBLE AS n_tok, "
        f"list_filter(list_transform(tok, lambda t: coalesce(regexp_extract(t, '{ALPHA_RUN_RE}'), '')), "
        f"lambda t: t <> '') AS alpha, "
        f"len(list_filter(tok, lambda t: {elong_tok})) AS n_el FROM t), "
        f"v AS (SELECT *, greatest(1, len(alpha))::DOUBLE AS n_alpha FROM u) "
        f"SELECT {keys}, {cols} FROM v"
    )
