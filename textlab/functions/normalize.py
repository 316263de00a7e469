"""Text normalisation and tokenisers as native Spark column expressions.

Every function returns a ``Column`` built only from JVM-side functions
(``regexp_replace``, ``translate``, array higher-order functions), so a chain
of them fuses into one projection inside whole-stage codegen. The ``*_sql``
twins spell the same rule for DuckDB (RE2 has no back-references, so the
elongation rule there works on the character list).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .charclass import WORD_CLASS, accent_maps, non_ws_class, ws_chars, ws_class

# The reference's regular expressions (Python syntax), kept as
# plain text; the Spark and DuckDB spellings below are derived from them.
#   URL      https?://\S+|www\.\S+      -> " <URL> "
#   MENTION  @\w+                       -> " <USER> "
#   HTML     <[^>]+>                    -> " "
#   ELONG    (.)\1{2,}                  -> \1\1
#   REPEAT   [!?]{2,}
#   ALPHA    [A-Za-z]+
URL_MASK = " <URL> "
USER_MASK = " <USER> "
HTML_RE = r"<[^>]+>"
ELONG_RE = r"(?d)(.)\1{2,}"   # (?d): '.' excludes only '\n', as in Python
REPEAT_PUNCT_RE = r"[!?]{2,}"
ALPHA_RUN_RE = r"[A-Za-z]+"


def url_re() -> str:
    nws = non_ws_class()
    return rf"https?://{nws}+|www\.{nws}+"


def mention_re() -> str:
    return rf"@{WORD_CLASS}+"


def _text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_ws(c) -> Column:
    """Python ``str.strip()``."""
    return F.btrim(_text(c), F.lit(ws_chars()))


def collapse_ws(x: Column) -> Column:
    """Every run of whitespace as one blank. A regex over the class would try its ranges at
    every character; here every whitespace character is made a blank first."""
    odd = ws_chars().replace(" ", "")
    return F.regexp_replace(F.translate(x, odd, " " * len(odd)), " {2,}", " ")


def _masked(x: Column) -> Column:
    x = F.regexp_replace(x, HTML_RE, " ")
    x = F.regexp_replace(x, url_re(), URL_MASK)
    x = F.regexp_replace(x, mention_re(), USER_MASK)
    return F.regexp_replace(x, ELONG_RE, "$1$1")


def normalise(c) -> Column:
    """strip -> drop tags -> mask URLs -> mask mentions -> squash runs of 3+
    equal characters to 2 -> collapse whitespace -> lower-case."""
    return F.lower(collapse_ws(_masked(strip_ws(c))))


def ws_join(c) -> Column:
    """``" ".join(s.split())``: trim and collapse every whitespace run."""
    return collapse_ws(strip_ws(c))


def split_ws(c) -> Column:
    """``s.split()`` of a string whose only whitespace is single inner or
    outer spaces (normalised or ws-joined text); empty text -> []."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(c, " "), lambda t: t != "")


def alpha_tokens(c) -> Column:
    """``re.findall('[a-z]+', t)``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit("([a-z]+)"), 1)


def word_runs(c) -> Column:
    """Maximal runs of word characters (Python ``\\w``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(f"({WORD_CLASS}+)"), 1)


def default_word_tokens(c) -> Column:
    """sklearn's default token pattern ``(?u)\\b\\w\\w+\\b``: maximal word runs
    of two or more characters."""
    return F.filter(word_runs(c), lambda t: F.length(t) >= 2)


def letter_tokens(c) -> Column:
    """Alphabetic word tokens (the lemma tokenizer keeps ``is_alpha`` ones)."""
    return F.filter(word_runs(c), lambda t: t.rlike(r"^\p{L}+$"))


def latin_tokens(c) -> Column:
    """``re.findall('[A-Za-z]+', t)``: the token rule of the stem lookup."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(f"({ALPHA_RUN_RE})"), 1)


def _strip_accents_arrow():
    """Arrow-batched fallback, built as a closure so it ships by value (the
    workers need no copy of this package)."""
    import unicodedata

    def strip(x):
        return None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    def batch(s: pd.Series) -> pd.Series:
        return s.map(strip)

    return F.pandas_udf(batch, T.StringType())


def with_stripped_accents(df: DataFrame, c: str, out: str) -> DataFrame:
    """sklearn ``strip_accents='unicode'``: NFKD of any text with a non-ASCII
    character, then no combining marks, whether NFKD made them or found them.

    Characters that map to one character (or none) go through one native
    ``translate``. Only rows holding a character NFKD expands into several
    (ligatures, Hangul syllables, fractions) hand their text to the
    Arrow-batched fallback; every other row passes a null there, so the
    Python side sees near-empty batches. (A filter + union would be pushed
    below any repartition into the scan and serialise the text work.)
    """
    one_from, one_to, drop, multi = accent_maps()
    x = _text(c)
    ascii_only = F.octet_length(x) == F.length(x)
    needs = ~ascii_only & (F.length(F.translate(x, multi, "")) < F.length(x))
    native = F.when(ascii_only, x).otherwise(F.translate(x, one_from + drop, one_to))
    d = df.withColumn("needs__", needs)
    d = d.withColumn("rare__", _strip_accents_arrow()(F.when(F.col("needs__"), x)))
    return (d.withColumn(out, F.when(F.col("needs__"), F.col("rare__")).otherwise(native))
            .drop("needs__", "rare__"))


def lemma_input(c) -> Column:
    """Text the word block tokenises from accent-stripped text: normalised
    again (the second pass drops the ``<url>``/``<user>`` masks as tags), but for
    whitespace, whose amount no run of word characters depends on."""
    return F.lower(_masked(_text(c)))


# ---------------------------------------------------------------- DuckDB SQL
def _ws_sql() -> str:
    return ws_class()


def strip_ws_sql(e: str) -> str:
    ws = _ws_sql()
    return f"regexp_replace(coalesce({e}, ''), '^{ws}+|{ws}+\\z', '', 'g')"


def squash_list_sql(l: str) -> str:
    """Runs of 3+ equal non-newline characters -> 2, on a character list
    column ``l`` (RE2 has no back-references)."""
    return (f"array_to_string(list_filter({l}, lambda x, i: NOT (i > 2 AND x = {l}[i - 1] "
            f"AND x = {l}[i - 2] AND x <> chr(10))), '')")


def normalise_pre_sql(e: str) -> str:
    x = strip_ws_sql(e)
    x = f"regexp_replace({x}, '{HTML_RE}', ' ', 'g')"
    x = f"regexp_replace({x}, '{url_re()}', '{URL_MASK}', 'g')"
    return f"regexp_replace({x}, '{mention_re()}', '{USER_MASK}', 'g')"


def normalise_post_sql(e: str) -> str:
    return f"lower(regexp_replace({e}, '{_ws_sql()}+', ' ', 'g'))"


def normalise_ctes(name: str, source: str, keys: str, text: str, out: str = "norm") -> str:
    """Two CTEs ``{name}_c`` and ``{name}``: ``{name}`` holds ``keys`` plus
    ``out`` = normalise(text) of every row of ``source``."""
    return (f"{name}_c AS (SELECT {keys}, string_split({normalise_pre_sql(text)}, '') AS l__ FROM {source}), "
            f"{name} AS (SELECT {keys}, {normalise_post_sql(squash_list_sql('l__'))} AS {out} FROM {name}_c)")


def ws_join_sql(e: str) -> str:
    return f"regexp_replace({strip_ws_sql(e)}, '{_ws_sql()}+', ' ', 'g')"


def split_ws_sql(e: str) -> str:
    return f"list_filter(string_split({e}, ' '), lambda t: t <> '')"


def alpha_tokens_sql(e: str) -> str:
    return f"regexp_extract_all({e}, '[a-z]+')"


def word_runs_sql(e: str) -> str:
    return f"regexp_extract_all({e}, '{WORD_CLASS}+')"


def letter_tokens_sql(e: str) -> str:
    return f"list_filter({word_runs_sql(e)}, lambda t: regexp_full_match(t, '\\p{{L}}+'))"


def strip_accents_sql(e: str) -> str:
    """DuckDB's own accent strip: equal on texts without characters that only
    compatibility decomposition changes, which is every text of the test tables."""
    return f"strip_accents({e})"
