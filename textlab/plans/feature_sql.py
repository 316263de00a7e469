"""DuckDB statements of the feature job (oracle side of the TF-IDF, chi2
and assembly queries). Mirrors :mod:`textlab.plans.features` step by step."""

from __future__ import annotations

from ..functions.charclass import sql_literal
from ..functions.normalize import (alpha_tokens_sql, letter_tokens_sql, normalise_ctes,
                                   strip_accents_sql)
from ..functions.stats import STAT_COLUMNS, raw_text_stats_sql
from ..operators.split import split_sql


def _list(vals) -> str:
    return "[" + ", ".join(sql_literal(v) for v in vals) + "]"


def _lemma_case(var: str, lemmas) -> str:
    if not lemmas:
        return var
    whens = " ".join(f"WHEN {sql_literal(f)} THEN {sql_literal(l)}" for f, l in lemmas)
    return f"lower(CASE {var} {whens} ELSE {var} END)"


def feature_ctes(lab_q: str, seed: int, lemmas, words, k_best: int | None = None,
                 word_n=(1, 2), char_n=(3, 4), min_df=(3, 3)) -> str:
    """CTE list (no leading WITH) defining:
    ``s`` split rows, ``post`` postings (doc_id, block, term, tf), ``vocab``
    (block, term, df, idf, idx), ``tfidf`` (doc_id, idx, w), ``feat`` all
    blocks before selection, ``sel`` (old_idx, new_idx, chi2), ``fsel``
    selected features (doc_id, idx, w)."""
    lab_sub = f"({lab_q}) lab"
    wgrams = []
    for n in range(word_n[0], word_n[1] + 1):
        if n == 1:
            wgrams.append("wtok")
        else:
            parts = " || ' ' || ".join(f"wtok[i + {j}]" for j in range(n))
            wgrams.append(f"list_transform(range(1, len(wtok) - {n - 2}), lambda i: {parts})")
    # Positions are unnested and cut with substr: a DuckDB lambda that
    # captures the character list copies it per element (quadratic).
    cterms = " UNION ALL ".join(
        f"SELECT doc_id, 1 AS block, substr(norm, i, {n}) AS term FROM "
        f"(SELECT doc_id, norm, unnest(range(1, length(norm) - {n - 2})) AS i FROM n1)"
        for n in range(char_n[0], char_n[1] + 1))
    ctes = [
        f"s AS ({split_sql(lab_sub, seed)})",
        f"lab AS ({lab_q})",
        normalise_ctes("n1", "lab", "doc_id, label, text", "text"),
        f"n1s AS (SELECT doc_id, {strip_accents_sql('norm')} AS t FROM n1)",
        normalise_ctes("n2", "n1s", "doc_id", "t", "norm2"),
        f"wt AS (SELECT doc_id, list_transform({letter_tokens_sql('norm2')}, lambda x: {_lemma_case('x', lemmas)}) AS wtok FROM n2)",
        f"terms AS (SELECT doc_id, 0 AS block, unnest(list_concat({', '.join(wgrams)})) AS term FROM wt "
        f"UNION ALL {cterms})",
        "post AS (SELECT doc_id, block, term, count(*) AS tf FROM terms GROUP BY ALL)",
        "ntr AS (SELECT count(*) AS n FROM s WHERE split = 'train')",
        "dfs AS (SELECT block, term, count(*) AS df, sum(tf) AS ttf FROM post JOIN s USING (doc_id) "
        "WHERE s.split = 'train' GROUP BY ALL)",
        f"vocab AS (SELECT block, term, df, ln((1.0 + (SELECT n FROM ntr)) / (1.0 + df)) + 1.0 AS idf, "
        f"row_number() OVER (ORDER BY block, term) - 1 AS idx FROM dfs "
        f"WHERE (block = 0 AND df >= {min_df[0]}) OR (block = 1 AND df >= {min_df[1]}))",
        "vsize AS (SELECT count(*) AS v FROM vocab)",
        "raw AS (SELECT doc_id, block, idx, (1.0 + ln(tf)) * idf AS r FROM post JOIN vocab USING (block, term))",
        "tfidf AS (SELECT doc_id, idx, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id, block)) AS w FROM raw)",
        f"st AS ({raw_text_stats_sql('lab', 'text', 'doc_id', 15)})",
        "stl AS (SELECT doc_id, (SELECT v FROM vsize) + j - 1 AS idx, w FROM (SELECT doc_id, "
        f"unnest([{', '.join(STAT_COLUMNS)}]) AS w, unnest(range(1, {len(STAT_COLUMNS) + 1})) AS j FROM st) WHERE w <> 0)",
        f"pr AS (SELECT doc_id, {alpha_tokens_sql('norm')} AS tok FROM n1)",
        f"prl AS (SELECT doc_id, (SELECT v FROM vsize) + {len(STAT_COLUMNS)} AS idx, w FROM (SELECT doc_id, "
        f"CASE WHEN len(tok) = 0 THEN 0.0 ELSE len(list_filter(tok, lambda x: list_contains({_list(words)}, x))) "
        f"/ len(tok) END AS w FROM pr) WHERE w <> 0)",
        "feat AS (SELECT * FROM tfidf UNION ALL SELECT * FROM stl UNION ALL SELECT * FROM prl)",
        "pri AS (SELECT label, count(*) / (SELECT count(*) FROM s WHERE split = 'train') AS p FROM s "
        "WHERE split = 'train' GROUP BY label)",
        "agg AS (SELECT idx, sum(w) AS tot, sum(CASE WHEN s.label = 0 THEN w ELSE 0 END) AS o0, "
        "sum(CASE WHEN s.label = 1 THEN w ELSE 0 END) AS o1 FROM feat JOIN s USING (doc_id) "
        "WHERE s.split = 'train' GROUP BY idx)",
        "chi AS (SELECT idx, power(o0 - tot * (SELECT p FROM pri WHERE label = 0), 2) / (tot * (SELECT p FROM pri WHERE label = 0)) "
        "+ power(o1 - tot * (SELECT p FROM pri WHERE label = 1), 2) / (tot * (SELECT p FROM pri WHERE label = 1)) AS chi2 FROM agg)",
    ]
    if k_best:
        ctes += [
            f"best AS (SELECT idx AS old_idx, chi2 FROM chi ORDER BY round(chi2, 6) DESC, idx DESC LIMIT {k_best})",
            "sel AS (SELECT old_idx, row_number() OVER (ORDER BY old_idx) - 1 AS new_idx, chi2 FROM best)",
            "fsel AS (SELECT doc_id, new_idx AS idx, w FROM feat JOIN sel ON feat.idx = sel.old_idx)",
        ]
    return ", ".join(ctes)
