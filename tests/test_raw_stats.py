"""Raw-text statistics of odd texts against plain Python."""

import random
import re
import unicodedata

import pytest

from textlab.functions.stats import STAT_COLUMNS, raw_text_stats


def _plain_stats(text):
    s = " ".join((text or "").split())
    tok = s.split()
    n, n_tok = max(1, len(s)), max(1, len(tok))
    alpha = [m.group() for m in (re.search("[A-Za-z]+", t) for t in tok) if m]
    letter = lambda c: unicodedata.category(c)[0] == "L"
    elongated = sum(bool(re.search(r"(.)\1{2,}", t)) for t in tok)
    word = lambda c: unicodedata.category(c)[0] in "LN" or c == "_"
    return dict(zip(STAT_COLUMNS, [
        sum(unicodedata.category(c) == "Lu" for c in s) / max(1, sum(map(letter, s))), s.count("!") / n, s.count("?") / n,
        sum(c in ".,;:!?\"'()[]{}" for c in s) / n, len(re.findall(r"https?://[^ ]+|www\.[^ ]+", s)), elongated / n_tok,
        sum(all(map(letter, t)) and t.upper() == t and len(t) >= 2 for t in tok) / n_tok, sum(c.isdigit() for c in s) / n,
        len(re.findall("[!?]{2,}", s)) / (n / 100.0), elongated, len({a.lower() for a in alpha}) / max(1, len(alpha)),
        sum(map(len, alpha)) / max(1, len(alpha)),
        sum(t.lower() in ("you", "u", "ur", "ya", "youre", "you're") for t in tok) / n_tok,
        sum(a == "@" and word(b) for a, b in zip(s, s[1:]))]))


@pytest.mark.parametrize("slice_chars", [1, 200, 1 << 20])
def test_statistics_of_odd_texts(spark, slice_chars, monkeypatch):
    from textlab.functions import stats
    monkeypatch.setattr(stats, "SLICE_CHARS", slice_chars)
    r = random.Random(9)
    bits = ["you", "U", "You're", "ABC", "ÉÀ", "aaa", "!!", "?!?", " ", "\n", " ", "@bob", "@ ", "@@x", "http://a.b", "www.x",
            "httpwww.", "ß", "ĸĸ", "中文", "x1y", "1²", "'", "😀😀😀", "\0", "_", "don't", "Yaaa", "ya", "İ", "日日日", "!!!"]
    texts = [None, "", " \n", "!", "!!", "aaa", "a", "@", "@a", *("".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(400))]
    out = raw_text_stats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()  # was: 13 regexes and token lambdas a text
    for row in out.collect():
        want = _plain_stats(texts[row.doc_id])
        assert {c: round(row[c], 9) for c in STAT_COLUMNS} == {c: round(v, 9) for c, v in want.items()}, repr(texts[row.doc_id])
