"""Normalisation and the 14 raw statistics on the FIXTURES micro-cases."""

import pytest
from pyspark.sql import functions as F

from textlab.functions.normalize import normalise, with_stripped_accents
from textlab.functions.stats import STAT_COLUMNS, raw_text_stats

CASES = [
    ("m0", "", "", "", [0] * 14),
    ("m1", None, "", "", [0] * 14),
    ("m2", "  a b\u001cc\u0085d ", "a b c d", "a b c d", [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0]),
    ("m3", "SOOO coool!!! AAaa you, You u", "soo cool!! aaaa you, you u", "soo cool!! aa you, you u",
     [0.35, 0.1034, 0, 0.1379, 0, 0.3333, 0.1667, 0, 3.4483, 2, 0.8333, 3.3333, 0.3333, 0]),
    ("m4", "mail me@x.org http://a.b/c?d=1 www.x.y <b>hi</b> <i", "mail me <user> .org <url> <url> hi <i",
     "mail me .org hi <i", [0, 0, 0.0196, 0.1176, 2, 0.1667, 0, 0.0196, 0, 1, 1, 2.5, 0, 1]),
    ("m5", "CAFÉ naïve ²3 ÉÉÉÉ ß", "café naïve ²3 éé ß", "café naïve ²3 éé ß",
     [0.5714, 0, 0, 0, 0, 0.2, 0.4, 0.1, 0, 1, 1, 2.5, 0, 0]),
    ("m6", "a\nb\n\n\n\nc", "a b c", "a b c", [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0]),
    ("m7", "can't 42 _x_ a1b2", "can't 42 _x_ a1b2", "can't 42 _x_ a1b2",
     [0, 0, 0, 0.0588, 0, 0, 0, 0.2353, 0, 0, 1, 1.6667, 0, 0]),
    ("m8", "???!! wow?! !", "??!! wow?! !", "??!! wow?! !",
     [0, 0.3077, 0.3077, 0.6154, 0, 0.3333, 0, 0, 15.3846, 1, 1, 3, 0, 0]),
    ("m9", "@Zoé!! of trash, IDIOT idiot! the moron", " <user> !! of trash, idiot idiot! the moron",
     " !! of trash, idiot idiot! the moron", [0.2143, 0.0769, 0, 0.1026, 0, 0, 0.1429, 0, 2.5641, 0, 0.8571, 3.8571, 0, 1]),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(c[0], c[1]) for c in CASES], "doc_id string, text string")


def test_normalise_once_and_twice(cases):
    got = {r.doc_id: (r.n1, r.n2) for r in cases.select(
        "doc_id", normalise("text").alias("n1"), normalise(normalise("text")).alias("n2")).collect()}
    for cid, _, n1, n2, _ in CASES:
        assert got[cid] == (n1, n2), cid


def test_raw_statistics(cases):
    got = {r.doc_id: [round(r[c], 4) for c in STAT_COLUMNS] for r in raw_text_stats(cases).collect()}
    for cid, _, _, _, stats in CASES:
        assert got[cid] == pytest.approx(stats, abs=1e-4), cid


def test_normalised_has_no_long_runs(spark):
    """No character stands three times in a row in what normalising twice leaves."""
    texts = ["soooo goood", "AAaa!!!???", "1111 22 333", "x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(normalise(normalise("text")).alias("n"))
    assert df.count() == len(texts) and df.where(F.col("n").rlike(r"([a-z])\1{2,}")).count() == 0


def test_accent_strip(spark):
    """Any text with a non-ASCII character loses its combining marks, found or made."""
    df = spark.createDataFrame([("Café Ångström",), ("ﬁne ½",), ("plain",), ("e\u0301",), ("é cafe\u0301",), (None,)],
                               "t string")
    got = [r.s for r in with_stripped_accents(df, "t", "s").collect()]
    assert got == ["Cafe Angstrom", "fine 1⁄2", "plain", "e", "e cafe", ""]
