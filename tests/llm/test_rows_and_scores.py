"""Repeated and null ids in near-duplicates and the pipeline; toxicity features in plain Python."""

import random

import numpy as np

import corpus_pipeline
from textlab.llm import neardup, toxicity

SCHEMA = "doc_id long, text string, source string, text_key int, id string"


def _text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def _near(seed):
    return _text(seed) + " tail"


def test_components_do_not_depend_on_the_order_of_repeated_ids(spark):
    rows = [(5, _text(1)), (5, _text(2)), (3, _near(2)), (8, _near(1)), (None, _text(1)), (9, _text(3)), (9, _text(3))]
    seen = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = neardup.near_duplicates(df, k=3).select("doc_id", "component_id", "kept", "n_shingles").collect()
        seen.add(tuple(sorted(map(repr, got))))
    assert len(seen) == 1
    by = sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None)
    assert by == [(3, 3, True), (5, 3, False), (5, 5, True), (8, 5, False), (9, 9, True), (9, 9, True)]


def test_near_duplicate_stage_judges_rows(spark):
    """A row goes by its own text; rows without an id stay; other columns may have any name."""
    rows = [(5, _text(1), "a"), (5, _text(2), "a"), (3, _near(2), "b"), (None, _text(4), "a"), (None, _text(4), "a"),
            (None, None, None), (7, "", "a"), (7, "", "a"), (11, _text(6), "a"), (11, _near(6), "a")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id or 0), r.text or "") for r in out.collect())
    assert kept[:3] == [(0, ""), (0, _text(4)), (0, _text(4))]
    assert [k for k in kept if k[0] == 5] == [(5, _text(1))] and (3, _near(2)) in kept
    assert [k for k in kept if k[0] == 7] == [(7, "")]
    assert len([k for k in kept if k[0] == 11]) == 1
    assert corpus_pipeline.without_near_duplicates(spark, docs.limit(0), "").count() == 0


def _grams(text):
    """Distinct character n-grams of a text, written out."""
    out = []
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        out.append(" " if c in "\t\n\x0b\x0c\r\x85\xa0  　 " else low)
    squeezed = ""
    for c in [" ", *out, " "]:
        if c != " " or not squeezed.endswith(" "):
            squeezed += c
    return {squeezed[i:i + n] for n in toxicity.SIZES for i in range(len(squeezed) - n + 1)}


def _key(gram):
    h = 0
    mask = (1 << 64) - 1
    for k, c in enumerate(gram):
        h = ord(c) if k == 0 else (h * 0x100000001B3 + ord(c)) & mask
    return int(toxicity.mix(np.array([(h + (len(gram) << 56)) & mask], np.uint64))[0])


def test_features_are_the_distinct_character_grams():
    texts = ["Bad  idiot!", "", "a", "É   x\n\ny", "aaaaaaaa", "İ ß ÀÉ 日本語 😀😀😀", " \t ", "x" * 3000 + "IDIOT"]
    raw = [t.encode() for t in texts]
    offs = np.append(0, np.cumsum([len(r) for r in raw]))
    row, key = toxicity.feature_keys(np.frombuffer(b"".join(raw), np.uint8), offs)
    for i, text in enumerate(texts):
        assert set(key[row == i].tolist()) == {_key(g) for g in _grams(text)}


def test_scores_equal_a_plain_sum_over_grams(spark):
    """Counts, log ratios and scores recomputed from whole sets of n-grams, given the fitted weights."""
    rng = random.Random(1)
    bad, good = ["idiot", "scum", "trash"], ["garden", "river", "paper", "music"]
    rows = []
    for i in range(160):
        words = [rng.choice(good) for _ in range(8)] + [rng.choice(bad)] * (i % 3 == 0)
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, ""), (902, "plain " * 500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, parts=3)
    counts = {}
    for _, text, toxic in rows:
        for g in _grams(text):
            counts.setdefault(_key(g), [0, 0])[toxic] += 1
    n1 = sum(t for *_, t in rows)
    n0 = len(rows) - n1
    significant = set()
    for k, (c0, c1) in counts.items():
        p, q = (c1 + 0.5) / (n1 + 1), (c0 + 0.5) / (n0 + 1)
        error = np.sqrt((1 - p) / (c1 + 0.5) + (1 - q) / (c0 + 0.5))
        if c0 + c1 >= toxicity.MIN_DOCS and abs(np.log(p / q)) / error >= toxicity.LEAST_Z:
            significant.add(k)
    assert set(model.keys.tolist()) == significant and len(significant) > 10
    weight = dict(zip(model.keys.tolist(), model.weights))
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    for r in docs.collect():
        margin = model.intercept + sum(weight.get(_key(g), 0.0) for g in _grams(r.text or ""))
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-margin))) < 1e-9
    assert sum(got[i].predicted == t for i, _, t in rows) > 140
    assert got[900].score == got[901].score and not got[902].predicted
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_item_of_more_words_than_a_short_integer_holds(documents, spark):
    from textlab.llm import decontaminate
    rng = random.Random(3)
    item = " ".join(f"w{rng.randrange(10**7)}" for _ in range(33_000))
    docs = documents([(1, "before it " + item + " after", "s"), (2, "clean text of some words", "s"), (3, None, "s")])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    got = [tuple(r) for r in decontaminate.benchmark_matches(docs, bench).collect()]
    assert got == [(1, 7, 2, 33_000, 0)]


def test_blocks_of_items_one_after_another(documents, spark, monkeypatch):
    from textlab.llm import decontaminate
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    rng = random.Random(4)
    items = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(25)) for _ in range(5)]
    docs = documents([(i, f"x {t} y", "s") for i, t in enumerate(items)] + [(50, "none of them here", "s"), (51, None, "s")])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.benchmark_matches(docs, bench).collect())
    assert got == [(i, i) for i in range(5)]
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()) == [50, 51]


def test_licence_unit_shorter_than_its_template(documents):
    from textlab.llm import licenses
    docs = documents([(1, "a b c", "s"), (2, "a b", "s"), (3, None, "s")])
    out = licenses.scan_licenses(docs, templates=(("T", "a b c d"),)).collect()
    assert [(r["doc_id"], r["shared"], r["unit_bigrams"]) for r in out] == [(1, 2, 2)]


def test_phrases_are_whole_words(documents):
    from textlab.llm import linequality
    lines = ["We assign in this design in the given way what we can.", "In terms of usefulness it is a good thing to have.",
             "Please sign in to read on.", "By our Terms of Use you agree."]
    got = {r["doc_id"]: r["n_lines_failed"] for r in linequality.clean_lines(
        documents([(i, t, "s") for i, t in enumerate(lines)])).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}
