import random

import corpus_pipeline
from textlab.llm import neardup, sitelines


def test_short_page_loses_boilerplate_and_copies_keep_theirs(documents):
    rng = random.Random(4)

    def words(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    menu = words(12)
    rows = [(i, f"{menu}\n{words(40)}", "a") for i in range(60)]
    rows += [(100, f"{menu}\nshort page", "a"), (101, f"{menu}\n{words(3)}\n{words(3)}", "a")]
    body = [words(30) for _ in range(6)]
    copy = "\n".join(body)
    rows += [(200 + i, copy, "a") for i in range(12)]
    rows += [(300 + i, f"{copy}\n{words(4)}", "a") for i in range(8)]
    rows += [(400, menu, "b"), (400, f"{menu}\n{words(5)}", "a"), (None, None, "a"), (None, f"{menu}\nx", "a")]
    docs = documents(rows)
    out = corpus_pipeline.without_site_lines(docs.sparkSession, docs, "").collect()
    want = [(i, t if t is None or s == "b" else "\n".join(x for x in t.split("\n") if x != menu)) for i, t, s in rows]
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(want, key=repr)


def test_ratio_alone_decides_and_names_may_clash(documents):
    rows = [(i, f"top\nown {i}" if i < 4 else f"own {i}\nend {i}", "small") for i in range(20)]
    rows += [(30, "own 1\nalone", "other"), (30, "own 1\nalone", "other")]
    docs = documents(rows).selectExpr("*", "1 as _tl_bad", "2 as bad", "3 as row", "4 as d", "5 as page", "6 as _tl_dropped")
    out = sitelines.drop_site_lines(docs)
    assert set(out.columns) == set(docs.columns)
    got = sorted((r["doc_id"], r["text"], r["_tl_dropped"], r["bad"], r["row"], r["d"], r["page"], r["_tl_bad"]) for r in out.collect())
    want = [(i, t.removeprefix("top\n"), int(i < 4), 2, 3, 4, 5, 1) for i, t, s in rows[:20]] + [(30, "", 2, 2, 3, 4, 5, 1)] * 2
    assert got == sorted(want)


def test_copies_that_differ_in_one_line_each(documents):
    rng = random.Random(9)
    words = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    body = [words(20) for _ in range(5)]
    rows = [(i, "\n".join(body), "a") for i in range(10)]
    rows += [(100 + i, "\n".join(body[:i % 5] + [words(20)] + body[i % 5 + 1:]), "a") for i in range(30)]
    rows += [(200 + i, f"foot of the site\n{words(30)}\n{words(30)}", "a") for i in range(60)]
    out = sitelines.drop_site_lines(documents(rows), fold_copies=True).collect()
    want = {(i, t.replace("foot of the site\n", "")) for i, t, _ in rows}
    assert {(r["doc_id"], r["text"]) for r in out} == want


def test_near_copies_with_edits_of_their_own(documents):
    """Links of a group whose members often miss the first pivot, with and without more pivots."""
    rng = random.Random(12)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(w), "s"))
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t, _ in rows}
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert 1 < len(set(comp.values())) < 60
    for pivots in (0, 4):
        out = neardup.near_duplicates(documents(rows), pivots=pivots).collect()
        assert {r["doc_id"]: r["component_id"] for r in out} == comp
