"""Operators against brute force, the libraries, round trips and edge cases."""

import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from textlab.llm import (components, decontaminate, licenses, linequality, neardup, pieces, records, sitelines, toxicity,
                         urls, warc)
from textlab.llm.queries import PIECE_MODEL, WORD_TOKENIZER, held_out, tokenizer_path

WORDS = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("n", "rt", "sé", "st")]
ODD = ["", "  a  b ", "a\nb\tc.d's", "é é. İ..x,y I'LL don't.'s", "日本語 😀  ▁▁ x", "a" * 3000, " " * 40,
       "Σας x²3½ K.", "\x1c\x85a\xa0b", "<|endoftext|> <s> <0x0A>", "A b<|endoftext|>C <|STARTOFTEXT|><|startoftext|>", "MENTRÉ. Über÷×"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_records_round_trip(spark, documents):
    from tokenizers import Tokenizer
    path = tokenizer_path(WORD_TOKENIZER)
    tok = Tokenizer.from_file(path)
    rows = [(i * 3 % 13, t, "s") for i, t in enumerate(ODD)] + [(99, None, None), (None, "x", None), (5, "dup", "s"), (5, "dup", "s")]
    out = records.token_records(documents(rows), path).collect()
    assert len(out) == len(rows)
    start = 0
    want = sorted(((-1 if i is None else i), t or "") for i, t, _ in rows)
    got = sorted(out, key=lambda r: r["start"])
    for (i, text), r in zip(want, got):
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        assert r["doc_id"] == (None if i == -1 else i) and r["ids"] == ids
        assert r["start"] == start and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert records.token_records(documents([]), path).count() == 0


def test_records_damage_and_seek(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/r"
    shard = records.write_records(documents([(i, f"w{i}", "s") for i in range(5)]), folder,
                                  tokenizer_path(WORD_TOKENIZER), 2, 49_408).orderBy("shard").first()
    assert records.read_at(shard["path"], shard["n_docs"] - 1, 2)[0] is not None
    data = bytearray(open(shard["path"][7:] + ".rec", "rb").read())
    data[13] ^= 1
    import io
    with pytest.raises(ValueError):
        records.unframe(io.BytesIO(bytes(data)).read)


def test_url_rules(spark):
    pages = spark.createDataFrame([
        (1, "http://x.example.org/es/1", None), (2, "https://www.y.com/de/5?ref=a", ""), (3, "http://y.com/de/5.html", None),
        (4, None, None), (5, "nohost", "x"), (6, "HTTP://A.ORG/q", None), (7, "http://z.net/p#f", '<link rel="canonical" href="http://y.com/de/5">'),
        (8, "http://z.net/q", None), (8, "http://z.net/q", None), (9, "http://z.net/r", '<meta http-equiv="refresh" content="0; url=http://z.net/p">')],
        "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in
           urls.judge_urls(pages, urls.rule_table(spark)).collect()}
    assert got[1] == ("x.example.org", "/es/1", "example.org/es/", "block")
    assert got[2][2:] == ("com/de/", "block") and got[6] == ("a.org", "/q", "org/", "allow")
    assert got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert got[7][2:] == (None, "block") and got[9][2:] == (None, "block") and got[8][2:] == (None, "allow")
    assert urls.judge_urls(pages.limit(0), urls.rule_table(spark)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 330)] + \
            [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {x: find(x) for x in parent if find(x) != x}
    assert all(got[x] == c for x, c in want.items()) and all(got.get(x, x) == find(x) for x in parent)


def test_licenses(documents):
    got = rows_of(licenses.scan_licenses(documents([
        (1, "Some other text that stands before it.\nReleased under the MIT License.", "s"), (2, "LICENSED UNDER CC-BY-NC 4.0", "s"), (3, None, None),
        (4, "", "s"), (5, "nothing of the sort here at all", "s"), (6, "x " * 20000, "s")])), "doc_id", "unit", "license")
    assert got == [(1, 1, "MIT"), (2, 0, "CC-BY-NC-4.0")]


def test_licenses_against_brute_force(documents):
    """Notices with words lost, added and exchanged, lone or inside a text; every unit that reaches the threshold is found."""
    rng = random.Random(11)
    texts = []
    for _, notice in licenses.TEMPLATES:
        for d in (0, 1, 1, 2, 3, 5, 9):
            words = edited(rng, notice.split(), min(d, len(notice.split())))
            texts += [" ".join(words).upper() if d == 1 else " ".join(words), f"{prose(rng, 9)}\n{' '.join(words)}\n\n{prose(rng, 9)}"]
    known = [(name, set(licenses.template_bigrams(t))) for name, t in licenses.TEMPLATES]
    want = set()
    for i, text in enumerate(texts):
        units = list(dict.fromkeys(text.split("\n") + (re.split(r"\n[ \t]*\n\s*", text) if "\n\n" in text else []) + [text]))
        for k, unit in enumerate(units):
            own = set(licenses.template_bigrams(unit))
            fits = [(-Fraction(2 * len(own & g), len(own) + len(g)), name) for name, g in known
                    if 10 * len(own & g) >= 4 * (len(own) + len(g))]
            if fits:
                want.add((i, k, min(fits)[1]))
    got = rows_of(licenses.scan_licenses(documents([(i, t, "s") for i, t in enumerate(texts)])), "doc_id", "unit", "license")
    assert len(want) > 50 and got == sorted(want, key=repr)


def naive_distance(x, y):
    prev = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        cur = [i]
        for j, b in enumerate(y, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (a != b)))
        prev = cur
    return prev[-1]


def edited(rng, words, d):
    out = list(words)
    for _ in range(d):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = rng.choice(WORDS) + "x"
        elif kind == 1:
            out.insert(k, rng.choice(WORDS) + "y")
        else:
            del out[k]
    return out


def test_decontamination_against_brute_force(spark, documents):
    rng = random.Random(11)
    items = [(k, [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]) for k, n in enumerate([3, 7, 15, 22, 30, 41, 57] * 3)]
    docs = []
    for i in range(160):
        body = [rng.choice(WORDS) for _ in range(rng.randrange(0, 60))]
        if i % 4:
            _, w = rng.choice(items)
            put = edited(rng, w, rng.randrange(0, decontaminate.allowed(len(w), 0.8) + 2))
            at = rng.randrange(len(body) + 1)
            body[at:at] = put
        docs.append((i, " ".join(body), "s"))
    docs += [(500, None, None), (501, "", "s"), (502, " ".join(items[4][1]).upper() + ".", "s")]
    want = set()
    for i, text, _ in docs:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        for k, x in items:
            n, d = len(x), decontaminate.allowed(len(x), 0.8)
            if w and any(naive_distance(w[p:p + n], x) <= d for p in range(max(1, len(w) - n + 1))):
                want.add((i, k))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(900, None), (901, "...")], "item_id long, text string")
    frame = documents(docs)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.benchmark_matches(frame, bench).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 60
    clean = decontaminate.clean_documents(frame, bench)
    assert clean.columns == frame.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _, _ in docs} - {i for i, _ in got}
    assert decontaminate.benchmark_matches(frame, bench.limit(0)).count() == 0
    assert decontaminate.benchmark_matches(frame.limit(0), bench).count() == 0


def test_warc(spark, tmp_path):
    big, other = "é" * 600, "x" * 1000
    pages = spark.createDataFrame([(1, "http://a/b c\r\n", big), (4, "u", big), (9, None, big), (2, "u", other), (3, "u", "small"),
                                   (5, "u", "small"), (6, "u", None), (None, "u", other)], "page_id long, url string, html string")
    files = warc.normalise(warc.write_archives(pages, f"file://{tmp_path}/m"), f"file://{tmp_path}/r")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archives(files).collect()}
    assert got == {1: (1200, "revisit", 9), 4: (1200, "revisit", 9), 9: (1200, "response", None), 2: (1000, "response", None),
                   3: (5, "response", None), 5: (5, "response", None), 6: (0, "response", None), None: (1000, "response", None)}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_line_quality(documents):
    def brute(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        twice = {g for g in grams if grams.count(g) > 1}
        return len(words), len({i + j for i, g in enumerate(grams) if g in twice for j in range(5)})
    rng = random.Random(5)
    texts = ["", None, "a b", " ".join("abcdef" * 3), prose(rng, 40) + ".", "\n".join([prose(rng, 12) + "."] * 3),
             "Home | News | About | Contact\n" + prose(rng, 30) + "."] + [" ".join(rng.choice("abc") for _ in range(30)) for _ in range(20)]
    got = {r["doc_id"]: r for r in linequality.clean_lines(documents([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_repeat_words"]) == brute(t), t
    assert got[4]["kept"] and not got[0]["kept"] and got[6]["n_lines_failed"] == 1 and got[5]["n_dup_lines"] == 2


def test_toxicity(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40) + (" you zzgrob" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~held_out()))
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    test = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["predicted"] == y for i, y in test) >= 0.98 * len(test)
    assert got[900]["score"] == got[901]["score"] and 0 <= got[900]["score"] < 0.3
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(docs, none).collect()} == {0.0}


def test_pieces_against_library(documents):
    import sentencepiece
    path = tokenizer_path(PIECE_MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    alphabet = list("abcdeinorst  ..,'\n▁éßж日😀0189<>") + ["the", "ing", " ", "tion"]
    texts = ODD + [None] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(300)]
    out = pieces.encode_documents(documents([(i, t, "s") for i, t in enumerate(texts)]), path, check=True)
    got = {r["doc_id"]: r for r in pieces.decode_ids(out, path).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == sp.encode(t or ""), t
        assert got[i]["round_trip"] and got[i]["decoded"] == (t or "").replace("▁", " ")


def test_near_duplicates_against_brute_force(documents):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.randrange(30, 90))]
        for _ in range(rng.randrange(1, 12)):
            texts.append(" ".join(edited(rng, base, rng.randrange(0, 4))))
    texts += [None, "", " \n", "one two", "ONE two", "one", texts[0], texts[0].upper()]
    rows = [(i * 7 % 1009, t, "s") for i, t in enumerate(texts)]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())
    sets = {i: shingles(t) for i, t, _ in rows}
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and
             100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    out = neardup.near_duplicates(documents(rows + [(None, "x y z", "s")]), k=3, percent=85)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got.pop(None)["kept"]
    assert {i: r["component_id"] for i, r in got.items()} == comp
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (comp[i] == i) for i, r in got.items())
    assert neardup.near_duplicates(documents([])).count() == 0


def test_site_lines(documents):
    rows = [(i, f"Menu\nown line {i}\n\n Menu ", "a") for i in range(10)] + [(20, "Menu\nother", "b"), (21, None, "a"), (22, "", None)]
    frame = documents(rows)
    got = {r["doc_id"]: (r["text"], r["_tl_dropped"]) for r in sitelines.drop_site_lines(frame).collect()}
    assert got[3] == ("own line 3\n", 2) and got[20] == ("Menu\nother", 0) and got[21] == (None, 0) and got[22] == ("", 0)
    copies = documents([(i, "all\nthe same", "a") for i in range(10)] + rows[:5])
    spared = [(r["doc_id"], r["text"]) for r in sitelines.drop_site_lines(copies, fold_copies=True).where("n = 7").collect()]
    assert sorted(spared) == sorted([(i, "all\nthe same") for i in range(10)] + [(i, f"own line {i}\n") for i in range(5)])
    assert sitelines.drop_site_lines(documents([])).count() == 0


def test_pipeline_small(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(1)
    base = [prose(rng, 60) + "." for _ in range(60)]
    item = prose(rng, 30)
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    docs += [(100, base[0], "en", "s", 1), (101, base[1] + " " + item, "en", "s", 1), (102, None, None, None, None)]
    docs += [(200 + i, prose(rng, 30) + " zzgrob zzgrob", "en", "s", 1) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 200)) for i, *_ in docs], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(60)) | {102}
    assert all(r["round_trip"] for r in got.values()) and got[5]["n_tokens"] == len(got[5]["ids"])


def test_registered(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {re.match(r"op\d+_|", n)[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
