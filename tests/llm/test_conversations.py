"""Repair, trie and sharding against plain versions, and edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from textlab.llm import kdshards, repair, trie
from textlab.llm.queries import damage

SPACES = " \t\n\x0b\x0c\r"
FORM = re.compile(r"(s?(ua)+)?")


def conversations(spark, rows):
    """With columns of clashing names."""
    return spark.createDataFrame([(c, t, r, x, 1, "h") for c, t, r, x in rows],
                                 "conv_id long, turn long, role string, text string, cost int, _conv string")


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) by a search over
    whole audits, state by state; rows are (turn, role, text)."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def step(state, c):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, c))

    def better(d, k, v):
        if k not in d or v[:2] < d[k][:2]:
            d[k] = v
    done = {}
    frontier = {"": (0, "", ())}
    for k in range(len(rows) + 1):
        paths = []  # every number of insertions before row k
        for state, got in frontier.items():
            paths.append((state, got))
            cur = [(state, got)]
            for _ in range(4):
                cur = [(step(s, role[0]), (c + 3, a + "I", (*o, f"{role}:"))) for s, (c, a, o) in cur
                       for role in ("user", "assistant") if step(s, role[0])]
                paths += cur
        if k == len(rows):
            for state, got in paths:
                if state in ("", "a"):
                    better(done, 0, got)
            break
        _, role, text = rows[k]
        nxt = {}
        for state, (cost, audit, out) in paths:
            better(nxt, state, (cost + 4, audit + "D", out))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 if faults[k] == "truncated" else 0
                s = step(state, role[:1])
                if s:
                    better(nxt, s, (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for to in ("user", "assistant"):
                    s = step(state, to[0])
                    if s:
                        better(nxt, s, (cost + 3 + more, audit + "R", (*out, f"{to}:{text}")))
        frontier = nxt
    cost, audit, out = done[0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_rows(rng, convs, longest):
    texts = ["Yes.", "No", "Why?", "", " \n", "Ok!", "a. b", "Ça. ", "x" * 200 + "."]
    roles = ["user", "assistant", "system", "tool", "User", None]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, longest)):
            turn = rng.choice([t, t, t, t + 2, None])
            rows.append((c, turn, rng.choices(roles, [8, 8, 2, 1, 1, 1])[0], rng.choice([*texts, None])))
    return rows


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("parts", [1, 13])
def test_repair_equals_plain_search(spark, parts):
    rng = random.Random(3 + parts)
    rows = random_rows(rng, 60, 9) + [(None, 0, "assistant", "Alone."), (None, 1, "user", "Alone.")]
    rows += [(900, k, "ua"[k % 2] + "x", f"t{k}{rng.choice('.,')}") for k in range(300)]  # cut into runs
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.conv_id: r for r in repair.repair_conversations(conversations(spark, rows)).collect()}
        turns = repair.repaired_turns(conversations(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    groups = {}
    for r in in_order([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]):
        groups.setdefault(r[0], []).append(r[1:])
    assert set(got) == set(groups)
    for c, own in groups.items():
        assert tuple(got[c][f] for f in FIELDS) == plain_repair(own), (c, own)
        out = sorted((r for r in turns if r.conv_id == c), key=lambda r: r.position)
        assert [r.position for r in out] == list(range(len(out)))
        assert FORM.fullmatch("".join(r.role[0] for r in out))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in out).encode()).hexdigest() == got[c].repaired_sha256


def test_repair_grammar_is_shared_and_exact():
    """A rule's matrix is the product of its symbols, whatever the rules are."""
    rng = random.Random(5)
    symbols = [rng.randrange(repair.SYMBOLS) for _ in range(40)]
    flat, offs = repair.np.array(symbols * 3, "int32"), repair.np.array([0, 40, 80, 120])
    mats = [repair.symbol_matrix(s) for s in range(repair.SYMBOLS)]
    rules = []
    for _ in range(30):
        a, b = rng.randrange(len(mats)), rng.randrange(len(mats))
        rules.append((a, b, len(mats)))
        mats.append(repair.multiply(mats[a], mats[b]))
    rules += [(symbols[0], symbols[1], len(mats))]
    mats.append(repair.multiply(mats[symbols[0]], mats[symbols[1]]))
    short, cuts = repair.rewrite(flat, offs, rules)
    assert len(short) < len(flat)

    def result(seq):
        m = [{0: (0, repair.Rope())}]
        for s in seq:
            m = repair.multiply(m, mats[s])
        cost, audit = repair.cheapest(m[0])
        return cost, str(audit)
    assert {result(short[cuts[k]:cuts[k + 1]]) for k in range(3)} == {result(symbols)}


def test_repair_same_symbols_and_ropes():
    flat, offs = repair.rewrite(repair.np.array([1, 1, 1, 1, 1, 2], "int32"), repair.np.array([0, 3, 6]), [(1, 1, 9)])
    assert flat.tolist() == [9, 1, 9, 2] and offs.tolist() == [0, 2, 4]
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("DK") for _ in range(rng.randint(0, 60))) for _ in "ab")
        b = a[:rng.randint(0, 60)] + b if rng.random() < 0.7 else b

        def rope(x):
            r = repair.Rope()
            while x:
                k = rng.randint(1, 20)
                r, x = r + repair.Rope(x[:k]), x[k:]
            return r
        ra, rb = rope(a), rope(b)
        assert str(ra) == a and (ra < rb) == (a < b)


def test_damage_and_empty(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(6) for t in range(10)]
    out = {}
    for r in damage(conversations(spark, rows)).collect():
        out.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    kinds = set()
    for c, t, role, text in rows:
        k = zlib.crc32(f"{c}:{t}".encode()) % 20
        kinds.add(k)
        want = {0: [], 1: [(role, "")], 2: [(role, "One Two")], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert out.get((c, t), []) == want.get(k, [(role, text)])
    assert kinds >= set(range(5))
    assert repair.repair_conversations(conversations(spark, [])).count() == 0
    assert repair.repaired_turns(conversations(spark, [])).count() == 0


# ----------------------------------------------------------------------- trie
def plain_trie(rows, rebuild=True):
    own = {}
    for c, _, r, x in in_order([(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]):
        own.setdefault(c, []).append((r, x))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    members.setdefault((), [])
    out = {}
    for key, who in members.items():
        below = [k for k in members if k[:len(key)] == key]
        kids = [k for k in members if len(k) == len(key) + 1 and k[:-1] == key]
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(key))
        out[(min(who) if who else None, len(key))] = (
            min(members[key[:-1]]) if key else None, len(who), len(kids),
            sum(not any(k[:-1] == b and k for k in members) for b in below),
            sum((len(members[b]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", b[-1][1])) for b in below if b),
            hashlib.sha256(ends.encode()).hexdigest())
    return out


def as_map(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in rows}
    assert len(out) == len(rows)
    return out


def trie_rows(rng):
    rows = []
    for c in [*range(0, 50), 107, 999]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 7])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", "", None, "c", "a  b\nc"])))
    rows += [(7, 3, "user", "same")] * 3 + [(None, 0, "user", "nobody")]
    rows += [(c, t, "user", f"long {t}") for c in (60, 61) for t in range(40)]
    return rows


def test_trie_equals_plain(spark):
    rows = trie_rows(random.Random(8))
    assert as_map(trie.rebased_trie(conversations(spark, rows))) == plain_trie(rows)
    assert as_map(trie.plain_trie(conversations(spark, rows))) == plain_trie(rows, rebuild=False)


def test_trie_cut_into_small_shards_and_bands(spark, monkeypatch):
    """Many shards, several bands above them, queues that spill and prefix blocks."""
    rows = trie_rows(random.Random(9))
    monkeypatch.setattr(trie, "BLOCK", 8)
    monkeypatch.setattr(trie, "PIECE", 2)
    turns = trie.written(trie.ordered_turns(conversations(spark, rows)), "ordered")
    sizes = turns.groupBy("conv_id").agg(trie.F.max("at").alias("n"))
    got = trie.conversation_trie(turns.join(sizes, "conv_id").withColumnRenamed("at", "depth"), sizes.select("conv_id"),
                                 share=6, queue=2, band=3)
    assert as_map(got) == plain_trie(rows, rebuild=False)


def test_trie_empty_and_turnless(spark):
    empty = as_map(trie.rebased_trie(conversations(spark, [])))
    assert empty == {(None, 0): (None, 0, 0, 1, 0, hashlib.sha256(b"").hexdigest())}
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    assert as_map(trie.rebased_trie(conversations(spark, rows))) == plain_trie(rows)


def test_spilling_queue():
    rng, q = random.Random(2), trie.SpillingQueue(most=5)
    items = [((-rng.randint(0, 9), rng.randint(0, 9)), (k,)) for k in range(200)]
    for key, value in items:
        q.push(key, value)
    for key in sorted({k for k, _ in items}):
        assert sorted(q.pop_all(key)) == sorted(v for k, v in items if k == key)
    assert not q.heap and not q.heads


# -------------------------------------------------------------------- sharding
def documents_table(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows],
                                 "doc_id long, text string, lang string, source string, shard int")


def check_shards(rows, out, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    loads = [0] * shards
    slots = {}
    for r in out:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def docs_rows(rng, n):
    return [(rng.choice([None, k, k]) if k % 50 == 0 else k, rng.choice([None, "é" * rng.randint(0, 30), "w " * rng.randint(0, 99)]),
             rng.choice(["en", "de", None]), rng.choice([f"src{rng.randint(0, 9)}", None])) for k in range(n)]


def test_shards_are_even(spark):
    rows = docs_rows(random.Random(4), 1500)
    for shards in (1, 7, 12):
        loads = check_shards(rows, kdshards.shard_documents(documents_table(spark, rows), shards).collect(), shards)
        assert max(loads) - min(loads) <= 2 * max(len((t or "").encode()) + 16 for _, t, _, _ in rows)


def test_shards_by_bins_equal_shards_by_sorting(spark, monkeypatch):
    rows = docs_rows(random.Random(6), 800)
    want = {(r.doc_id, r.size, r.text_crc32): r.shard for r in kdshards.shard_documents(documents_table(spark, rows), 6).collect()
            if r.doc_id is not None}
    monkeypatch.setattr(kdshards, "BINS", 5)
    monkeypatch.setattr(kdshards, "SORT_ROWS", 3)
    got = {(r.doc_id, r.size, r.text_crc32): r.shard for r in kdshards.shard_documents(documents_table(spark, rows), 6).collect()
           if r.doc_id is not None}
    assert got == want


def test_hot_copies_and_repeated_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(kdshards, "SORT_ROWS", 20)
    rows = [(5, "the same row", "en", "hot")] * 300 + [(k, "the same text", "en", "hot") for k in range(300)]
    loads = check_shards(rows, kdshards.shard_documents(documents_table(spark, rows), 8).collect(), 8)
    assert max(loads) - min(loads) <= 2 * 29


def test_copies_stay_together_where_bytes_allow(spark):
    rows = [(k, f"text {k % 40} " * (1 + k % 40), "en", "s") for k in range(400)]
    out = kdshards.shard_documents(documents_table(spark, rows), 4, dims=("size", "lang", "source")).collect()
    spread = {}
    for r in out:
        spread.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in spread.values()) <= 3  # one a cut


def test_shards_edges_and_files(spark, tmp_path):
    assert kdshards.shard_documents(documents_table(spark, []), 5).count() == 0
    few = check_shards([(1, "a", "en", "s")], kdshards.shard_documents(documents_table(spark, [(1, "a", "en", "s")]), 5).collect(), 5)
    assert sum(few) == 17
    rows = docs_rows(random.Random(7), 200) + [(1, "long " * 100_000, "en", "s")]
    back = kdshards.write_shards(documents_table(spark, rows), f"file://{tmp_path}/out", 6, files=2)
    assert back.columns == ["doc_id", "text", "lang", "source", "shard", "_shard"]
    assert sorted(map(repr, back.drop("_shard").collect())) == sorted(map(repr, documents_table(spark, rows).collect()))
    assert {p.name for p in (tmp_path / "out").glob("_shard=*")} <= {f"_shard={k}" for k in range(6)}
    assert back.groupBy("_shard").count().where("count > 20").count() >= 2  # beside the one with the long text
    by_target = kdshards.shard_documents(documents_table(spark, rows), target_bytes=100_000)
    assert by_target.agg({"shard": "max"}).first()[0] >= 4
