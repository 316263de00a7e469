"""Operator 11: repair of conversation structure at least cost.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Its
rows, in order, become symbols of role and first fault; edits (keep, rerole,
delete, insert) are paid for by a shortest path through the four states of that
pattern. A symbol is a 4 x 4 matrix over (min, +) whose entries hold a cost and the
audit, the string of the edits' initials, as a rope. Since products associate:

1. Rows are ordered in ranges, so a conversation of any length is cut into runs of
   bounded size (``ordering``); each run is a string of symbols.
2. Equal strings are taken once, whatever conversations they come from.
3. Re-Pair: the most frequent pairs of neighbouring symbols, counted over all
   strings, become rules, round after round. The matrix of a rule is the product
   of its two sides, worked out once and shared by all conversations. ``ROUNDS``
   and ``RULES`` bound the grammar, not the work: pairs without a rule stay, and
   their matrices are multiplied one by one.
4. A string's matrix is the product over its last symbols; conversations cut into
   several runs multiply the matrices of their runs.

Among equal costs the audit least in ASCII wins. Two audits of one cost between
the same states over the same rows can't be prefixes of each other (the longer one
would hold one insertion more), so the least of a product is the product of the
least.

Nulls and edges: a null role or text is one space; rows are ordered by turn (nulls
first), then role, the first ``TIE_CHARS`` characters of the text and a hash of
role and text, so ties and repeated rows have one order; a null conv_id is a
conversation of its own; a role whose first letter is not s, u or a can't be kept;
an empty table gives an empty one; other columns are ignored, whatever their names.
The audit and the hash of one conversation are single values: its texts are
streamed through one task, which holds a batch of rows and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.ordering import ordered
from textlab.llm.shared import drop_written, offsets_of, written

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES, FAULTS = "suax", ("", "blank", "duplicate", "truncated")
#: Symbol r * 4 + f is role ROLES[r] with fault FAULTS[f], written as a letter from A on.
SYMBOLS = len(ROLES) * len(FAULTS)
RULES, ROUNDS = 256, 8
TIE_CHARS = 64

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept role, by state before it.
KEEP = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The state that an inserted or changed row leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Insertions that end a conversation in each state.
CLOSE = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
COST_CHANGE, COST_DELETE, COST_TRUNCATED = 3, 4, 3

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A string as a tree of shared parts, with a hash to compare parts by."""

    __slots__ = ("n", "h", "left", "right", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.n, self.h = len(text), 0
            for c in text:
                self.h = (self.h * _BASE + ord(c)) % _PRIME
        else:
            self.n = left.n + right.n
            self.h = (left.h * pow(_BASE, right.n, _PRIME) + right.h) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.n:
            return other
        if not other.n:
            return self
        if self.n + other.n <= 16:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += (x.right, x.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.n == y.n and x.h == y.h):
                continue
            if x.left is not None and (y.left is None or x.n >= y.n):
                a += (x.right, x.left)
                b.append(y)
            elif y.left is not None:
                b += (y.right, y.left)
                a.append(x)
            else:
                k = min(x.n, y.n)
                if x.text[:k] != y.text[:k]:
                    return x.text[:k] < y.text[:k]
                if x.n > k:
                    a.append(Rope(x.text[k:]))
                if y.n > k:
                    b.append(Rope(y.text[k:]))
        return bool(b) and not a


Entry = tuple[int, Rope]
Matrix = list[dict[int, Entry]]  # row: state before; column: state after


def _put(row: dict[int, Entry], state: int, cost: int, audit: Rope) -> None:
    old = row.get(state)
    if old is None or cost < old[0] or (cost == old[0] and audit < old[1]):
        row[state] = (cost, audit)


def multiply(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for row in a:
        new: dict[int, Entry] = {}
        for k, (cost, audit) in row.items():
            for j, (more, rest) in b[k].items():
                old = new.get(j)
                if old is None or cost + more <= old[0]:
                    _put(new, j, cost + more, audit + rest)
        out.append(new)
    return out


def symbol_matrix(symbol: int) -> Matrix:
    """Insertions before a row, then its own edit."""
    role, fault = ROLES[symbol // len(FAULTS)], FAULTS[symbol % len(FAULTS)]
    extra = COST_TRUNCATED if fault == "truncated" else 0
    out: Matrix = []
    for start in range(4):
        row: dict[int, Entry] = {}
        state, inserted = start, 0
        while inserted < 4:  # from there on, a state met before, at a higher cost
            base, lead = COST_CHANGE * inserted, "I" * inserted
            _put(row, state, base + COST_DELETE, Rope(lead + "D"))
            if fault not in ("blank", "duplicate"):
                if role in KEEP[state]:
                    _put(row, KEEP[state][role], base + extra, Rope(lead + "K"))
                _put(row, NEXT[state], base + COST_CHANGE + extra, Rope(lead + "R"))
            state, inserted = NEXT[state], inserted + 1
        out.append(row)
    return out


def cheapest(row: dict[int, Entry]) -> Entry:
    """The least way to end well from a row of the whole product."""
    best: dict[int, Entry] = {}
    for state, (cost, audit) in row.items():
        _put(best, 0, cost + COST_CHANGE * CLOSE[state], audit + Rope("I" * CLOSE[state]))
    return best[0]


# ------------------------------------------------------------------- grammar
def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    col = batch.column(batch.schema.get_field_index("symbols"))
    offs = np.asarray(col.offsets, np.int64)
    return np.asarray(col.values.to_numpy(zero_copy_only=False), np.int32)[offs[0]:offs[-1]], offs - offs[0]


def rewrite(flat: np.ndarray, offs: np.ndarray, rules: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair (a, b) of neighbours in a row as symbol c, from the left, rule by rule."""
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    for a, b, c in rules:
        at = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b) & (row[:-1] == row[1:]))
        if a == b and len(at):  # of overlapping pairs every other one
            head = np.r_[True, np.diff(at) != 1]
            run = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        if len(at):
            flat = flat.copy()
            flat[at] = c
            stay = np.ones(len(flat), bool)
            stay[at + 1] = False
            flat, row = flat[stay], row[stay]
    return flat, offsets_of(np.bincount(row, minlength=len(offs) - 1))


def _rewriter(rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offs = rewrite(*_flat(batch), rules)
            cols = [pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, pa.int32()))
                    if name == "symbols" else batch.column(k) for k, name in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)
    return run


#: Stands for all symbols in the counts of pairs.
ALL = -1


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offs = _flat(batch)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
        pair = (flat[:-1].astype(np.int64) << 32) | flat[1:]
        pair, n = np.unique(pair[row[:-1] == row[1:]], return_counts=True)
        pair, n = np.append(pair, ALL), np.append(n, len(flat))
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])


def learn_grammar(strings: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> tuple[DataFrame, list[Matrix]]:
    """(the strings over the grammar's symbols, the matrix of every symbol).

    Each round takes the pairs at least a quarter as frequent as the most frequent
    one, ``rules`` at most; the driver sees those pairs only. It ends when a round
    would take away fewer than one symbol in 20.
    """
    matrices = [symbol_matrix(s) for s in range(SYMBOLS)]
    cur = written(strings, "symbols")
    for _ in range(rounds):
        counted = (cur.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                   .where("n > 1").orderBy(F.desc(F.col("pair") == ALL), F.desc("n"), "pair").limit(rules + 1).collect())
        top = [r for r in counted[1:] if 4 * r.n >= counted[1].n]
        if 20 * sum(r.n for r in top) <= counted[0].n if counted else True:
            break
        new = []
        for r in top:
            a, b = r.pair >> 32, r.pair & 0xFFFFFFFF
            new.append((a, b, len(matrices)))
            matrices.append(multiply(matrices[a], matrices[b]))
        nxt = written(cur.mapInArrow(_rewriter(new), cur.schema), "symbols")
        drop_written(cur)
        cur = nxt
    return cur, matrices


_FACTS = ("key string, blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "cost array<long>, audit array<string>")


def _evaluator(matrices: list[Matrix]):
    """Facts of every string: fault counts, and cost and audit of one row of its
    matrix (from START, closed) or, for runs of longer conversations, of all four
    rows and columns (a missing entry: cost -1)."""
    faults = np.arange(SYMBOLS) % len(FAULTS)
    legal = {x + y for x, y in ("su", "ua", "au")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.to_pydict()
            rows = []
            for key, string, symbols, cut in zip(cols["key"], cols["string"], cols["symbols"], cols["cut"], strict=True):
                raw = np.frombuffer(string.encode(), np.uint8).astype(np.int64) - ord("A")
                count = np.bincount(faults[raw], minlength=len(FAULTS))
                pairs, n = np.unique(raw[:-1] // 4 * 4 + raw[1:] // 4, return_counts=True)
                illegal = sum(int(m) for p, m in zip(pairs, n, strict=True) if ROLES[p // 4] + ROLES[p % 4] not in legal)
                product: Matrix = [{s: (0, Rope())} for s in range(4 if cut else 1)]
                for s in symbols:
                    product = multiply(product, matrices[s])
                if cut:
                    got = [product[i].get(j, (-1, Rope())) for i in range(4) for j in range(4)]
                else:
                    got = [cheapest(product[0])]
                rows.append((key, *map(int, count[1:]), illegal, ROLES[raw[0] // 4], ROLES[raw[-1] // 4],
                             [c for c, _ in got], [str(a) for _, a in got]))
            if rows:
                names = [x.split()[0] for x in _FACTS.split(", ")]
                kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return run


def _join_runs(runs: pd.DataFrame) -> pd.DataFrame:
    """One conversation from its runs in order."""
    runs = runs.sort_values("_part", kind="stable")
    row: dict[int, Entry] = {START: (0, Rope())}
    illegal, last = 0, None
    for r in runs.itertuples():
        matrix = [{j: (int(r.cost[4 * i + j]), Rope(r.audit[4 * i + j])) for j in range(4) if r.cost[4 * i + j] >= 0}
                  for i in range(4)]
        row = multiply([row], matrix)[0]
        illegal += r.illegal + (last is not None and last + r.first not in ("su", "ua", "au"))
        last = r.last
    cost, audit = cheapest(row)
    return pd.DataFrame({"_conv": [runs["_conv"].iloc[0]], "blank": [int(runs.blank.sum())],
                         "duplicate": [int(runs.duplicate.sum())], "truncated": [int(runs.truncated.sum())],
                         "illegal": [int(illegal)], "cost": [cost], "audit": [str(audit)]})


# ------------------------------------------------------------------ operator
def _turns(conversations: DataFrame) -> DataFrame:
    """The rows under one naming, with what orders and describes them."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("_conv"), "conv_id", "turn",
        role.alias("role"), text.alias("text"), F.substring(text, 1, TIE_CHARS).alias("_tie"),
        F.xxhash64(F.lit(1), role, text).alias("_h1"), F.xxhash64(F.lit(2), role, text).alias("_h2"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_tie"), F.col("_h1"), F.col("_h2")]


def _symbols(turns: DataFrame) -> DataFrame:
    """(_conv, _part, string): the runs of all conversations as strings of symbols."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    facts = turns.select("_conv", "turn", "role", "_tie", "_h1", "_h2", (bare == "").alias("_blank"),
                         F.substring(bare, -1, 1).isin(*ENDS).alias("_ended"))
    rows = ordered(facts, "_conv", _order(), "turns").select("_conv", "_h1", "_h2", "_blank", "_ended", "_id", "_part",
                                                             F.substring("role", 1, 1).alias("_role"))
    first = rows.groupBy("_conv", "_h1", "_h2").agg(F.min("_id").alias("_first"))
    rows = rows.join(first, ["_conv", "_h1", "_h2"])
    role = F.when(F.col("_role") == "s", 0).when(F.col("_role") == "u", 1).when(F.col("_role") == "a", 2).otherwise(3)
    fault = (F.when(F.col("_blank"), 1).when(F.col("_id") > F.col("_first"), 2)
             .when(~F.col("_ended"), 3).otherwise(0))
    symbol = F.char(F.lit(ord("A")) + role * len(FAULTS) + fault)
    return (rows.select("_conv", "_part", F.struct("_id", symbol.alias("s")).alias("x"))
            .groupBy("_conv", "_part").agg(F.sort_array(F.collect_list("x")).alias("x"))
            .select("_conv", "_part", F.array_join(F.transform("x", lambda v: v["s"]), "").alias("string")))


def audit_conversations(turns: DataFrame) -> DataFrame:
    """(_conv, blank, duplicate, truncated, illegal, cost, audit, gaps) of rows of ``_turns``."""
    runs = written(_symbols(turns).withColumn("key", F.md5("string")), "runs")
    several = runs.groupBy("_conv").agg((F.count("*") > 1).alias("cut"))
    runs = runs.join(several, "_conv")
    codes = F.transform(F.split("string", ""), lambda c: F.ascii(c) - ord("A"))
    strings = (runs.groupBy("key").agg(F.first("string").alias("string"), F.max("cut").alias("cut"))
               .select("key", "string", "cut", codes.alias("symbols")))
    # a key that is in some longer conversation is worked out both ways
    strings = strings.withColumn("cut", F.explode(F.when(F.col("cut"), F.array(F.lit(False), F.lit(True)))
                                                  .otherwise(F.array(F.lit(False)))))
    shared, matrices = learn_grammar(strings)
    facts = written(shared.mapInArrow(_cut_kept(_evaluator(matrices)), "cut boolean, " + _FACTS), "facts")
    drop_written(shared)
    whole = (runs.where("not cut").select("_conv", "key")
             .join(facts.where("not cut").withColumnsRenamed({"cost": "costs", "audit": "audits"}), "key")
             .select("_conv", "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"),
                     F.col("audits")[0].alias("audit")))
    pieces = runs.where("cut").select("_conv", "_part", "key").join(facts.where("cut").drop("cut"), "key").drop("key")
    joined = pieces.groupBy("_conv").applyInPandas(_join_runs, whole.schema)
    per_turn = turns.groupBy("_conv", "turn").agg(F.lit(1).alias("one"))
    gaps = per_turn.groupBy("_conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    return whole.unionByName(joined).join(gaps, "_conv")


def _cut_kept(run):
    """``run`` on the rows of each kind of ``cut`` apart, which it then names."""
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in (False, True):
                part = batch.filter(pa.compute.equal(batch.column(batch.schema.get_field_index("cut")), value))
                for out in run([part] if part.num_rows else []):
                    yield pa.RecordBatch.from_arrays([pa.array([value] * out.num_rows), *out.columns],
                                                     ["cut", *out.schema.names])
    return both


def _streamed(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit row (``turn`` null, tag 0), then its rows in order."""
    facts = [c for c in audits.columns if c != "_conv"]
    head = audits.select("_conv", F.lit(0).alias("_tag"), *[F.lit(None).cast(t).alias(c) for c, t in turns.dtypes
                                                           if c not in ("_conv", *facts)], *facts)
    body = turns.select("_conv", F.lit(1).alias("_tag"), *[c for c in turns.columns if c != "_conv"],
                        *[F.lit(None).cast(dict(audits.dtypes)[c]).alias(c) for c in facts])
    return (head.unionByName(body).repartition(F.col("_conv"))
            .sortWithinPartitions("_conv", "_tag", *_order()).drop("_tie", "_h1", "_h2"))


class _Editor:
    """The edits of one conversation, applied to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _new_role(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role = self._new_role()
            self.last = role[0]
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            role = self._new_role() if edit == "R" else role
            self.last = role[0]
            yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_conv", *_COUNTS, "audit", "repaired_sha256"]
    editor, facts, digest, any_row = None, None, None, False

    def feed(rows) -> None:
        nonlocal any_row
        for _, role, text in rows:
            if any_row:
                digest.update(b"\n")
            digest.update(role.encode())
            digest.update(b":")
            digest.update(text.encode())
            any_row = True

    def batch_of(done) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                                          names)

    for batch in batches:
        done = []
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_tag", "role", "text", *names[:-1])]
        for tag, role, text, *own in zip(*cols, strict=True):
            if tag == 0:
                if editor is not None:
                    feed(editor.end())
                    done.append((*facts, digest.hexdigest()))
                editor, facts, digest, any_row = _Editor(own[-1]), own, hashlib.sha256(), False
            else:
                feed(editor.row(role, text))
        if done:
            yield batch_of(done)
    if editor is not None:
        feed(editor.end())
        yield batch_of([(*facts, digest.hexdigest())])


def _emit_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    editor, conv, at = None, None, 0
    for batch in batches:
        out = []
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("_tag", "_conv", "turn", "role", "text", "audit")]
        for tag, key, turn, role, text, audit in zip(*cols, strict=True):
            if tag == 0:
                for edit in editor.end() if editor else ():
                    out.append((conv, at, None, edit[0], *edit[1:]))
                    at += 1
                editor, conv, at = _Editor(audit), key, 0
            else:
                for edit in editor.row(role, text):
                    out.append((conv, at, None if edit[0] == "I" else turn, *edit))
                    at += 1
        if out:
            yield _turn_batch(out)
    if editor is not None and (out := [(conv, at + k, None, *e) for k, e in enumerate(editor.end())]):
        yield _turn_batch(out)


def _turn_batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["_conv", "position", "turn", "edit", "role", "text"])


def _conv_id(conversations: DataFrame) -> Column:
    kind = conversations.schema["conv_id"].dataType
    return F.when(F.col("_conv") != " ", F.col("_conv")).cast(kind).alias("conv_id")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256 (of the repaired ``role:text`` lines)."""
    turns = _turns(conversations).drop("conv_id").withColumn("turn", F.col("turn").cast("long"))
    audits = audit_conversations(turns)
    kinds = ("_conv string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string")
    out = _streamed(turns, audits).mapInArrow(_hash_repaired, kinds)
    return out.select(_conv_id(conversations), *_COUNTS, "audit", "repaired_sha256")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, position (from 0), turn (null
    for inserted rows), edit (K, R or I), role, text."""
    turns = _turns(conversations).drop("conv_id").withColumn("turn", F.col("turn").cast("long"))
    rows = _streamed(turns, audit_conversations(turns).select("_conv", "audit"))
    out = rows.mapInArrow(_emit_repaired, "_conv string, position long, turn long, edit string, role string, text string")
    return out.select(_conv_id(conversations), "position", "turn", "edit", "role", "text")
