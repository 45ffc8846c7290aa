import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, position long, `a.b` int, place string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, "y") for row in rows], SCHEMA)


def cheapest(rows):
    """Backward over all states: cost, audit and what is said, by plain recursion over a table."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    table = {("", len(rows)): (0, "", ()), ("a", len(rows)): (0, "", ())}

    def better(key, found):
        if key not in table or found[:2] < table[key][:2]:
            table[key] = found

    for at in range(len(rows), -1, -1):
        if at < len(rows):
            role, text, fault = rows[at]
            for last, legal in steps.items():
                options = []
                if (last, at + 1) in table:
                    options.append((3, "D", (last, at + 1), None))
                if fault in (None, "truncated"):
                    more = fault == "truncated"
                    if role[:1] in legal and (legal[role[:1]], at + 1) in table:
                        options.append((more, "K", (legal[role[:1]], at + 1), (role, text)))
                    for name in ("user", "assistant"):
                        if name[0] in legal and (name[0], at + 1) in table:
                            options.append((2 + more, "R", (name[0], at + 1), (name, text)))
                for price, letter, to, said in options:
                    cost, audit, after = table[to]
                    better((last, at), (cost + price, letter + audit, ((said,) if said else ()) + after))
        for _ in range(4):  # insertions in front of the row, as long as they pay
            for last, legal in steps.items():
                for name in ("user", "assistant"):
                    to = (name[0], at)
                    if name[0] in legal and to in table:
                        cost, audit, after = table[to]
                        better((last, at), (cost + 2, "I" + audit, ((name, ""),) + after))
    return table["", 0]


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        visible = VISIBLE.findall(text)
        fault = None if visible and visible[-1] in ".!?" else "truncated"
        if (role, text) in seen:
            fault = "duplicate"
        if not visible:
            fault = "blank"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def brute(rows):
    """Contract of the query, one conversation at a time."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        groups[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    result = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, *_ in own if t is not None}
        judged = faults([(r, t) for _, r, t in own])
        cost, audit, said = cheapest(judged)
        kinds = [f for *_, f in judged]
        legal = {"su", "ua", "au"}
        result.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(a[1][:1] + b[1][:1] not in legal for a, b in zip(own, own[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


def made(rng, count, first=0, longest=9):
    rows = []
    for conv in range(first, first + count):
        roles = ["system"] * rng.randrange(2) + ["user", "assistant"] * rng.randrange(1, longest)
        for turn, role in enumerate(roles):
            if rng.random() < 0.1:
                role = rng.choice(["user", "assistant", "system", "tool", None, ""])
            text = rng.choice([f"Text {rng.randrange(10**6)}.", "Same words.", f"cut {rng.randrange(99)}", "Why? \n", " \t", "", None])
            if rng.random() < 0.6:
                text = f"A sound answer {rng.randrange(10**6)}!"
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text))
    return rows


def query(spark, rows, tasks=3):
    frame = repair.repair_query(conversations(spark, rows).repartition(tasks))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_query_is_what_brute_force_gives(spark):
    rows = made(random.Random(121), 150)
    assert query(spark, rows) == brute(rows)


def test_conversations_over_several_ranges_and_blocks(spark, monkeypatch):
    """One conversation holds most rows; blocks and ranges are joined."""
    monkeypatch.setattr(repair, "BLOCK", 7)
    rng = random.Random(122)
    rows = made(rng, 1, longest=2) + made(rng, 20, first=10)
    rows += [(5, t, r, f"Line {rng.randrange(40)}" + rng.choice([".", "", "?"])) for t, r in enumerate(rng.choices(["user", "assistant", "system"], [5, 5, 1], k=600))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = repair.ordered(repair.damaged(conversations(spark, rows)))
        parts = {r.position >> 33 for r in placed.where("conv_id = 5").select("position").collect()}
        assert len(parts) > 1
        assert query(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    """No ids, no turns, rows that are equal, rows that tie, everything dropped, an empty table, a long text."""
    rows = [(None, None, "user", "Hello."), (None, None, "user", "Hello."), (None, 3, None, None), (None, 4, "", "x" * 100_000)]
    rows += [(1, 1, "user", "B."), (1, 1, "user", "A"), (1, 1, "assistant", "C!"), (2, 0, "system", "Only.")]
    rows += [(3, 7, "assistant", "Equal."), (3, 7, "assistant", "Equal."), (3, 9, "assistant", "Equal."), (4, -5, "user", "é…")]
    dropped = next(c for c in range(100, 10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    found = query(spark, rows)
    assert found == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found
    assert query(spark, []) == []


def test_repaired_rows_are_well_formed(spark):
    rows = made(random.Random(123), 60)
    table, figures = repair.repaired(conversations(spark, rows))
    groups = defaultdict(list)
    for r in table.collect():
        groups[r.conv_id].append(r)
    audits = {r.conv_id: r.audit for r in figures.collect()}
    assert set(audits) == {r[0] for r in rows}
    for conv, audit in audits.items():
        said = sorted(groups[conv], key=lambda r: r.place)
        assert [r.place for r in said] == list(range(len(said)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in said))
        assert "".join(r.edit for r in said) == audit.replace("D", "")
        assert all((r.text == "") == (r.edit == "I") for r in said)


ROWS = st.lists(st.tuples(st.sampled_from("suaua "), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=14)
NAMED = {0: None, 1: "truncated", 2: "duplicate", 3: "blank"}


@settings(max_examples=600, deadline=None)
@given(ROWS)
def test_search_is_optimal(rows):
    expected = cheapest([(initial, "t", NAMED[fault]) for initial, fault in rows])
    assert repair.search(rows, repair.EMPTY, repair.ENDS) == expected[:2]


@settings(max_examples=150, deadline=None)
@given(ROWS, st.integers(1, 5))
def test_blocks_change_nothing(rows, size):
    whole = repair.search(rows, repair.EMPTY, repair.ENDS)
    before, repair.BLOCK = repair.BLOCK, size
    try:
        assert repair.ended(repair.paths(rows, (repair.EMPTY,))) == whole
        assert repair.ended(repair.paths(rows)) == whole
    finally:
        repair.BLOCK = before


@settings(max_examples=300, deadline=None)
@given(ROWS)
def test_bounds_are_never_above_the_cost(rows):
    early, late = repair.lower_bounds(rows)
    for at in range(len(rows) + 1):
        for state in repair.STATES:
            path = repair.search(rows[at:], state, repair.STATES)
            assert (late if state else early)[at] <= path[0]


@pytest.mark.parametrize("roles", ["u" * 96, "a" * 96, "uua" * 32, " " * 96, "us" * 48])
def test_hard_blocks_stay_small(roles):
    """Nodes that a search touches grow with the rows, not with the ways to edit them."""
    rng = random.Random(124)
    rows = [(r, rng.choice([0, 0, 1, 2])) for r in roles]
    touched = []

    @lru_cache(maxsize=None)
    def edits(row, state):
        return repair_edits(row, state)

    repair_edits = repair.row_edits

    def counted(row, state):
        touched.append(1)
        return edits(row, state)

    repair.row_edits = counted
    try:
        assert repair.search(rows, repair.EMPTY, repair.ENDS) == cheapest([(i, "t", NAMED[f]) for i, f in rows])[:2]
    finally:
        repair.row_edits = repair_edits
    assert len(touched) < 100 * len(rows)
