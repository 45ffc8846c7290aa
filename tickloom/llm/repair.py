"""Repair of conversation structure by depth-first branch-and-bound.

A repaired conversation has the roles ``(system? (user assistant)+)?``. Its rows are read in order, and each is kept
(K, free), given the role user or assistant (R, 2), or deleted (D, 3); a row without text may be inserted
anywhere (I, 2). Blank and repeated rows must be deleted; a truncated row that stays costs 1. The letters of
the edits in order are the audit. The cheapest edits are wanted, and of equally cheap ones the ASCII-least audit.

A node of the search is a row number with a state: what the roles so far allow next. The search keeps an
explicit stack, dives into the most promising edit first, and drops a prefix if it is no better than the best one that
reached its node (the dominance table), or if its cost and a lower bound for the remaining rows cannot beat the
incumbent (cost, audit). It ends when the stack is empty, which proves the incumbent. Two prefixes of one node and
cost never continue one another, as they edit the same rows and so have equally many insertions.

Searches are short: a conversation is cut into blocks of ``BLOCK`` rows, and each block is solved from every
state it may begin with to every state it may end with. Blocks are then joined, first those of one
range of the sorted table, which bounds them, then the ranges of a conversation. So a conversation with a third of
all rows is ordered, marked and solved by many tasks. What stays whole is what a result holds in
one cell: the audit, a letter per edit; and the edits are applied in order, by a task that streams the rows.

Null roles and texts are one space. Rows of one turn go by role, by the first ``KEY`` characters
of the text, then by a digest of it; null turns come first. Equal rows are rows of their own, all but the first
repeated. The conversation without an id is one like any other. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import stored

#: Rows of a block that is searched as one; no result depends on it.
BLOCK = 96
#: Characters of a text by which rows of one turn and role are ordered.
KEY = 64
SPACE = " \t\n\x0b\x0c\r"
USER, ASSISTANT = "user", "assistant"

#: Faults of a row, the first that applies.
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
#: What was said so far: nothing, system, user or assistant last. A conversation may end with EMPTY or ANSWERED.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
STATES = (EMPTY, OPENED, ASKED, ANSWERED)
ENDS = (EMPTY, ANSWERED)
#: The role that an edit can give the next row, and the state after it.
GIVEN = {EMPTY: ("u", ASKED), OPENED: ("u", ASKED), ASKED: ("a", ANSWERED), ANSWERED: ("u", ASKED)}
ROLES = {"u": USER, "a": ASSISTANT}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
RENAME, DELETE, INSERT = 2, 3, 2

Path = tuple[int, str]
#: Role initial (s, u, a, or a space for any other) and fault of a row.
Row = tuple[str, int]


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row of this role, null if the role cannot come next."""
    if initial == "s":
        return OPENED if state == EMPTY else None
    role, after = GIVEN[state]
    return after if role == initial else None


def row_edits(row: Row, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, state after)`` of what can be done with a row."""
    initial, fault = row
    edits = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        stays = int(fault == TRUNCATED)
        after = kept_state(state, initial)
        if after is not None:
            edits.append(("K", stays, after))
        edits.append(("R", RENAME + stays, GIVEN[state][1]))
    return edits


def lower_bounds(rows: list[Row]) -> tuple[list[int], list[int]]:
    """What the rows from each place on must cost at least: before anything was said, and after.

    Every row pays for its cheapest edit by itself. On top of that, of two rows of one role that stand
    side by side once the rows to delete are gone, one must be changed or something put between them, which
    costs 2 more; pairs without a common row add up.
    """
    at_start, later, pairs = [0], [0], [0]
    follows: tuple[str, int] | None = None  # role of the next row that may stay, and the pairs after it
    for initial, fault in reversed(rows):
        stays = int(fault == TRUNCATED)
        changed = min(DELETE, RENAME + stays)
        if fault in (BLANK, DUPLICATE):
            own = own_later = DELETE
            count = pairs[-1]
        else:
            own_later = stays if initial in "ua" else changed
            own = stays if initial in "sua" else changed
            count = pairs[-1]
            if follows and initial in "ua" and follows[0] == initial:
                count = max(count, follows[1] + 1)
            follows = (initial, pairs[-1])
        at_start.append(at_start[-1] + own)
        later.append(later[-1] + own_later)
        pairs.append(count)
    extra = [min(RENAME, INSERT) * n for n in pairs]
    return [a + b for a, b in zip(at_start, extra)][::-1], [a + b for a, b in zip(later, extra)][::-1]


def search(rows: list[Row], start: int, ends: tuple[int, ...]) -> Path | None:
    """Cheapest edits of the rows from a state to one of ``ends``, with the ASCII-least audit; none if impossible."""
    bounds = lower_bounds(rows)
    best: Path | None = None
    reached: dict[tuple[int, int], Path] = {(0, start): (0, "")}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if reached[at, state] != (cost, audit):
            continue  # a better prefix came here meanwhile
        if best and not _promising(best, cost + bounds[state != EMPTY][at], audit):
            continue
        if at == len(rows) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        steps = [("I", INSERT, at, GIVEN[state][1])]
        if at < len(rows):
            steps += [(letter, price, at + 1, after) for letter, price, after in row_edits(rows[at], state)]
        found = []
        for letter, price, to, after in steps:
            path = (cost + price, audit + letter)
            least = path[0] + bounds[after != EMPTY][to]
            if best and not _promising(best, least, path[1]):
                continue
            if (to, after) not in reached or path < reached[to, after]:
                reached[to, after] = path
                found.append((least, letter, to, after, path))
        found.sort(reverse=True)
        stack += [(to, after, *path) for _, _, to, after, path in found]
    return best


def _promising(best: Path, least: int, audit: str) -> bool:
    """Whether a prefix that must cost at least ``least`` in the end can still beat the incumbent."""
    return least < best[0] or least == best[0] and audit <= best[1][: len(audit)]


Paths = dict[tuple[int, int], Path]


def joined(first: Paths, second: Paths) -> Paths:
    """Best paths through both, by the states they begin and end with."""
    found: Paths = {}
    for (a, b), (cost, audit) in first.items():
        for (c, d), (more, rest) in second.items():
            if b == c:
                path = (cost + more, audit + rest)
                if (a, d) not in found or path < found[a, d]:
                    found[a, d] = path
    return found


def paths(rows: list[Row], starts: tuple[int, ...] = STATES) -> Paths:
    """Best paths through the rows, from each of ``starts`` to every state that can be reached."""
    total: Paths | None = None
    for at in range(0, len(rows), BLOCK):
        block = rows[at : at + BLOCK]
        own = {}
        for start in starts if total is None else sorted({end for _, end in total}):
            for end in STATES:
                path = search(block, start, (end,))
                if path is not None:
                    own[start, end] = path
        total = own if total is None else joined(total, own)
    return total or {(start, start): (0, "") for start in starts}


def cheapest(rows: list[Row]) -> Path:
    """Cost and audit of a whole conversation."""
    if len(rows) <= BLOCK:
        return search(rows, EMPTY, ENDS) or (0, "")
    return ended(paths(rows, (EMPTY,)))


def ended(found: Paths) -> Path:
    return min(path for (start, end), path in found.items() if start == EMPTY and end in ENDS)


def conversation_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, whatever else the rows carry; null roles and texts are one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows with a ``position`` that grows along conversations, and what can be said of a row alone.

    The upper bits of a position number the range of the sorted table that a row is in. Ranges are cut
    by rows, equal ones included, so none holds much more than its share.
    """
    rows = conversation_rows(conversations).withColumns(
        {
            "_key": F.substring("text", 1, KEY),
            "_one": F.xxhash64("role", "text"),
            "_two": F.xxhash64(F.lit(1), "role", "text"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    order = ["conv_id", "turn", "role", "_key", "_one", "_two", "_row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    tail = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return placed.select(
        "conv_id", "turn", "role", "text", "_one", "_two",
        F.monotonically_increasing_id().alias("position"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(" ").alias("initial"),
        F.when(tail == "", BLANK).when(F.right(tail, F.lit(1)).isin(".", "!", "?"), SOUND)
        .otherwise(TRUNCATED).alias("fault"),
    )


def marked(placed: DataFrame) -> DataFrame:
    """``conv_id, turn, position, initial, fault`` with repeated rows known."""
    firsts = (
        placed.groupBy("conv_id", "_one", "_two")
        .agg(F.min("position").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("_one").alias("_a"), F.col("_two").alias("_b"), "_first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_one") == F.col("_a")) & (F.col("_two") == F.col("_b"))
    repeated = (F.col("fault") != BLANK) & (F.col("position") > F.col("_first"))
    return placed.drop("role", "text").join(firsts, same, "left").select(
        "conv_id", "turn", "position", "initial", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault")
    )


_PATH = "array<struct<start: int, end: int, cost: long, audit: string>>"
_COUNTS = "rows long, blank long, duplicate long, truncated long, illegal long"
_PART = f"conv_id long, part long, {_COUNTS}, first string, last string, paths {_PATH}"
_WHOLE = f"conv_id long, {_COUNTS}, cost long, audit string"
_COUNTED = ("rows", "blank", "duplicate", "truncated", "illegal")


def _part(conv_id: int | None, part: int, codes: list[dict], whole: bool) -> dict:
    """Summary of the rows of a conversation in one range; of a whole one, the best path alone."""
    rows = [(code["initial"], code["fault"]) for code in codes]
    faults = [fault for _, fault in rows]
    found = {(EMPTY, ANSWERED): cheapest(rows)} if whole else paths(rows)
    return {
        "conv_id": conv_id,
        "part": part,
        "rows": len(rows),
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum((a[0], b[0]) not in LEGAL for a, b in pairwise(rows)),
        "first": rows[0][0],
        "last": rows[-1][0],
        "paths": [{"start": a, "end": b, "cost": c, "audit": s} for (a, b), (c, s) in sorted(found.items())],
    }


def _whole(conv_id: int | None, parts: list[dict]) -> dict:
    """A conversation from its parts, in order."""
    found: Paths | None = None
    for part in parts:
        own = {(p["start"], p["end"]): (p["cost"], p["audit"]) for p in part["paths"]}
        found = {k: v for k, v in own.items() if k[0] == EMPTY} if found is None else joined(found, own)
    cost, audit = ended(found or {})
    row = {name: sum(part[name] for part in parts) for name in _COUNTED}
    row["illegal"] += sum((a["last"], b["first"]) not in LEGAL for a, b in pairwise(parts))
    return {"conv_id": conv_id, **row, "cost": cost, "audit": audit}


def _schema(frame: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(frame.sparkSession.createDataFrame([], ddl).schema)


def _by_row(frame: DataFrame, make, ddl: str) -> DataFrame:
    """A row for each row, made in Python."""
    schema = _schema(frame, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows = [make(**row) for row in batch.slice(i, 500).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return frame.mapInArrow(run, ddl)


def solved(marks: DataFrame) -> DataFrame:
    """Counts of faults, cost and audit of every conversation that has rows."""
    totals = marks.groupBy("conv_id").agg(F.count("*").alias("_total"))
    totals = totals.withColumnRenamed("conv_id", "_conv")
    parts = (
        marks.groupBy("conv_id", F.shiftright("position", 33).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "initial", "fault"))).alias("codes"))
        .join(totals, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .select("conv_id", "part", "codes", (F.size("codes") == F.col("_total")).alias("whole"))
    )
    summaries = _by_row(parts, _part, _PART)
    fields = ["part", *_COUNTED, "first", "last", "paths"]
    gathered = summaries.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("parts"))
    return _by_row(gathered, _whole, _WHOLE)


def edited(placed: DataFrame, solutions: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, edit`` of the repaired rows, in order within a task.

    The audit of a conversation comes before its rows, which are streamed: no task holds them together.
    """
    stream = placed.select("conv_id", "position", "role", "text", F.lit(None).cast("string").alias("audit"))
    ahead = solutions.select(
        "conv_id", F.lit(-1).cast("long").alias("position"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), "audit",
    )
    ddl = "conv_id long, place long, role string, text string, edit string"
    schema = _schema(placed, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, EMPTY, 0

        def spoken(conv_id, role: str, text: str, edit: str) -> dict:
            nonlocal state, place
            initial = role[:1] if edit == "K" else GIVEN[state][0]
            state = kept_state(state, initial)
            place += 1
            return {"conv_id": conv_id, "place": place - 1, "role": role, "text": text, "edit": edit}

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                conv_id = row["conv_id"]
                if row["audit"] is not None:
                    audit, at, state, place = row["audit"], 0, EMPTY, 0
                    edits = len(audit.rstrip("I"))
                    continue
                while audit[at] == "I":
                    rows.append(spoken(conv_id, ROLES[GIVEN[state][0]], "", "I"))
                    at += 1
                letter = audit[at]
                at += 1
                if letter != "D":
                    role = row["role"] if letter == "K" else ROLES[GIVEN[state][0]]
                    rows.append(spoken(conv_id, role, row["text"], letter))
                if at == edits:  # what is inserted after the last row
                    rows += [spoken(conv_id, ROLES[GIVEN[state][0]], "", "I") for _ in audit[at:]]
            yield pa.RecordBatch.from_pylist(rows, schema)

    both = stream.unionByName(ahead)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(run, ddl)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` from the rows of ``edited`` as they come: a running hash, no text is kept."""
    ddl = "conv_id long, repaired_sha256 string"
    schema = _schema(rows, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, current = None, None
        for batch in batches:
            done = []
            for row in batch.select(["conv_id", "place", "role", "text"]).to_pylist():
                said = f"{row['role']}:{row['text']}".encode()
                if row["place"]:
                    running.update(b"\n" + said)
                    continue
                if running:
                    done.append({"conv_id": current, "repaired_sha256": running.hexdigest()})
                running, current = hashlib.sha256(said), row["conv_id"]
            yield pa.RecordBatch.from_pylist(done, schema)
        if running:
            last = {"conv_id": current, "repaired_sha256": running.hexdigest()}
            yield pa.RecordBatch.from_pylist([last], schema)

    return rows.mapInArrow(run, ddl)


def repaired(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows, and ``conv_id``, counts, gaps, cost and audit of every conversation that has rows."""
    placed = stored(ordered(conversations), "ordered")
    marks = stored(marked(placed), "marks")
    solutions = stored(solved(marks), "solved")
    turns = marks.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    figures = solutions.join(turns, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return edited(placed, solutions), figures


def damage_of(conversations: DataFrame) -> Column:
    """What the contract does to a row: the hash of conversation and turn, by 20."""
    names = [F.coalesce(F.col(n).cast("long").cast("string"), F.lit(" ")) for n in ("conv_id", "turn")]
    return F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """0 drops a row, 1 empties its text, 2 takes its full stops and the like, 3 repeats it, 4 makes it the user's."""
    kind = damage_of(conversations)
    rows = conversation_rows(conversations).withColumn("_kind", kind).where("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, USER).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("copy"),
    )


def repair_query(conversations: DataFrame) -> DataFrame:
    """Contract of the query: every original conversation, repaired after damage, with a digest of the result."""
    rows, figures = repaired(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    figures = figures.withColumnRenamed("conv_id", "_a")
    texts = digests(rows).withColumnRenamed("conv_id", "_b")
    whole = ids.join(figures, F.col("conv_id").eqNullSafe(F.col("_a")), "left").join(
        texts, F.col("conv_id").eqNullSafe(F.col("_b")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
