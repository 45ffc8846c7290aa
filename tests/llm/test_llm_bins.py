import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_brute import documents, hard_texts, prose
from tokenizers import Tokenizer

from tickloom.llm import bins

PATH = public_tokenizers.path(bins.TOKENIZER)
WHOLE, CACHED = Tokenizer.from_file(PATH), bins.ByteIds(PATH)


def whole_ids(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n\n  \t.,'sé́ x7<|>"), max_size=60), max_size=3))
def test_words_give_the_ids_of_whole_texts(rows):
    assert [x.tolist() for x in CACHED(rows)] == [whole_ids(t) for t in rows]


@pytest.mark.parametrize("text", [
    "", " ", "\n", "a ", "a\n", " a", "\na", "a  b", "a \nb", "a\n b", "a\n\nb", "a   b", "a\n\n", "  ", "\n\n\n", "it's 'so", "Ġa Ċb",
    "<|endoftext|>", "a <|endoftext|> b", "a\tb", "a\r\nb", "x y", "\x1c a", "end.\nNew  line \n\nx", " \n a",
])
def test_white_space_and_special_tokens(text):
    assert CACHED([text])[0].tolist() == whole_ids(text)


def one_by_one(lengths, limits, rule):
    """Every piece by itself into the best of all open sequences."""
    histogram = Counter(lengths)
    weights = bins.demand(histogram, limits) / limits.vector.astype(float) ** 2
    filled = []
    for n in sorted(lengths, reverse=True):
        wanted = bins.need(n)
        best = None
        for i, (room, held) in enumerate(filled):
            if (room >= wanted).all():
                if rule == "norm":
                    score = ((room - wanted).astype(float) ** 2 * weights).sum()
                else:
                    score = -(room.astype(float) * wanted * weights).sum()
                key = (score, tuple(room.tolist()))
                if best is None or key < best[0]:
                    best = key, i
        if best is None:
            filled.append((limits.vector - wanted, [n]))
        else:
            room, held = filled[best[1]]
            filled[best[1]] = room - wanted, [*held, n]
    return Counter(tuple(held) for _, held in filled)


def contents(histogram, runs):
    """Sequences of a plan, pieces in order of offset; every rank must have one place."""
    runs = sorted(runs)
    held = defaultdict(list)
    for (n, rank, first, each, offset), after in zip(runs, [*runs[1:], None]):
        stop = after[1] if after and after[0] == n else histogram[n]
        assert stop > rank
        for k in range(stop - rank):
            held[first + k // each].append((offset + k % each * n, n))
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
    assert sorted(held) == list(range(len(held)))
    return Counter(tuple(n for _, n in sorted(pieces)) for pieces in held.values())


LIMITS = [bins.Limits(32, 32, 32 * 32), bins.Limits(32, 3, 32 * 32), bins.Limits(32, 32, 300), bins.Limits(32, 4, 500)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 17), max_size=120), st.sampled_from(LIMITS), st.sampled_from(["norm", "dot"]))
def test_plan_is_what_placing_one_by_one_gives(lengths, limits, rule):
    histogram = Counter(lengths)
    found = contents(histogram, bins.plan(histogram, limits, rule))
    assert found == one_by_one(lengths, limits, rule)
    for pieces in found:
        assert sum(pieces) <= limits.tokens and len(pieces) <= limits.documents
        assert sum(n * n for n in pieces) <= limits.attention


def test_what_cannot_fit_raises():
    with pytest.raises(ValueError, match="fits no sequence"):
        bins.plan({20: 1}, bins.Limits(32, 32, 300))
    with pytest.raises(ValueError, match="no such rule"):
        bins.plan({20: 1}, rule="first")
    assert bins.plan({}) == []


def test_many_pieces_are_a_short_plan_and_fill_sequences():
    rng = random.Random(113)
    histogram = {n: rng.randrange(1, 10**6) // n + 1 for n in range(1, 1025)}
    runs = bins.plan(histogram)
    assert len(runs) < 20_000
    last = max(first + -(-(count - rank) // each) for (n, rank, first, each, _), count in (
        (r, next((s[1] for s in sorted(runs) if s[0] == r[0] and s[1] > r[1]), histogram[r[0]])) for r in sorted(runs)
    ))
    assert last <= 1.002 * sum(n * c for n, c in histogram.items()) / 1024 + 1


def places(rows, limits):
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    for spans in found.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(spans) <= limits.documents
        assert sum(n * n for _, n in spans) <= limits.attention
    return found


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(111)
    texts = hard_texts(rng) + [(100 + i, prose(rng, rng.randrange(1, 500))) for i in range(200)]
    rows = bins.bins_query(documents(spark, texts).repartition(5)).collect()
    found = places(rows, bins.Limits())
    assert len(found) <= 1.03 * sum(r.length for r in rows) / 1024 + 1
    expected = Counter()
    for i, text in texts:
        ids = np.array([*whole_ids(text or ""), 2], "<u4")
        starts = [0] if len(ids) <= 1024 else sorted({0, *range(len(ids) - 1024, 0, -1024)})
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_all_capacities_hold_on_tables(spark, rule):
    rng = random.Random(112)
    docs = documents(spark, {i: prose(rng, rng.randrange(0, 60)) for i in range(150)} | {200 + i: None for i in range(150)})
    limits = bins.Limits(512, 7, 60_000)
    pieces = bins.tokenized(docs.repartition(4), 200)
    rows = bins.pack(pieces, limits, rule).collect()
    found = places(rows, limits)
    assert sum(map(len, found.values())) == len(rows) == pieces.count()
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert Counter(tuple(n for _, n in sorted(x)) for x in found.values()) == one_by_one(
        [r.length for r in rows], limits, rule
    )


def test_columns_with_odd_names_are_carried_and_no_rows_give_none(spark):
    rows = spark.createDataFrame([("x", 3, 1), ("y", 3, 2)], "`a.b` string, length long, _block int")
    packed = bins.pack(rows).collect()
    assert sorted((r["a.b"], r.offset) for r in packed) in ([("x", 0), ("y", 3)], [("x", 3), ("y", 0)])
    assert bins.bins_query(documents(spark, {})).count() == 0


def test_groups_of_texts_change_nothing(monkeypatch):
    rng = random.Random(114)
    texts = [prose(rng, 50, 300).replace(" ", rng.choice([". ", ", ", "\n", " "]), 20) + "x" * rng.randrange(100) for _ in range(60)]
    assert [x.tolist() for x in CACHED(texts)] == [whole_ids(t) for t in texts]
    monkeypatch.setattr(bins, "CHARACTERS", 1000)
    table = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})
    groups = list(bins._groups(table))
    assert len(groups) > 10 and [t for _, some in groups for t in some] == texts
