import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_brute import documents, hard_texts, prose

from tickloom.llm import chunks

NUMBERS = chunks.gears()


def slow_cuts(data):
    """The rolling hash byte by byte."""
    mask = ((1 << max(1, (chunks.ABOUT - chunks.LEAST).bit_length() - 1)) - 1) << 24
    ends, start = [], 0
    for i in range(len(data)):
        rolled = 0
        for j in range(max(0, i - 31), i + 1):
            rolled = ((rolled << 1) + int(NUMBERS[data[j]])) & 0xFFFFFFFF
        size = i + 1 - start
        if size >= chunks.LEAST and rolled & mask == 0 or size == chunks.MOST:
            ends.append(i + 1)
            start = i + 1
    return ends if start == len(data) else [*ends, len(data)]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900) | st.integers(0, 900).map(lambda n: b"a" * n))
def test_cuts_match_the_rolling_hash(data):
    assert chunks.cuts(data, NUMBERS) == slow_cuts(data)


def test_portions_change_nothing(monkeypatch):
    data = np.random.default_rng(1).bytes(20_000)
    whole = chunks.cuts(data, NUMBERS)
    monkeypatch.setattr(chunks, "PORTION", 777)
    assert chunks.cuts(data, NUMBERS) == whole
    assert max(np.diff([0, *whole])) <= chunks.MOST


def test_insertions_shift_only_nearby_chunks():
    data = prose(random.Random(61), 4_000, 3_000).encode()
    changed = data[:9_000] + b"inserted words " + data[9_000:]
    own, other = ({d[a:b] for a, b in zip([0, *e], e)} for d, e in ((x, chunks.cuts(x, NUMBERS)) for x in (data, changed)))
    assert len(own - other) <= 6


def slow_repeats(texts):
    """Every occurrence of a repeated chunk with its keeper."""
    places = defaultdict(list)
    for i, text in texts:
        data = (text or "").encode()
        ends = slow_cuts(data) if len(data) < 5_000 else chunks.cuts(data, NUMBERS)
        for a, b in zip([0, *ends], ends):
            places[data[a:b]].append((i, a, b - a))
    found = Counter()
    for where in places.values():
        if len(where) > 1:
            first = min(where, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
            for i, a, n in where:
                found[(i, a, n, len(where), first[0], first[1])] += 1
    return found


def corpus(rng):
    passage = prose(rng, 70, 9_000)
    texts = hard_texts(rng)
    for i in range(40):
        parts = [prose(rng, rng.randrange(5, 120), 9_000) for _ in range(2)]
        texts.append((100 + i, f" {passage} ".join(parts) if i % 4 == 0 else " ".join(parts)))
    return [*texts, (300, texts[-1][1])]


def test_repeats_match_brute_force(spark):
    texts = corpus(random.Random(62))
    rows = chunks.repeated_chunks(documents(spark, texts).repartition(3)).collect()
    found = Counter((r.doc_id, r.start, r.length, r.copies, r.keeper_doc_id, r.keeper_start) for r in rows)
    assert found == slow_repeats(texts)


def test_passages_are_caught_and_clean_documents_left(spark):
    texts = corpus(random.Random(63))
    rows = chunks.chunks_query(documents(spark, texts)).collect()
    ids = {r.doc_id for r in rows}
    assert {100 + i for i in range(0, 40, 4)} <= ids and {139, 300} <= ids
    assert ids & {100 + i for i in range(39) if i % 4} == set()
    assert all(r.kept == (r.doc_id == r.keeper_doc_id) for r in rows if r.doc_id and r.doc_id >= 100)
    covered = defaultdict(set)
    for r in rows:
        assert r.copies > 1
        covered[r.doc_id].update(range(r.start, r.stop))
    # spans are parts of a stretch: stretches are long enough, or a whole text
    expected = defaultdict(set)
    for i, a, b in slow_stretches(texts):
        expected[i].update(range(a, b))
    assert {i: s for i, s in covered.items() if i is not None} == expected
    assert {r.keeper_doc_id for r in rows if r.doc_id == 300} == {139}


def test_nothing_to_chunk(spark):
    assert chunks.chunks_query(documents(spark, {})).count() == 0
    assert chunks.chunks_query(documents(spark, {1: None, 2: "", 3: "a"})).count() == 0


def slow_stretches(texts):
    """Byte ranges of unbroken repeated stretches that have the least length or are a whole text."""
    sizes = {i: len((t or "").encode()) for i, t in texts}
    found, places = set(), sorted({(i, a, a + n) for i, a, n, *_ in slow_repeats(texts) if i is not None})
    while places:
        i, a, b = places.pop(0)
        while places and places[0][:2] == (i, b):
            b = places.pop(0)[2]
        if b - a >= chunks.SPAN or (a, b) == (0, sizes[i]):
            found.add((i, a, b))
    return found


def test_stretches_stay_whole_when_keepers_differ(spark):
    """Parts of a passage that were first seen in different documents, and texts shorter than the least length."""
    rng = random.Random(64)
    passage = prose(rng, 90, 9_000)
    data = passage.encode()
    ends = chunks.cuts(data, NUMBERS)
    parts = [data[a:b].decode() for a, b in zip([0, *ends], ends)]
    texts = [(i, part) for i, part in enumerate(parts)]
    texts += [(100, passage), (101, prose(rng, 30, 9_000) + passage), (200, "a short text"), (201, "a short text")]
    rows = chunks.chunks_query(documents(spark, texts)).collect()
    covered = {(r.doc_id, byte) for r in rows for byte in range(r.start, r.stop)}
    assert covered == {(i, byte) for i, a, b in slow_stretches(texts) for byte in range(a, b)}
    assert len(covered) == sum(r.stop - r.start for r in rows)
    assert sum(r.stop - r.start for r in rows if r.doc_id == 100) == len(data)
    assert {(r.doc_id, r.start, r.stop, r.kept) for r in rows if r.doc_id >= 200} == {(200, 0, 12, True), (201, 0, 12, False)}
    assert min(r.stop - r.start for r in rows if r.doc_id == 100) < chunks.SPAN
