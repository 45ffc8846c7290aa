import random

import numpy as np
import pytest
from llm_brute import documents, fingerprint, hard_texts, near_groups, prose

from tickloom.llm import simhash
from tickloom.llm.components import components


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


def test_fingerprints_and_groups_match_brute_force(spark):
    rng = random.Random(11)
    texts = hard_texts(rng)
    for i in range(12):
        base = prose(rng, 300, 10_000)
        texts += [(100 + 20 * i + j, edited(rng, base, j // 3)) for j in range(15)]
    rows = simhash.simhash_query(documents(spark, texts).repartition(3)).collect()
    texts = [(i, t) for i, t in texts if i is not None]
    marks = [fingerprint(t) for _, t in texts]
    found = {r.doc_id: r for r in rows}
    assert {i: f"{m:016x}" for (i, _), m in zip(texts, marks)} == {
        i: r.fingerprint for i, r in found.items() if i is not None
    }
    roots = near_groups(marks, lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for (i, _), root in zip(texts, roots):
        smallest[root] = min(smallest.get(root, i), i)
    assert {i: smallest[root] for (i, _), root in zip(texts, roots)} == {
        i: r.component_id for i, r in found.items() if i is not None
    }
    assert len(set(roots)) < len(texts) - 30


def test_portions_do_not_change_a_fingerprint(monkeypatch):
    text = prose(random.Random(12), 2_000, 500)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PORTION", 64)
    assert simhash.fingerprint(text) == whole == fingerprint(text)
    assert simhash.fingerprint("y" * 1_000 + " a") == fingerprint("y" * 1_000 + " a")


def test_anchors_cover_and_meet():
    """Anchors are code words within the covering radius; points two bits apart always meet at one."""
    rng = np.random.default_rng(3)
    points = rng.integers(0, 1 << 63, 500, np.uint64) << np.uint64(1)
    anchors = simhash.nearest_anchor(points)
    assert (np.bitwise_count(points ^ anchors) <= 9).all()
    assert (simhash.nearest_anchor(anchors) == anchors).all()
    for _ in range(300):
        a = rng.integers(0, 1 << 63, 1, np.uint64)
        b = a.copy()
        for bit in rng.integers(0, 64, 2):
            b ^= np.uint64(1 << int(bit))
        meet = [set(simhash.nearest_anchor(simhash.around(x, 1)).ravel().tolist()) for x in (a, b)]
        assert meet[0] & meet[1]


def test_links_reach_exactly_the_distance(spark):
    base = 0x123456789ABCDEF0
    marks = [base, base ^ 3, base ^ 0xF, base ^ (1 << 63) ^ (1 << 5), base ^ (7 << 20)]
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    frame = spark.createDataFrame([(m,) for m in signed], "fp long")
    pairs = {frozenset((r.a, r.b)) for r in simhash.links(frame).collect()}
    for pair in pairs:
        a, b = pair
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    groups = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    assert len({groups[signed[i]] for i in (0, 1, 2, 3)}) == 1 and signed[4] not in groups


def test_large_group_of_near_copies(spark):
    """One group of thousands: links stay near linear."""
    rng = random.Random(13)
    marks = {0}
    while len(marks) < 3000:
        marks.add(sum(1 << b for b in rng.sample(range(60), rng.randrange(0, 4))))
    frame = spark.createDataFrame([(m,) for m in marks], "fp long")
    pairs = simhash.links(frame)
    assert pairs.count() < 64 * len(marks)
    assert components(pairs).select("root").distinct().count() == 1


def test_keep_one_keeps_columns_and_one_of_each(spark):
    docs = documents(spark, [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "other words here"), (None, "x"), (4, None), (5, "")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["1", "2", "4", "None"]
    assert simhash.keep_one(documents(spark, {})).count() == 0
    assert simhash.simhash_query(documents(spark, {})).count() == 0


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


@pytest.mark.parametrize("links, expected", [
    ([], {}),
    ([(1, 1)], {}),
    ([(2, 1), (1, 2), (3, 2), (None, 9), (9, None)], {1: 1, 2: 1, 3: 1}),
    ([(i, i + 1) for i in range(100, 400)], {i: 100 for i in range(100, 401)}),
    ([(i, 10_000) for i in range(200)] + [(-5, -7)], {**{i: 0 for i in range(200)}, 10_000: 0, -5: -7, -7: -7}),
])
def test_components(spark, links, expected):
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in components(frame).collect()} == expected
