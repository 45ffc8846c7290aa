import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import hamming

SCHEMA = "vec_id long, embedding array<float>, label int, code string, other int, distance int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, top, every):
    usable = [(i, np.array([x is not None and x > 0 for x in v])) for i, v in rows if i is not None and v is not None and len(v) == 64]
    found = []
    for q, a in usable:
        if q % every == 0:
            near = sorted(((int((a != b).sum()), i) for i, b in usable))[:top]
            found += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(found)


def clustered(rng, count, spread):
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for i in range(count)]


@pytest.mark.parametrize("spread, top, every", [(0.2, 10, 10), (30.0, 7, 25)])
def test_same_as_a_full_scan(spark, spread, top, every):
    rows = clustered(random.Random(71), 220, spread)
    found = hamming.top_k(vectors(spark, rows), top, every).collect()
    assert sorted(map(tuple, found)) == brute(rows, top, every)


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(72)
    hot = [rng.gauss(0, 1) for _ in range(64)]
    rows = [(i, hot) for i in range(0, 120)] + [(200 + i, [-x for x in hot]) for i in range(3)]
    rows += [(None, hot), (500, None), (550, [1.0]), (600, [None, *hot[1:]]), (650, []), (700, [0.0] * 64), (-50, hot)]
    found = hamming.top_k(vectors(spark, rows), 10, 50).collect()
    assert sorted(map(tuple, found)) == brute(rows, 10, 50)


def test_fewer_rows_than_asked_for(spark):
    rng = random.Random(73)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in (0, 50, 3)]
    found = hamming.top_k(vectors(spark, rows)).collect()
    assert sorted(map(tuple, found)) == brute(rows, 10, 50) and len(found) == 6


def test_empty_table_and_no_query(spark):
    assert hamming.top_k(vectors(spark, [])).count() == 0
    assert hamming.top_k(vectors(spark, [(1, [1.0] * 64)])).count() == 0


def test_code_bits(spark):
    row = vectors(spark, [(1, [1.0] + [-1.0] * 62 + [2.0])]).select(hamming.sign_code(F.col("embedding")).alias("c"))
    assert row.first().c == 1 - (1 << 63)
