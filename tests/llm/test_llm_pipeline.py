import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_brute import WORD, counts, documents, fingerprint, line_keepers, near_groups, prose
from test_llm_secrets import base
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tickloom.llm import chunks, lines, packing, quality, secret_scan, simhash
from tickloom.llm.sql import SQL

FOLDER = "/root/testdata/sf0.01"


def corpus(rng):
    texts = {i: "\n".join(prose(rng, 40, 100_000) for _ in range(3)) for i in range(60)}
    texts[60] = texts[5]  # a copy
    texts[61] = texts[6].replace("\n", "\nadded line of its own here\n", 1)
    texts[62] = "too short"
    texts[63] = " ".join(["again and again"] * 40)
    texts[64] = texts[7].split("\n")[0] + "\n" + prose(rng, 80, 100_000) + " token=abcdefgh12345678\n" + prose(rng, 60, 100_000)
    texts[65] = None
    return texts


def without_lines(texts):
    keepers = line_keepers(list(texts.items()))
    return {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if not WORD.search(x) or keepers[(i, n)] == (i, n))
        for i, t in texts.items()
    }


def test_stages_match_brute_force(spark, tmp_path):
    texts = corpus(random.Random(81))
    folder = str(tmp_path)
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()

    kept = {}
    for i, t in texts.items():
        words, _, _, _, repeated = counts(t)
        if words >= 50 and 100 * repeated <= 50 * words:
            kept[i] = t
    assert set(texts) - set(kept) == {62, 63, 65}
    kept = without_lines(kept)
    ids = list(kept)
    roots = near_groups([fingerprint(kept[i]) for i in ids], lambda a, b: (a ^ b).bit_count() <= 2)
    kept = {i: kept[i] for n, i in enumerate(ids) if roots[n] == n}
    for i, t in kept.items():
        at = 0
        parts = []
        for _, a, b in base(t):
            if a >= at:
                parts += [t[at:a], "[SECRET]"]
                at = b
        kept[i] = "".join([*parts, t[at:]])
    assert "[SECRET]" in kept[64]

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected = []
    for i, t in kept.items():
        x = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        expected += [(i, s, zlib.crc32(x[s : s + 2048].tobytes()), len(x)) for s in range(0, len(x), 2048)]
    assert sorted((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in rows) == sorted(expected)


def test_stages_keep_the_columns(spark):
    docs = documents(spark, corpus(random.Random(82)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes


def test_empty_documents_pass_through(spark, tmp_path):
    documents(spark, {}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = connection.execute(SQL[name])
    names = [c[0] for c in expected.description]
    frame = contract.queries()[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(names)
    found = frame.select(names).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())


def test_every_operator_is_registered():
    names = set(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and "pipeline" not in contract.oracle_sql()


def test_rows_of_one_id_are_documents_of_their_own(spark):
    """Null and repeated ids: what goes from one row, or is found in it, does not touch the others."""
    rng = random.Random(83)
    a, b, c, d = (prose(rng, 60, 100_000) for _ in range(4))
    for i in (None, 5):
        docs = documents(spark, [(i, f"{a}\n{b}"), (i, f"{c}\n{b}"), (i, f"{b}\n{d}")]).repartition(3)
        left = [r.text.split("\n") for r in lines.without_duplicates(docs).collect()]
        assert sorted(x for t in left for x in t if x) == sorted([a, b, c, d])
        kept = [r.text for r in simhash.keep_one(documents(spark, [(i, a), (i, b), (i, a), (9, c)])).collect()]
        assert sorted(kept) == sorted([a, b, c])
        spans = chunks.chunks_query(documents(spark, [(i, a), (i, f"{b}{c}"), (i, a + d), (i, f"{b}{c}{d}")])).collect()
        assert sum(not r.kept for r in spans) >= 2
        assert sum(r.stop - r.start for r in spans if not r.kept) > len(a) + len(b) + len(c) - 3 * chunks.MOST
        assert sum(r.kept for r in spans) >= 2


@pytest.mark.parametrize("stage", [lines.without_duplicates, simhash.keep_one, secret_scan.without_secrets])
def test_any_further_columns_pass_through(spark, stage):
    rng = random.Random(84)
    docs = documents(spark, [(i, prose(rng, 60, 100_000)) for i in range(4)])
    docs = docs.selectExpr("*", "1 AS _doc", "'d' AS _digest", "2 AS `a.b`", "3 AS _new", "4 AS `x y`", "5 AS root")
    found = stage(docs)
    assert found.columns == docs.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))


def test_further_columns_pass_the_quality_rules(spark):
    docs = documents(spark, [(1, prose(random.Random(85), 60, 100_000))]).selectExpr("*", "2 AS `a.b`", "3 AS n_words")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in quality.keep_good(docs, labels).collect()] == [tuple(r) for r in docs.collect()]
