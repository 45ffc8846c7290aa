import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_brute import documents, hard_texts, prose
from tokenizers import Tokenizer

from tickloom.llm import packing


WHOLE = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
CACHED = packing.TokenIds(public_tokenizers.path(packing.TOKENIZER))


@pytest.fixture(scope="module")
def tokenizer():
    return WHOLE


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n\t.,'sé́ΣSTİǅ<|>"), max_size=90), max_size=3))
def test_words_give_the_ids_of_whole_texts(texts):
    ours = CACHED(texts)
    assert [x.tolist() for x in ours] == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgotten_and_long_words_change_nothing(tokenizer, monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, 50) + " " + "ab" * rng.randrange(20, 60) + " end" for _ in range(20)]
    monkeypatch.setattr("tickloom.llm.wordcache.REMEMBERED", 30)
    ours = packing.TokenIds(public_tokenizers.path(packing.TOKENIZER))
    for text in texts:
        assert ours([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_sequences(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(places) == list(range(len(places)))
    return sum(r.length for r in rows) / (capacity * max(1, len(places)))


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rng = random.Random(8)
    texts = hard_texts(rng) + [(100 + i, prose(rng, rng.randrange(1, 900))) for i in range(200)]
    rows = packing.pack_documents(documents(spark, texts).repartition(5)).collect()
    fill = check_sequences(rows, 2048)
    assert fill > 0.97
    ids = defaultdict(list)
    for i, text in texts:
        ids[i].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    for i, found in ids.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        expected = [
            (s, min(2048, len(x) - s), zlib.crc32(x[s : s + 2048].tobytes()), len(x))
            for x in found for s in range(0, len(x), 2048)
        ]
        assert sorted(expected) == [(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in own]


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, {})).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_runs_place_every_rank_once(histogram):
    runs = packing.pack_histogram(histogram, 64)
    held = defaultdict(int)
    seen = defaultdict(list)
    for length, rank, count, first, offset in runs:
        seen[length].append((rank, count))
        for k in range(first, first + count):
            assert held[k] == offset
            held[k] += length
            assert held[k] <= 64
    for length, spans in seen.items():
        at = 0
        for rank, count in sorted(spans):
            assert rank == at
            at += count
        assert at == histogram[length]
    assert set(seen) == set(histogram)


def test_a_million_pieces_are_a_short_plan():
    rng = random.Random(9)
    runs = packing.pack_histogram({n: rng.randrange(1, 10**6) for n in range(1, 2049)})
    assert len(runs) < 50_000
