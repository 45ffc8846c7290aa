import random
import zlib
from collections import Counter

import xxhash
from llm_brute import documents, hard_texts

from tickloom.llm import language

ENDINGS = {"en": ["the", "ing", "tion", "wh"], "de": ["sch", "ung", "keit", "ü"], "fr": ["eau", "que", "é", "ment"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choices(ENDINGS[lang], k=rng.randrange(1, 4))) for _ in range(words))


def corpus(spark, rng, count):
    langs = {i: rng.choice(list(ENDINGS)) for i in range(count)}
    texts = {i: text(rng, lang, rng.randrange(1, 80)) for i, lang in langs.items()}
    return documents(spark, texts, langs), langs


def test_held_out_documents_are_found(spark):
    docs, langs = corpus(spark, random.Random(31), 300)
    rows = language.language_query(docs.repartition(3)).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in langs}
    apart = [r for r in rows if r.held_out]
    assert len(apart) > 30 and sum(r.lang_pred == langs[r.doc_id] for r in apart) / len(apart) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_profiles_hold_the_most_frequent(spark):
    docs = documents(spark, {1: "ab ab ab", 2: "ba", 3: "zz", 4: None}, {1: "x", 2: "x", 3: None, 4: "y"})
    docs = docs.where("crc32(cast(string(doc_id) as binary)) % 5 != 0")
    learned = language.profiles(docs, 4)
    assert None not in learned and "y" not in learned
    words = {1: "ab ab ab", 2: "ba"}
    counts = Counter(g for i, t in words.items() if zlib.crc32(str(i).encode()) % 5 for w in t.split() for g in language.grams(w))
    assert learned["x"] == [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]]


def test_distance_is_out_of_place():
    """Two n-grams swapped, one missing."""
    ranker = language.Ranker({"x": ["a", "b", "_a"], "y": ["q"]}, 3)
    tops = ranker.top(["a a b"])
    names = {v: k for k, v in ranker.grams.items()}
    own = [names[i] for i in tops[0]]
    expected = sum(abs(i - ["a", "b", "_a"].index(g)) if g in ("a", "b", "_a") else 3 for i, g in enumerate(own))
    lang, score = ranker.predict(["a a b"])[0]
    assert lang == "x" and score == 1 - expected / 9


def test_nothing_to_go_by(spark):
    docs = documents(spark, hard_texts(random.Random(32)))
    rows = {r.doc_id: r for r in language.language_query(docs).collect() if r.doc_id is not None}
    for i in (1, 2, 3, 5):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert {rows[i].lang_pred for i in (4, 6, 7, 9, 11)} == {"en"}
    assert language.language_query(documents(spark, {})).count() == 0
    unknown = documents(spark, {1: "text"}, {1: None})
    assert language.language_query(unknown).first().lang_pred == "und"


def test_memory_does_not_change_a_prediction(monkeypatch):
    learned = {k: [g for w in v for g in language.grams(w)][:20] for k, v in ENDINGS.items()}
    rng = random.Random(33)
    texts = [text(rng, rng.choice(list(ENDINGS)), 30) for _ in range(40)]
    whole = language.Ranker(learned, 20).predict(texts)
    monkeypatch.setattr(language, "REMEMBERED", 5)
    ranker = language.Ranker(learned, 20)
    assert [ranker.predict([t])[0] for t in texts] == whole


def letters(text):
    """Runs of letters, one character at a time."""
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        else:
            words, word = (words + [word] if word else words), ""
    return words


def tally(words):
    counts = Counter()
    for word in words:
        framed = f"_{word}_"
        counts.update(framed[a:b] for a in range(len(framed)) for b in range(a + 1, min(a + 3, len(framed)) + 1))
    del counts["_"]
    return counts


def brute(rows):
    """The query over plain lists: profiles, ranks and distances by definition."""
    learned = {}
    for i, t, lang in rows:
        if lang is not None and (i is None or zlib.crc32(str(i).encode()) % 5):
            learned.setdefault(lang, Counter()).update(tally(letters(t)))
    tops = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:400]] for lang, c in learned.items() if c}
    found = []
    for i, t, _ in rows:
        own = sorted(tally(letters(t)).items(), key=lambda x: (-x[1], xxhash.xxh64_intdigest(x[0].encode())))[:400]
        far = {
            lang: sum(abs(n - top.index(g)) if g in top else 400 for n, (g, _) in enumerate(own))
            for lang, top in tops.items()
        }
        best = min(sorted(far), key=far.get) if own and far else "und"
        score = 1 - far[best] / (400 * len(own)) if own and far else 0.0
        found.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 0, best, round(score, 12)))
    return sorted(found, key=repr)


def test_query_is_what_brute_force_gives(spark):
    rng = random.Random(34)
    rows = []
    for i in range(120):
        lang = rng.choice(list(ENDINGS))
        rows.append((i, text(rng, lang, rng.randrange(1, 60)) + rng.choice(["", " 12½ x²y", "\nÄpfel Ⅷ!", "_a_"]), rng.choice([lang, lang, None])))
    rows += [(200 + i, t, None) for i, t in enumerate(["²", "½ ⅓", "Ⅷ Ⅻ", "١٢", "é", "你好", "", None, "a²"])] + [(None, "the thing", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = language.language_query(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 12)) for r in found), key=repr) == brute(rows)
    assert {r.lang_pred for r in found if r.doc_id in (200, 201, 202, 203)} == {"und"}
