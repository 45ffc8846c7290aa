from pyspark.sql import functions as F

from tickloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place string, last int, pair_id int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def rendered(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def brute(pairs):
    """pair -> (chosen turns, rejected turns) to what the operator returns."""
    found = {}
    for pair, (a, b) in pairs.items():
        n = 0
        while n < min(len(a), len(b)) - 1 and a[n] == b[n]:
            n += 1
        sides = []
        for turns in (a[n:], b[n:]):
            text, mask = "", []
            for role, said in turns:
                start = len(text) + len(f"<|im_start|>{role}\n")
                if role == "assistant":
                    mask.append((start, start + len(said) + len("<|im_end|>")))
                text += rendered(role, said)
            sides.append((text, mask))
        prompt = "".join(rendered(*t) for t in a[:n])
        found[pair] = (n, prompt, sides[0][0], sides[1][0], sides[0][1], sides[1][1])
    return found


PAIRS = {
    1: ([("user", "hi"), ("assistant", "yes é\U0001f389")], [("user", "hi"), ("assistant", "no")]),
    2: ([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], [("user", "a"), ("assistant", "b")]),
    3: ([("user", "same"), ("assistant", "same")], [("user", "same"), ("assistant", "same")]),
    4: ([("user", "x")], [("system", "x"), ("user", "x"), ("assistant", "")]),
    5: ([("assistant", "A"), ("assistant", "B"), ("tool", "C"), ("assistant", "D")], [("assistant", "A"), ("user", "B")]),
}


def test_longest_prefix_and_masks(spark):
    rows = [
        (pair, side == 0, n, role, said, 0)
        for pair, sides in PAIRS.items() for side, turns in enumerate(sides) for n, (role, said) in enumerate(turns)
    ]
    rows += [(6, True, 0, "user", "alone", 0), (None, True, 0, "user", "x", 0), (7, None, 0, "user", "x", 0)]
    frame = spark.createDataFrame(rows, "pair_id long, is_chosen boolean, turn int, role string, text string, _a int")
    found = {
        r.pair_id: (r.n_common, r.prompt, r.chosen, r.rejected, [tuple(m) for m in r.chosen_mask], [tuple(m) for m in r.rejected_mask])
        for r in chat.formatted(frame.repartition(3)).collect()
    }
    assert found == brute(PAIRS)
    for _, _, chosen, rejected, *masks in found.values():
        for text, mask in zip((chosen, rejected), masks):
            assert all(text[b - 10 : b] == "<|im_end|>" for _, b in mask)


def test_null_turns_and_repeated_rows(spark):
    rows = [(1, True, None, None, None), (1, True, 1, "user", "q"), (1, True, 1, "user", "q"), (1, False, None, "", ""), (1, False, 1, "user", "z")]
    frame = spark.createDataFrame(rows, "pair_id long, is_chosen boolean, turn int, role string, text string")
    row = chat.formatted(frame).first()
    assert (row.n_common, row.prompt) == (1, rendered("", ""))
    assert row.chosen == rendered("user", "q") * 2 and row.rejected == rendered("user", "z")


def test_rejections_take_the_next_answer(spark):
    rows = [
        (1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "more"),
        (2, 0, "user", "u2"), (2, 1, "assistant", "a2"), (2, 2, "user", "v2"), (2, 3, "assistant", "b2"),
        (3, 0, "user", "no answer"), (4, None, "assistant", None),
        (5_000, 0, "user", "far"), (5_000, 1, "assistant", "alone"), (None, 0, "assistant", "lost"),
    ]
    found = {r.pair_id: r for r in chat.chat_query(conversations(spark, rows)).collect()}
    assert set(found) == {1, 2, 4, 5_000}
    one = found[1]
    assert (one.n_common, one.prompt) == (1, rendered("user", "u1"))
    assert one.chosen == rendered("assistant", "a1") + rendered("user", "more")
    assert one.rejected == rendered("assistant", "b2") and one.rejected_mask == "22-34"
    assert found[2].n_common == 3 and found[2].rejected == rendered("assistant", "")
    assert found[4].rejected == rendered("assistant", "a1") and found[4].prompt == ""
    assert found[5_000].chosen == found[5_000].rejected == rendered("assistant", "alone")


def test_empty_table(spark):
    assert chat.chat_query(conversations(spark, [])).count() == 0


def test_one_conversation_repeated_many_times(spark):
    rows = [(i, n, r, t) for i in range(400) for n, (r, t) in enumerate([("user", "same"), ("assistant", "answer")])]
    found = chat.chat_query(conversations(spark, rows))
    assert found.count() == 400
    assert found.where(F.col("n_common") == 1).count() == 400
