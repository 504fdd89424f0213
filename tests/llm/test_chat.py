from flowlab.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def joined(spark, rows, **how):
    got = chat.rotate_perspectives(spark.createDataFrame(rows, SCHEMA), **how).collect()
    out = {}
    for r in sorted(got, key=lambda r: r["part"]):
        key = (r["conv_id"], r["perspective"])
        text, mask = out.get(key, ("", []))
        assert r["start_char"] == len(text)
        out[key] = (text + r["text"], mask + [tuple(m) for m in r["mask"]])
    return out


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé 𝄞"), (1, 3, "ann", "bye")]
    got = joined(spark, rows)
    assert set(got) == {(1, "ann"), (1, "bob")}
    text, mask = got[(1, "ann")]
    assert text == "<|system|>\nbe nice\n<|end|>\n<|assistant|>\nhi\n<|end|>\n<|user bob|>\nhé 𝄞\n<|end|>\n<|assistant|>\nbye\n<|end|>\n"
    assert [text[a:b] for a, b in mask] == ["hi", "bye"]
    text, mask = got[(1, "bob")]
    assert "<|user ann|>\nhi" in text and [text[a:b] for a, b in mask] == ["hé 𝄞"]


def test_long_conversation_in_parts(spark):
    rows = [(7, i, "ab"[i % 2], f"turn {i}") for i in range(1000)]
    got = joined(spark, rows, part_turns=64)
    for who in "ab":
        text, mask = got[(7, who)]
        assert [text[a:b] for a, b in mask] == [t for _, _, r, t in rows if r == who]
        assert text.count("<|end|>") == 1000


def test_nulls_ties_repeats_and_narrators_only(spark):
    rows = [(None, None, None, None), (None, 1, "", "x"), (2, 0, "a", "same"), (2, 0, "a", "same"), (2, 0, "b", ""), (3, 0, "system", "alone"), (4, 0, "a", "z" * 100_000)]
    got = joined(spark, rows)
    assert set(got) == {(None, "unknown"), (2, "a"), (2, "b"), (4, "a")}
    assert [b - a for a, b in got[(None, "unknown")][1]] == [0, 1]
    assert [b - a for a, b in got[(2, "a")][1]] == [4, 4]
    assert joined(spark, []) == {}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "a", "hi", 3, "q")], SCHEMA + ", perspective int, said string")
    assert [r["perspective"] for r in chat.rotate_perspectives(df).collect()] == ["a"]
