"""Lines of few words: exact copies at every length, and near copies counted in characters."""

import random

from flowlab.llm import lines

from tests.llm.test_lines import SCHEMA, near


def removed(spark, rows):
    return {r["doc_id"]: list(r["removed"]) for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_copies_of_one_or_two_words_go(spark):
    rows = [(0, "Les.\nAnd ornd.\n\n他们在同一天离开了那座城市"), (1, "Les.\nand ornd."), (2, "And  ornd.\n他们在同一天离开了那座城市\n\n Les. ")]
    assert removed(spark, rows) == {0: [], 1: [0], 2: [0, 1, 3]}


def test_near_copies_of_few_words_go(spark):
    base = ["Licensed under the Apache License, Version 2.0.", "他们在同一天离开了那座城市，谁也没有再提起过去的那些事情。", "https://example.org/a/long/path/without/any/space"]
    rows = [(0, "\n".join(base)), (1, "Licensed under the Apache Licence, Version 2.0.\n" + base[1].replace("城", "村") + "\n" + base[2][:-1])]
    rows += [(2, "Licensed under the Apache Licences Version 2.0."), (3, "Licensed under the ApacheLicense, Version 2.0.\nChapter 1"), (4, "Chapter 2")]
    assert removed(spark, rows) == {0: [], 1: [0, 1, 2], 2: [0], 3: [0], 4: []}


def test_unit_and_bound_are_parameters(spark):
    rows = [(0, "one two three four five six seven eight nine\nnext line"), (1, "one two three four five six seven eight nones\nnexr line"), (2, "one two three four five six seven eight nine!")]
    df = spark.createDataFrame(rows, SCHEMA)
    by_word = {r["doc_id"]: list(r["removed"]) for r in lines.dedup_lines(df).collect()}
    by_character = {r["doc_id"]: list(r["removed"]) for r in lines.dedup_lines(df, near_words=10**6, near_characters=9).collect()}
    assert by_word == {0: [], 1: [0], 2: [0]} and by_character == {0: [], 1: [1], 2: [0]}


def test_text_keys(spark):
    rows = [("b", "one two\nx"), ("a", "one two"), (None, "x"), ("c", "one two")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: list(r["removed"]) for r in got} == {"b": [0, 1], "a": [], None: [], "c": [0]}


def test_random_short_lines_against_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefg    é城") for _ in range(rng.randint(20, 44))) for _ in range(12)]

    def line():
        s = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(s))
            s[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "y", " "])
        return "".join(s)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 6)))) for i in range(80)]
    seen, want, close = [], {}, 0
    for i, text in rows:
        want[i] = []
        for pos, words in enumerate(t.split() for t in text.split("\n")):
            flat, gone = " ".join(words), False
            for o in seen:
                other = " ".join(o)
                by_word = min(len(words), len(o)) >= lines.NEAR_WORDS and near(words, o)
                by_character = min(len(words), len(o)) < lines.NEAR_WORDS and min(len(flat), len(other)) >= lines.NEAR_CHARACTERS and near(flat, other)
                gone |= words == o or by_word or by_character
                close += by_character and words != o
            if words:
                want[i] += [pos] if gone else []
                seen.append(words)
    assert close > 20
    assert removed(spark, rows) == want
