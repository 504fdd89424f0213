import random

from flowlab.llm import lines

SCHEMA = "doc_id bigint, text string"


def near(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) <= 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(rows):
    """rows: distinct (doc_id, th, text); the numbers of the lines that go."""
    seen, out = [], {}
    for doc_id, th, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        gone = []
        for pos, line in enumerate((text or "").split("\n")):
            w = line.split()
            if w:
                if any(w == s or (min(len(w), len(s)) >= lines.NEAR_WORDS and near(w, s)) for s in seen):
                    gone.append(pos)
                seen.append(w)
        out[(doc_id, text)] = gone
    return out


def check(spark, rows):
    got = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    hashed = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "xxhash64(text) AS th", "text").distinct().collect()
    want = brute([tuple(r) for r in hashed])
    assert len(got) == len(rows)
    originals = {(i, t): t for i, t in rows}
    for (i, t), gone in want.items():
        match = [r for r in got if r["doc_id"] == i and list(r["removed"]) == gone]
        assert match, (i, t, gone)
        kept = None if t is None else "\n".join(x for n, x in enumerate(originals[(i, t)].split("\n")) if n not in gone)
        assert any(r["text"] == kept for r in match)


def test_random_lines_against_brute_force(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 12))] for _ in range(12)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + ["x" + str(rng.randint(0, 3))] + w[i:], w[:i] + w[i + 1 :], w[:i] + ["y"] + w[i + 1 :]])
        return rng.choice([" ", "  ", "\t"]).join(w)

    check(spark, [(i, "\n".join(line() for _ in range(rng.randint(1, 6)))) for i in range(60)])


def test_edge_cases(spark):
    long = "\n".join(f"word{i} and some more words in line number {i * 7} of text {i * i}" for i in range(3000))
    check(spark, [(None, "one two three four"), (1, None), (2, ""), (3, "one two three four\n\n\na b"), (3, "one two three four\n\n\na b"), (4, long), (5, "one  two three four "), (6, "é two three\n é two three")])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lines.dedup_lines(empty).collect() == []
    df = spark.createDataFrame([(1, "a b c\na b c", 9, "x", 5)], "doc_id bigint, text string, removed int, a string, th int")
    got = lines.dedup_lines(df).collect()[0].asDict()
    assert got == {"doc_id": 1, "text": "a b c", "a": "x", "th": 5, "n_lines": 2, "removed": [1]}


def test_many_lines_that_differ_in_one_word(spark):
    """A large group that shares one variant: linear work, all but the earliest go."""
    rows = [(i, f"invoice number {i} total amount is due within thirty days") for i in range(500)]
    got = {r["doc_id"]: list(r["removed"]) for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: [] if i == 0 else [0] for i in range(500)}
