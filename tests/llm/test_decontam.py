import random

from flowlab.llm import decontam

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_myers_against_dynamic_programming():
    rng = random.Random(6)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 80))) for _ in range(2))
        d, end = decontam.best_match(p, t)
        assert d == distance(p, t)
        assert d == len(p) or distance(p, t[:end]) == d


def test_edited_items_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, 30)) for i in range(20)]
    rows = []
    for i in range(60):
        text, kind = prose(rng, 150), i % 3
        if kind:
            item = list(items[i % 20][1])
            for _ in range(0 if kind == 1 else decontam.budget(len(item)) - 4):
                item[rng.randrange(len(item))] = rng.choice("xyz")
            text += ".\n" + ("".join(item).upper() if kind == 1 else "".join(item)) + "! " + prose(rng, 50)
        rows.append((i, text))
    df, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontam.contaminations(df, bench).collect()}
    norm = {i: t for i, t in df.select("doc_id", decontam.normalised(df["text"])).collect()}
    want = {(i, j): d for i, t in norm.items() for j, b in items if (d := distance(b, t)) <= decontam.budget(len(b))}
    assert got == want and len(want) >= 40
    assert {r["doc_id"] for r in decontam.decontaminate(df, bench).collect()} == {i for i in range(60) if i % 3 == 0}


def test_short_items_are_found_as_whole_words(spark):
    bench = spark.createDataFrame([("a", "Ten chars!"), ("b", "x9"), ("c", "exactly twelve"), ("d", "ab cd ef gh ij kl mno")], "item_id string, text string")
    rows = [(1, "here: TEN  chars."), (2, "often chars"), (3, "ten charsx x9"), (4, "x9"), (5, "inexactly twelve"), (6, "x exactly, twelve\nx99"), (7, "ab cd ef gh ij kl mno"), (8, "ab cd ef gh ij kl mnop")]
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["end"]) for r in decontam.contaminations(spark.createDataFrame(rows, DOCS), bench).collect())
    assert got == [(1, "a", 0, 14), (3, "b", 0, 13), (4, "b", 0, 2), (6, "c", 0, 16), (7, "d", 0, 21)]


def test_a_benchmark_of_many_parts(spark, monkeypatch):
    """The plan does not grow with the number of parts."""
    rng = random.Random(8)
    items = [(i, prose(rng, 12)) for i in range(30)]
    rows = [(i, prose(rng, 20) + " " + items[i % 30][1] + " " + items[(i * 7) % 30][1]) for i in range(40)] + [(40, prose(rng, 30)), (3, None)]
    df, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, decontam.contaminations(df, bench).collect()))
    sizes = []
    for chars in (1200, 600):
        monkeypatch.setattr(decontam, "MOST_CHARS", chars)
        split = decontam.contaminations(df, bench)
        assert sorted(map(tuple, split.collect())) == whole and len(whole) >= 70
        sizes.append(split._jdf.queryExecution().optimizedPlan().toString().count("Python"))
    assert sizes == [0, 0]


def test_edge_cases(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog again and again"
    bench = spark.createDataFrame([(1, item), (1, item), (2, "too short"), (7, "no"), (8, "¡!"), (None, item), (3, None), (4, item + " and more words to follow it")], ITEMS)
    df = spark.createDataFrame([(1, item, 9), (1, item, 9), (None, "x " + item.upper(), 8), (2, None, 7), (3, "", 6), (4, "a" * 200_000, 5)], DOCS + ", hits int")
    got = sorted((repr(r["doc_id"]), r["item_id"], r["distance"]) for r in decontam.contaminations(df, bench).collect())
    assert got == [("1", 1, 0), ("1", 1, 0), ("None", 1, 0)]
    kept = decontam.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted(r["hits"] for r in kept.collect()) == [5, 6, 7]
    monkeypatch.setattr(decontam, "MOST_CHARS", 100)  # several passes over the benchmark
    assert sorted((repr(r["doc_id"]), r["item_id"], r["distance"]) for r in decontam.contaminations(df, bench).collect()) == got
    assert decontam.contaminations(df, bench.limit(0)).collect() == [] and decontam.contaminations(df.limit(0), bench).collect() == []
