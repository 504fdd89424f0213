import random
import re

from flowlab.llm import jaccard
from flowlab.llm.common import stage

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    return frozenset([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [[b for b in range(len(sets)) if a != b and sets[a][1] and len(sets[a][1] & sets[b][1]) >= 0.8 * len(sets[a][1] | sets[b][1])] for a in range(len(sets))]
    root = list(range(len(sets)))
    for _ in sets:
        root = [min([root[a], *(root[b] for b in links[a])], key=lambda r: (sets[r][0] is None, sets[r][0] or 0)) for a in range(len(sets))]
    return sorted((i, sets[root[a]][0], len(links[a]), len({sets[b][1] for b in links[a]} - {s})) for a, (i, s) in enumerate(sets))


def check(spark, rows):
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_link_texts"]) for r in got.collect()) == brute(rows)


def corpus(rng, n, words=40):
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(4)) for _ in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, words))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "  ", ", "]).join(w)))
    return rows


def test_random_texts_against_brute_force(spark):
    check(spark, corpus(random.Random(1), 160, 60))


def test_large_group_in_blocks(spark, monkeypatch):
    """One group of near copies, cut into several blocks: every link is found once."""
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 16)
    rng = random.Random(2)
    body = [f"w{rng.randint(0, 9999)}" for _ in range(400)]
    rows = []
    for i in range(90):
        w = list(body)
        w[rng.randrange(400)] = f"new{i}"
        rows.append((i, " ".join(w)))
    check(spark, rows)


def test_edge_cases(spark):
    same = "some words that occur twice in here"
    check(spark, [(1, same), (2, same.upper() + "!"), (3, None), (4, ""), (5, "?!"), (6, "one"), (7, "One."), (8, "one two"), (9, " ".join(f"x{i}" for i in range(30_000)))])
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(None, same, 1, "y"), (None, same, 2, "z")], "doc_id bigint, text string, label int, n_links string")
    assert sorted(map(tuple, jaccard.near_duplicates(clash).collect())) == [(None, 1, None, 1, 0, jaccard.sure_depth()), (None, 2, None, 1, 0, jaccard.sure_depth())]


def test_one_of_each(spark):
    same = "some words that occur twice in here"
    rows = [(2, same), (1, same), (1, same), (3, "other words entirely in this one here"), (4, ""), (5, None), (4, "")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, same), rows[3], rows[4], rows[5], rows[6]], key=repr)


def test_texts_of_one_of_each_are_signed_once(spark, monkeypatch):
    plans = {}

    def keep(df, label="stage"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(jaccard, "stage", keep)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, ""), (4, None)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(df).collect()) == [1, 3, 4]
    assert plans["named"].count("ArrowEvalPython") == 1


def test_prefix_is_shortened_for_each_set_until_the_recall_is_reached(spark):
    """Pairs of similarity 0.8 to 0.85: measured recall, at depths that differ between sets. A group of nearly equal texts stays at
    the longest prefix, sets with less similar neighbours go on to shorter ones, none below what the target needs at the threshold."""
    sure = jaccard.sure_depth()
    assert 1 - (1 - 0.8**sure) ** jaccard.TREES >= jaccard.TARGET_RECALL > 1 - (1 - 0.8 ** (sure + 1)) ** jaccard.TREES
    rng = random.Random(9)
    rows, body = [], [f"v{rng.randint(0, 99_999)}" for _ in range(300)]
    for i in range(40):  # one crowd
        w = list(body)
        w[rng.randrange(300)] = f"crowd{i}"
        rows.append((i, " ".join(w)))
    for i in range(300):  # pairs near the threshold: a few words replaced far from each other
        w = [f"u{rng.randint(0, 99_999)}" for _ in range(200)]
        other = list(w)
        for j in range(4):
            other[20 + 45 * j] = f"new{i}x{j}"
        rows += [(100 + 2 * i, " ".join(w)), (101 + 2 * i, " ".join(other))]
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: (c, n) for i, c, n, _ in brute(rows)}
    pairs = [i for i in range(100, 700) if want[i][1]]
    assert len(pairs) > 500
    assert sum(got[i]["n_links"] for i in pairs) >= 0.99 * len(pairs)
    assert min(got[i]["depth"] for i in range(40)) >= jaccard.DEEPEST - 1 and min(got[i]["depth"] for i in pairs) == sure
    assert len({r["depth"] for r in got.values()}) >= 4
    assert all((got[i]["class_id"], got[i]["n_links"]) == want[i] for i in range(40))


def test_text_keys(spark):
    same = "some words that occur twice in here"
    got = jaccard.near_duplicates(spark.createDataFrame([("b", same), ("a", same), (None, "x")], "doc_id string, text string"))
    assert sorted((r["doc_id"] or "", r["class_id"]) for r in got.collect()) == [("", None), ("a", "a"), ("b", "a")]
    assert [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame([("b", same), ("a", same)], "doc_id string, text string")).collect()] == [("a", same)]


def test_hot_sets_and_classes(spark, monkeypatch):
    """With every key hot, and with some, joins give the same rows."""
    from flowlab.llm import skew

    rows = corpus(random.Random(4), 80, 30)
    for hot in (1, 10**9):
        monkeypatch.setattr(skew, "HOT", hot)
        monkeypatch.setattr(skew, "LEAST", 1)
        check(spark, rows)
