"""The filter audit against plain rules that apply every order to every document."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest
from flowlab.llm import filter_audit, queries


def tables():
    rng = random.Random(8)
    docs = [(i, " ".join(f"w{rng.randint(0, rng.choice([40, 900]))}" for _ in range(rng.choice([5, 99, 100, 101, 400]))), rng.choice(["aa", "bb", None, ""])) for i in range(150)]
    docs += [(200, None, "aa"), (201, "", "aa"), (202, " \t\n ", "cc"), (203, "ÀÉ ABC", "aa"), (204, "a b c " * 60, "aa"), (205, "100 % sure", "dd"), (206, docs[3][1], docs[3][2])]
    docs += [(207, docs[3][1], "bb"), (208, "X" * 9 + "y" * 91, "bb"), (209, "X" * 11 + "y" * 89, "bb"), (205, "100 % sure", "dd"), (None, "100 % sure", "dd"), (210, " ".join(f"u{i}" for i in range(60_000)), "ee"), (211, "\va\fb\rc\x1cd\x00", "ee")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 212, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    return docs, labels


def plain(docs, labels):
    def fails(i, t):
        t = t or ""
        words = [w for w in re.split("[\x20\t-\r]+", t) if w]
        earlier = i is not None and any(j is not None and j < i and (x or "") == t for j, x, _ in docs)
        tests = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), earlier]
        return "".join(c for c, x in zip("ABCDE", tests, strict=True) if x)

    rows = [(p or "", fails(i, t), any(d == i and q == 1 for d, q, _ in labels if i is not None), any(d == i and x == 1 for d, _, x in labels if i is not None)) for i, t, p in docs]
    out, total = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for p in permutations("ABCDE"):
            left = own
            for step, c in enumerate(p, 1):
                removed = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                redundant = sum(c in r[1] for r in own) - len(removed)
                total[part, c] = total.get((part, c), 0) + len(removed)
                out[part, "".join(p), step] = (len(left), len(removed), redundant, sum(r[1] == c for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed))
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_rules(spark, tmp_path, monkeypatch, small):
    if small:  # many shards, lists and blocks
        for name, value in (("SHARD_WORDS", 300), ("LEAST_PARTS", 3), ("PARTS", 1), ("SHARD_BYTES", 3000)):
            monkeypatch.setattr(filter_audit, name, value)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    docs, labels = tables()
    spark.createDataFrame([(i, t, p, "x") for i, t, p in docs], "doc_id bigint, text string, lang string, PART string").repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    try:
        rows = queries.queries()["op11_filter_audit"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(got) and got == plain(docs, labels)
    with duckdb.connect() as db:
        for name in ("documents", "labels"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        said = db.sql(queries.oracle_sql()["op11_filter_audit"]).fetchall()
    assert {r[:3]: r[3:] for r in said} == got


def test_matrix(spark):
    texts = ["b a b", None, "", "c a", "b"]
    matrix, dictionary = filter_audit.document_term_matrix(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id int, text string, lang string").repartition(3))
    word = {r["word_id"]: r["word"] for r in dictionary.collect()}
    assert len(word) == 3 and min(word) >= 0 and sorted(word.values()) == ["a", "b", "c"]
    got = {}
    for r in matrix.collect():
        indptr, indices, data = np.frombuffer(r["indptr"], "<i8"), np.frombuffer(r["indices"], "<i8"), np.frombuffer(r["data"], "<i4")
        for d, a, b in zip(r["documents"], indptr, indptr[1:], strict=False):
            got[d["key"]] = {word[w]: n for w, n in zip(indices[a:b], data[a:b], strict=True)}
    assert got == {0: {"a": 1, "b": 2}, 1: {}, 2: {}, 3: {"a": 1, "c": 1}, 4: {"b": 1}}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert filter_audit.audit(filter_audit.failing(none), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect() == []
