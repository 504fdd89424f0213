import random
import re

from flowlab.llm import secrets
from flowlab.llm.common import stage
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string"
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def brute(text):
    out = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        out += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


TEXTS = [
    None, "", "nothing here", "password = 'hunter22x' and Token: abc, secret: token: abcdef", "apikey=abcdef API_KEY=\"a-b/c+d=\"", "é𝄞 passwd:x1y2z3 AKIA" + "A1" * 8 + " 𝄞 " + "0af" * 9,
    "AKIAAKIA" + "Z" * 14, "deadbeef" * 3 + " " + "deadbeef" * 2 + "G" + "0" * 23, "secret=" + "a" * 30, ("token=abcdef12 " * 700 + "\n") * 2, "ſecret=abcdefg tokEn \t= nope",
]


def scanned(spark, rows, ledger=None, rules=secrets.RULES):
    docs = spark.createDataFrame(rows, SCHEMA)
    paths = stage(secrets.addressed(docs), "paths")
    return paths, stage(secrets.scan(docs, secrets.pending_blobs(paths, ledger, rules), rules), "ledger")


def test_base_findings_against_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[5])]
    docs, ledger = scanned(spark, rows)
    got = secrets.findings_by_path(docs, ledger).collect()
    base = tuple(PATTERNS)
    seen = sorted((repr(r["doc_id"]), ",".join(f"{f['kind']}:{f['start']}:{f['end']}" for f in r["findings"] if f["kind"] in base)) for r in got)
    assert seen == sorted((repr(i), brute(t)) for i, t in rows)


def test_only_unseen_pairs_are_scanned(spark):
    _, first = scanned(spark, [(1, "secret=abcdef1"), (2, "secret=abcdef1"), (3, "other")], rules=secrets.BASE)
    assert first.count() == 2
    docs, second = scanned(spark, [(1, "secret=abcdef1"), (9, "eyJ" + "a" * 10 + "." + "b" * 10 + "." + "c" * 10)], first)
    pending = {r["blob"]: set(r["scanned"]) for r in second.collect()}
    assert sorted(map(len, pending.values())) == [2, 5]  # the known blob meets only the new rule versions
    _, third = scanned(spark, [(1, "secret=abcdef1")], first.unionByName(second))
    assert third.count() == 0
    found = {r["doc_id"]: [f["kind"] for f in r["findings"]] for r in secrets.findings_by_path(docs, first.unionByName(second)).collect()}
    assert found == {1: ["assign"], 9: ["jwt"]}


def test_a_full_ledger_moves_only_new_texts(spark):
    """With all but one document known, one text passes to the exchange; beyond the bound of what is sent the result is the same."""
    old = [(i, f"secret=abcdef{i:04d}") for i in range(300)]
    _, first = scanned(spark, old)
    docs = spark.createDataFrame([*old, (1000, "token: fresh-one"), (1001, "token: fresh-one")], SCHEMA)
    paths = stage(secrets.addressed(docs), "paths")
    pending = secrets.pending_blobs(paths, first)
    wanted = pending.select(F.col("blob").alias("w_blob"))
    due = secrets._texts_due(docs, wanted, F.lit(True))
    assert sorted(r["text"] for r in due.collect()) == ["token: fresh-one"] * 2
    plan = due.groupBy("blob").agg(F.first("text"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("Exchange hashpartitioning(blob") < plan.index("BroadcastHashJoin")
    got = [(r["scanned"], r["findings"]) for r in secrets.scan(docs, pending).collect()]
    assert len(got) == 1 and [f["rule"] for f in got[0][1]] == ["assign:1"]
    sent, secrets.SENT = secrets.SENT, 0
    try:
        assert [(r["scanned"], r["findings"]) for r in secrets.scan(docs, pending).collect()] == got
    finally:
        secrets.SENT = sent


def test_hints_lose_no_match():
    """Every match that passes holds the hint of its rule."""
    rng = random.Random(3)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abc", "x1_", "AKIA", "Z9", "0af", "eyJ", ".", "-----BEGIN ", "PRIVATE KEY-----", "é"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(2, 24)))
        for r in secrets.RULES:
            if any(len(m[r.group]) >= r.least for m in re.finditer(r.pattern, text)):
                found += 1
                assert re.search(r.hint, text), (r, text)
    assert found > 1000


def test_versions_of_paths(spark):
    """Every historical version of a path is addressed; an old secret is found though the newest version is clean."""
    rows = [("a.txt", 1, "secret=abcdef1"), ("a.txt", 2, "gone"), ("b.txt", 1, "secret=abcdef1"), (None, 1, None)]
    versions = spark.createDataFrame(rows, "path string, version int, text string")
    paths = secrets.addressed(versions)
    ledger = secrets.scan(versions, secrets.pending_blobs(paths))
    got = {(r["path"], r["version"]): len(r["findings"]) for r in secrets.findings_by_path(paths, ledger).collect()}
    assert got == {("a.txt", 1): 1, ("a.txt", 2): 0, ("b.txt", 1): 1, (None, 1): 0}


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "secret=abcdef1", "x", 5, 6)], "doc_id bigint, text string, blob string, l_blob int, due int")
    paths = secrets.addressed(docs)
    row = secrets.findings_by_path(paths, secrets.scan(docs, secrets.pending_blobs(paths))).collect()[0]
    assert (row["l_blob"], row["due"], len(row["blob"]), len(row["findings"])) == (5, 6, 64, 1)
    paths, ledger = scanned(spark, [])
    assert secrets.findings_by_path(paths, ledger).collect() == []
