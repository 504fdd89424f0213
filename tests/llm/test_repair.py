"""Conversation repair against a plain search over strings."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from flowlab.llm import queries, repair

sys.setrecursionlimit(20_000)
SPACES = " \t\n\v\f\r"
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
TO = {0: 2, 1: 2, 2: 3, 3: 2}


def hurt(rows):
    out = []
    for c, t, r, x in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if f:
            row = (c, t, "user" if f == 4 else r, "" if f == 1 else re.sub("[.!?]", "", x) if f == 2 else x)
            out += [row] * (2 if f == 3 else 1)
    return out


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, r, x in rows:
        body = x.strip(SPACES)
        faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((r, x))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))

    @lru_cache(None)
    def best(i, q, run):
        """(cost, audit) of the cheapest way on; run: insertions just made."""
        ways = []
        if i == len(rows) and q in (0, 3):
            ways.append((0, ""))
        if run < 3:
            c, a = best(i, TO[q], run + 1)
            ways.append((c + 3, "I" + a))
        if i < len(rows):
            c, a = best(i + 1, q, 0)
            ways.append((c + 4, "D" + a))
            if faults[i] not in ("blank", "duplicate"):
                more, initial = 3 * (faults[i] == "truncated"), rows[i][2][:1]
                if initial == "s" and q == 0 or initial == NEXT[q]:
                    c, a = best(i + 1, 1 if initial == "s" else TO[q], 0)
                    ways.append((c + more, "K" + a))
                c, a = best(i + 1, TO[q], 0)
                ways.append((c + more + 3, "R" + a))
        return min(ways) if ways else (1 << 60, "")

    cost, audit = best(0, 0, 0)
    q, kept, left = 0, [], list(rows)
    for e in audit:
        row = left.pop(0) if e != "I" else None
        if e == "D":
            continue
        role = row[2] if e == "K" else "user" if NEXT[q] == "u" else "assistant"
        kept.append((role, row[3] if row else ""))
        q = 1 if role[0] == "s" and e == "K" else TO[q]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def table(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Hello.", "Why?", "no end", "", " \n", "So!  ", "x" * 50 + ".", "ünd. ", "a", None, "Done.\n"]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            rows.append((c if c else None, rng.choice([t, t, t, None, rng.randint(0, 9)]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "ann"]), rng.choice(texts) if rng.random() < 0.5 else f"say {rng.random()}."))
    return rows


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def run(spark, tmp_path, df):
    df.withColumn("AUDIT", df["turn"]).write.parquet(f"{tmp_path}/conversations.parquet")
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.queries()["op12_conversation_repair"](spark, str(tmp_path)).collect()}


def test_against_plain_search(spark, frame, tmp_path):
    rows = table(1, 150, 9) + [(1000, t, "user", "x") for t in range(40) if zlib.crc32(f"1000:{t}".encode()) % 20 == 0]
    after = hurt(rows)
    got = run(spark, tmp_path, frame(rows))
    assert got == {c: plain([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert got[1000] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation_in_many_segments(spark, frame, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{rng.random()}" + rng.choice([".", "."])) for t in range(300)] + [(8, 0, "user", "a."), (8, 1, "assistant", "b.")] * 40
    monkeypatch.setattr(repair, "SEGMENT", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = run(spark, tmp_path, frame(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    after = hurt(rows)
    assert got == {c: plain([r for r in after if r[0] == c]) for c in (7, 8)}


def test_segments_join_like_one(monkeypatch):
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(2, 14))]
        cut = rng.randint(1, len(rows) - 1)
        parts = repair.joined(repair.segment(rows[:cut]), repair.segment(rows[cut:]))
        assert parts == repair.segment(rows)
        assert repair.closed(parts) == repair.closed(repair.segment(rows, (repair.START,)))


def test_rows_and_empty(spark, frame):
    rows = frame([(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (2, 0, "assistant", "Alone.")])
    planned = repair.plans(rows)
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in planned.collect()} == {1: (3, "KR"), 2: (3, "IK")}
    got = sorted((r["conv_id"], r["place"], r["edit"], r["turn"], r["role"], r["text"]) for r in repair.repaired(rows, planned).collect() if r["turn"] is not None)
    assert got == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "R", 1, "assistant", "Well."), (2, 1, "K", 0, "assistant", "Alone.")]
    none = frame([])
    assert repair.plans(none).count() == 0 and repair.digests(none, repair.plans(none)).count() == 0
