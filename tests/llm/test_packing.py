"""Packing: pieces against the tokenizers library, places against the rules, the number of sequences against best fit and the least possible."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from flowlab.llm import packing, queries
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rules(tokenizer, docs):
    """(doc_id, piece, start, length, crc32) of every piece."""
    out = []
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        for p, end in enumerate(range(first, len(ids) + 1, 2048)):
            start = end - (2048 if p else first)
            out.append((i, p, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    return out


def sound(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query(spark, tokenizer, tmp_path):
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.choice([3, 50, 300, 700, 2000])))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "same"), (202, "same"), (None, "no key"), (203, "a<|endoftext|>b <|endoftext|>"), (204, "ünd ça\n\n  x٣" * 30_000), (205, "ab" * 90_000), (206, "hello " * 2047), (207, "hello " * 2046 + "x y")]
    spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id bigint, text string, LENGTH string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op13_best_fit_packing"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[c] for c in got.columns[:5]) for r in rows), key=key) == sorted(rules(tokenizer, docs), key=key)
    tokens = sum(r["length"] for r in rows)
    assert sound(rows) <= 1.02 * -(-tokens // 2048) + 1


def test_empty_and_ids(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.packed(packing.stage(packing.pieces(none))).collect() == []
    row = packing.pieces(spark.createDataFrame([("k", "hi there")], "name string, body string"), "name", "body", with_ids=True).first()
    assert (row["name"], row["ids"]) == ("k", [5303, 612, 0])


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(2049, np.int64)
    for v in rng.integers(1, 2049, 400) if seed % 2 else rng.integers(1, 700, 400):
        counts[v] += rng.integers(1, 50)
    alike = packing.plan(counts)
    placed = np.zeros(2049, np.int64)
    for a in alike:
        assert sum(a.lengths) + a.free == 2048 and a.free >= 0
        for v in a.lengths:
            placed[v] += a.count
    assert (placed == counts).all()
    plain = packing._best_fit([], {v: int(counts[v]) for v in range(1, 2049) if counts[v]}, 2048)
    assert sum(a.count for a in alike) <= 1.003 * sum(a.count for a in plain) + 1


def test_groups_have_equal_cardinality():
    counts = np.zeros(101, np.int64)
    counts[[90, 80, 70, 60]] = [5, 3, 4, 2]
    groups = packing.groups_of(counts, 50, 4)
    assert groups == [[(90, 4)], [(90, 1), (80, 3)], [(70, 4)], [(60, 2)]] or groups == [[(90, 5), (80, 3)], [(70, 4)], [(60, 2)]]


def test_configurations_beat_pairs_of_equals():
    # 60 and 40 fill a sequence of 100 together; alone each wastes 40 or 20
    chosen = packing.configurations([60, 40], [10, 10], 100)
    assert sum(n for n, _ in chosen) == 10 and all((c == 1).all() for _, c in chosen)
