import hashlib
import math
import random

import public_tokenizers
import pytest
from flowlab.llm import bpe, token_counts
from flowlab.llm.common import read_bytes

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tree():
    return bpe.TreeEncoder(read_bytes(public_tokenizers.path(bpe.VOCABULARY)))


def test_small_leaves_equal_the_whole(tree, monkeypatch):
    """With leaves of a few characters every kind of border is met."""
    for name, value in (("LEAF_CHARS", 7), ("LEAF_BYTES", 5), ("FIRST_CHARS", 2), ("FIRST_TOKENS", 1)):
        monkeypatch.setattr(bpe, name, value)
    rng = random.Random(1)
    letters = "ab cé's 12\n\t  !?.,日本 ab  \r\x1c\x85𝄞"
    for i in range(4000):
        text = "".join(rng.choice(letters if i % 3 else "abcdeintho") for _ in range(rng.randint(0, 120)))
        ids = tree.encode(text)
        assert ids == tree._base.encode_ordinary(text), repr(text)
        assert tree.decode(ids) == text.encode()


def test_long_texts(tree):
    rng = random.Random(2)
    words = " ".join("".join(rng.choice("abcdefgh'é1") for _ in range(rng.randint(1, 9))) for _ in range(20_000))
    assert bpe.LEAF_CHARS < 1000
    for text in (words, words[:1500], " " * 30_000 + "x", "日 本　" * 5_000, "ab" * 1500 + "\n" * 3000 + "<|endoftext|>"):
        assert tree.encode(text) == tree._base.encode_ordinary(text)
    # one piece of many thousand bytes: pairs of neighbouring tokens prove the joins
    for letters in ("abcdeintho", "abé日", "日本語字𝄞"):
        piece = "".join(rng.choice(letters) for _ in range(20_000))
        assert tree.encode(piece) == tree._base.encode_ordinary(piece)


def test_documents(spark, tree):
    rows = [(1, "Hello wörld"), (2, None), (3, ""), (1, "Hello wörld"), (None, "x" * 5000)]
    df = spark.createDataFrame([(i, t, "keep", 7, 8) for i, t in rows], SCHEMA + ", source string, ids int, _bpe int")
    got = bpe.encode_documents(df).collect()
    assert got[0].asDict().keys() == {"doc_id", "source", "_bpe", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}
    for r, (i, t) in zip(got, rows, strict=True):
        ids = tree._base.encode_ordinary(t or "")
        assert (r["doc_id"], r["n_tokens"], r["ids"]) == (i, len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_token_counts_against_brute_force(spark, tree):
    rng = random.Random(3)
    texts = ["word " * rng.choice([0, 1, 2, 3, 50, 1500]) + "x" * rng.randint(0, 3) for _ in range(60)] + [None, ""]
    lengths = sorted(len(tree._base.encode_ordinary(t or "")) for t in texts)
    sums = token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame(list(enumerate(texts)), SCHEMA)))
    for r in sums.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_over"] == sum(x > n for x in lengths) and r["tokens_over"] == sum(x for x in lengths if x > n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert lengths[r["rank_from"] - 1] == n == lengths[r["rank_to"] - 1]
    clash = spark.createDataFrame([(t, 3, 4) for t in texts], "text string, n_docs int, n_tokens string")
    got = {(r["kind"], r["at"]): r for r in token_counts.answers(token_counts.length_histogram(clash)).collect() if r["kind"] != "length"}
    for n in token_counts.LIMITS:
        r = got["limit", n]
        assert (r["n_docs"], r["docs_over"], r["tokens_over"], r["total_docs"], r["total_tokens"], r["truncated_total"]) == (lengths.count(n), sum(x > n for x in lengths), sum(x for x in lengths if x > n), len(lengths), sum(lengths), sum(min(x, n) for x in lengths))
    for q in token_counts.SHARES:
        r = got["quantile", q]
        assert r["n_tokens"] == lengths[max(1, math.ceil(q * len(lengths))) - 1] and r["n_docs"] == lengths.count(r["n_tokens"])
    assert token_counts.answers(token_counts.length_histogram(clash.limit(0))).collect() == []
    limits = [0, 1, 7, 100, 10_000]
    assert {r["context"]: r["truncated_total"] for r in token_counts.truncated_totals(sums, limits).collect()} == {c: sum(min(x, c) for x in lengths) for c in limits}
    assert {r["share"]: r["n_tokens"] for r in token_counts.quantiles(sums, [0.0, 0.5, 1.0]).collect()} == {0.0: lengths[0], 0.5: lengths[30], 1.0: lengths[-1]}
    assert token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame([], SCHEMA))).collect() == []
