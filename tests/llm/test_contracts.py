"""Every registered query of the training-data operators on small tables: required columns, and their values against plain rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from flowlab.llm import bpe, queries
from flowlab.llm.common import read_bytes

from tests.llm.test_ann import exact
from tests.llm.test_jaccard import brute as near_rules
from tests.llm.test_langid import SYLLABLES, prose
from tests.llm.test_lines import brute as line_rules
from tests.llm.test_secrets import PATTERNS, TEXTS
from tests.llm.test_secrets import brute as base_spans

ITEM = "the quick brown fox jumps over the lazy dog again and again"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, d = random.Random(12), str(tmp_path_factory.mktemp("tables"))
    docs = [(i, prose(rng, g, rng.randint(1, 60)), g) for i in range(80) for g in [rng.choice(list(SYLLABLES))]]
    docs += [(100 + i, t, None) for i, t in enumerate(TEXTS)] + [(200, "1 2 3", "aa"), (201, docs[0][1] + "\n" + docs[1][1], "aa"), (202, docs[3][1], docs[3][2]), (203, "x " + ITEM.upper() + " y", "bb"), (204, "", "cc")]
    vectors = [(i, np.random.default_rng(i).standard_normal(12).tolist()) for i in range(260)] + [(260, None), (300, [0.0] * 12), (350, [1.0] * 11 + [float("nan")])]
    urls = ["http://A.example.COM/en/7?q", "https://example.com/en/8", "http://x.net/de/1", "http://example.net/de/88#f", "ftp://org/es/", "http://com/en", "example.com/en/", None, "://com/en/", "http://notcom/en/"]
    conv = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "ann", None), (2, 0, "bob", "alone")]
    for name, rows, schema in (
        ("documents", [(i, t, g, "s", len(t or "")) for i, t, g in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("embeddings", vectors, "vec_id bigint, embedding array<double>"),
        ("pages", list(enumerate(urls)), "page_id bigint, url string"), ("benchmark", [(1, ITEM), (2, "no such item")], "item_id bigint, text string"), ("conversations", conv, "conv_id bigint, turn int, role string, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d, docs, vectors, urls


def rows_of(spark, name, d):
    return queries.queries()[name](spark, d).collect()


def test_op1(spark, tables):
    d, docs, _, _ = tables
    got = {r["doc_id"]: r for r in rows_of(spark, "op1_language_id", d)}
    assert got.keys() == {i for i, _, _ in docs}
    for i, t, _ in docs:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in ({"aa", "bb", "cc"} if t and any(c.isalpha() for c in t) else {"und"})
    assert np.mean([got[i]["lang_pred"] == g for i, t, g in docs[:80]]) > 0.9


def test_op3(spark, tables):
    d, docs, _, _ = tables
    got = {r["doc_id"]: r for r in rows_of(spark, "op3_secret_scans", d)}
    for i, t, _ in docs:
        want, r = base_spans(t), got[i]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k + ":") for s in want.split(",")) for k in PATTERNS]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in PATTERNS] == [s for s in want.split(",") if s]


def test_op5(spark, tables):
    d, _, _, urls = tables
    for r in rows_of(spark, "op5_url_filters", d):
        url, host, path = urls[r["page_id"]], "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == (max(fits)[1:] if fits else (None, "allow"))


def test_op6_and_op7(spark, tables):
    d, docs, _, _ = tables
    tree = bpe.TreeEncoder(read_bytes(public_tokenizers.path(bpe.VOCABULARY)))
    lengths = []
    got = {r["doc_id"]: r for r in rows_of(spark, "op6_byte_level_bpe", d)}
    for i, t, _ in docs:
        ids = tree._base.encode_ordinary(t or "")
        lengths.append(len(ids))
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    counts = {r["n_tokens"]: r["n_docs"] for r in rows_of(spark, "op7_token_counts", d) if r["kind"] == "length"}
    assert counts == {n: lengths.count(n) for n in lengths}


def test_op9(spark, tables):
    d, _, vectors, _ = tables
    fine = [(i, v) for i, v in vectors if v and any(v) and all(np.isfinite(v))]
    want, got = {}, {}
    for q, near in exact([(i, v) for i, v in fine], 50, 5).items():
        want[q] = [i for _, i in near]
    for r in sorted(rows_of(spark, "op9_nearest_neighbours", d), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_op4_op8_op10_op2(spark, tables):
    d, docs, _, _ = tables
    got = sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_link_texts"]) for r in rows_of(spark, "op4_ngram_jaccard_join", d))
    assert got == near_rules([(i, t) for i, t, _ in docs])
    gone = line_rules([(i, 0, t) for i, t, _ in docs])
    lines = {r["doc_id"]: r for r in rows_of(spark, "op8_line_dedup", d)}
    assert {i for i in lines if lines[i]["removed"]} >= {i for (i, t), n in gone.items() if n} and lines[202]["removed"] == "0" and lines[201]["removed"] == "0,1"
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in rows_of(spark, "op10_decontamination", d)] == [(203, 1, 0)]
    chats = rows_of(spark, "op2_chat_formatting", d)
    assert {(r["conv_id"], r["perspective"]) for r in chats} == {(1, "ann"), (1, "bob"), (2, "bob")}
