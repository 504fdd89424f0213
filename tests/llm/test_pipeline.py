"""run() against a plain version of the same five rules, and the behaviour of its stages."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from flowlab.llm import bpe, decontam, langid
from flowlab.llm.common import read_bytes

from tests.llm.test_decontam import distance
from tests.llm.test_jaccard import shingles
from tests.llm.test_langid import SYLLABLES, prose
from tests.llm.test_lines import brute as line_rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture(rng):
    rows, items = [], [(i, prose(rng, "aa", 30)) for i in range(3)]
    shared = prose(rng, "bb", 12)
    for i in range(60):
        lang = rng.choice(list(SYLLABLES))
        lines = [prose(rng, lang, rng.randint(20, 40)) for _ in range(4)]
        if i % 5 == 0:
            lines.insert(2, shared)
        if i % 9 == 0:
            lines.append(items[i % 3][1].upper() + ".")
        rows.append((i, "\n".join(lines), lang))
    for i in range(60, 75):  # near copies: one word in about a hundred replaced; every line differs in more than one
        words = rows[i - 50][1].split()
        words[5] = words[70] = "zz"
        rows.append((i, " ".join(words), rows[i - 50][2]))
    mixed = " ".join(a + " " + b for a, b in zip(prose(rng, "aa", 60).split(), prose(rng, "bb", 60).split(), strict=True))
    rows += [(90, prose(rng, "aa", 70), "bb"), (91, mixed, "aa"), (92, "Привет, как дела? Сегодня хорошая погода. " * 5, None), (93, "привет", None), (94, prose(rng, "cc", 40), None)]
    rows += [(95, "\n".join(prose(rng, "bb", 30) for _ in range(700)), "bb")]
    rows += [(80, None, "aa"), (81, "", "aa"), (82, "123 !!", "bb"), (83, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    return [(i, t, g, "s", len(t or "")) for i, t, g in rows], items


def reason(text, lang, model):
    if not text or not any(c.isalpha() for c in text):
        return "no letter"
    b = text.lower().encode()
    p = np.sort(langid.pooled(model, [b])[0][0])
    best = model.langs[int(langid.pooled(model, [b])[0][0].argmax())]
    if len(text) < corpus_pipeline.LONG:
        return None
    if langid.familiar(model, [b])[0] < corpus_pipeline.FAMILIAR:
        return "unlearned"
    if p[-1] - p[-2] < corpus_pipeline.MIXED:
        return "mixed"
    return "mislabelled" if lang in model.langs and best != lang and p[-1] - p[-2] >= corpus_pipeline.SURE else None


def plain(rows, hashes, items, model):
    kept = [r for r in rows if reason(r[1], r[2], model) is None]
    gone = line_rules({(r[0], hashes[r[1]], r[1]) for r in kept})
    texts = [(r[0], r[2], "\n".join(x for n, x in enumerate(r[1].split("\n")) if n not in gone[(r[0], r[1])])) for r in kept]
    out = []
    for i, lang, t in sorted(x for x in set(texts) if x[2].strip()):  # nothing is left of the others
        s = shingles(t)
        if not s or not any(len(s & o) >= 0.8 * len(s | o) for _, _, _, o in out):
            out.append((i, lang, t, s))
    norm = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    clean = [x for x in out if not any(distance(norm(b), norm(x[2])) <= decontam.budget(len(norm(b))) for _, b in items)]
    tree = bpe.TreeEncoder(read_bytes(public_tokenizers.path(bpe.VOCABULARY)))
    return sorted((i, lang, tree._base.encode_ordinary(t)) for i, lang, t, _ in clean)


def test_run_against_plain_rules(spark, tmp_path):
    rows, items = fixture(random.Random(8))
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    assert {reason(t, g, m) for m in [langid.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"))] for i, t, g, _, _ in rows if i in (90, 92)} == {"mislabelled", "unlearned"}
    model = langid.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    want = plain(rows, hashes, items, model)
    got = sorted((r["doc_id"], r["lang"], list(r["ids"])) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want
    assert 40 < len(got) < len(rows)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS and docs.collect() == []
    spark.createDataFrame([], SCHEMA + ", hits int").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert len(corpus_pipeline.STAGES) == 5
