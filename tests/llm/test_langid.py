import random

import numpy as np
from flowlab.llm import langid

SYLLABLES = {"aa": ["the", "ing", "tion", "and"], "bb": ["sch", "ung", "ein", "zu"], "cc": ["que", "eau", "lle", "é"]}


def prose(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(rng, n):
    return [(i, prose(rng, lang), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def test_gradients_by_finite_differences():
    m = langid.train(["abc def" * 9, "xyz uvw" * 9], ["a", "b"], rounds=1, hidden=4)
    for n in ("input", "gate", "cand", "out", "bias"):
        setattr(m, n, getattr(m, n).astype(np.float64))
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 123, (4, 6)).astype(np.uint8), np.array([0, 1, 0, 1])

    def loss():
        p = langid._position_probabilities(m, langid._states(m, x).astype(np.float64))
        return -np.log(p[:, np.arange(4), y]).mean()

    for w, g in zip((m.input, m.gate, m.cand, m.out, m.bias), langid._gradients(m, x, y), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert abs(g[at] - (up - down) / 2e-2) < 1e-3 * max(1, abs(g[at]))


def plain(m, text):
    """Probabilities of every position of a stretch of bytes, by a plain loop in each direction, one byte at a time."""
    hidden, out = m.gate.shape[1], []
    for d, order in enumerate((text, text[::-1])):
        h, states = np.zeros(hidden), []
        for byte in order:
            given = m.input[byte + 256 * d].astype(float)
            f = 1 / (1 + np.exp(-(given[:hidden] + h @ m.gate[d])))
            h = h + f * (np.tanh(given[hidden:] + (f * h) @ m.cand[d]) - h)
            states.append(h)
        out.append(np.array(states))
    logits = out[0] @ m.out[:hidden] + out[1][::-1] @ m.out[hidden:] + m.bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def test_rows_against_plain_loops():
    """Each row equals a plain loop over its stretch of the text, and every position counts once."""
    rng = random.Random(1)
    m = langid.train([prose(rng, g) for g in SYLLABLES for _ in range(60)], [g for g in SYLLABLES for _ in range(60)])
    n, c = langid.STEPS, langid.CONTEXT
    texts = [b"", b"a", *(prose(rng, g, k).encode() for g in SYLLABLES for k in (1, 5, 30, 300)), b"x" * n]
    p, counts, runs = langid.pooled(m, texts)
    assert counts.sum(1).tolist() == [len(t) for t in texts]
    for i, t in enumerate(texts):
        rows = [plain(m, (b" " * c + t + b" " * (n + c))[s : s + n + 2 * c])[c : c + min(n, len(t) - s)] for s in range(0, len(t), n)]
        if len(t):
            every = np.concatenate(rows)
            labels = every.argmax(1)
            assert np.abs(p[i] - every.mean(0)).max() < 1e-4
            assert np.abs(counts[i] - np.bincount(labels, minlength=3)).max() <= 1 and abs(runs[i] - 1 - np.count_nonzero(np.diff(labels))) <= 2
        alone = langid.pooled(m, [t])
        assert np.allclose(alone[0][0], p[i]) and alone[2][0] == runs[i] == len(langid.position_labels(m, t.decode()))


def test_unlearned_scripts_and_letters_are_unfamiliar():
    rng = random.Random(3)
    m = langid.train([prose(rng, g) for g in SYLLABLES for _ in range(60)], [g for g in SYLLABLES for _ in range(60)], rounds=1)
    known = [prose(rng, g).encode() for g in SYLLABLES]
    other = ["привет как дела".encode(), "今天天气很好".encode(), b"xqzj vkpw zzx qwjrk"]
    assert langid.familiar(m, known).min() > 0.98 and langid.familiar(m, other).max() < 0.4 and langid.familiar(m, [b""]) == 0


def test_ties_and_clashing_names(spark):
    flat = langid.train(["ab " * 30, "cd " * 30], ["x", "b"], rounds=1)
    for w in (flat.input, flat.gate, flat.cand, flat.out, flat.bias):
        w[:] = 0
    df = spark.createDataFrame([(1, "abc", 5, 6, 7)], "doc_id bigint, text string, _p int, _known int, Score int")
    got = langid.identify(df, flat).collect()[0].asDict()
    assert got == {"doc_id": 1, "text": "abc", "_p": 5, "_known": 6, "lang_pred": "b", "score": 0.5, "margin": 0.0, "agreeing": 1.0, "n_runs": 1, "familiar": 2 / 3}


def test_held_out_accuracy_and_edge_cases(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame(corpus(rng, 300), "doc_id bigint, text string, lang string")
    m = langid.fit(docs)
    out = langid.identify(docs.withColumn("held", langid.held_out(docs["doc_id"])), m).filter("held").collect()
    assert len(out) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.95
    odd = [(1, None), (2, ""), (3, "12 34 !"), (4, prose(rng, "bb", 20_000)), (4, prose(rng, "bb")), (None, prose(rng, "cc"))]
    df = spark.createDataFrame([(i, t, "old", 3) for i, t in odd], "doc_id bigint, text string, lang_pred string, held int")
    got = langid.identify(df, m).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "bb", "bb", "cc"]
    assert all(0 <= r["score"] <= 1 for r in got) and [r["score"] for r in got][:3] == [0, 0, 0]
    assert langid.identify(df.limit(0), m).collect() == []
    assert {r["lang_pred"] for r in langid.identify(df, langid.fit(docs.limit(0))).collect()} == {"und"}
    runs = langid.position_labels(m, prose(rng, "aa", 40) + " " + prose(rng, "bb", 40))
    assert runs[0][0] == 0 and all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False)) and {runs[0][2], runs[-1][2]} == {"aa", "bb"}
