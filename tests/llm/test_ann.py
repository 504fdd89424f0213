import numpy as np
from flowlab.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(rows, divisor, k):
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    out = {}
    for q in x:
        if q % divisor == 0:
            near = [(-(x[q] @ v) / (np.sqrt(x[q] @ x[q]) * np.sqrt(v @ v)), i) for i, v in x.items() if i != q]
            out[q] = sorted(near)[:k]
    return out


def found(spark, rows, **how):
    out = {}
    for r in sorted(ann.nearest(spark.createDataFrame(rows, SCHEMA), **how).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 16))
    rows = [(i, (centres[i % 30] + 0.6 * rng.standard_normal(16)).tolist()) for i in range(6000)]
    want, got = exact(rows, 50, 5), found(spark, rows)
    assert set(got) == set(want)
    hits = sum(len({i for _, i in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in got:
        scores = {i: -s for s, i in exact([*((i, v) for i, v in rows if i in {q, *(n for n, _ in got[q])})], 1, 5)[q]}
        assert all(abs(scores[i] - s) < 1e-12 for i, s in got[q])


def test_equal_vectors_and_unusable_ones(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 120)] + [(200, [3.0, 2.0, 1.0]), (250, None), (300, [0.0, 0.0, 0.0]), (350, [1.0, None, 2.0]), (400, [float("nan"), 1.0, 1.0]), (450, [1.0, 2.0]), (500, [float("inf"), 1.0, 1.0]), (None, same), (5, same)]
    got = found(spark, rows)
    assert set(got) == {0, 50, 100, 200}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4] == [i for i, _ in got[200]]
    assert all(abs(s - 1) < 1e-12 for _, s in got[0])


def test_few_candidates_and_empty(spark):
    assert {q: [i for i, _ in n] for q, n in found(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]).items()} == {0: [2, 1]}
    assert found(spark, []) == {}
    assert found(spark, [(0, [1.0, 0.0])]) == {}


def test_best_bin_first_reaches_every_leaf():
    rng = np.random.default_rng(5)
    tree = ann.fit_tree(rng.standard_normal((2000, 8)), 2000)
    assert tree.leaves > 50
    assert sorted(tree.order(rng.standard_normal(8), tree.leaves)) == list(range(tree.leaves))
    wide = tree.split({0: rng.standard_normal((3, 8)), 7: rng.standard_normal((4, 8))})
    assert wide.leaves == tree.leaves + 5
    assert sorted(wide.order(rng.standard_normal(8), wide.leaves)) == list(range(wide.leaves))
    assert set(wide.file(rng.standard_normal((5000, 8)))) <= set(range(wide.leaves))
    wide.sizes = np.ones(wide.leaves, int)
    assert len(wide.order(rng.standard_normal(8), 1, 9)) == 9


def test_components_of_any_size(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((40, 6))
    scale = [1e200, 1e-200, 1.0, 1e300, 5e-324 * 2**60]
    rows = [(i, (x[i] * scale[i % 5]).tolist()) for i in range(40)]
    df = spark.createDataFrame([(str(i), v) for i, v in rows] + [("no number", [1.0] * 6)], "vec_id string, embedding array<double>")
    got = ann.nearest(df, divisor=10, target=1.0)  # every row is a calibration query here
    plain = exact([(i, x[i].tolist()) for i in range(40)], 10, 5)
    for q in (0, 10, 20, 30):
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got.collect() if r["query_id"] == q)
        assert [i for _, i, _ in found] == [i for _, i in plain[q]] and all(abs(s + w) < 1e-6 for (_, _, s), (w, _) in zip(found, plain[q], strict=True))


def test_visits_follow_recall_over_all_rows(spark, monkeypatch):
    """Unstructured vectors, the worst case: recall is reached with under half of the rows scored; and a second fit where the
    first one's leaves hold many rows."""
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((4000, 48)))]
    want = exact(rows, 50, 5)
    shares, leaves, calibrate = [], [], ann.calibrate

    def noted(tree, *rest):
        leaves.append(tree.leaves)
        shares.append(calibrate(tree, *rest))

    monkeypatch.setattr(ann, "calibrate", noted)
    for sample, most in ((20_000, 512), (200, 16)):
        monkeypatch.setattr(ann, "SAMPLE", sample)
        monkeypatch.setattr(ann, "SPLIT_ROWS", most)
        got = found(spark, rows)
        assert all(len(n) == 5 for n in got.values())
        assert sum(len({i for _, i in want[q]} & {i for i, _ in got[q]}) for q in want) >= 0.9 * 5 * len(want)
    assert shares[0] < 0.5 and shares[1] < 0.7 and min(leaves) > 100
