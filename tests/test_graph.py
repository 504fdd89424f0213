import random

import pytest
from flowlab.operators import graph
from pyspark.sql import functions as F


def cliques(spark):
    """Two groups of eight that are dense inside and joined by one edge."""
    rng = random.Random(1)
    pairs = [(a, b) for base in (0, 8) for a in range(base, base + 8) for b in range(base, base + 8) if a != b and rng.random() < 0.7] + [(0, 8)]
    return spark.createDataFrame([(a, b, 1, a == 0, 5.0, ["DoS"] if a == 0 else []) for a, b in pairs], "src bigint, dst bigint, weight bigint, has_attack boolean, total_bytes double, attack_cats array<string>")


def test_pagerank_against_power_iteration(spark):
    e = spark.createDataFrame([(1, 2, 3), (2, 3, 1), (3, 1, 1), (1, 3, 1), (3, 4, 2)], "src bigint, dst bigint, weight bigint")
    got = {r["ip"]: r["pagerank"] for r in graph.pagerank(e, tolerance=1e-10).collect()}
    w = {1: {2: 0.75, 3: 0.25}, 2: {3: 1.0}, 3: {1: 1 / 3, 4: 2 / 3}, 4: {}}
    r = dict.fromkeys(w, 0.25)
    for _ in range(200):
        loose = sum(r[i] for i in w if not w[i])
        r = {j: 0.15 / 4 + 0.85 * (loose / 4 + sum(r[i] * w[i].get(j, 0) for i in w)) for j in w}
    assert got == pytest.approx(r, abs=1e-6) and sum(got.values()) == pytest.approx(1)


def test_communities_find_the_cliques(spark):
    e = cliques(spark)
    parts = graph.communities(e)
    groups = {}
    for r in parts.collect():
        groups.setdefault(r["community"], set()).add(r["ip"])
    assert sorted(map(sorted, groups.values())) == [list(range(8)), list(range(8, 16))]
    both = graph.undirected(e)
    q = graph.modularity(both, parts).first()["modularity"]
    lp = graph.modularity(both, graph.label_propagation(e)).first()["modularity"]
    assert -0.5 <= lp <= q + 1e-9 <= 1


def test_stats_views_and_collapse(spark):
    e = cliques(spark)
    nodes, parts = graph.build_nodes(e), graph.communities(e)
    stats = graph.community_stats(nodes, e, parts)
    by_size = {r["attacker_count"]: r for r in stats.collect()}
    assert by_size[1]["is_malicious"] and by_size[1]["attack_cats"] == ["DoS"] and not by_size[0]["is_malicious"]
    classes = {r["ip"]: r["severity"] for r in graph.severity_class(nodes, parts, stats.filter("is_malicious")).collect()}
    assert classes[0] == "crit" and classes[1] == "warn" and classes[8] == "clean"
    small = graph.collapse_peers(e, nodes, parts, stats.filter("is_malicious"), 3)
    ends = {r["src"] for r in small.collect()} | {r["dst"] for r in small.collect()}
    assert "0" in ends and "1" not in ends and any(x.startswith("community:") for x in ends)
    assert small.filter("src = dst").isEmpty()
    assert graph.ego(e, nodes, 999, 5).first()["found"] is False
    assert graph.ego(e, nodes, 0, 3).count() == 4
    assert graph.neighbours(e, nodes.filter("ip = 8").select("ip")).filter("ip = 0").count() == 1
    top = graph.top_neighbours(e, 2).groupBy("ip").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert top == 2
