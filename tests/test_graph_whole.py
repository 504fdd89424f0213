"""Labels that settle, and the graph of customers and suppliers."""

import pytest
from flowlab.operators import graph
from flowlab.plans import graphs
from flowlab.sources import files
from flowlab.sources.shared import shared_dir
from pyspark.sql import functions as F

from tests.test_queries import DATA, oracle, test_query_equals_sql as equals_sql  # noqa: F401


def test_labels_settle(spark):
    pairs = [(i, i + 1, 20 - i) for i in range(8)]
    e = spark.createDataFrame(pairs, "src bigint, dst bigint, weight bigint")
    label = {r["ip"]: r["community"] for r in graph.label_propagation(e, rounds=1).collect()}
    assert set(label) == set(range(9))
    for i in label:
        votes = {}
        for a, b, w in pairs:
            if i in (a, b):
                votes[label[a + b - i]] = votes.get(label[a + b - i], 0) + w
        assert label[i] == min(votes, key=lambda c: (-votes[c], c))


@pytest.mark.parametrize("name", ["graph_degrees_large", "graph_pagerank_large"])
def test_large_graph_equals_sql(spark, oracle, name):  # noqa: F811
    equals_sql(spark, oracle, name)


def modularity_of(spark, edges, parts):
    return graph.modularity(graph.undirected(edges), parts).first()["modularity"]


def test_communities_of_customers_and_suppliers(spark):
    """Communities cover every node, and are better than each node alone and than all together."""
    e = graphs.graph_build_edges_large(spark, str(DATA)).filter("src % 3 = 0").cache()
    parts = graph.communities(e, patience=2).cache()
    assert parts.count() == e.select("src").union(e.select("dst")).distinct().count()
    alone = modularity_of(spark, e, parts.select("ip", F.col("ip").cast("string").alias("community")))
    assert modularity_of(spark, e, parts) > max(alone, 0.0)


def test_iterative_jobs_leave_no_tables(spark):
    """And communities are no worse than settled labels."""
    pairs = [(i, (i * 7 + 1) % 30, 1 + i % 3) for i in range(30)] + [(i, i + 1, 9) for i in range(0, 28, 2)]
    e = spark.createDataFrame(pairs, "src bigint, dst bigint, weight bigint")
    folder = f"{shared_dir(spark)}/flowlab"
    before, found = set(files.names(spark, folder)), []
    for job in (graph.communities, graph.label_propagation):
        found.append(modularity_of(spark, e, job(e)))
        left = set(files.names(spark, folder)) - before
        assert len(left) == 1, left  # its result
        before |= left
    assert found[0] >= found[1]


def test_a_hub_does_not_make_its_neighbours_wait(spark, monkeypatch):
    """Rows of a graph of two sides settle in few rounds, as the side with fewer neighbours moves at once."""
    pairs = [(i, 1000 + (i * k * 7 + k) % 12, 1 + (i + k) % 5) for i in range(300) for k in range(6)]
    e = spark.createDataFrame(pairs, "src bigint, dst bigint, weight bigint")
    made, stage = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, name: made.append(name) or stage(df, name))
    parts = {r["ip"]: r["community"] for r in graph.label_propagation(e, rounds=0).collect()}
    assert made.count("wishes") <= 12
    for n in parts:
        votes = {}
        for a, b, w in pairs:
            if n in (a, b):
                votes[parts[a + b - n]] = votes.get(parts[a + b - n], 0) + w
        assert parts[n] == min(votes, key=lambda c: (-votes[c], c))


def test_graph_sink_reads_the_lines_once(spark, monkeypatch):
    from flowlab.plans import storage

    made, edges = [], graphs.edges
    monkeypatch.setattr(graphs, "edges", lambda *a: made.append(a) or edges(*a))
    assert storage.sink_graph_tables(spark, str(DATA)).count() > 0 and len(made) == 1
