"""Queries on orders as a graph: nations of customers and suppliers (small, for algorithms), customers and suppliers (large)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import graph
from flowlab.plans.base import Book, table

book = Book()


def flows(spark, d):
    """Customer nation to supplier nation: attack where returned, protocol the order priority, category the line status."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("src"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("dst"))
    bought = o.join(c, F.col("o_custkey") == F.col("c_custkey"))  # before the lines, which would move once more
    rows = li.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    attack = (F.col("l_returnflag") == "R") & (F.col("src") % 4 == 0) & (F.col("dst") % 3 == 0)
    return rows.select("src", "dst", F.col("o_orderpriority").alias("proto"), F.col("l_extendedprice").alias("bytes"), attack.alias("attack"), F.col("l_linestatus").alias("cat"), "o_custkey", "l_suppkey")


FLOWS = """(SELECT CAST(c_nationkey AS BIGINT) AS src, CAST(s_nationkey AS BIGINT) AS dst, o_orderpriority AS proto, l_extendedprice AS bytes, l_returnflag = 'R' AND c_nationkey % 4 = 0 AND s_nationkey % 3 = 0 AS attack, l_linestatus AS cat, o_custkey, l_suppkey
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""
EDGES = f"(SELECT src, dst, count(*) AS weight, bool_or(attack) AS has_attack, round(sum(bytes), 2) AS total_bytes FROM {FLOWS} GROUP BY ALL)"
NODES = f"(SELECT ip, CAST(sum(w) AS BIGINT) AS total_flows, bool_or(a) AS is_attacker FROM (SELECT src AS ip, weight AS w, has_attack AS a FROM {EDGES} UNION ALL SELECT dst, weight, false FROM {EDGES}) GROUP BY 1)"
DEGREES = f"""(SELECT ip, sum(o) AS raw_out, sum(i) AS raw_in, round(sum(o) / greatest(count(*) OVER () - 1, 1), 9) AS out_c, round(sum(i) / greatest(count(*) OVER () - 1, 1), 9) AS in_c, round((sum(o) + sum(i)) / greatest(count(*) OVER () - 1, 1), 9) AS degree_c
 FROM (SELECT src AS ip, 1 AS o, 0 AS i FROM {EDGES} UNION ALL SELECT dst, 0, 1 FROM {EDGES}) GROUP BY 1)"""
RANKS = f"""(WITH RECURSIVE e AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS p FROM {EDGES}), n AS (SELECT DISTINCT ip FROM {NODES}), r AS (SELECT ip, 1.0::DOUBLE / (SELECT count(*) FROM n) AS r, 0 AS i FROM n
 UNION ALL SELECT n.ip, 0.15 / (SELECT count(*) FROM n) + 0.85 * coalesce(g.g, 0), g.i FROM n JOIN (SELECT dst, any_value(r.i) + 1 AS i, sum(r.r * e.p) AS g FROM r JOIN e ON e.src = r.ip GROUP BY dst) g ON g.dst = n.ip WHERE g.i <= 60) SELECT ip, arg_max(r, i) AS pagerank FROM r GROUP BY 1)"""
#: The communities used where SQL needs a given partition.
PARTS = f"(SELECT ip, 'c' || (ip % 5) AS community FROM {NODES})"
SCORED = f"(SELECT *, round(0.5 * round(pagerank, 6) + 0.3 * out_c + 0.2 * degree_c, 6) AS danger FROM {NODES} JOIN {DEGREES} USING (ip) JOIN {RANKS} USING (ip))"
STATS = f"""(SELECT community, size, attacker_count, coalesce(internal_edges, 0) AS internal_edges, coalesce(attack_edges, 0) AS attack_edges, coalesce(bytes, 0) AS bytes, attacker_count >= 1 AS is_malicious FROM
 (SELECT community, count(*) AS size, count(*) FILTER (is_attacker) AS attacker_count FROM {NODES} JOIN {PARTS} USING (ip) GROUP BY 1) LEFT JOIN
 (SELECT s.community, count(*) FILTER (s.community = t.community) AS internal_edges, count(*) FILTER (has_attack) AS attack_edges, round(sum(total_bytes), 2) AS bytes FROM {EDGES} JOIN {PARTS} s ON s.ip = src JOIN {PARTS} t ON t.ip = dst GROUP BY 1) USING (community))"""


def edges(spark, d):
    return graph.build_edges(flows(spark, d))


def nodes(spark, d):
    return graph.build_nodes(edges(spark, d))


def placed(n):
    """The communities of PARTS for a table of nodes."""
    return n.select("ip", F.concat(F.lit("c"), (F.col("ip") % 5).cast("string")).alias("community"))


def parts(spark, d):
    return placed(nodes(spark, d))


def scored(spark, d):
    ranks = graph.pagerank(edges(spark, d), tolerance=1e-12).withColumn("pagerank", F.round("pagerank", 6))
    return graph.with_danger(nodes(spark, d), graph.degrees(edges(spark, d)), ranks).withColumn("danger", F.round("danger", 6))


def stats(spark, d):
    return graph.community_stats(nodes(spark, d), edges(spark, d), parts(spark, d))


@book.add(f"""SELECT e.*, p.protos, coalesce(c.cats, '') AS attack_cats FROM {EDGES} e JOIN (SELECT src, dst, string_agg(proto || '=' || n, ',' ORDER BY proto) AS protos FROM (SELECT src, dst, proto, count(*) AS n FROM {FLOWS} GROUP BY ALL) GROUP BY ALL) p USING (src, dst)
 LEFT JOIN (SELECT src, dst, string_agg(DISTINCT cat, ',' ORDER BY cat) AS cats FROM {FLOWS} WHERE attack GROUP BY ALL) c USING (src, dst)""")
def graph_build_edges(spark, d):
    protos = F.array_join(F.transform(F.map_entries("proto_counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return edges(spark, d).withColumn("protos", protos).withColumn("attack_cats", F.array_join("attack_cats", ",")).drop("proto_counts")


@book.add(f"SELECT n.ip, total_flows, is_attacker, coalesce(cats, '') AS attack_cats FROM {NODES} n LEFT JOIN (SELECT src AS ip, string_agg(DISTINCT cat, ',' ORDER BY cat) AS cats FROM {FLOWS} WHERE attack GROUP BY 1) USING (ip)")
def graph_build_nodes(spark, d):
    return nodes(spark, d).withColumn("attack_cats", F.array_join("attack_cats", ","))


@book.add("SELECT src, dst, weight, round(total_bytes, 2) AS total_bytes FROM (SELECT o_custkey AS src, 1000000000 + l_suppkey AS dst, count(*) AS weight, sum(l_extendedprice) AS total_bytes FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)")
def graph_build_edges_large(spark, d):
    f = flows(spark, d).select(F.col("o_custkey").alias("src"), (F.col("l_suppkey") + 1_000_000_000).alias("dst"), "proto", "bytes", "attack", "cat")
    return graph.build_edges(f).select("src", "dst", "weight", "total_bytes")


LARGE = "(SELECT o_custkey AS src, 1000000000 + l_suppkey AS dst, count(*) AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"


@book.add(f"SELECT ip, CAST(raw_out AS BIGINT) AS raw_out, CAST(raw_in AS BIGINT) AS raw_in, out_c, in_c, degree_c FROM {DEGREES.replace(EDGES, LARGE)}")
def graph_degrees_large(spark, d):
    return graph.degrees(graph_build_edges_large(spark, d))


@book.add(f"""WITH e AS {LARGE}, n AS (SELECT src AS ip FROM e UNION SELECT dst FROM e), c AS (SELECT count(*) AS n, 1 / (count(*) + 0.85 * (SELECT count(DISTINCT src) FROM e)) AS f FROM n), g AS (SELECT dst, sum(weight / o) AS g FROM e JOIN (SELECT src, sum(weight) AS o FROM e GROUP BY 1) USING (src) GROUP BY 1)
 SELECT ip, round(c.f * (1 + 0.85 * coalesce(g, 0)), 9) AS pagerank FROM c, n LEFT JOIN g ON dst = ip""")
def graph_pagerank_large(spark, d):
    """The graph is bipartite, so SQL has the limit in closed form: customers have rank f, suppliers f * (1 + 0.85 * what they are given)."""
    return graph.pagerank(graph_build_edges_large(spark, d), tolerance=1e-15).withColumn("pagerank", F.round("pagerank", 9))


@book.add(f"SELECT ip, CAST(raw_out AS BIGINT) AS raw_out, CAST(raw_in AS BIGINT) AS raw_in, out_c, in_c, degree_c FROM {DEGREES}")
def graph_degrees(spark, d):
    return graph.degrees(edges(spark, d))


@book.add(f"SELECT ip, round(pagerank, 6) AS pagerank FROM {RANKS}")
def graph_pagerank(spark, d):
    return graph.pagerank(edges(spark, d), tolerance=1e-12).withColumn("pagerank", F.round("pagerank", 6))


@book.add(f"SELECT count(*) AS nodes, count(*) FILTER (is_attacker) AS attackers, (SELECT count(*) FROM {EDGES}) AS edges, (SELECT count(*) FILTER (has_attack) FROM {EDGES}) AS attack_edges, round((SELECT count(*) FROM {EDGES}) / count(*), 6) AS avg_out_degree FROM {NODES}")
def graph_summary(spark, d):
    return graph.summary(nodes(spark, d), edges(spark, d))


@book.add(f"""WITH u AS (SELECT x, y, CAST(sum(w) AS DOUBLE) AS w FROM (SELECT src AS x, dst AS y, weight AS w FROM {EDGES} UNION ALL SELECT dst, src, weight FROM {EDGES}) GROUP BY ALL), p AS (SELECT a.community AS c, sum(w) AS tot, sum(CASE WHEN a.community = b.community THEN w ELSE 0 END) AS inside FROM u JOIN {PARTS} a ON a.ip = x JOIN {PARTS} b ON b.ip = y GROUP BY 1)
 SELECT round(sum(inside / m2 - power(tot / m2, 2)), 6) AS modularity FROM p, (SELECT sum(tot) AS m2 FROM p)""")
def graph_modularity(spark, d):
    return graph.modularity(graph.undirected(edges(spark, d)), parts(spark, d))


@book.add()
def graph_communities(spark, d):
    """Of all customers and suppliers."""
    return graph.communities(graph_build_edges_large(spark, d))


@book.add()
def graph_label_propagation(spark, d):
    """Of all customers and suppliers."""
    return graph.label_propagation(graph_build_edges_large(spark, d))


@book.add(f"SELECT * FROM {STATS}")
def graph_community_stats(spark, d):
    return stats(spark, d).drop("attack_cats")


@book.add(f"SELECT src, dst, s.community AS src_community, t.community AS dst_community FROM {EDGES} JOIN {PARTS} s ON s.ip = src JOIN {PARTS} t ON t.ip = dst")
def join_graph_endpoints(spark, d):
    return graph.endpoint_communities(edges(spark, d), parts(spark, d)).select("src", "dst", "src_community", "dst_community")


@book.add(f"SELECT ip, danger FROM {SCORED}")
def graph_danger_score(spark, d):
    return scored(spark, d).select("ip", "danger")


@book.add(f"SELECT ip, danger, CAST(row_number() OVER (ORDER BY danger DESC, ip) AS INTEGER) AS rank FROM {SCORED} ORDER BY danger DESC, ip LIMIT 5")
def topn_danger_nodes(spark, d):
    return graph.top_danger(scored(spark, d), 5).select("ip", "danger", "rank")


@book.add(f"SELECT ip, round(pagerank, 6) AS pagerank FROM {SCORED} WHERE is_attacker")
def graph_flagged(spark, d):
    return graph.flagged(scored(spark, d)).select("ip", "pagerank")


@book.add(f"SELECT community FROM {STATS} WHERE is_malicious ORDER BY attacker_count DESC, attack_edges DESC, bytes DESC, internal_edges DESC, size DESC, community LIMIT 2")
def graph_rank_malicious(spark, d):
    return graph.rank_malicious(stats(spark, d), 2).select("community")


@book.add(f"""WITH w AS (SELECT community FROM {STATS} WHERE is_malicious ORDER BY attacker_count DESC, attack_edges DESC, bytes DESC, internal_edges DESC, size DESC, community LIMIT 2), a AS (SELECT ip FROM {NODES} WHERE is_attacker),
 v AS (SELECT ip FROM a UNION SELECT src FROM {EDGES} WHERE dst IN (SELECT ip FROM a) UNION SELECT dst FROM {EDGES} WHERE src IN (SELECT ip FROM a) UNION SELECT ip FROM {PARTS} WHERE community IN (SELECT community FROM w)) SELECT ip, is_attacker FROM {SCORED} JOIN v USING (ip) ORDER BY is_attacker DESC, danger DESC, ip LIMIT 12""")
def graph_view_threat(spark, d):
    return graph.view_threat(scored(spark, d), edges(spark, d), parts(spark, d), stats(spark, d), 12, 2).select("ip", "is_attacker")


@book.add(f"""WITH a AS (SELECT * FROM {EDGES} WHERE src % 2 = 0 AND dst % 2 = 0), f AS (SELECT src, dst FROM a WHERE has_attack ORDER BY weight DESC, src, dst LIMIT 12), x AS (SELECT a.*, CASE WHEN f.src IS NULL THEN 1 ELSE 0 END AS later FROM a LEFT JOIN f USING (src, dst)) SELECT src, dst, weight, has_attack FROM x ORDER BY later, weight DESC, src, dst LIMIT 20""")
def graph_view_edges(spark, d):
    return graph.view_edges(edges(spark, d), nodes(spark, d).filter("ip % 2 = 0").select("ip"), 20).select("src", "dst", "weight", "has_attack")


@book.add(f"SELECT ip FROM {SCORED} ORDER BY round(pagerank, 6) DESC, ip LIMIT 10")
def graph_view_full(spark, d):
    return graph.view_full(scored(spark, d), 10).select("ip")


@book.add(f"""WITH n AS (SELECT ip, sum(weight) AS weight, string_agg(DISTINCT role, '+' ORDER BY role) AS role FROM (SELECT dst AS ip, weight, 'target' AS role FROM {EDGES} WHERE src = 3 UNION ALL SELECT src, weight, 'source' FROM {EDGES} WHERE dst = 3) WHERE ip <> 3 GROUP BY 1)
 SELECT ip, total_flows AS weight, 'self' AS role, true AS found FROM {NODES} WHERE ip = 3 UNION ALL (SELECT ip, CAST(weight AS BIGINT), role, true FROM n ORDER BY weight DESC, ip LIMIT 6)""")
def graph_ego(spark, d):
    return graph.ego(edges(spark, d), nodes(spark, d), 3, 6)


@book.add(f"""WITH b AS (SELECT src AS ip, dst AS peer, weight, 'target' AS role FROM {EDGES} UNION ALL SELECT dst, src, weight, 'source' FROM {EDGES}) SELECT *, CAST(row_number() OVER (PARTITION BY ip ORDER BY weight DESC, peer, role) AS INTEGER) AS rank FROM b WHERE ip <> peer QUALIFY rank <= 8""")
def topn_neighbours(spark, d):
    return graph.top_neighbours(edges(spark, d))


@book.add(f"""WITH big AS (SELECT community FROM {PARTS} GROUP BY 1 HAVING count(*) >= 3), m AS (SELECT community FROM {STATS} WHERE is_malicious AND community IN (SELECT community FROM big)), t AS (SELECT ip, CASE WHEN community IN (SELECT community FROM m) AND NOT is_attacker THEN 'community:' || community ELSE CAST(ip AS VARCHAR) END AS t FROM {PARTS} JOIN {NODES} USING (ip))
 SELECT s.t AS src, d.t AS dst, CAST(sum(weight) AS BIGINT) AS weight, round(sum(total_bytes), 2) AS total_bytes, bool_or(has_attack) AS has_attack FROM {EDGES} JOIN t s ON s.ip = src JOIN t d ON d.ip = dst WHERE s.t <> d.t GROUP BY 1, 2""")
def graph_collapse_peers(spark, d):
    return graph.collapse_peers(edges(spark, d), nodes(spark, d), parts(spark, d), stats(spark, d).filter("is_malicious"), 3)


@book.add(f"""SELECT ip, CASE WHEN is_attacker THEN 'crit' WHEN is_malicious THEN 'warn' ELSE 'clean' END AS severity FROM {NODES} JOIN {PARTS} USING (ip) JOIN {STATS} USING (community)""")
def graph_severity_class(spark, d):
    return graph.severity_class(nodes(spark, d), parts(spark, d), stats(spark, d).filter("is_malicious")).select("ip", "severity")


@book.add(f"""SELECT ip, CASE WHEN is_attacker THEN 'crit' WHEN is_malicious THEN 'warn' ELSE 'clean' END AS severity, round(greatest(10.0, least(60.0, round(pagerank, 6) * 1000)), 6) AS size, danger, round(100 * percent_rank() OVER (ORDER BY danger), 6) AS danger_pct FROM {SCORED} JOIN {PARTS} USING (ip) JOIN {STATS} USING (community)""")
def graph_node_payload(spark, d):
    classes = graph.severity_class(nodes(spark, d), parts(spark, d), stats(spark, d).filter("is_malicious"))
    return graph.node_payload(scored(spark, d), classes)


@book.add(f"SELECT src, dst, weight, has_attack, greatest(1.0, least(5.0, weight / 10)) AS width FROM {EDGES} WHERE src <> dst")
def graph_edge_payload(spark, d):
    return graph.edge_payload(edges(spark, d))


@book.add(f"SELECT src, dst, weight FROM {EDGES} WHERE src = 7 OR dst = 7")
def graph_lookup(spark, d):
    ids = nodes(spark, d).filter("ip = 7").select("ip")
    return graph.edges_among(edges(spark, d), ids, any_end=True).select("src", "dst", "weight")


@book.add(f"SELECT community, 'C' || row_number() OVER (ORDER BY is_malicious DESC, attacker_count DESC, size DESC, community) AS name FROM {STATS}")
def graph_cluster_names(spark, d):
    return graph.cluster_names(stats(spark, d))
