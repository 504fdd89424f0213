"""Directed weighted graphs of flows as node and edge tables."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.sources.shared import stage, unstage


def build_edges(flows: DataFrame) -> DataFrame:
    """flows(src, dst, proto, bytes, attack, cat) to one row per (src, dst): weight, proto_counts, attack_cats, has_attack,
    total_bytes. Flows are counted per protocol and category first, so a busy pair meets as a few rows."""
    by = flows.groupBy("src", "dst", "proto", F.when(F.col("attack"), F.col("cat")).alias("cat")).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"), F.max("attack").alias("a"))
    by_proto = by.groupBy("src", "dst", "proto").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("a").alias("a"), F.collect_set("cat").alias("cats"))
    return by_proto.groupBy("src", "dst").agg(
        F.sum("n").alias("weight"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("proto", "n")))).alias("proto_counts"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("cats")))).alias("attack_cats"), F.max("a").alias("has_attack"), F.round(F.sum("b"), 2).alias("total_bytes"),
    )


def build_nodes(edges: DataFrame) -> DataFrame:
    """(ip, total_flows, is_attacker, attack_cats): flows at either end; an attacker is the source of an attack."""
    ends = edges.select(F.col("src").alias("ip"), "weight", F.col("has_attack").alias("a"), "attack_cats").unionByName(
        edges.select(F.col("dst").alias("ip"), "weight", F.lit(False).alias("a"), F.array().cast("array<string>").alias("attack_cats"))
    )
    cats = ends.select("ip", F.explode("attack_cats").alias("c")).groupBy("ip").agg(F.sort_array(F.collect_set("c")).alias("attack_cats"))
    base = ends.groupBy("ip").agg(F.sum("weight").alias("total_flows"), F.max("a").alias("is_attacker"))
    return base.join(cats, "ip", "left").withColumn("attack_cats", F.coalesce("attack_cats", F.array().cast("array<string>")))


def degrees(edges: DataFrame) -> DataFrame:
    """Raw degrees over distinct edges and centralities (divided by n - 1)."""
    ends = edges.select(F.col("src").alias("ip"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("ip"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    raw = ends.groupBy("ip").agg(F.sum("o").alias("raw_out"), F.sum("i").alias("raw_in"))
    total = raw.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(1)).alias("_n"))
    n = F.col("_n")
    return raw.join(F.broadcast(total), how="cross").select("ip", "raw_out", "raw_in", F.round(F.col("raw_out") / n, 9).alias("out_c"), F.round(F.col("raw_in") / n, 9).alias("in_c"), F.round((F.col("raw_out") + F.col("raw_in")) / n, 9).alias("degree_c"))


def pagerank(edges: DataFrame, alpha: float = 0.85, rounds: int = 200, tolerance: float = 1e-6) -> DataFrame:
    """(ip, pagerank): weighted, the mass of nodes without out-edges spread evenly, until the L1 change is under n * tolerance.
    A round is one join and one aggregation whose ranks are written; one more aggregation over them gives the change and the mass without
    out-edges. Raises if `rounds` rounds are not enough."""
    weights = edges.groupBy("src", "dst").agg(F.sum("weight").cast("double").alias("w"))
    share = weights.join(weights.groupBy("src").agg(F.sum("w").alias("all")), "src").select("src", "dst", (F.col("w") / F.col("all")).alias("p"))
    share = stage(share, "transitions")
    nodes = share.select(F.col("src").alias("ip")).union(share.select("dst")).distinct()
    sources = share.select(F.col("src").alias("ip")).distinct().withColumn("has_out", F.lit(True))
    n = nodes.count()
    if not n:
        return nodes.withColumn("pagerank", F.lit(0.0))
    ranks = stage(nodes.join(sources, "ip", "left").select("ip", F.coalesce("has_out", F.lit(False)).alias("has_out"), F.lit(1.0 / n).alias("r")), "ranks")
    lost = ranks.agg(F.coalesce(F.sum(F.when(~F.col("has_out"), F.col("r"))), F.lit(0.0))).first()[0]
    for _ in range(rounds):
        given = ranks.select("ip", "r").join(share, F.col("ip") == F.col("src")).groupBy("dst").agg(F.sum(F.col("r") * F.col("p")).alias("g"))
        met = ranks.select("ip", "has_out", F.col("r").alias("old")).join(given, F.col("ip") == F.col("dst"), "left")
        last, ranks = ranks, stage(met.select("ip", "has_out", "old", (F.lit((1 - alpha) / n + alpha * lost / n) + alpha * F.coalesce("g", F.lit(0.0))).alias("r")), "ranks")
        unstage(last)
        row = ranks.agg(F.sum(F.abs(F.col("r") - F.col("old"))).alias("change"), F.coalesce(F.sum(F.when(~F.col("has_out"), F.col("r"))), F.lit(0.0)).alias("lost")).first()
        lost = row["lost"]
        if row["change"] < n * tolerance:
            return ranks.select("ip", F.col("r").alias("pagerank"))
    raise ValueError(f"ranks still change by more than {tolerance} a node after {rounds} rounds")


def undirected(edges: DataFrame) -> DataFrame:
    """(x, y, w) in both directions, weights of both directions summed; self-loops count twice, as in modularity."""
    both = edges.select(F.col("src").alias("x"), F.col("dst").alias("y"), F.col("weight").cast("double").alias("w")).unionByName(edges.select(F.col("dst").alias("x"), F.col("src").alias("y"), F.col("weight").cast("double").alias("w")))
    return both.groupBy("x", "y").agg(F.sum("w").alias("w"))


def modularity(both: DataFrame, parts: DataFrame) -> DataFrame:
    """One row: Q of a partition parts(ip, community)."""
    a = parts.select(F.col("ip").alias("x"), F.col("community").alias("cx"))
    b = parts.select(F.col("ip").alias("y"), F.col("community").alias("cy"))
    per = both.join(a, "x").join(b, "y").groupBy(F.col("cx").alias("c")).agg(F.sum("w").alias("tot"), F.sum(F.when(F.col("cx") == F.col("cy"), F.col("w")).otherwise(0.0)).alias("inside"))
    all_ = per.agg(F.sum("tot").alias("m2"))
    return per.join(F.broadcast(all_), how="cross").agg(F.round(F.sum(F.col("inside") / F.col("m2") - (F.col("tot") / F.col("m2")) ** 2), 6).alias("modularity"))


def label_propagation(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(ip, community): until no node has another label with more weight around it, ties to the smaller. In the first
    `rounds` rounds half of the nodes move at once. After them only nodes that come before all neighbours that want to move
    (those with fewer neighbours first, so that few wait for a node that many meet, then by a hash that changes): no two neighbours
    move together, so the weight inside labels grows, or labels get smaller at equal weight, and it ends."""
    both = stage(undirected(edges).filter("x <> y"), "undirected")
    labels = stage(both.groupBy(F.col("x").alias("ip")).agg(F.count(F.lit(1)).alias("d")).select("ip", F.col("ip").cast("string").alias("community"), "d"), "labels")
    for i in itertools.count():
        votes = both.join(labels, both["y"] == labels["ip"]).groupBy("x", "community").agg(F.sum("w").alias("w"))
        best = votes.groupBy("x").agg(F.min_by("community", F.struct((-F.col("w")).alias("w"), F.col("community"))).alias("new"))
        wish = stage(labels.join(best, labels["ip"] == best["x"]).select("ip", "community", "new", "d", F.xxhash64("ip", F.lit(i)).alias("h")), "wishes")
        open_ = wish.filter("new <> community")
        if open_.isEmpty():
            unstage(both, wish)
            return labels.select("ip", "community")
        if i < rounds:
            turn = F.pmod("h", F.lit(2)) == 0
            moved = wish.select("ip", F.when(turn, F.col("new")).otherwise(F.col("community")).alias("community"), "d")
        else:
            a, b = (open_.select(F.col("ip").alias(n), F.struct("d", "h", "ip").alias(f"h{n}")) for n in ("x", "y"))
            waits = both.join(a, "x").join(b, "y").filter("hy < hx").select(F.col("x").alias("ip"), F.lit(True).alias("waits")).distinct()
            moved = wish.join(waits, "ip", "left").select("ip", F.when(F.col("waits"), F.col("community")).otherwise(F.col("new")).alias("community"), "d")
        last, labels = labels, stage(moved, "labels")
        unstage(last, wish)


def _quality(level: DataFrame, home: DataFrame, m2: float) -> float:
    """Modularity of home(x, k, c) over level(x, y, w)."""
    a, b = home.select("x", F.col("c").alias("cx")), home.select(F.col("x").alias("y"), F.col("c").alias("cy"))
    inside = level.join(a, "x").join(b, "y").filter("cx = cy").agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("v"))
    spread = home.groupBy("c").agg(F.sum("k").alias("t")).agg(F.coalesce(F.sum(F.col("t") * F.col("t")), F.lit(0.0)).alias("v"))
    i, s = (r["v"] for r in inside.unionAll(spread).collect())
    return i / m2 - s / m2**2


def communities(edges: DataFrame, patience: int = 4) -> DataFrame:
    """(ip, community): Louvain with synchronous moves. In a round half of the nodes (by a hash that changes) move to the
    neighbouring community with the greatest gain in modularity, ties to the smaller name. Rounds go on until no node wants to
    move, or `patience` rounds have not raised the modularity (moves made at once can undo each other); the best round counts.
    Then communities become the nodes of the next level, until a level raises nothing. Modularity rises from level to level, so it
    ends. Every round is joins and aggregations."""
    both = stage(undirected(edges), "undirected")
    parts = stage(both.select(F.col("x").alias("ip")).distinct().withColumn("community", F.col("ip").cast("string")), "parts")
    level = stage(both.select(F.col("x").cast("string").alias("x"), F.col("y").cast("string").alias("y"), "w"), "level")
    m2 = level.agg(F.sum("w")).first()[0]
    while m2:
        home = stage(level.groupBy("x").agg(F.sum("w").alias("k")).withColumn("c", F.col("x")), "homes")
        first = best_q = _quality(level, home, m2)
        best, stale = home, 0
        for i in itertools.count():
            totals = home.groupBy("c").agg(F.sum("k").alias("tot"))
            around = level.filter("x <> y").join(home.select(F.col("x").alias("y"), F.col("c").alias("nc")), "y").groupBy("x", "nc").agg(F.sum("w").alias("w"))
            own = home.select("x", F.col("c").alias("nc"), F.lit(0.0).alias("w"))
            options = around.unionByName(own).groupBy("x", "nc").agg(F.sum("w").alias("w")).join(home, "x").join(totals.withColumnRenamed("c", "nc"), "nc")
            gain = F.col("w") - F.col("k") * (F.col("tot") - F.when(F.col("nc") == F.col("c"), F.col("k")).otherwise(0.0)) / m2
            wish = options.withColumn("g", F.round(gain, 9)).groupBy("x").agg(
                F.max_by("nc", F.struct(F.col("g"), (F.col("nc") == F.col("c")).alias("stay"))).alias("to"), F.max("g").alias("top"), F.max(F.when(F.col("nc") == F.col("c"), F.col("g"))).alias("here")
            )
            turn = F.pmod(F.xxhash64("x", F.lit(i)), F.lit(2)) == 0
            moves = F.col("top") > F.col("here") + 1e-9
            new = stage(home.join(wish, "x").select("x", "k", F.when(turn & moves, F.col("to")).otherwise(F.col("c")).alias("c"), moves.alias("open")), "homes")
            if new.filter("open").isEmpty():
                unstage(new)
                break
            if home is not best:
                unstage(home)
            home = new.select("x", "k", "c")
            q = _quality(level, home, m2)
            if q > best_q + 1e-9:
                unstage(best)
                best, best_q, stale = home, q, 0
            else:
                stale += 1
            if stale == patience:
                break
        if home is not best:
            unstage(home)
        if best_q <= first + 1e-9:
            unstage(best)
            break
        to, last = best.select("x", "c"), (parts, level, best)
        parts = stage(parts.join(to.select(F.col("x").alias("community"), F.col("c").alias("to")), "community").select("ip", F.col("to").alias("community")), "parts")
        level = stage(
            level.join(to.withColumnRenamed("c", "cx"), "x").join(to.select(F.col("x").alias("y"), F.col("c").alias("cy")), "y").groupBy(F.col("cx").alias("x"), F.col("cy").alias("y")).agg(F.sum("w").alias("w")), "level"
        )
        unstage(*last)
    unstage(both, level)
    return parts


def community_stats(nodes: DataFrame, edges: DataFrame, parts: DataFrame, malicious_from: int = 1) -> DataFrame:
    """(community, size, attacker_count, internal_edges, attack_cats, attack_edges, bytes, is_malicious)."""
    per = nodes.join(parts, "ip").groupBy("community").agg(F.count(F.lit(1)).alias("size"), F.count_if("is_attacker").alias("attacker_count"))
    cats = nodes.join(parts, "ip").select("community", F.explode("attack_cats").alias("c")).groupBy("community").agg(F.sort_array(F.collect_set("c")).alias("attack_cats"))
    placed = endpoint_communities(edges, parts)
    inside = placed.groupBy(F.col("src_community").alias("community")).agg(
        F.count_if(F.col("src_community") == F.col("dst_community")).alias("internal_edges"), F.count_if("has_attack").alias("attack_edges"), F.round(F.sum("total_bytes"), 2).alias("bytes")
    )
    out = per.join(cats, "community", "left").join(inside, "community", "left").fillna(0, ["internal_edges", "attack_edges", "bytes"])
    return out.withColumn("attack_cats", F.coalesce("attack_cats", F.array().cast("array<string>"))).withColumn("is_malicious", F.col("attacker_count") >= malicious_from)


def endpoint_communities(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges with src_community and dst_community."""
    return edges.join(parts.select(F.col("ip").alias("src"), F.col("community").alias("src_community")), "src", "left").join(parts.select(F.col("ip").alias("dst"), F.col("community").alias("dst_community")), "dst", "left")


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.count_if("is_attacker").alias("attackers"))
    e = edges.agg(F.count(F.lit(1)).alias("edges"), F.count_if("has_attack").alias("attack_edges"))
    return n.join(e, how="cross").withColumn("avg_out_degree", F.round(F.col("edges") / F.nullif(F.col("nodes"), F.lit(0)), 6))


def danger(pagerank: Column, out_c: Column, degree_c: Column) -> Column:
    """The weights .5, .3, .2."""
    return 0.5 * pagerank + 0.3 * out_c + 0.2 * degree_c


def with_danger(nodes: DataFrame, degree: DataFrame, ranks: DataFrame) -> DataFrame:
    return nodes.join(degree, "ip").join(ranks, "ip").withColumn("danger", F.round(danger(F.col("pagerank"), F.col("out_c"), F.col("degree_c")), 9))


def top_danger(scored: DataFrame, k: int) -> DataFrame:
    return scored.orderBy(F.desc("danger"), "ip").limit(k).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("danger"), "ip")))


def flagged(scored: DataFrame) -> DataFrame:
    return scored.filter("is_attacker").orderBy(F.desc("pagerank"), "ip")


def rank_malicious(stats: DataFrame, k: int | None = None) -> DataFrame:
    order = [F.desc("attacker_count"), F.desc("attack_edges"), F.desc("bytes"), F.desc("internal_edges"), F.desc("size"), F.asc("community")]
    out = stats.filter("is_malicious").orderBy(*order)
    return out.limit(k) if k else out


def edges_among(edges: DataFrame, ids: DataFrame, any_end: bool = False) -> DataFrame:
    """Edges with both ends (or any end) in ids(ip)."""
    s, d = ids.select(F.col("ip").alias("src")).distinct(), ids.select(F.col("ip").alias("dst")).distinct()
    if any_end:
        marked = edges.join(s.withColumn("_s", F.lit(True)), "src", "left").join(d.withColumn("_d", F.lit(True)), "dst", "left")
        return marked.filter("_s or _d").drop("_s", "_d")
    return edges.join(s, "src", "left_semi").join(d, "dst", "left_semi")


def neighbours(edges: DataFrame, ids: DataFrame) -> DataFrame:
    touching = edges_among(edges, ids, any_end=True)
    return touching.select(F.col("src").alias("ip")).union(touching.select("dst")).distinct()


def view_threat(scored: DataFrame, edges: DataFrame, parts: DataFrame, stats: DataFrame, budget: int, top: int = 5) -> DataFrame:
    """Nodes: attackers, their neighbours and the members of the worst malicious communities, by danger within a budget."""
    attackers = scored.filter("is_attacker").select("ip")
    worst = rank_malicious(stats, top).select("community")
    members = parts.join(worst, "community", "left_semi").select("ip")
    wanted = attackers.union(neighbours(edges, attackers)).union(members).distinct()
    return scored.join(wanted, "ip", "left_semi").orderBy(F.desc("is_attacker"), F.desc("danger"), "ip").limit(budget)


def view_edges(edges: DataFrame, ids: DataFrame, budget: int, attack_share: float = 0.6) -> DataFrame:
    """Edges among the nodes within a budget, up to `attack_share` of it for attacks first, heaviest first."""
    among = edges_among(edges, ids)
    order = [F.desc("weight"), F.asc("src"), F.asc("dst")]
    attacks = among.filter("has_attack").orderBy(*order).limit(int(budget * attack_share))
    rest = among.join(attacks.select("src", "dst"), ["src", "dst"], "left_anti").orderBy(*order).limit(budget)
    first = attacks.withColumn("_first", F.lit(0)).unionByName(rest.withColumn("_first", F.lit(1)))
    return first.orderBy("_first", *order).limit(budget).drop("_first")


def view_full(scored: DataFrame, k: int) -> DataFrame:
    return scored.orderBy(F.desc("pagerank"), "ip").limit(k)


def ego(edges: DataFrame, nodes: DataFrame, ip, limit: int) -> DataFrame:
    """The node and its neighbours with their role and heaviest edge to it; one row found=false if it is unknown."""
    out = edges.filter(F.col("src") == ip).select(F.col("dst").alias("ip"), "weight", F.lit("target").alias("role"))
    back = edges.filter(F.col("dst") == ip).select(F.col("src").alias("ip"), "weight", F.lit("source").alias("role"))
    near = out.unionByName(back).filter(F.col("ip") != ip).groupBy("ip").agg(F.sum("weight").alias("weight"), F.array_join(F.sort_array(F.collect_set("role")), "+").alias("role"))
    top = near.orderBy(F.desc("weight"), "ip").limit(limit)
    me = nodes.filter(F.col("ip") == ip).select("ip", F.col("total_flows").alias("weight"), F.lit("self").alias("role"))
    if me.isEmpty():
        return edges.sparkSession.createDataFrame([(None, None, None, False)], "ip bigint, weight bigint, role string, found boolean")
    return me.unionByName(top).withColumn("found", F.lit(True))


def top_neighbours(edges: DataFrame, k: int = 8) -> DataFrame:
    """The strongest k links of every node, either direction, with the role of the other end."""
    both = edges.select(F.col("src").alias("ip"), F.col("dst").alias("peer"), "weight", F.lit("target").alias("role")).unionByName(edges.select(F.col("dst").alias("ip"), F.col("src").alias("peer"), "weight", F.lit("source").alias("role")))
    order = Window.partitionBy("ip").orderBy(F.desc("weight"), "peer", "role")
    return both.filter("ip <> peer").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def collapse_peers(edges: DataFrame, nodes: DataFrame, parts: DataFrame, malicious: DataFrame, least: int) -> DataFrame:
    """Edges after the unflagged members of malicious communities of at least `least` nodes became one node per community;
    edges folded (weight and bytes summed, attack if any), self-edges dropped."""
    sizes = parts.groupBy("community").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).join(malicious.select("community"), "community", "left_semi")
    folded = parts.join(nodes.select("ip", "is_attacker"), "ip").join(sizes, "community", "left")
    name = F.when(F.col("n").isNotNull() & ~F.col("is_attacker"), F.concat(F.lit("community:"), F.col("community"))).otherwise(F.col("ip").cast("string"))
    to = folded.select("ip", name.alias("to"))
    moved = edges.join(to.select(F.col("ip").alias("src"), F.col("to").alias("s")), "src").join(to.select(F.col("ip").alias("dst"), F.col("to").alias("d")), "dst").filter("s <> d")
    return moved.groupBy(F.col("s").alias("src"), F.col("d").alias("dst")).agg(F.sum("weight").alias("weight"), F.round(F.sum("total_bytes"), 2).alias("total_bytes"), F.max("has_attack").alias("has_attack"))


def severity_class(nodes: DataFrame, parts: DataFrame, malicious: DataFrame) -> DataFrame:
    """crit for attackers, warn for members of malicious communities, else clean."""
    bad = malicious.select("community", F.lit(True).alias("_bad"))
    return nodes.join(parts, "ip", "left").join(bad, "community", "left").withColumn("severity", F.when(F.col("is_attacker"), "crit").when(F.col("_bad"), "warn").otherwise("clean")).drop("_bad")


def node_payload(scored: DataFrame, classes: DataFrame) -> DataFrame:
    """Display form: class and size (page rank times 1000, between 10 and 60). danger_pct is the percentile of
    danger in the view; scored is a view of bounded size, as a global rank is one task."""
    pct = F.percent_rank().over(Window.partitionBy(F.lit(0)).orderBy("danger"))
    return scored.join(classes.select("ip", "severity"), "ip").select("ip", "severity", F.round(F.greatest(F.lit(10.0), F.least(F.lit(60.0), F.col("pagerank") * 1000)), 6).alias("size"), "danger", F.round(100 * pct, 6).alias("danger_pct"))


def edge_payload(edges: DataFrame) -> DataFrame:
    """Without self-loops and blank ends; width is weight / 10 between 1 and 5."""
    return edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))).select("src", "dst", "weight", "has_attack", F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.col("weight") / 10)).alias("width"))


def cluster_names(stats: DataFrame) -> DataFrame:
    """Communities in order of severity with names C1, C2 ..."""
    order = [F.desc("is_malicious"), F.desc("attacker_count"), F.desc("size"), F.asc("community")]
    # a global sort; rows of a partition are numbered on from the rows of those before it
    rows = stage(stats.orderBy(*order).select("community", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")), "names")
    sizes = rows.groupBy("p").agg(F.count(F.lit(1)).alias("m"), F.min("i").alias("i0"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    placed = rows.join(F.broadcast(sizes.select("p", "i0", before.alias("b"))), "p")
    return placed.select("community", F.concat(F.lit("C"), (F.col("b") + F.col("i") - F.col("i0") + 1).cast("string")).alias("name"))
