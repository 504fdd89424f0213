"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; where its leaves would hold many rows, every leaf is split once more by k-means on
a bounded sample of its own rows. Every row is filed under one leaf. A query takes nodes from a priority queue,
nearest centroid first, and so visits leaves in order of promise. How many leaves it visits is calibrated: for a number of
calibration queries the exact neighbours among all rows are found, and visits are widened until the share of them that
lies in visited leaves reaches the target. Neighbouring leaves form a block; rows and queries meet in a join on blocks, and
only rows of leaves that a query visits are scored. Large blocks and busy ones are cut. Equal vectors are searched once.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm.common import frugal, stage

#: Bounds of a fit: sampled vectors, and components of them in all; rows aimed at in a leaf, sampled vectors in a leaf at least,
#: leaves of the first fit at most.
SAMPLE, SAMPLE_VALUES, LEAF_ROWS, LEAF_SAMPLE, FIT_LEAVES = 20_000, 2_000_000, 8, 4, 1500
#: Leaves of the first fit that hold more rows on average are split into leaves of a quarter of that, but into so many at most; and components
#: of all centroids at most.
SPLIT_ROWS, SPLIT, CENTROID_VALUES = 512, 256, 16_000_000
BRANCH, ROUNDS, SEED = 128, 8, 11
#: Recall that visits are widened to, and calibration queries.
TARGET_RECALL, QUERIES = 0.94, 400
#: Rows and queries that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


@dataclass
class Tree:
    """Node n has centroid rows children[n] of `centroids`, each leading to another node or (negative) to leaf -1 - x."""

    centroids: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    #: Rows in each leaf, and leaves that a query visits.
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    visits: int = 1

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: at each node on to the nearest centroid."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))] if self.children else []
        while todo:
            node, at = todo.pop()
            nearest = (x[at] @ self.centroids[node].T).argmax(1)
            for c, child in enumerate(self.children[node]):
                part = at[nearest == c]
                if not len(part):
                    continue
                if child < 0:
                    out[part] = -1 - child
                else:
                    todo.append((child, part))
        return out

    def order(self, q: np.ndarray, leaves: int, rows: int = 0) -> list[int]:
        """Leaves in best-bin-first order: the first `leaves`, and more until they hold `rows` rows."""
        if not self.children:
            return [0]
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < leaves or held < rows):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                held += int(self.sizes[-1 - node]) if len(self.sizes) else 0
                continue
            for near, child in zip((self.centroids[node] @ q).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (-near, child))
        return out

    def split(self, parts: dict[int, np.ndarray]) -> Tree:
        """The tree with leaves replaced by nodes of the given centroids; leaves are numbered anew, neighbours together."""
        out = Tree([*self.centroids], [[*c] for c in self.children])

        def renumbered(child: int) -> int:
            if child >= 0:
                out.children[child] = [renumbered(c) for c in out.children[child]]
                return child
            c = parts.get(-1 - child)
            if c is None or len(c) < 2:
                out.leaves += 1
                return -out.leaves
            out.centroids.append(c)
            out.children.append([-out.leaves - 1 - i for i in range(len(c))])
            out.leaves += len(c)
            return len(out.children) - 1

        if self.children:
            renumbered(0)
        elif 0 in parts and len(parts[0]) > 1:
            out = Tree([parts[0]], [[-1 - i for i in range(len(parts[0]))]], len(parts[0]))
        else:
            out.leaves = 1
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two (so exactly) that brings the largest component to between a half and one."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        at = (x @ c.T).argmax(1)
        sums = (at == np.arange(k)[:, None]).astype(float) @ x
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), c)
    return c


def fit_tree(sample: np.ndarray, rows: int) -> Tree:
    """A tree for about `rows` vectors from a sample of distinct ones. Leaves are numbered so that neighbours come together."""
    tree, rng, x = Tree(), np.random.default_rng(SEED), _unit(_scaled(sample.astype(float))) if len(sample) else sample
    least = max(LEAF_SAMPLE, -(-len(x) * LEAF_ROWS // max(rows, 1)), -(-len(x) // FIT_LEAVES))

    def grow(at: np.ndarray) -> int:
        k = min(BRANCH, len(at) // least)
        if k >= 2:
            c = _kmeans(x[at], k, rng)
            nearest = (x[at] @ c.T).argmax(1)
            sizes = np.bincount(nearest, minlength=k)
            if sizes.max() < len(at):
                node = len(tree.children)
                used = np.flatnonzero(sizes)
                tree.centroids.append(c[used])
                tree.children.append([])
                tree.children[node] = [grow(at[nearest == u]) for u in used]
                return node
        tree.leaves += 1
        return -tree.leaves

    if len(x):
        grow(np.arange(len(x)))
    tree.leaves = max(tree.leaves, 1)
    return tree


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(list(column)).astype(float)


def _collected(rows: DataFrame, column: str) -> np.ndarray:
    """A bounded column of vectors on the driver."""
    arrow = rows.select(column).toArrow().column(0).combine_chunks()
    return arrow.flatten().to_numpy().reshape(len(arrow), -1) if len(arrow) else np.zeros((0, 0))


def _filed(rows: DataFrame, tree: Tree) -> DataFrame:
    """rows(v, ids) with their leaf."""
    sent = rows.sparkSession.sparkContext.broadcast(tree)

    @frugal
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(leaf=sent.value.file(_unit(_scaled(_matrix(pdf["v"])))))

    return stage(rows.select("v", "ids").mapInPandas(work, "v array<double>, ids array<bigint>, leaf int"), "ann-index")


def build(groups: DataFrame, rows: int, size: int) -> tuple[Tree, DataFrame]:
    """A tree for groups(v, ids) of `size` components, and groups with their leaf."""
    most = max(2, min(SAMPLE, SAMPLE_VALUES // size))
    order = (F.xxhash64(F.col("ids")[0]), F.col("ids")[0])
    tree = fit_tree(_collected(groups.orderBy(*order).limit(most).select("v"), "v"), rows)
    index = _filed(groups, tree)
    parts = min(SPLIT, CENTROID_VALUES // size // tree.leaves, 4 * rows // tree.leaves // SPLIT_ROWS)
    if rows > tree.leaves * SPLIT_ROWS and parts >= 2:
        each = F.row_number().over(Window.partitionBy("leaf").orderBy(*order))
        few = index.withColumn("n", each).filter(F.col("n") <= min(parts * 8, max(2, SAMPLE_VALUES // size))).select("leaf", "v")

        def split(pdf: pd.DataFrame) -> pd.DataFrame:
            x = _unit(_scaled(_matrix(pdf["v"])))
            c = _kmeans(x, min(parts, len(x)), np.random.default_rng(SEED))
            return pd.DataFrame({"leaf": pdf["leaf"].iat[0], "c": list(c)})

        # at most CENTROID_VALUES numbers
        fitted = few.groupBy("leaf").applyInPandas(split, "leaf int, c array<double>").toPandas()
        tree = tree.split({int(leaf): np.unique(_matrix(g["c"]), axis=0) for leaf, g in fitted.groupby("leaf")})
        index = _filed(index, tree)
    tree.sizes = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n")).collect():  # a number for each leaf
        tree.sizes[r["leaf"]] = r["n"]
    return tree, index


def calibrate(tree: Tree, index: DataFrame, k: int, target: float) -> float:
    """Sets visits, widened until the share of exact neighbours, among all rows, that lie in visited leaves reaches the
    target for the calibration queries. Returns the share of rows that their visits score."""
    rows = index.orderBy(F.xxhash64(F.col("ids")[0], F.lit(SEED)), F.col("ids")[0]).limit(max(1, min(QUERIES, SAMPLE_VALUES // 64)))
    asked = _collected(rows.select("v"), "v")
    if tree.leaves == 1 or len(asked) < 2:
        tree.visits = tree.leaves
        return 1.0
    queries = _unit(_scaled(asked))
    sent = index.sparkSession.sparkContext.broadcast((asked, queries))

    @frugal
    def nearest_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The k nearest of each query in a partition."""
        own, q = sent.value
        best, leaf = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        for pdf in batches:
            if not len(pdf):
                continue
            v, at = _matrix(pdf["v"]), pdf["leaf"].to_numpy()
            for lo in range(0, len(v), 2048):
                x = v[lo : lo + 2048]
                near = q @ _unit(_scaled(x)).T
                for i, j in zip(*np.nonzero(near > 1 - 1e-9), strict=True):
                    if (x[j] == own[i]).all():
                        near[i, j] = -np.inf  # the query itself
                near, leaves = np.concatenate([best, near], 1), np.concatenate([leaf, np.broadcast_to(at[lo : lo + 2048], near.shape)], 1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                best, leaf = np.take_along_axis(near, top, 1), np.take_along_axis(leaves, top, 1)
        i, j = np.nonzero(np.isfinite(best))
        yield pd.DataFrame({"q": i, "near": best[i, j], "leaf": leaf[i, j]})

    found = index.select("v", "leaf").mapInPandas(nearest_here, "q int, near double, leaf int")
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("near")))).filter(F.col("n") <= k).select("q", "leaf").collect()
    home = defaultdict(list)  # at most k leaves for each query
    for r in best:
        home[r["q"]].append(r["leaf"])
    needed, place = [], np.empty(tree.leaves, np.int64)
    for i, q in enumerate(queries):  # one order of leaves at a time
        place[tree.order(q, tree.leaves)] = np.arange(tree.leaves)
        needed += place[home[i]].tolist()
    needed = np.array(needed)
    visits = 1
    while (needed < visits).mean() < target and visits < tree.leaves:
        visits += max(1, visits // 32)
    tree.visits = min(visits, tree.leaves)
    return float(np.mean([tree.sizes[tree.order(q, tree.visits)].sum() for q in queries]) / tree.sizes.sum())


def nearest(vectors: DataFrame, divisor: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding", target: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every key divisible by `divisor` the k nearest other rows found, by
    largest cosine in double precision, ties to the smaller key.

    Vectors that are null, zero or hold null or non-finite components, rows with a null key or one that is no integer (keys
    given as text may hold integers), and vectors of another
    length than the most frequent one (of equally frequent ones the longest) take no part. Components may have any finite
    size. Rows equal in key and vector are one; a query never finds its own key. Queries visit leaves with more than k rows,
    so k candidates are found if there are as many. Other columns are
    ignored; an empty table gives an empty result. Recall of the calibration queries among all rows reaches `target`.
    """
    double = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double"))
    typed = vectors.schema[key].dataType
    number = F.col(f"`{key}`").cast("bigint") if isinstance(typed, T.IntegralType) else F.col(f"`{key}`").cast("string").try_cast("bigint")
    rows = vectors.select(number.alias("id"), double.alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rows = rows.filter(F.size("v") == size["d"]).withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(SEED), F.reverse("v"))})
    # Equal vectors are known by 128 bits. Their k + 1 smallest keys are enough: ties go to them, and one may be the query itself.
    few = rows.dropDuplicates(["id", "h", "g"]).withColumn("n", F.row_number().over(Window.partitionBy("h", "g").orderBy("id"))).filter(F.col("n") <= k + 1)
    groups = stage(few.groupBy("h", "g").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")), "ann-groups")
    tree, index = build(groups, size["count"], size["d"])
    calibrate(tree, index, k, target)

    # equal query vectors are searched once, under their smallest key
    asked = rows.filter(F.col("id") % divisor == 0).dropDuplicates(["id", "h", "g"])
    asked = stage(asked.withColumn("q", F.min("id").over(Window.partitionBy("h", "g"))), "ann-queries")
    span = max(1, int(BLOCK_ROWS * tree.leaves // max(1, tree.sizes.sum())))  # leaves of a block
    sent = vectors.sparkSession.sparkContext.broadcast(tree)  # bounded by SAMPLE and CENTROID_VALUES

    @frugal
    def planned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for q, v, x in zip(pdf["q"], pdf["v"], _unit(_scaled(_matrix(pdf["v"]))) if len(pdf) else (), strict=True):
                leaves = np.sort(sent.value.order(x, sent.value.visits, k + 2))
                cut = np.flatnonzero(np.diff(leaves // span)) + 1
                rows += [(q, v, int(part[0] // span), part) for part in np.split(leaves, cut)]
            if rows:
                yield pd.DataFrame(rows, columns=["q", "v", "block", "leaves"])

    visits = stage(asked.filter("id = q").select("q", "v").mapInPandas(planned, "q bigint, v array<double>, block int, leaves array<int>"), "ann-visits")
    index = index.withColumn("block", F.floor(F.col("leaf") / span).cast("int"))
    # one row for each of a bounded number of blocks
    cuts = F.broadcast(
        index.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("rb"))
        .join(visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("qb")), "block")
    )
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    left = index.join(cuts, "block").select("block", part(F.col("ids"), "rb").alias("r"), every("qb").alias("b"), "leaf", "v", "ids")
    right = visits.join(cuts, "block").select("block", every("rb").alias("r"), part("q", "qb").alias("b"), "leaves", "v", "q")

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _best(c, q, k)

    on = ["block", "r", "b"]
    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(meet, "q bigint, id bigint, score double")
    order = [F.desc("score"), F.col("id")]
    top = met.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("n") <= k + 1).drop("n")
    answers = asked.select(F.col("id").alias("query_id"), F.col("q").alias("o")).join(top, F.col("o") == F.col("q")).filter(F.col("query_id") != F.col("id"))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _best(c: pd.DataFrame, q: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each query of a block the keys of its k + 1 nearest vectors in the leaves it visits, with scores that depend on
    the pair alone."""
    if not len(c) or not len(q):
        return pd.DataFrame({"q": [], "id": [], "score": []})
    c = c.sort_values("leaf", kind="stable")
    x, y = _scaled(_matrix(c["v"])), _scaled(_matrix(q["v"]))
    nx, ny = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
    near = np.full((len(y), len(x)), -np.inf)
    leaves = c["leaf"].to_numpy()
    visited = np.concatenate(list(q["leaves"]))
    who = np.repeat(np.arange(len(q)), [len(v) for v in q["leaves"]])
    by_leaf = np.argsort(visited, kind="stable")
    visited, who = visited[by_leaf], who[by_leaf]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(leaves)) + 1, [len(leaves)]])
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        a, z = np.searchsorted(visited, [leaves[lo], leaves[lo] + 1])
        if z > a:
            near[who[a:z], lo:hi] = (y[who[a:z]] @ x[lo:hi].T) / ny[who[a:z], None] / nx[lo:hi]
    keep = min(k + 1, len(x))
    floor = -np.partition(-near, keep - 1, axis=1)[:, keep - 1]
    a, b = np.nonzero((near >= floor[:, None] - 1e-12) & np.isfinite(near))
    if not len(a):
        return pd.DataFrame({"q": [], "id": [], "score": []})
    score = np.einsum("ij,ij->i", y[a], x[b]) / (ny[a] * nx[b])
    ids = [c["ids"].iat[i] for i in b]
    sizes = np.fromiter(map(len, ids), int, len(ids))
    out = pd.DataFrame({"q": np.repeat(q["q"].to_numpy()[a], sizes), "id": np.concatenate(ids), "score": np.repeat(score, sizes)})
    out = out.sort_values(["q", "score", "id"], ascending=[True, False, True])
    return out.groupby("q", sort=False).head(k + 1)
