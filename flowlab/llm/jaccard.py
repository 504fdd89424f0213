"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts with the same set of word shingles are one representative. Each tree of the forest labels every representative with
DEEPEST MinHash values of BITS bits, packed most significant first into one number; a tree is the sorted trie of those
labels, and what two labels share from the front is a node of it. Representatives start from the longest prefix. For each it is shortened,
in all trees at once, until the estimated recall reaches the target: two sets of similarity s share a prefix of d values in some tree with
probability 1 - (1 - s^d)^trees, and s is read off the tries themselves, as the share of the meetings at one depth that go on to
the next one (a meeting goes on with probability s), drawn toward the threshold by PRIOR meetings, less its standard error, and never below the threshold. A set whose
neighbours are nearly equal is compared at a long prefix, one with few or less similar ones at a shorter, at the shortest at which the threshold itself reaches the
target. It is compared in as many trees as the target takes at its prefix. Candidates are verified on whole shingle sets.

Large nodes are cut into blocks and verified block against block: only counts of links and one row per member leave a
block, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm import bloom, textops
from flowlab.llm.common import bounded_batches, frugal, shelved, stage, unstage
from flowlab.llm.components import connected
from flowlab.llm.skew import join_weighted

SHINGLE, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.999
#: Trees; values in a label, and bits of a value; meetings at the threshold that every set is given before its own are counted.
TREES, DEEPEST, BITS, PRIOR = 24, 10, 6, 32.0
#: Members and shingles in a block, about; columns of a block's incidence matrix held at once.
BLOCK_MEMBERS, BLOCK_SHINGLES, COLUMNS = 512, 600_000, 8_192


def sure_depth(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES) -> int:
    """The longest prefix at which two sets of that similarity share a node in some tree with probability `recall`."""
    for depth in range(DEEPEST, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    raise ValueError("more trees are needed for this recall")


def _hash_parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def _labels(sets: list[np.ndarray], trees: int) -> np.ndarray:
    """(sets, trees): the label of each set in each tree; sets are not empty."""
    every = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    times, flip = _hash_parameters(trees * DEEPEST)
    out = np.zeros((trees, len(sets)), np.uint64)
    for k in range(trees * DEEPEST):
        least = np.minimum.reduceat((every ^ flip[k]) * times[k] >> np.uint64(32), first)
        out[k // DEEPEST] = out[k // DEEPEST] << np.uint64(BITS) | textops.mix(least + np.uint64(k)) >> np.uint64(64 - BITS)
    return out.T


def _name(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of hashes, as signed numbers."""
    n = np.uint64(len(s))
    pair = textops.mix(np.array([textops.mix(s).sum(dtype=np.uint64) + n, textops.mix(s ^ np.uint64(0x5BF03635D1C4A9E7)).sum(dtype=np.uint64) ^ n]))
    a, b = pair.view(np.int64)
    return int(a), int(b)


def _signer(trees: int):
    """(a, b, n, labels) for each text: name and size of its shingle set, zeros without a word. A set that recurs in a task
    has its labels once."""

    @frugal
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for texts in batches:
            names, sizes, labels = [], [], []
            for _, part in textops.slices(list(texts)):
                fresh, at = [], []
                for s in textops.shingles(part, SHINGLE):
                    name = _name(s) if len(s) else (0, 0)
                    if len(s) and name not in seen:
                        if len(seen) < 200_000:  # beyond it labels are made again, and merged later
                            seen.add(name)
                        fresh.append(s)
                        at.append(len(names))
                    names.append(name)
                    sizes.append(len(s))
                    labels.append(None)
                if fresh:
                    for i, row in zip(at, _labels(fresh, trees).view(np.int64), strict=True):
                        labels[i] = row
            yield pd.DataFrame({"a": [x for x, _ in names], "b": [x for _, x in names], "n": sizes, "labels": labels}).astype({"a": "int64", "b": "int64", "n": "int32"})

    return sign


def named(docs: DataFrame, text: str = "text", trees: int = TREES) -> DataFrame:
    """docs (but text) with a, b, n, labels of the shingle set of each text; docs must not use these names."""
    made = F.pandas_udf(_signer(trees), "struct<a:bigint,b:bigint,n:int,labels:array<bigint>>")(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, made.alias("_named")).select(*kept, "_named.*")


def _shingle_rows(table: np.ndarray, bits: int):
    """(a, b, shingles) of texts whose name the filter lets through."""

    @frugal
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for pdf in batches:
            for _, part in textops.slices(list(pdf["text"])):
                fresh = []
                for s in textops.shingles(part, SHINGLE):
                    if len(s):
                        name = _name(s)
                        if name not in seen and bloom.hits(table, bits, np.array([name[0]]).view(np.uint64))[0]:
                            if len(seen) < 200_000:
                                seen.add(name)
                            fresh.append((name, s))
                if fresh:
                    yield pd.DataFrame({"a": [x[0] for x, _ in fresh], "b": [x[1] for x, _ in fresh], "shingles": [s.view(np.int64) for _, s in fresh]})

    return rows


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, sets): sizes of the intersections of sorted arrays of distinct values."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], (np.cumsum(uses > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.diag([float(len(s)) for s in sets])
    np.fill_diagonal(out, 0)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, z = np.searchsorted(column, [lo, lo + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - lo)), np.float32)
        m[owner[a:z], column[a:z] - lo] = 1
        out += m @ m.T
    return out


def _verified(group: dict, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one block pair of a node: per member the links first found there (texts, copies), and the smallest member that it
    is linked with through members of the group. A pair is compared at the shorter of its two prefixes, in the first tree in
    which it shares that much."""
    sizes = group["n"].astype(float)
    due = np.minimum(group["depth"][:, None], group["depth"]) == group["at"]
    np.fill_diagonal(due, False)
    if group["i"] != group["j"]:
        side = group["block"] == group["i"]
        due &= side[:, None] != side
    for p in (group["labels"] >> np.uint64(BITS * (DEEPEST - group["at"]))).T[: group["tree"]]:
        due &= p[:, None] != p
    root = np.arange(len(sizes))
    if not due.any():
        return np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), root
    common = _intersections(group["shingles"])
    # common / (x + y - common) >= threshold, without division; the slack is far below one element's weight
    linked = due & (common * (1 + threshold) >= threshold * (sizes[:, None] + sizes) - 1e-7)
    while True:
        least = np.where(linked, root, len(root)).min(1, initial=len(root))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return linked.sum(1), linked @ group["copies"], root


FOUND = "a bigint, b bigint, texts bigint, copies bigint, to_a bigint, to_b bigint"
KEYS = ["node", "i", "j"]


def _verify_rows(threshold: float):
    """Rows come sorted by node, i, j; a group may go on in the next batch."""

    def flush(parts: list[pd.DataFrame]) -> pd.DataFrame | None:
        g = pd.concat(parts) if len(parts) > 1 else parts[0]
        if len(g) < 2:
            return None
        g = g.sort_values(["a", "b"])
        a, b = g["a"].to_numpy(), g["b"].to_numpy()
        group = {k: g[k].to_numpy() for k in ("n", "copies", "block", "depth")} | {"shingles": list(g["shingles"]), "labels": np.stack(list(g["labels"])).view(np.uint64)}
        group |= {k: int(g[k].iat[0]) for k in ("i", "j", "tree", "at")}
        texts, copies, root = _verified(group, threshold)
        some = (texts > 0) | (root != np.arange(len(root)))
        if not some.any():
            return None
        return pd.DataFrame({"a": a[some], "b": b[some], "texts": texts[some], "copies": copies[some], "to_a": a[root[some]], "to_b": b[root[some]]})

    @frugal
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, parts = None, []
        for pdf in batches:
            keys = pdf[KEYS].to_numpy()
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            done = []
            for lo, hi in zip([0, *cut], [*cut, len(pdf)], strict=True):
                if hi == lo:
                    continue
                key = tuple(keys[lo])
                if key != open_key and parts:
                    done.append(flush(parts))
                    parts = []
                open_key = key
                parts.append(pdf.iloc[lo:hi])
            if done := [x for x in done if x is not None]:
                yield pd.concat(done)
        if parts and (last := flush(parts)) is not None:
            yield last

    return rows


def _node(depth: Column) -> Column:
    """The trie node of a label at a depth."""
    bits = F.lit(BITS) * (F.lit(DEEPEST) - depth)
    return F.xxhash64("tree", depth, F.call_function("shiftrightunsigned", F.col("label"), bits.cast("int")))


def _reach(meetings: Column, sure: int, threshold: float, recall: float, trees: int) -> Column:
    """struct<depth, trees> of a set with meetings(at, c) at the depths from `sure` on: the longest prefix whose estimated recall is enough in all
    trees (`sure` if none is), and how many trees it takes there."""
    at = lambda d: F.coalesce(F.get(F.filter(meetings, lambda x: x["at"] == d), F.lit(0))["c"], F.lit(0))
    counts = [at(d).cast("double") for d in range(sure, DEEPEST + 1)]
    went_on, met = sum(counts[1:], F.lit(PRIOR * threshold)), sum(counts[:-1], F.lit(PRIOR))
    share = went_on / met
    s = F.greatest(share - F.sqrt(share * F.greatest(1 - share, F.lit(0.0)) / met), F.lit(threshold))
    needed = lambda d: F.ceil(F.log(F.lit(1 - recall)) / F.log(F.greatest(1 - F.pow(s, F.lit(d)), F.lit(1e-9)))).cast("int")
    at_depth = lambda d: F.struct(F.lit(d).alias("depth"), F.least(needed(d), F.lit(trees)).alias("trees"))
    return F.coalesce(*[F.when(needed(d) <= trees, at_depth(d)) for d in range(DEEPEST, sure, -1)], at_depth(sure))


def forest(sets: DataFrame, threshold: float, recall: float, trees: int) -> tuple[DataFrame, DataFrame]:
    """(members, depths) of sets(a, b, n, labels). depths: a, b, depth, the prefix each representative is compared at; absent
    if nothing shares the shortest prefix with it. members: node, at (its depth), tree, blocks, a, b, depth, a row for each
    member of a node at which some representative is compared."""
    sure = sure_depth(threshold, recall, trees)
    levels = F.array(*[F.lit(d) for d in range(DEEPEST, sure - 1, -1)])
    at = sets.select("a", "b", "n", F.posexplode("labels").alias("tree", "label")).withColumn("top", _node(F.lit(sure)))
    # most labels share no node of the shortest prefix with another one, and are done
    shared = at.groupBy("top").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("top")
    rows = stage(at.join(shared, "top", "left_semi").select("a", "b", "n", "tree", "label", F.explode(levels).alias("at")).withColumn("node", _node(F.col("at"))).drop("label"), "trie")
    size = (F.count(F.lit(1)).alias("m"), F.sum(F.col("n").cast("long")).alias("s"), F.min("tree").alias("first_tree"))
    marks = (F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum(F.col("a") % 1_000_003).alias("sa"))
    nodes = stage(rows.groupBy("node").agg(F.min("at").alias("n_at"), *size, *marks).filter("m > 1").withColumnRenamed("node", "n_node"), "nodes")
    met = stage(join_weighted(rows, nodes, F.col("node") == F.col("n_node"), "m").select("node", "at", "tree", "a", "b", "m"), "met")
    meetings = met.groupBy("a", "b", "at").agg(F.sum(F.col("m") - 1).alias("c")).groupBy("a", "b").agg(F.collect_list(F.struct("at", "c")).alias("meetings"))
    depths = stage(meetings.select("a", "b", _reach(F.col("meetings"), sure, threshold, recall, trees).alias("r")).select("a", "b", "r.*"), "depths")
    placed = stage(met.join(depths, ["a", "b"]), "placed")
    used = placed.filter("at = depth and tree < trees").select("node").distinct()
    # the same members often meet in several trees; the first tree stands for all of them
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_MEMBERS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    kept = nodes.join(used, F.col("n_node") == F.col("node"), "left_semi").groupBy("n_at", "m", "s", "xa", "xb", "sa").agg(F.min(F.struct("first_tree", "n_node")).alias("f"))
    kept = stage(kept.select(F.col("f.n_node").alias("k_node"), F.col("f.first_tree").alias("tree"), blocks, F.col("m").alias("k_m")), "kept")
    members = join_weighted(placed.drop("m", "tree", "trees"), kept, F.col("node") == F.col("k_node"), "k_m")
    members = stage(members.select("node", "at", "tree", "blocks", "a", "b", "depth"), "members")
    unstage(rows, nodes, met, placed, kept)
    return members, depths.drop("trees")


def similar_sets(sets: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """(found, depths). sets: a, b, n, copies, labels of each distinct shingle set, staged; texts: one column text. found: a, b,
    texts, copies (links to other sets, and to documents that hold those) and label struct<a,b> of the connected component, for sets with a link."""
    members, depths = forest(sets, threshold, recall, trees)
    table, bits = bloom.build(members.select("a").distinct(), "a")
    sent = texts.sparkSession.sparkContext.broadcast(table)
    lowered = texts.select(F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    # broadcast values are opened in the tasks
    shingles = lowered.mapInPandas(lambda it: _shingle_rows(sent.value, bits)(it), "a bigint, b bigint, shingles array<bigint>").groupBy("a", "b").agg(F.first("shingles").alias("shingles"))
    full = shingles.join(sets.select("a", "b", "n", "copies", "labels"), ["a", "b"])
    block = F.pmod(F.xxhash64("a", "b", "node"), F.col("blocks").cast("long")).cast("int")
    dealt = (
        members.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(full, ["a", "b"])
        .select("node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "tree", "at", "depth", "a", "b", "n", "copies", "labels", "shingles")
        .repartition(*KEYS)
        .sortWithinPartitions(*KEYS)
    )
    found = stage(dealt.mapInPandas(_verify_rows(threshold), FOUND), "found")
    unstage(members)
    links = found.groupBy("a", "b").agg(F.sum("texts").alias("texts"), F.sum("copies").alias("copies"))
    ends = (F.struct(F.col("a"), F.col("b")).alias("x"), F.struct(F.col("to_a").alias("a"), F.col("to_b").alias("b")).alias("y"))
    component = connected(found.select(*ends).filter("x <> y"))
    return links.join(component, (F.col("a") == F.col("id.a")) & (F.col("b") == F.col("id.b"))).select("a", "b", "texts", "copies", "label"), depths


def _grouped(names: DataFrame, least: Column, texts: DataFrame, threshold: float, recall: float, trees: int) -> DataFrame:
    """For each distinct shingle set of names(a, b, n, labels): s_a, s_b, copies, texts and linked (links to sets and to
    documents), depth, and c_least, the least value of `least` in its class."""
    own = names.filter("n > 0").groupBy("a", "b").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("labels", ignorenulls=True).alias("labels"), F.min(least).alias("least"))
    sets = stage(own, "sets")
    found, depths = similar_sets(sets, texts, threshold, recall, trees)
    zero = F.lit(0).cast("long")
    labelled = (
        sets.drop("labels")
        .join(found.withColumnRenamed("copies", "linked"), ["a", "b"], "left")
        .join(depths, ["a", "b"], "left")
        .select("a", "b", "copies", "least", "label", F.coalesce("texts", zero).alias("texts"), F.coalesce("linked", zero).alias("linked"), F.coalesce("depth", F.lit(sure_depth(threshold, recall, trees))).alias("depth"))
    )
    labelled = stage(labelled, "labelled")
    together = labelled.filter(F.col("label").isNotNull())
    classes = stage(together.groupBy(F.col("label").alias("c_label")).agg(F.min("least").alias("c_least"), F.count(F.lit(1)).alias("c_m")), "classes")
    columns = (F.col("a").alias("s_a"), F.col("b").alias("s_b"), "copies", "texts", "linked", "depth")
    joined = join_weighted(together, classes, F.col("label") == F.col("c_label"), "c_m").select(*columns, "c_least")
    return stage(joined.unionByName(labelled.filter(F.col("label").isNull()).select(*columns, F.col("least").alias("c_least"))), "grouped")


def _of_set() -> Column:
    return (F.col("a") == F.col("s_a")) & (F.col("b") == F.col("s_b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES) -> DataFrame:
    """The columns of docs (but text) with class_id, n_links, n_link_texts and depth.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least `threshold`; words
    are runs of ASCII letters and digits and of non-ASCII characters, in lower case, and a text of one to four words is
    one shingle. A link between different sets at the threshold itself is found with probability `recall`, more similar ones
    more surely; copies always. class_id is the smallest key of the connected component; n_links counts other documents linked
    to this one, n_link_texts the different shingle sets among them, depth is the prefix at which its set was
    compared (see the module). Texts without a word (null, empty) are linked to nothing, form their own class and have depth null. Keys of any
    sortable type; null keys count as the largest, and a component of null keys has class null. Repeated rows are copies of each other.
    Columns of docs named like the results are replaced; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    away, back = shelved(docs, ["class_id", "n_links", "n_link_texts", "depth", text])
    base = docs.select(*away, F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    names = stage(named(base, "_text", trees), "named")
    groups = _grouped(names, F.col("_key"), docs.select(F.col(f"`{text}`").alias("text")), threshold, recall, trees)
    rows = join_weighted(names.filter("n > 0").drop("n", "labels"), groups, _of_set(), "copies")
    zero = F.lit(0).cast("long")
    worded = rows.select(*back, F.col("c_least").alias("class_id"), (F.col("linked") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_link_texts"), "depth")
    return worded.unionByName(names.filter("n = 0").select(*back, F.col("_key").alias("class_id"), zero.alias("n_links"), zero.alias("n_link_texts"), F.lit(None).cast("int").alias("depth")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES) -> DataFrame:
    """The rows of docs that stay when one document of each class of `near_duplicates` stays: the one with the smallest
    key (nulls last), then the smallest hash of its text. Of rows equal in key and text one stays. Texts without a
    word all stay. Only the keys of those that go are joined to docs."""
    bounded_batches(docs.sparkSession)
    k, th = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))
    slim = docs.select(k.alias("k"), th.alias("th"), F.col(f"`{text}`").alias("text"))
    # filtered once it is written: a filter on what Python made would be pushed below it, and Python run twice, in two workers a task
    names = stage(named(slim, "text", trees), "named").filter("n > 0")
    order = F.struct(F.col("k").isNull().alias("none"), F.col("k").alias("k"), F.col("th").alias("th"))
    groups = _grouped(names, order, slim.select("text"), threshold, recall, trees)
    rows = join_weighted(names.select("k", "th", "a", "b"), groups.select("s_a", "s_b", "copies", "c_least"), _of_set(), "copies")
    stays = F.col("k").eqNullSafe(F.col("c_least.k")) & (F.col("th") == F.col("c_least.th"))
    # rows of a key and text, and whether one of them stays
    odd = rows.groupBy("k", "th").agg(F.count(F.lit(1)).alias("rows"), F.max(stays).alias("stays")).filter("rows > 1 or not stays")
    odd = stage(odd.select(F.col("k").alias("o_k"), F.col("th").alias("o_th"), "stays"), "odd")
    away, back = shelved(docs, [])
    whole = docs.select(*away, k.alias("k"), th.alias("th"))
    match = F.col("k").eqNullSafe(F.col("o_k")) & (F.col("th") == F.col("o_th"))
    once = whole.join(odd.filter("stays"), match).dropDuplicates(["o_k", "o_th"])
    return whole.join(odd, match, "left_anti").select(*back).unionByName(once.select(*back))
