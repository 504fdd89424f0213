"""Best-fit packing of documents into sequences of a fixed number of tokens, by linear grouping.

Documents are encoded and cut where they stand; of each piece only its length matters from there on, and there are at most as
many lengths as a sequence has tokens. So the corpus is brought down to a histogram, a table whose size is bounded by the capacity
and not by the data, and for that table the packing is decided:

1. Large lengths, ordered, are cut into groups of equal cardinality, and every length is rounded up to the largest of its group.
2. How many sequences of each configuration (a multiset of group sizes that fits) to fill is a linear programme over the few sizes; its
   columns are generated as needed by a knapsack, and its solution is rounded down.
3. The actual lengths of a group take the places that configurations have for it.
4. What rounding down left over, and then the small lengths, longest first, go where they fit best.

The result is a list of runs: the pieces of one length with ranks from a to b lie in sequences from s on, at one offset. Every piece learns its
rank among those of its length from counts by task, and finds its run by a binary search. No documents meet in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowlab.llm.bpe import CERTAIN, VOCABULARY, TreeEncoder, encoder
from flowlab.llm.common import bounded_batches, frugal, read_bytes, stage

CAPACITY = 2048
#: The tokenizer's one special token and its id (the tokenizer knows it in texts), and the id that ends a document.
SPECIAL, SPECIAL_ID, END = "<|endoftext|>", 50256, 0
#: Characters that are encoded at once; a longer stretch without a certain border is taken whole.
STRETCH = 1 << 16
#: Tried one after another until the number of sequences is the least possible: (lengths above capacity / share are large, groups). Where
#: few lengths are small, a lower bound on what is large wastes what rounding up leaves free: (8, 48) took 1 % more sequences.
SETTINGS = [(3, 192), (3, 384), (2, 64)]


# -- pieces -----------------------------------------------------------------------------------------------------------


def encode(tree: TreeEncoder, text: str) -> np.ndarray:
    """The ids of a text, as the `tokenizers` library gives them without adding special tokens, and END."""
    out = []
    for i, part in enumerate(text.split(SPECIAL)):
        if i:
            out.append(np.array([SPECIAL_ID], "<u4"))
        lo = 0
        while lo < len(part):
            hi = lo + STRETCH
            while hi < len(part):
                last = None
                for last in CERTAIN.finditer(part, max(lo, hi - 1024), hi + 1):
                    pass
                if last:
                    hi = last.start() + 1
                    break
                hi += STRETCH
            out.append(np.array(tree.encode(part[lo:hi]), "<u4"))
            lo = hi
    return np.concatenate([*out, np.array([END], "<u4")])


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: the key, piece (from 0), start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), part and nth (the task, and the place among its pieces of that length), and with_ids the ids.

    A document of at most `capacity` tokens, its END included, is one piece; a longer one is cut into pieces of capacity, of which the first takes
    the remainder. Null texts count as empty: one piece, of END alone. Repeated rows and null keys are documents of their own. Other
    columns are not carried. The vocabulary is that of byte_bpe_50k.json, read from its tiktoken form at `path`. Whoever reads the
    result twice must write it first, as part and nth belong to one run."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks = spark.sparkContext.broadcast(read_bytes(path or public_tokenizers.path(VOCABULARY)))
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint" + (", ids array<int>" if with_ids else "")
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, part, met = encoder(ranks.value), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows, owner = [], []
            for i, t in enumerate(batch[1]):
                ids = encode(tree, t.as_py() or "")
                first = len(ids) % capacity or capacity
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, end - (capacity if piece else first))
                    own = ids[start:end]
                    rows.append((piece, start, len(own), zlib.crc32(own.tobytes()), part, met[len(own)], *([own.astype(np.int32)] if with_ids else [])))
                    owner.append(i)
                    met[len(own)] += 1
            if rows:
                made = [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch[0].take(pa.array(owner)), *made], schema=schema)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(cut, ddl)


# -- the plan: a bounded problem ----------------------------------------------------------------------------------------


@dataclass
class Alike:
    """`count` sequences with the same lengths in the same order, and what is free in each."""

    count: int
    free: int
    lengths: list[int] = field(default_factory=list)


def groups_of(counts: np.ndarray, least: int, n_groups: int) -> list[list[tuple[int, int]]]:
    """Linear grouping: [(length, how many), ...] of each group, longest first; groups hold equally many, and a length that begins two groups joins them."""
    lengths = [v for v in range(len(counts) - 1, least - 1, -1) if counts[v]]
    each = -(-sum(int(counts[v]) for v in lengths) // n_groups) if lengths else 0
    out: list[list[tuple[int, int]]] = []
    room = 0
    for v in lengths:
        left = int(counts[v])
        while left:
            if not room:
                room = each
                if not out or out[-1][0][0] != v:
                    out.append([])
            take = min(room, left)
            if out[-1] and out[-1][-1][0] == v:
                out[-1][-1] = (v, out[-1][-1][1] + take)
            else:
                out[-1].append((v, take))
            left, room = left - take, room - take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[int, np.ndarray]]:
    """(sequences, how many of each size) of a best fractional solution, rounded down: the cutting-stock programme by column generation."""
    s, need = np.array(sizes), np.array(demand, float)
    basis = np.diag(capacity // s).astype(float)
    most = int(capacity // s.min())
    at = np.arange(capacity + 1)[:, None] - s[None, :]
    outside = at < 0
    at = np.maximum(at, 0)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(len(s)))
        # the most valuable configuration: a knapsack by number of items
        value, picks = np.zeros(capacity + 1), []
        best, best_k = 1 + 1e-9, -1
        for k in range(most):
            each = np.where(outside, -np.inf, value[at] + price)
            pick = each.argmax(1)
            value = each[np.arange(capacity + 1), pick]
            picks.append(pick)
            if value[-1] > best:
                best, best_k = value[-1], k
        if best_k < 0:
            break
        column, w = np.zeros(len(s)), capacity
        for k in range(best_k, -1, -1):
            g = picks[k][w]
            column[g] += 1
            w -= s[g]
        x, d = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, ratio.argmin()] = column
    x = np.linalg.solve(basis, need)
    return [(int(np.floor(n + 1e-6)), basis[:, j].round().astype(int)) for j, n in enumerate(x) if n >= 1 - 1e-6]


def _substituted(groups: list[list[tuple[int, int]]], chosen: list[tuple[int, np.ndarray]], capacity: int) -> tuple[list[Alike], dict[int, int]]:
    """Sequences with actual lengths in place of group sizes, and the pieces for which there was no place."""
    left = [list(g) for g in groups]
    out = []
    for count, column in chosen:
        takers = [g for g, n in enumerate(column) for _ in range(n)]
        done = 0
        runs = []  # for each place: [(length, how many)] over the sequences
        for g in takers:
            run, want = [], count
            while want and left[g]:
                length, n = left[g][0]
                take = min(n, want)
                run.append((length, take))
                want -= take
                left[g][0] = (length, n - take)
                if n == take:
                    left[g].pop(0)
            runs.append(run + [(0, want)] * bool(want))
        while done < count:
            step = min(r[0][1] for r in runs)
            own = [r[0][0] for r in runs if r[0][0]]
            out.append(Alike(step, capacity - sum(own), own))
            for r in runs:
                r[0] = (r[0][0], r[0][1] - step)
                if not r[0][1]:
                    r.pop(0)
            done += step
    rest: dict[int, int] = defaultdict(int)
    for g in left:
        for length, n in g:
            rest[length] += n
    return [a for a in out if a.lengths], rest


def _best_fit(alike: list[Alike], rest: dict[int, int], capacity: int) -> list[Alike]:
    """Longest first, each piece to the sequence with the least room that takes it; equal sequences move together."""
    by_free: list[list[Alike]] = [[] for _ in range(capacity + 1)]
    for a in alike:
        by_free[a.free].append(a)
    for length in sorted(rest, reverse=True):
        left, free = rest[length], length
        while left:
            while free <= capacity and not by_free[free]:
                free += 1
            if free > capacity:  # new sequences
                by_free[capacity].append(Alike(-(-left // (capacity // length)), capacity))
                free = capacity
            a = by_free[free].pop()
            # after a piece the same sequence has the least room, until no other piece goes in
            k = min(free // length, left)
            n = min(a.count, left // k)
            if n < a.count:
                by_free[free].append(Alike(a.count - n, free, list(a.lengths)))
            by_free[free - k * length].append(Alike(n, free - k * length, a.lengths + [length] * k))
            left -= n * k
    return [a for of in by_free for a in of if a.lengths]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Alike]:
    """Sequences for counts[length] pieces of every length up to capacity. The best of SETTINGS; the first that reaches the least possible number is it."""
    counts = np.asarray(counts, np.int64)
    full = [Alike(int(counts[capacity]), 0, [capacity])] if counts[capacity] else []
    open_ = counts.copy()
    open_[capacity] = 0
    tokens = int((open_ * np.arange(capacity + 1)).sum())
    least = max(-(-tokens // capacity), int(open_[capacity // 2 + 1 :].sum()))
    best: list[Alike] | None = None
    for share, n_groups in SETTINGS:
        groups = groups_of(open_, capacity // share + 1, n_groups)
        small = {v: int(open_[v]) for v in range(1, capacity // share + 1) if open_[v]}
        chosen = configurations([g[0][0] for g in groups], [sum(n for _, n in g) for g in groups], capacity) if groups else []
        alike, rest = _substituted(groups, chosen, capacity)
        out = _best_fit(alike, rest | small, capacity)
        if best is None or sum(a.count for a in out) < sum(a.count for a in best):
            best = out
        if sum(a.count for a in best) <= least:
            break
    return full + (best or [])


def runs(alike: list[Alike], capacity: int = CAPACITY) -> pd.DataFrame:
    """length, rank, sequence, offset: from this rank (among the pieces of that length) on, one piece goes to each sequence from that
    number on, at that offset, up to the next run of the length."""
    rows, met, sequence = [], defaultdict(int), 0
    for a in alike:
        offset = 0
        for length in a.lengths:
            rows.append((length, met[length], sequence, offset))
            met[length] += a.count
            offset += length
        sequence += a.count
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


# -- all pieces --------------------------------------------------------------------------------------------------------


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of written `pieces` (but part and nth) with sequence_id and offset (bigints): every piece has a place, in each sequence they follow
    each other without a gap, and no sequence has more than capacity tokens. An empty table has no sequence.

    The histogram that is collected has a row for each length, so at most `capacity`; the runs that are broadcast are bounded likewise."""
    of_task = cut.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task and length
    bases = stage(of_task.select(F.col("length").alias("b_length"), F.col("part").alias("b_part"), "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in bases.groupBy("b_length").agg(F.sum("n").alias("n")).collect():
        counts[r["b_length"]] = r["n"]
    found = runs(plan(counts, capacity), capacity)
    first = np.concatenate([[0], np.cumsum(counts)])  # of each length, in the order of runs
    places = cut.sparkSession.sparkContext.broadcast((first, (first[found["length"].to_numpy(np.int64)] + found["rank"].to_numpy(np.int64)), found["sequence"].to_numpy(np.int64), found["offset"].to_numpy(np.int64)))

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        starts, begin, sequence, offset = places.value
        at = starts[length.to_numpy(np.int64)] + rank.to_numpy(np.int64)
        run = np.searchsorted(begin, at, "right") - 1
        return pd.DataFrame({"sequence_id": sequence[run] + at - begin[run], "offset": offset[run]})

    met = cut.join(bases, (F.col("length") == F.col("b_length")) & (F.col("part") == F.col("b_part")))
    kept = [c for c in cut.columns if c not in ("part", "nth")]
    return met.withColumn("__at", placed("length", F.col("base") + F.col("nth"))).select(*[F.col(f"`{c}`") for c in kept], "__at.*")
