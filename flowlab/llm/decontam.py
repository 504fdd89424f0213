"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a text with some edits. Cut into one piece more than the edits allowed, at least one piece occurs
unchanged. The first characters of every piece are hashed; one vectorised pass over whole texts hashes the window at every
character and looks it up, so exact hits of pieces say where to look, and Myers' bit-parallel edit distance verifies
the item there. Texts are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm import textops
from flowlab.llm.common import bounded_batches, frugal, shelved, stage

#: Characters of a piece, at least (of normalised text); an item of fewer than two pieces has no budget.
PIECE = 12
#: Characters of benchmark items sent to the tasks at once; a larger benchmark is matched in as many passes, one after another.
MOST_CHARS = 8_000_000


def normalised(text: Column) -> Column:
    """Lower case, every run of characters other than letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def budget(length: int, piece: int = PIECE) -> int:
    """The edits allowed for an item: as many as leave pieces of `piece` characters, about 8 %."""
    return max(1, length // piece) - 1


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance between the pattern and any substring of text, and where the first such
    one ends. One addition and a few bit operations on whole columns for each character (Myers 1999)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        rise = down | (full & ~(h | up))
        fall = up & h
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, i + 1
        rise, fall = rise << 1 & full, fall << 1 & full
        up = fall | (full & ~(x | rise))
        down = rise & x
    return best, end


_Q = np.uint64(0x9FB21C651E98DF25)
_Q_INVERSE = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))


class _Windows:
    """Hashes of windows of joined texts; a line feed, which normalised text does not hold, ends each."""

    def __init__(self, texts: list[str]):
        self.code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        n = len(self.code) + 1
        self._down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _Q_INVERSE)]))
        up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _Q)]))
        self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textops.mix(self.code.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.first = np.cumsum(size) - size

    def hashes(self, at: np.ndarray, width: int) -> np.ndarray:
        return textops.mix((self._sum[at + width] - self._sum[at]) * self._down[at])

    def starts(self, width: int) -> np.ndarray:
        """Every place of a window of full PIECE width; of narrower ones those that begin and end with words."""
        at = np.arange(max(0, len(self.code) - width))
        if width == PIECE:
            return at
        edge = self.code <= 32
        begins = np.concatenate([[True], edge[:-1]])
        return at[begins[at] & edge[at + width]]


@dataclass
class _Table:
    """Pieces by the hash of their window: sorted hashes with item, place in the item and end of the piece."""

    hashes: np.ndarray
    item: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    bits: int = 0
    map: np.ndarray | None = None

    def __post_init__(self):
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.item, self.lo, self.hi = self.hashes[order], self.item[order], self.lo[order], self.hi[order]
        self.bits = min(26, max(16, len(self.hashes).bit_length() + 5))
        self.map = np.zeros(1 << self.bits, bool)
        self.map[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into h, row of the table) of all equal hashes."""
        at = np.flatnonzero(self.map[(h >> np.uint64(64 - self.bits)).astype(np.int64)])
        lo, hi = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
        return np.repeat(at, hi - lo), textops.spread(lo, hi - lo)


@dataclass
class Matcher:
    """Finds items in texts. Items without a budget are found as whole words only."""

    items: list[tuple]

    def __post_init__(self):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for n, (_, t) in enumerate(self.items):
            parts = budget(len(t)) + 1
            for p in range(parts):
                rows.setdefault(min(PIECE, len(t)), []).append((n, len(t) * p // parts, len(t) * (p + 1) // parts))
        every = _Windows([t for _, t in self.items])
        self.tables = {}
        for width, pieces in rows.items():
            item, lo, hi = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
            self.tables[width] = _Table(every.hashes(every.first[item] + lo, width), item, lo, hi)

    def find(self, texts: list[str]) -> list[list[tuple]]:
        """For each text (item id, distance, end) of each item that occurs, at its best match."""
        out: list[list[tuple]] = [[] for _ in texts]
        windows = _Windows(texts)
        starts: dict[tuple[int, int], list[int]] = {}
        for width, table in self.tables.items():
            at = windows.starts(width)
            hit, row = table.hits(windows.hashes(at, width))
            place = at[hit]
            owner = np.searchsorted(windows.first, place, "right") - 1
            for k, i, r in zip(owner.tolist(), (place - windows.first[owner]).tolist(), row.tolist(), strict=True):
                n, lo, hi = int(table.item[r]), int(table.lo[r]), int(table.hi[r])
                if texts[k][i : i + hi - lo] == self.items[n][1][lo:hi]:
                    starts.setdefault((k, n), []).append(i - lo)
        for (k, n), places in sorted(starts.items()):
            if found := self._verified(texts[k], self.items[n][1], sorted(places)):
                out[k].append((self.items[n][0], *found))
        return out

    def _verified(self, text: str, pattern: str, starts: list[int]) -> tuple[int, int] | None:
        k, m = budget(len(pattern)), len(pattern)
        if not k:
            for s in starts:
                if (s == 0 or text[s - 1] == " ") and text[s + m : s + m + 1] in ("", " "):
                    return 0, s + m
            return None
        best = None
        for lo, hi in self._spans(starts, m, k, len(text)):
            d, end = best_match(pattern, text[lo:hi])
            if d <= k and (best is None or d < best[0]):
                best = (d, lo + end)
        return best

    @staticmethod
    def _spans(starts: list[int], m: int, k: int, n: int) -> Iterator[tuple[int, int]]:
        """Where a match can lie for the given places of the item's start; overlapping spans are one."""
        lo = hi = -1
        for s in starts:
            a, z = max(0, s - k), min(n, s + m + k)
            if a <= hi:
                hi = max(hi, z)
            else:
                if hi > lo:
                    yield lo, hi
                lo, hi = a, z
        if hi > lo:
            yield lo, hi


_matchers: dict[str, Matcher] = {}


def _matcher(name: str, items: list[tuple]) -> Matcher:
    """One matcher per worker and benchmark part."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(items)
    return _matchers[name]


def _kind(benchmark: DataFrame, item: str) -> str:
    """Integer ids stay integers; all others are given as text."""
    return "bigint" if isinstance(benchmark.schema[item].dataType, T.IntegralType) else "string"


def _item_parts(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The items in parts of about MOST_CHARS / 2 characters, one after another."""
    items = stage(benchmark.select(F.col(f"`{item}`").cast(_kind(benchmark, item)).alias("id"), normalised(F.col(f"`{text}`")).alias("t")).filter(F.col("id").isNotNull() & (F.col("t") != "")).distinct(), "items")
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    parts = max(1, -(-total // (MOST_CHARS // 2)))
    for p in range(parts):
        yield [(r["id"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(parts)) == p).orderBy("id", "t").collect()]


def _finder(sent: Broadcast, kind: str):
    name = uuid.uuid4().hex

    @frugal
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = _matcher(name, sent.value)
        for batch in batches:
            out = []
            for _, part in textops.slices(list(batch)):
                out += [[{"item_id": i, "distance": d, "end": e} for i, d, e in hits] for hits in matcher.find([t.decode() for t in part])]
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(find, f"array<struct<item_id:{kind},distance:int,end:int>>")


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The columns of docs with hits: array of struct<item_id,distance,end>, one for each benchmark item that occurs in the
    text with at most `budget` edits; end is the place behind the match in the normalised text.

    Both sides are compared in normalised form. Items of fewer than 24 normalised characters have no budget and are found
    as whole words. Items with a null id or without a letter or digit are ignored; an item listed twice is matched once
    per different text. Ids that are no integers are given as text. Null and empty texts have no hits. Repeated rows are each matched. A
    column of docs named hits is replaced. Empty tables give no rows or no hits. Whole texts are searched.

    A benchmark of up to MOST_CHARS / 2 characters is one broadcast and one pass. A larger one is matched part by part: the
    hits of a part are written under the hash of their text before the next part is sent, and joined to docs at the end.
    """
    away, back = shelved(docs, ["hits"])
    spark, kind = docs.sparkSession, _kind(benchmark, item)
    bounded_batches(spark)
    parts = _item_parts(benchmark, item, item_text)
    base = docs.select(*away, normalised(F.col(f"`{text}`")).alias("_t"))
    first, second = next(parts), next(parts, None)
    if second is None:
        return base.withColumn("hits", _finder(spark.sparkContext.broadcast(first), kind)("_t")).select(*back, "hits")
    found = None
    for items in chain((first, second), parts):
        found = _part_hits(base, items, kind, found)
    each = found.groupBy("f_id").agg(F.flatten(F.collect_list("hits")).alias("f_hits"))
    keyed = base.withColumn("t_id", F.sha2("_t", 256))
    none = F.array().cast(f"array<struct<item_id:{kind},distance:int,end:int>>")
    return keyed.join(each, F.col("t_id") == F.col("f_id"), "left").select(*back, F.coalesce("f_hits", none).alias("hits"))


def _part_hits(base: DataFrame, items: list[tuple], kind: str, before: DataFrame | None) -> DataFrame:
    """before with (f_id, hits) of one part of the benchmark: a row for each different text with a hit."""
    sent = base.sparkSession.sparkContext.broadcast(items)
    hit = base.select("_t").withColumn("hits", _finder(sent, kind)("_t")).filter(F.size("hits") > 0)
    now = stage(hit.select(F.sha2("_t", 256).alias("f_id"), "hits").dropDuplicates(["f_id"]), "hits")
    sent.unpersist()
    return now if before is None else before.unionByName(now)


def contaminations(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """A row for each document and item of `with_hits`: the columns of docs (but text) with item_id, distance and end."""
    text = names.get("text", "text")
    own = (text, "item_id", "distance", "end")
    away, back = shelved(docs, own)
    found = with_hits(docs.select(*away, F.col(f"`{text}`").alias("text")), benchmark, **{k: v for k, v in names.items() if k != "text"})
    return found.withColumn("hit", F.explode("hits")).select(*back, "hit.item_id", "hit.distance", "hit.end")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of docs in which no benchmark item occurs."""
    away, back = shelved(docs, [])
    text = names.pop("text", "text")
    found = with_hits(docs.select(*away, F.col(f"`{text}`").alias("text")), benchmark, **names)
    return found.filter(F.size("hits") == 0).select(*back)
