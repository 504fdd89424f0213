"""Line dedup by a deletion-neighbourhood join, edits counted in words, or for lines of few words in characters.

Two lines are near if one word (or character) inserted, removed or replaced turns one into the other. Every line emits
hashed keys of its variants with one of them left out; lines meet on equal variants, the edit distance of those that meet
is verified on their words (or characters), and only the earliest line stays.

Emitting variants of all lines would move several times the input, so a pigeonhole test goes first: near lines share
their first or their last half (in words or characters). Only lines that share a half with another line emit variants. Which halves
are shared is sent to the tasks as a Bloom filter of bounded size: a false hit emits variants for nothing, no line is
missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm import bloom, textops
from flowlab.llm.common import bounded_batches, frugal, shelved, stage, whole_key
from flowlab.llm.skew import join_weighted

#: Defaults: words from which near lines are compared by words, and characters from which lines of fewer words are by characters.
NEAR_WORDS, NEAR_CHARACTERS = 8, 24

_Q = np.uint64(0xD6E8FEB86659FD93)
_CHARACTERS = np.uint64(0xA0761D6478BD642F)  # keys of characters do not meet those of words
_Q_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))

#: Halves of words (h), of characters (c); NO_HALF where a line has none.
HALVES = [f"{k}{i}" for k in "hc" for i in range(4)]
LINES = "doc_id bigint, th bigint, pos int, a bigint, b bigint, " + ", ".join(f"{h} bigint" for h in HALVES)
NO_HALF = 0
#: Stands for a null key, and comes before every other.
NO_KEY = -(1 << 63)


class _Lines:
    """The lines of some texts as ranges of word hashes with sums of hash * Q^position; `short` gives some of them as ranges of
    character hashes. `text` and `pos` say where a line is, `index` is its number among the lines of the texts that have a word."""

    def __init__(self, texts: list[bytes]):
        h, text, line, first, last = textops.words(texts, textops.NOT_SPACE, places=True)
        new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (line[1:] != line[:-1])])) if len(h) else np.zeros(0, np.int64)
        self._texts = texts
        self._first, self._last = first[new], last[np.concatenate([new[1:], [len(h)]]) - 1] if len(h) else new
        self.salt = np.uint64(0)
        self.text, self.pos, self.index = text[new], line[new], np.arange(len(new))
        self._summed(h, new)

    def of_words(self, least: int) -> _Lines:
        """The lines of at least `least` words."""
        out = copy(self)
        keep = self.n >= least
        out.start, out.n, out.text, out.pos, out.index = self.start[keep], self.n[keep], self.text[keep], self.pos[keep], self.index[keep]
        return out

    def short(self, least: int, most_words: int) -> _Lines:
        """The lines of at most `most_words` words and at least `least` characters, in characters. Only these lines are decoded."""
        at = np.flatnonzero((self.n <= most_words) & (self._last - self._first >= least))
        joined = b"\n".join([*self._texts, b""])
        code, line, _ = textops.characters([joined[a:z] for a, z in zip(self._first[at].tolist(), self._last[at].tolist(), strict=True)])
        new = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(code) else np.zeros(0, np.int64)
        out = copy(self)
        out.salt = _CHARACTERS
        out.index = self.index[at]
        out.text, out.pos = self.text[at], self.pos[at]
        out._summed(textops.mix(code.astype(np.uint64) + np.uint64(1)), new)
        keep = out.n >= least
        out.start, out.n, out.text, out.pos, out.index = out.start[keep], out.n[keep], out.text[keep], out.pos[keep], out.index[keep]
        return out

    def _summed(self, h: np.ndarray, new: np.ndarray) -> None:
        count = np.diff(np.concatenate([new, [len(h)]]))
        self.start, self.n = new, count
        self.words = h
        self.at = np.arange(len(h)) - np.repeat(new, count)  # position in the line
        longest = int(count.max()) if len(count) else 0
        self.up, self.down = (np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(longest + 1, q))]) for q in (_Q, _Q_INVERSE))
        self.sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[self.at], dtype=np.uint64)])

    def part(self, first: np.ndarray, count: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Hash of `count` words from word `first` of each line."""
        s = self.start[line] + first
        return textops.mix((self.sum[s + count] - self.sum[s]) * self.down[first] + count.astype(np.uint64)) ^ self.salt

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name the line's words."""
        every = np.arange(len(self.n))
        a = self.part(np.zeros_like(self.n), self.n, every)
        other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textops.mix(self.words) * self.up[self.at], dtype=np.uint64)])
        return a, textops.mix(other[self.start + self.n] - other[self.start] + self.n.astype(np.uint64))

    def halves(self) -> np.ndarray:
        """(lines, 4): hashes of the first and last words (characters) that a near line of equal, greater or smaller length shares."""
        every, zero = np.arange(len(self.n)), np.zeros_like(self.n)
        out = []
        for h in (self.n // 2, (self.n - 1) // 2):
            out += [self.part(zero, h, every), textops.mix(self.part(self.n - h, h, every))]
        return np.stack(out, 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _line_rows(near_words: int, near_characters: int):
    """LINES of each text."""

    @frugal
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, hashes = pdf["doc_id"].to_numpy(), pdf["th"].to_numpy()
            for first, part in textops.slices(list(pdf["text"])):
                lines = _Lines(part)
                if len(lines.n):
                    a, b = lines.ids()
                    at = first + lines.text
                    halves = np.full((len(at), 8), NO_HALF, np.int64)
                    long, short = lines.of_words(near_words), lines.short(near_characters, near_words)
                    halves[long.index, :4] = _signed(long.halves())
                    halves[short.index, 4:] = _signed(short.halves())
                    yield pd.DataFrame({"doc_id": ids[at], "th": hashes[at], "pos": lines.pos, "a": _signed(a), "b": _signed(b)} | dict(zip(HALVES, halves.T, strict=True)))

    return rows


VARIANTS = "a bigint, doc_id bigint, th bigint, pos int, kind int, left bigint, place int, words array<bigint>"


def _variants(lines: _Lines, names: np.ndarray, table: np.ndarray, bits: int, doc: np.ndarray, ids: np.ndarray, hashes: np.ndarray, kind: int) -> pd.DataFrame | None:
    """VARIANTS of the lines that may share a half with another one; names: the hash that names each line, doc: its row of ids and hashes."""
    if not len(lines.n):
        return None
    hit = bloom.hits(table, bits, lines.halves())
    front, back = hit[:, 0] | hit[:, 2], hit[:, 1] | hit[:, 3]
    at = np.flatnonzero(front | back)
    if not len(at):
        return None
    order = at[np.lexsort((lines.pos[at], hashes[doc[at]], ids[doc[at]], names[at]))]
    at = order[np.concatenate([[True], names[order[1:]] != names[order[:-1]]])]
    n = lines.n[at]
    # a shared front leaves the difference to the back half, and the other way round
    lo, hi = np.where(back[at], 0, (n - 1) // 2), np.where(front[at], n, n - (n - 1) // 2)
    line, place = np.repeat(at, hi - lo), textops.spread(lo, hi - lo)
    s = lines.start[line]
    head = lines.sum[s + place] - lines.sum[s]
    tail = (lines.sum[s + lines.n[line]] - lines.sum[s + place + 1]) * lines.down[1]
    left = textops.mix(head + tail + (lines.n[line] - 1).astype(np.uint64)) ^ lines.salt
    who = np.concatenate([at, line])
    return pd.DataFrame({
        "a": _signed(names[who]), "doc_id": ids[doc[who]], "th": hashes[doc[who]], "pos": lines.pos[who], "kind": np.repeat([kind, kind + 1], [len(at), len(line)]),
        "left": np.concatenate([_signed(lines.part(np.zeros_like(at), n, at)), _signed(left)]), "place": np.concatenate([np.full(len(at), -1), place]),
        "words": [*(_signed(lines.words[lines.start[i] : lines.start[i] + lines.n[i]]) for i in at), *[None] * len(line)],
    })


def _variant_rows(table: np.ndarray, bits: int, near_words: int, near_characters: int):
    """For each line that may share a half with another one: its words and their hash (kind 0), and for each word of the half
    that is not shared a hash of what is left without it, with its place (kind 1); the same in characters (kinds 2 and 3). Of
    equal lines in a batch the earliest is used."""

    @frugal
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, hashes = pdf["doc_id"].to_numpy(), pdf["th"].to_numpy()
            for first, part in textops.slices(list(pdf["text"])):
                every = _Lines(part)
                if not len(every.n):
                    continue
                names, _ = every.ids()
                for kind, lines in ((0, every.of_words(near_words)), (2, every.short(near_characters, near_words))):
                    made = _variants(lines, names[lines.index], table, bits, first + lines.text, ids, hashes, kind)
                    if made is not None:
                        yield made

    return rows


def _within_one(x: Column, y: Column) -> Column:
    """Whether one element inserted, removed or replaced turns array x into y: what stands before the first difference and
    what stands behind the last one must leave at most one element of either. Arrays are compared as wholes, in the JVM."""
    n, m = F.size(x), F.size(y)
    most = F.least(n, m)
    place = F.coalesce(F.get(F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: F.get(x, i - 1) != F.get(y, i - 1)), F.lit(0)), most + 1)

    def rest(c: Column, first: Column) -> Column:
        return F.slice(c, first, F.greatest(F.size(c) - first + 1, F.lit(0)))

    return (
        F.when(F.abs(n - m) > 1, False)
        .when(n == m, rest(x, place + 1) == rest(y, place + 1))
        .when(n > m, rest(x, place + 1) == rest(y, place))
        .otherwise(rest(x, place) == rest(y, place + 1))
    )


def _order() -> Column:
    """(doc_id, th, pos) as one number, so that sums by it stay in hash aggregation: the lowest 10 digits for pos, 8 for th."""
    low = F.pmod(F.col("th"), F.lit(100_000_000)) * F.lit(10_000_000_000) + F.col("pos")
    return (F.col("doc_id").cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def near_removed(docs: DataFrame, distinct: DataFrame, near_words: int, near_characters: int) -> DataFrame:
    """(a, by): lines with an earlier line within one word or character, and one such line. docs: doc_id, th, text; distinct: a
    and HALVES, one row per distinct line."""
    halves = distinct.select("a", F.explode(F.array(*HALVES)).alias("half")).filter(F.col("half") != NO_HALF)
    shared = halves.groupBy("half").agg(F.min("a").alias("x"), F.max("a").alias("y")).filter("x <> y").select("half")
    table, bits = bloom.build(stage(shared, "halves"), "half")
    sent = docs.sparkSession.sparkContext.broadcast(table)
    # broadcast values are opened in the tasks
    made = docs.mapInPandas(lambda it: _variant_rows(sent.value, bits, near_words, near_characters)(it), VARIANTS)
    rows = stage(made.select("a", _order().alias("o"), "kind", "left", "place", "words"), "variants")
    whole = rows.filter("kind % 2 = 0").groupBy("a", "left").agg(F.min("o").alias("o"))
    variants = rows.filter("kind % 2 = 1").select("left", "place", "a", "o", (F.col("kind") - 1).alias("of"))
    # Lines that agree but for the word (character) at one place differ by a replacement. Each such group is summed up by its earliest
    # line, so no pairs within a group arise; nearly all variants occur once and go here.
    groups = variants.groupBy("left", "place").agg(F.min_by("a", "o").alias("by"), F.min("o").alias("by_o"), F.min("a").alias("lo"), F.max("a").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi")
    # one common variant is not one task
    groups = stage(groups.select(F.col("left").alias("g_left"), F.col("place").alias("g_place"), "by", "n"), "variant-groups")
    replaced = join_weighted(variants, groups, (F.col("left") == F.col("g_left")) & (F.col("place") == F.col("g_place")), "n").filter("a <> by").select("a", "by", "of")
    # A line that equals what is left of another one differs by an insertion; the later of the two goes.
    short = whole.select("left", F.col("a").alias("s"), F.col("o").alias("s_o"))
    inserted = variants.drop("o").join(short, "left").join(whole.groupBy("a").agg(F.min("o").alias("t_o")), "a")
    later = F.col("t_o") > F.col("s_o")
    longer = inserted.select(F.when(later, F.col("a")).otherwise(F.col("s")).alias("a"), F.when(later, F.col("s")).otherwise(F.col("a")).alias("by"), "of")
    found = replaced.unionByName(longer).groupBy("a", "of").agg(F.min("by").alias("by"), F.max("by").alias("by2"))
    pairs = stage(found.select("a", "of", F.explode(F.array_distinct(F.array("by", "by2"))).alias("by")), "pairs")
    needed = pairs.select("a", "of").union(pairs.select("by", "of")).distinct()
    own = rows.filter("kind % 2 = 0").select("a", F.col("kind").alias("of"), "words")
    words = stage(own.join(needed, ["a", "of"], "left_semi").groupBy("a", "of").agg(F.first("words").alias("words")), "words")
    partner = words.select(F.col("a").alias("by"), "of", F.col("words").alias("by_words"))
    return pairs.join(words, ["a", "of"]).join(partner, ["by", "of"]).filter(_within_one(F.col("words"), F.col("by_words"))).select("a").distinct()


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", near_words: int = NEAR_WORDS, near_characters: int = NEAR_CHARACTERS) -> DataFrame:
    """The columns of docs with text rewritten, n_lines (before) and removed array<int> (numbers of the lines removed,
    from 0). A line goes if its words, in order, equal those of an earlier line; if it has at least `near_words` words and an
    earlier line of as many is within one word of it; or if it has at least `near_characters` characters (one space between
    words), an earlier line of as many is within one character of it, and one of the two has fewer than `near_words` words.
    A great `near_words` counts edits of all lines in characters, a small `near_characters` compares shorter lines. Earlier is:
    by key, then by a hash of the text, then by place.

    Lines are what line feeds separate; words are what ASCII white space separates. Lines without a word always
    stay. A line also goes if the earlier line near it goes itself. Null texts stay null with no lines; null keys
    come first, and keys may be of any sortable type. Rows that agree in key and text are one document and all get its result. Columns of docs named n_lines
    or removed are replaced; an empty table gives an empty result.
    """
    t = F.col("t")
    bounded_batches(docs.sparkSession)
    away, back = shelved(docs, ["n_lines", "removed"])
    base = whole_key(docs.select(*away, F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("t"), F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0)).alias("th")), "_key", "_k")
    base = base.withColumn("k", F.coalesce("_k", F.lit(NO_KEY)))
    slim = base.select(F.col("k").alias("doc_id"), "th", F.col("t").alias("text"))
    lines = stage(slim.mapInPandas(_line_rows(near_words, near_characters), LINES).withColumn("o", _order()), "lines")
    half = [F.first(h).alias(h) for h in HALVES]
    distinct = stage(lines.groupBy("a", "b").agg(F.min("o").alias("first"), F.max("o").alias("last"), F.count(F.lit(1)).alias("n"), *half), "distinct")
    near = near_removed(slim, distinct, near_words, near_characters).select(F.col("a").alias("near_a"), F.lit(True).alias("near"))
    # only lines that occur again or go need be looked up; a line that a great part of all documents holds is not one task
    gone = distinct.join(near, F.col("a") == F.col("near_a"), "left").filter(F.col("near") | (F.col("first") != F.col("last")))
    gone = stage(gone.select(F.col("a").alias("g_a"), F.col("b").alias("g_b"), "first", "near", "n"), "gone")
    met = join_weighted(lines.select("doc_id", "th", "pos", "o", "a", "b"), gone, (F.col("a") == F.col("g_a")) & (F.col("b") == F.col("g_b")), "n")
    dropped = met.filter(F.col("near") | (F.col("o") != F.col("first"))).groupBy(F.col("doc_id").alias("d_id"), F.col("th").alias("d_th")).agg(F.sort_array(F.collect_set("pos")).alias("d_pos"))
    # texts are matched by hashing, not sorted
    joined = base.drop("_key", "_k").join(dropped.hint("shuffle_hash"), (F.col("k") == F.col("d_id")) & (F.col("th") == F.col("d_th")), "left")
    split = joined.withColumn("parts", F.when(F.col("d_pos").isNotNull(), F.split("t", "\n", -1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("d_pos"))
    new = F.when(F.col("d_pos").isNull(), t).otherwise(F.array_join(F.transform(kept, lambda i: F.get("parts", i)), "\n"))
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "removed")]
    n_lines = F.when(t.isNull(), 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("int")
    own = [n_lines.alias("n_lines"), F.coalesce("d_pos", F.array().cast("array<int>")).alias("removed")]
    return split.select(*[new.alias(c) if c == text else b for c, b in zip(order, back, strict=True)], *own)
