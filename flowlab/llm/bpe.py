"""Byte-level BPE as a monoid tree reduction.

A text is halved down to leaves; leaves are encoded on their own, and two neighbours are joined by encoding again only
a window around their border. The window grows until both its ends stand where the encoding provably cannot depend on
what lies beyond:

* Between pieces (what the tokenizer's pattern matches): no alternative of the pattern matches a non-space followed by
  white space, so a border always stands there, whatever the context. Tokens left of the last such place before the
  join, and right of the first one after it, stay.
* Inside one very long piece: a sequence of tokens is the encoding of its bytes exactly if every adjacent pair of tokens
  is the encoding of the pair's own bytes. The window of tokens at the join is encoded again until the pairs at both
  of its ends pass that test.

Every node of the tree therefore holds exactly the encoding of its stretch of text. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import bounded_batches, frugal, others, read_bytes, shelved

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters in a leaf; bytes in a leaf of one long piece; the first window at a join, in characters and in tokens.
LEAF_CHARS, LEAF_BYTES, FIRST_CHARS, FIRST_TOKENS = 512, 1024, 64, 4

#: A place where a border between pieces is certain: a printable character, then a space or line feed.
CERTAIN = re.compile("[!-~À-ɏ][ \n]")


class TreeEncoder:
    """Encodes and decodes one text at a time; `ranks` is the content of a tiktoken file."""

    def __init__(self, ranks: bytes, pattern: str = public_tokenizers.PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self._base = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._one = tiktoken.Encoding("byte-bpe-piece", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})  # all of a text is one piece
        self._pieces = regex.compile(pattern)
        self.bytes_of = {v: k for k, v in table.items()}
        self.text_of = {v: str(v) for v in table.values()}
        self._length = {v: len(k) for k, v in table.items()}

    # -- a stretch of text ------------------------------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._node(text, 0, len(text)) if text else []

    def _node(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= LEAF_CHARS:
            return self._base.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        left, right = self._node(text, lo, mid), self._node(text, mid, hi)
        return self._join(text, lo, mid, hi, left, right)

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        start, end = self._certain_before(text, lo, mid), self._certain_after(text, mid, hi)
        drop, size = 0, len(text[start:mid].encode())
        while size > 0:
            drop += 1
            size -= self._length[left[-drop]]
        skip, size = 0, len(text[mid:end].encode())
        while size > 0:
            size -= self._length[right[skip]]
            skip += 1
        window = text[start:end]
        middle = self._base.encode_ordinary(window) if len(window) <= 2 * LEAF_CHARS else self._by_piece(window)
        del left[len(left) - drop :]
        left += middle
        left += right[skip:] if skip else right
        return left

    @staticmethod
    def _certain_before(text: str, lo: int, mid: int) -> int:
        """The last certain border in (lo, mid], looked for in a growing window, or lo."""
        width = FIRST_CHARS
        while True:
            at = max(lo, mid - width)
            last = None
            for last in CERTAIN.finditer(text, at, min(mid + 1, len(text))):
                pass
            if last:
                return last.start() + 1
            if at == lo:
                return lo
            width *= 2

    @staticmethod
    def _certain_after(text: str, mid: int, hi: int) -> int:
        """The first certain border in [mid, hi), or hi."""
        found = CERTAIN.search(text, mid - 1, hi)
        return found.start() + 1 if found else hi

    # -- a long stretch without a certain border ----------------------------------------------------------------------

    def _by_piece(self, window: str) -> list[int]:
        out: list[int] = []
        for m in self._pieces.finditer(window):
            piece = m[0].encode()
            out += self._piece(piece, 0, len(piece))
        return out

    def _piece(self, piece: bytes, lo: int, hi: int) -> list[int]:
        if hi - lo <= LEAF_BYTES:
            return self._merge(piece[lo:hi])
        mid = (lo + hi) // 2
        while piece[mid] & 0xC0 == 0x80:  # not inside a character
            mid -= 1
        if mid == lo:  # one long character in front
            return self._merge(piece[lo:hi])
        left, right = self._piece(piece, lo, mid), self._piece(piece, mid, hi)
        k = FIRST_TOKENS
        while True:
            a, b = left[-k:], right[:k]
            middle = self._merge(b"".join(map(self.bytes_of.__getitem__, a + b)))
            whole_left, whole_right = k >= len(left), k >= len(right)
            if middle and (whole_left or self._stable(left[-k - 1], middle[0])) and (whole_right or self._stable(middle[-1], right[k])):
                return left[:-k] + middle + right[k:]
            k *= 2

    def _merge(self, piece: bytes) -> list[int] | None:
        """The encoding of bytes as one piece; None if they cut a character."""
        try:
            return self._one.encode_ordinary(piece.decode())
        except UnicodeDecodeError:
            return None

    def _stable(self, a: int, b: int) -> bool:
        return self._merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    # -- decoding -----------------------------------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, joined pairwise up the tree."""
        parts = [b"".join(map(self.bytes_of.__getitem__, ids[i : i + LEAF_CHARS])) for i in range(0, len(ids), LEAF_CHARS)] or [b""]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0]


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str = public_tokenizers.PATTERN) -> TreeEncoder:
    """One encoder per Python worker and vocabulary."""
    return TreeEncoder(ranks, pattern)


def encode_documents(docs: DataFrame, text: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """The columns of docs (but text) with n_tokens, ids array<int>, ids_sha256 (of the decimal ids joined by a space)
    and decoded_sha256 (of the bytes that the ids decode to); with_ids=False leaves the ids out.

    The vocabulary file at `path` (a tiktoken file, about 1 MB) is read once and sent to the workers. Null texts count as
    empty and have no ids. Repeated rows are encoded each. Columns of docs named like the results are replaced. Texts
    may have any length and content; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(read_bytes(path or public_tokenizers.path(VOCABULARY)))
    own = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"][: None if with_ids else 1] + ([] if with_ids else ["ids_sha256", "decoded_sha256"])

    @frugal
    def digest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = encoder(ranks.value)
        for batch in texts:
            rows = [_encoded(tree, t, with_ids) for t in batch]
            yield pd.DataFrame(rows, columns=own)

    kinds = {"n_tokens": "bigint", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    made = F.pandas_udf(digest, "struct<" + ",".join(f"{c}:{kinds[c]}" for c in own) + ">")
    away, back = shelved(docs, [*own, text])
    return docs.select(*away, made(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_bpe")).select(*back, "_bpe.*")


def _encoded(tree: TreeEncoder, text: str, with_ids: bool) -> tuple:
    ids = tree.encode(text)
    digests = (hashlib.sha256(" ".join(map(tree.text_of.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(tree.decode(ids)).hexdigest())
    return (len(ids), np.array(ids, np.int32), *digests) if with_ids else (len(ids), *digests)


def token_lengths(docs: DataFrame, text: str = "text", path: str | None = None, length: Callable[[TreeEncoder, str], int] | None = None) -> DataFrame:
    """The columns of docs (but text) with n_tokens only. `length` replaces the tree encoder's own count."""
    bounded_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(read_bytes(path or public_tokenizers.path(VOCABULARY)))
    count = length or (lambda tree, t: len(tree.encode(t)))

    @frugal
    def lengths(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tree = encoder(ranks.value)
        for batch in texts:
            yield pd.Series([count(tree, t) for t in batch], dtype="int64")

    made = F.pandas_udf(lengths, "bigint")
    return docs.select(*others(docs, ["n_tokens", text]), made(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("n_tokens"))
