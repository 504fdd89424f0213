"""Vectorised word hashing inside tasks: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of text that are hashed at once; a longer text is taken alone.
SLICE = 500_000

_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^(n-1) and the same of its inverse, modulo 2^64; kept between calls."""
    global _up, _down
    if len(_up) < n:
        size = max(n, SLICE)
        _up, _down = np.full(size, _P), np.full(size, _P_INVERSE)
        _up[0] = _down[0] = 1
        np.multiply.accumulate(_up, out=_up)
        np.multiply.accumulate(_down, out=_down)
    return _up[:n], _down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which close values go far apart (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes), whole texts, about SLICE bytes at a time."""
    first, part, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode() if t else b""
        if part and size + len(b) > SLICE:
            yield first, part
            first, part, size = i, [], 0
        part.append(b)
        size += len(b)
    if part:
        yield first, part


def words(texts: list[bytes], word_byte: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
    """(hash, text index, line index in the text) of every word, in order, with `places` also its start and end in the texts joined by
    line feeds. Words are runs of bytes for which word_byte (256 booleans, false for the line feed) holds; lines end at line feeds."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = word_byte[data]
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    feeds = np.flatnonzero(data == 10)
    line = np.searchsorted(feeds, start)
    last = np.cumsum([len(t) + 1 for t in texts]) - 1  # the line feed behind each text
    text = np.searchsorted(last, start)
    before = np.concatenate([[0], np.searchsorted(feeds, last[:-1]) + 1]) if len(texts) else np.zeros(0, np.int64)
    return (hashes, text, line - before[text], start, end) if places else (hashes, text, line - before[text])


def characters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code point, text index, line index in the text) of every character of the lines, in order. Lines end at line feeds;
    white space (characters up to the space) between two words of a line is one space, and goes elsewhere."""
    data = np.frombuffer(b"\n".join([*texts, b""]).decode().encode("utf-32-le"), np.uint32)
    inside = data > 32
    feed = data == 10
    line = np.cumsum(feed) - feed
    start = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    keep = inside.copy()
    keep[start[1:][line[start[1:]] == line[start[:-1]]] - 1] = True
    at = np.flatnonzero(keep)
    size = np.array([len(t.decode()) + 1 for t in texts], np.int64)
    last = np.cumsum(size) - 1
    text = np.searchsorted(last, at)
    before = np.concatenate([[0], line[last[:-1]] + 1]) if len(texts) else np.zeros(0, np.int64)
    return np.where(inside[at], data[at], 32), text, line[at] - before[text]


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's runs of `size` words; a text of fewer words has one run, of them all."""
    h, text, _ = words(texts, WORD_CHARACTER)
    count = np.bincount(text, minlength=len(texts)) if len(h) else np.zeros(len(texts), np.int64)
    first = np.cumsum(count) - count
    runs = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    at = spread(first, runs)
    end = np.repeat(first + count, runs)
    acc = np.zeros(len(at), np.uint64)
    for j in range(size):
        inside = at + j < end
        acc = mix(acc * np.uint64(3) + np.where(inside, h[np.minimum(at + j, len(h) - 1)], np.uint64(j + 1)))
    stop = np.cumsum(runs)
    return [np.unique(acc[e - n : e]) for e, n in zip(stop, runs, strict=True)]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges starts[i] .. starts[i] + counts[i] - 1."""
    shift = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(starts - shift, counts)


#: What counts as a word byte. Bytes of non-ASCII characters always do.
NOT_SPACE = np.array([b > 32 for b in range(256)])
WORD_CHARACTER = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
