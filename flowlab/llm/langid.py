"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of labelled texts. It labels every byte
position from what stands before and after it, and a document's probabilities are the means over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm import textops
from flowlab.llm.common import bounded_batches, frugal, shelved

#: Bounds of the training sample: windows per language, characters per window, languages.
SAMPLE_PER_LANG, SAMPLE_CHARS, SAMPLE_LANGS = 1536, 160, 200
SAMPLE_PARTS = 64
HIDDEN, STEPS_TRAIN, BATCH, ROUNDS, RATE, SEED = 12, 48, 256, 260, 0.02, 7
#: Inference: bytes that a row of the batch labels, bytes read before and behind them, and rows run together.
STEPS, CONTEXT, ROWS = 208, 24, 1024
UNDETERMINED = "und"


@dataclass
class Model:
    """langs in order of the outputs; input (512, 2H): for each direction and byte what it adds to gate and candidate;
    gate, cand (2, H, H); out (2H, L), bias (L); seen (65536): the pairs of bytes that the training texts hold."""

    langs: list[str]
    input: np.ndarray
    gate: np.ndarray
    cand: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    seen: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _both_ways(x: np.ndarray) -> np.ndarray:
    """(rows, steps) bytes -> (steps, 2, rows) rows of the input table, the second direction from the end."""
    ahead = x.T.astype(np.int32)
    return np.stack([ahead, ahead[::-1] + 256], axis=1)


def _states(m: Model, x: np.ndarray, keep: bool = False):
    """Hidden states (steps, 2, rows, H) in each direction's own order; keep: also gates and candidates, for training."""
    ids, hidden = _both_ways(x), m.gate.shape[1]
    steps, _, rows = ids.shape
    h = np.zeros((2, rows, hidden), np.float32)
    out = np.empty((steps, 2, rows, hidden), np.float32)
    gates, cands = (np.empty_like(out), np.empty_like(out)) if keep else (None, None)
    for t in range(steps):
        given = m.input[ids[t]]
        f = _sigmoid(given[..., :hidden] + h @ m.gate)
        c = given[..., hidden:] + (f * h) @ m.cand
        c += c
        c = _sigmoid(c)
        c += c
        c -= 1  # tanh(x) = 2 sigmoid(2x) - 1
        if keep:
            gates[t], cands[t] = f, c
        c -= h
        c *= f
        h = np.add(h, c, out=out[t])
    return (out, gates, cands, ids) if keep else out


def _position_probabilities(m: Model, states: np.ndarray) -> np.ndarray:
    """(steps, rows, L)"""
    hidden = m.gate.shape[1]
    logits = states[:, 0] @ m.out[:hidden] + states[::-1, 1] @ m.out[hidden:] + m.bias
    np.clip(logits, -60, 60, out=logits)  # far beyond what trained weights give; exp stays finite
    np.exp(logits, out=logits)
    logits /= logits @ np.ones((logits.shape[-1], 1), logits.dtype)
    return logits


def _gradients(m: Model, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of the mean cross entropy over all positions."""
    hs, fs, cs, ids = _states(m, x, keep=True)
    steps, _, rows, hidden = hs.shape
    d = _position_probabilities(m, hs)
    d[:, np.arange(rows), y] -= 1
    d /= steps * rows
    d_out = np.concatenate([np.tensordot(hs[:, 0], d, ([0, 1], [0, 1])), np.tensordot(hs[::-1, 1], d, ([0, 1], [0, 1]))])
    d_hs = np.stack([d @ m.out[:hidden].T, (d @ m.out[hidden:].T)[::-1]], axis=1)
    d_gate, d_cand = np.zeros_like(m.gate), np.zeros_like(m.cand)
    d_given = np.empty((steps, 2, rows, 2 * hidden), np.float32)
    d_h = np.zeros((2, rows, hidden), np.float32)
    zero = np.zeros_like(d_h)
    turn = lambda a: a.transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        before, f, c = hs[t - 1] if t else zero, fs[t], cs[t]
        d_h = d_h + d_hs[t]
        d_c = d_h * f * (1 - c * c)
        d_fh = d_c @ turn(m.cand)
        d_f = (d_h * (c - before) + d_fh * before) * f * (1 - f)
        d_cand += turn(f * before) @ d_c
        d_gate += turn(before) @ d_f
        d_h = d_h * (1 - f) + d_fh * f + d_f @ turn(m.gate)
        d_given[t, ..., :hidden], d_given[t, ..., hidden:] = d_f, d_c
    d_input = np.zeros_like(m.input)
    np.add.at(d_input, ids.ravel(), d_given.reshape(-1, 2 * hidden))
    return [d_input, d_gate, d_cand, d_out, d.sum((0, 1))]


def _pairs(text: bytes) -> np.ndarray:
    """Every byte and the one before it as one number; a space stands before the first."""
    b = np.frombuffer(b" " + text, np.uint8).astype(np.uint16)
    return b[:-1] << np.uint16(8) | b[1:]


def familiar(m: Model, texts: list[bytes]) -> np.ndarray:
    """For each text the share of its byte pairs that the training texts hold; 0 for empty texts."""
    return np.array([m.seen[_pairs(t)].mean() if t else 0.0 for t in texts])


def train(texts: list[str], langs: list[str], rounds: int = ROUNDS, hidden: int = HIDDEN, seed: int = SEED) -> Model | None:
    """Fit by Adam on random windows, each language in equal number. None without labelled texts."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    pools = [[b for t, g in zip(texts, langs, strict=True) if g == n and (b := t.encode())] for n in names]
    pools = [p or [b" "] for p in pools]
    small = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    m = Model(names, small(512, 2 * hidden), small(2, hidden, hidden), small(2, hidden, hidden), small(2 * hidden, len(names)), np.zeros(len(names), np.float32), np.zeros(1 << 16, bool))
    for pool in pools:
        for b in pool:
            m.seen[_pairs(b)] = True
    weights = [m.input, m.gate, m.cand, m.out, m.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for r in range(1, rounds + 1):
        y = rng.integers(0, len(names), BATCH)
        x = np.full((BATCH, STEPS_TRAIN), 32, np.uint8)
        for i, k in enumerate(y):
            b = pools[k][rng.integers(len(pools[k]))]
            at = rng.integers(0, max(1, len(b) - STEPS_TRAIN + 1))
            part = np.frombuffer(b[at : at + STEPS_TRAIN], np.uint8)
            x[i, : len(part)] = part
        rate = RATE * min(1.0, 2 * (1 - r / (rounds + 1)))
        for w, g, a, v in zip(weights, _gradients(m, x, y), first, second, strict=True):
            a += 0.1 * (g - a)
            v += 0.01 * (g * g - v)
            w -= rate * (a / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-7)
    return m


def labelled(m: Model, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole texts, in pieces: (first position in the joined texts, probabilities (positions, L)), in order."""
    for at, x, lo, hi in _rows(texts):
        p = _position_probabilities(m, _states(m, x))
        steps = np.arange(x.shape[1])[:, None]
        yield at, p.transpose(1, 0, 2)[((steps >= lo) & (steps < hi)).T]


def pooled(m: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the mean of the probabilities of all byte positions (texts, L), how many positions have each language
    as their label (texts, L), and the runs of equal labels; zeros for empty texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    sums, counts, runs = np.zeros((len(texts), len(m.langs))), np.zeros((len(texts), len(m.langs)), np.int64), np.zeros(len(texts), np.int64)
    last = (-1, -1)
    for at, p in labelled(m, texts):
        text, label = owner[at : at + len(p)], p.argmax(1)
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        sums[text[first]] += np.add.reduceat(p, first, axis=0, dtype=float)
        counts += np.bincount(text * len(m.langs) + label, minlength=counts.size).reshape(counts.shape)
        new = np.concatenate([[(text[0], label[0]) != last], (text[1:] != text[:-1]) | (label[1:] != label[:-1])])
        runs += np.bincount(text[new], minlength=len(texts))
        last = (text[-1], label[-1])
    return sums / np.maximum(lengths, 1)[:, None], counts, runs


def _rows(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut whole texts into rows that label STEPS bytes each and also read the CONTEXT bytes before and behind them, so that
    both directions know their surroundings where labels count; ROWS of them at a time, all of one width, so that a text's result depends on nothing else: (first position in the joined
    texts, bytes, first and last position that counts in each row). What lies outside a text is read as spaces."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-lengths // STEPS)
    data = np.frombuffer(b" " * CONTEXT + b"".join(texts) + b" " * (STEPS + CONTEXT), np.uint8)
    doc = np.repeat(np.arange(len(texts)), counts)
    offset = np.cumsum(lengths) - lengths
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * STEPS
    steps = np.arange(STEPS + 2 * CONTEXT)
    for i in range(0, len(doc), ROWS):
        d, s = doc[i : i + ROWS], start[i : i + ROWS]
        long = np.minimum(lengths[d] - s, STEPS)
        place = s[:, None] + steps - CONTEXT
        x = data[(offset[d] + CONTEXT)[:, None] + place]
        yield int(offset[d[0]] + s[0]), np.where((place >= 0) & (place < lengths[d][:, None]), x, 32).astype(np.uint8), np.full(len(d), CONTEXT), CONTEXT + long


def position_labels(m: Model, text: str) -> list[tuple[int, int, str]]:
    """Runs (start, end, lang) of equal labels over the bytes of the lower-cased text."""
    out: list[tuple[int, int, str]] = []
    for at, p in labelled(m, [text.lower().encode()]):
        for i, label in enumerate(p.argmax(1)):
            name = m.langs[label]
            if out and out[-1][2] == name:
                out[-1] = (out[-1][0], at + i + 1, name)
            else:
                out.append((at + i, at + i + 1, name))
    return out


def held_out(key: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text is kept from training; null ids are neither held out nor
    learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], list[str]]:
    """A bounded sample for the driver: for each of at most SAMPLE_LANGS languages SAMPLE_PER_LANG documents, the
    first in order of a hash of their id in each of SAMPLE_PARTS parts, and of each document a window of SAMPLE_CHARS at a place that the hash chooses."""
    t, k = F.lower(F.col(f"`{text}`")), F.xxhash64(F.col(f"`{key}`").cast("string"))
    span = F.greatest(F.length(t) - SAMPLE_CHARS, F.lit(0)) + 1
    rows = docs.filter(
        (F.crc32(F.col(f"`{key}`").cast("string")) % 5 != 0) & F.col(f"`{lang}`").isNotNull() & F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    ).select(F.col(f"`{lang}`").alias("lang"), k.alias("k"), F.substring(t, (F.pmod(k, span) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
    # a common language is ranked in SAMPLE_PARTS parts, dealt by other bits of the hash
    dealt = rows.withColumn("part", F.pmod(F.shiftright("k", 40), F.lit(SAMPLE_PARTS)))
    first = dealt.withColumn("n", F.row_number().over(Window.partitionBy("lang", "part").orderBy("k", "text"))).filter(F.col("n") <= SAMPLE_PER_LANG // SAMPLE_PARTS)
    got = first.select("lang", "text", "n").orderBy("n", "lang", "text").limit(SAMPLE_PER_LANG * SAMPLE_LANGS).collect()
    return [r["text"] for r in got], [r["lang"] for r in got]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    return train(*training_sample(docs, key, text, lang))


OWN = {"lang_pred": "string", "score": "double", "margin": "double", "agreeing": "double", "n_runs": "bigint", "familiar": "double"}


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The columns of docs with lang_pred, score (the pooled probability of that language), margin (how far it is above the
    second one's; the score if there is none), agreeing (the share of byte positions labelled with it), n_runs (runs of equal
    labels) and familiar (the share of byte pairs that the training texts hold: low for scripts and letter sequences never learned).

    Only the text is read. Null texts and texts without a letter, and all texts if there is no model, are `und` with
    zeros. Repeated rows are each predicted. Columns of docs named like the results are replaced. Whole texts are
    read, whatever their length; ties between languages go to the first by name. An empty table gives an empty result.
    """
    away, back = shelved(docs, OWN)
    t = F.col(f"`{text}`")
    known = F.coalesce(t.rlike(r"\p{L}"), F.lit(False))
    none = [F.lit(UNDETERMINED if k == "string" else 0).cast(k).alias(c) for c, k in OWN.items()]
    if model is None:
        return docs.select(*away).select(*back, *none)
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 60 kB

    @frugal
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        names = np.array(m.langs, object)
        for batch in texts:
            made = []
            for _, part in textops.slices(list(batch)):
                p, counts, runs = pooled(m, part)
                best = p.argmax(1)
                every = np.arange(len(part))
                share = counts[every, best] / np.maximum(counts.sum(1), 1)
                second = np.sort(p, 1)[:, -2] if len(names) > 1 else 0.0
                made.append(pd.DataFrame({"lang_pred": names[best], "score": np.clip(p[every, best], 0, 1), "margin": np.clip(p[every, best] - second, 0, 1), "agreeing": share, "n_runs": runs, "familiar": familiar(m, part)}))
            yield pd.concat(made) if made else pd.DataFrame({c: [] for c in OWN})

    made = F.pandas_udf(predict, "struct<" + ",".join(f"{c}:{k}" for c, k in OWN.items()) + ">")
    scored = docs.select(*away, known.alias("_known"), made(F.when(known, F.lower(t)).otherwise(F.lit(""))).alias("_p"))
    return scored.select(*back, *[F.when(F.col("_known"), F.col(f"_p.{c}")).otherwise(n).alias(c) for c, n in zip(OWN, none, strict=True)])
