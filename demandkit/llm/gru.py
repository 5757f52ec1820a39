"""A bidirectional gated recurrent network with attention pooling over word and character inputs.

Written in numpy: windows of words are rows of a matrix of word numbers, and all windows of a batch
take a step together. A word's input is its own vector and the mean vector of its character n-grams,
so words never seen in training are judged by their spelling.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

HIDDEN = 8
WORD_DIM = 8
CHAR_DIM = 8
ATTENTION = 8
CHAR_BUCKETS = 1 << 14
NGRAMS = (3, 4, 5)
_WORDS_AT_ONCE = 1 << 14

Params = dict[str, np.ndarray]


def ngram_buckets(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, marked at both ends, and where each word's start.

    A word of one character has one n-gram, itself with its marks. Words are taken some thousands
    at a time, which bounds the memory in between.
    """
    parts = [_ngram_buckets(words[i : i + _WORDS_AT_ONCE]) for i in range(0, len(words), _WORDS_AT_ONCE)]
    sizes = np.cumsum([0, *(len(b) for b, _ in parts)])
    return np.concatenate([b for b, _ in parts]), np.concatenate([s + n for (_, s), n in zip(parts, sizes)])


def _ngram_buckets(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    text = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(codes))  # characters from here to the end of the word
    made, of = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        rolling = rolling[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in NGRAMS:
            at = np.flatnonzero(left[: len(rolling)] >= n)
            mixed = (rolling[at] ^ (rolling[at] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            made.append((mixed >> np.uint64(40)) % np.uint64(CHAR_BUCKETS))
            of.append(owner[at])
    buckets, of = np.concatenate(made).astype(np.int32), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(len(words)))
    return buckets[order], starts


def mean_rows(table: np.ndarray, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros((0, table.shape[1]), table.dtype)
    ends = np.append(starts[1:], len(buckets))
    made = np.empty((len(starts), table.shape[1]), table.dtype)
    for i in range(0, len(starts), _WORDS_AT_ONCE):
        s, e = starts[i : i + _WORDS_AT_ONCE], ends[i : i + _WORDS_AT_ONCE]
        sums = np.add.reduceat(table[buckets[s[0] : e[-1]]], s - s[0], axis=0)
        made[i : i + len(s)] = sums / (e - s)[:, None].astype(table.dtype)
    return made


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the sum of the ``rows`` that belong ``at`` it."""
    return np.stack([np.bincount(at, rows[:, c], n) for c in range(rows.shape[1])], axis=1).astype(rows.dtype)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_params(rng: np.random.Generator, words: int, dtype: type = np.float32) -> Params:
    def draw(*shape: int, scale: float = 0.3) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(dtype)

    size = WORD_DIM + CHAR_DIM
    made = {"words": draw(words, WORD_DIM, scale=0.05), "chars": draw(CHAR_BUCKETS, CHAR_DIM, scale=0.05)}
    for side in "fb":
        made |= {f"w{side}": draw(size, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, dtype)}
    made |= {"wa": draw(2 * HIDDEN, ATTENTION), "ca": np.zeros(ATTENTION, dtype), "va": draw(ATTENTION)}
    return made | {"wo": draw(2 * HIDDEN), "co": np.zeros(1, dtype)}


def inputs(p: Params, known: np.ndarray, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Input rows of words; ``known`` is a word's row in the table, 0 for words not in it."""
    return np.concatenate([p["words"][known], mean_rows(p["chars"], buckets, starts)], axis=1)


@dataclass
class _Trace:
    h: np.ndarray  # the states after each step, steps x windows x hidden
    gates: list


def _run(table: np.ndarray, u: np.ndarray, ids: np.ndarray, mask: np.ndarray, order: Sequence[int], keep: bool) -> _Trace:
    """One direction over all windows; masked steps leave the state as it is."""
    windows, steps = ids.shape
    h = np.zeros((windows, HIDDEN), table.dtype)
    states, gates = np.empty((steps, windows, HIDDEN), table.dtype), []
    for t in order:
        x, r = table[ids[:, t]], h @ u
        zr = _sigmoid(x[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
        z, g = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN :] + g * r[:, 2 * HIDDEN :])
        m = mask[:, t, None]
        if keep:
            gates.append((t, h, z, g, n, r[:, 2 * HIDDEN :], m))
        h = h + m * (1 - z) * (n - h)
        states[t] = h
    return _Trace(states, gates)


def forward(p: Params, rows: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Logits of windows ``ids`` (windows x steps, rows of ``rows``); ``mask`` is 1 where a word is."""
    steps = ids.shape[1]
    ahead = _run(rows @ p["wf"] + p["cf"], p["uf"], ids, mask, range(steps), keep)
    back = _run(rows @ p["wb"] + p["cb"], p["ub"], ids, mask, range(steps - 1, -1, -1), keep)
    both = np.concatenate([ahead.h, back.h], axis=2)
    a = np.tanh(both @ p["wa"] + p["ca"])
    e = a @ p["va"] + np.where(mask.T > 0, 0, -1e9).astype(both.dtype)
    e = np.exp(e - e.max(axis=0))
    weight = e / e.sum(axis=0)
    pooled = np.einsum("tw,twh->wh", weight, both)
    return pooled @ p["wo"] + p["co"][0], (ahead, back, both, a, weight, pooled)


def _run_back(grad_h: np.ndarray, trace: _Trace, u: np.ndarray, grad_u: np.ndarray, grad_x: list) -> None:
    carry = np.zeros_like(grad_h[0])
    for t, h, z, g, n, rn, m in reversed(trace.gates):
        d = carry + grad_h[t]
        dn = d * m * (1 - z) * (1 - n * n)
        dz = d * m * (h - n) * z * (1 - z)
        dg = dn * rn * g * (1 - g)
        dr = np.concatenate([dz, dg, dn * g], axis=1)
        grad_u += h.T @ dr
        carry = d * (1 - m * (1 - z)) + dr @ u.T
        grad_x.append((t, np.concatenate([dz, dg, dn], axis=1)))


def gradients(
    p: Params, known: np.ndarray, buckets: np.ndarray, starts: np.ndarray, ids: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> tuple[float, Params]:
    """Weighted cross entropy of the windows and its gradient by back propagation through time."""
    rows = inputs(p, known, buckets, starts)
    logits, (ahead, back, both, a, share, pooled) = forward(p, rows, ids, mask, keep=True)
    loss = float((weight * (np.logaddexp(0, logits) - y * logits)).sum() / weight.sum())
    d = weight * (_sigmoid(logits) - y) / weight.sum()
    g: Params = {"wo": pooled.T @ d, "co": np.array([d.sum()], p["co"].dtype)}
    d_pooled = d[:, None] * p["wo"]
    d_share = np.einsum("wh,twh->tw", d_pooled, both)
    d_e = share * (d_share - (share * d_share).sum(axis=0))
    g["va"] = np.einsum("tw,twa->a", d_e, a)
    d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
    g["wa"], g["ca"] = np.einsum("twh,twa->ha", both, d_a), d_a.sum(axis=(0, 1))
    d_both = share[:, :, None] * d_pooled + d_a @ p["wa"].T
    d_rows = np.zeros_like(rows)
    for side, trace, d_h in (("f", ahead, d_both[:, :, :HIDDEN]), ("b", back, d_both[:, :, HIDDEN:])):
        g[f"u{side}"], steps = np.zeros_like(p[f"u{side}"]), []
        _run_back(d_h, trace, p[f"u{side}"], g[f"u{side}"], steps)
        d_table = _sums(np.concatenate([ids[:, t] for t, _ in steps]), np.concatenate([d for _, d in steps]), len(rows))
        g[f"c{side}"], g[f"w{side}"] = d_table.sum(axis=0), rows.T @ d_table
        d_rows += d_table @ p[f"w{side}"].T
    g["words"] = _sums(known, d_rows[:, :WORD_DIM], len(p["words"]))
    g["words"][0] = 0  # unknown words stay without a vector
    sizes = np.diff(np.append(starts, len(buckets)))
    g["chars"] = _sums(buckets, np.repeat(d_rows[:, WORD_DIM:] / sizes[:, None], sizes, axis=0).astype(rows.dtype), CHAR_BUCKETS)
    return loss, g


class Adam:
    """Adaptive step sizes per parameter."""

    def __init__(self, p: Params, rate: float) -> None:
        self.rate, self.t = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, p: Params, g: Params) -> None:
        self.t += 1
        for k in p:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.01 * (g[k] ** 2 - self.v[k])
            p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)
