"""Word and shingle hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

from kelpforge.llm.common import WORD_TABLE

#: Words of a shingle.
SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer (murmur style) of every element; ``seed`` picks the function."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _BASE, dtype=np.uint64))


_POWERS = _powers(256)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and the offsets where each text's words begin.

    The offsets have one element more than the texts. A word's hash depends on its bytes alone.
    """
    global _POWERS
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    raw = np.frombuffer((b" ".join(texts) + b" ").translate(WORD_TABLE), dtype=np.uint8)
    inside = raw != 32
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    offsets = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), offsets
    lens = ends - starts
    at = np.zeros(len(lens), dtype=np.int64)
    np.cumsum(lens[:-1], out=at[1:])
    pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    if (longest := int(lens.max())) > len(_POWERS):
        _POWERS = _powers(2 * longest)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(raw[inside].astype(np.uint64) * _POWERS[pos], at)
    return mix(sums ^ lens.astype(np.uint64)), offsets


def shingle_hashes(texts: list[bytes], width: int = SHINGLE, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all shingles, their offsets by text, words of each text).

    A text of fewer than ``width`` words, but not none, has one shingle of all its words if
    ``short``, else none.
    """
    h, off = word_hashes(texts)
    n = np.diff(off)
    full = np.maximum(n - width + 1, 0)
    counts = np.where((n > 0) & (n < width), 1, full) if short else full
    out_off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out_off[1:])
    out = np.zeros(int(out_off[-1]), dtype=np.uint64)
    if len(h) >= width:
        with np.errstate(over="ignore"):
            acc = np.zeros(len(h) - width + 1, dtype=np.uint64)
            for k in range(width):
                acc = (acc + h[k : k + len(acc)]) * _BASE
        acc = mix(acc, 1)
        doc = np.repeat(np.arange(len(texts)), full)
        rel = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
        out[out_off[doc] + rel] = acc[off[doc] + rel]
    if short:
        for i in np.flatnonzero((n > 0) & (n < width)):
            x = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in h[off[i] : off[i + 1]]:
                    x = (x + w) * _BASE
            out[out_off[i]] = mix(np.array([x]), 2)[0]
    return out, out_off, n
