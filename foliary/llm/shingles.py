"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import functools

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(n, base % (1 << 64), np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(BASE), of(pow(BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_hashed(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run, from prefix sums."""
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def run_sum(data: np.ndarray) -> np.uint64:
    """What the bytes of a run that begins with them add to its hash."""
    up, _ = _powers(1 << max(16, int(len(data)).bit_length()))
    return ((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)]).sum(dtype=np.uint64)


def run_key(total: int, length: int) -> int:
    """The hash of :func:`runs_hashed` for a run whose sum is known."""
    return int(mix(np.array([(total + length) % (1 << 64)], np.uint64))[0])


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of bytes that are not white space begin, and end."""
    edge = np.diff((~_SPACE[data]).astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without white space, A to Z lowered), and where each text's words begin (and, last, end)."""
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    begins, ends = word_edges(data)
    hashes = runs_hashed(data, begins, ends)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    return hashes, np.searchsorted(begins, np.concatenate([[0], np.cumsum(sizes)]))


def sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text: its distinct shingles of ``width`` words, sorted; of fewer words, the whole sequence as one; of none, none."""
    hashes, first = words(texts)
    joined = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        joined = mix(joined * np.uint64(BASE) + hashes[k : k + len(joined)])
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= width:
            out.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                whole = mix(whole * np.uint64(BASE) + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
