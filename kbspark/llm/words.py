"""Words, shingles and lines of whole texts as NumPy arrays.

A word is a run of bytes other than 0x20 and 0x09-0x0D. A batch of texts is hashed
at once: every byte contributes ``TABLE[byte] * BASE**position`` (mod 2**64), so a
word's hash is a difference of two prefix sums times an inverse power, then mixed.
The hashes depend on nothing but the bytes, so they agree on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed together; a single longer text makes a batch of its own.
BATCH_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix64's last steps)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(0x2545F4914F6CDD1D))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, BATCH_BYTES + 1)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words of a batch of texts, in order; ``first[d]:first[d + 1]`` are those of text d."""

    def __init__(self, texts: list[bytes], lower: bool = False, newline: bool = False):
        raw = b" ".join(texts)
        self.bytes = np.frombuffer(raw, np.uint8)
        if lower:
            self.bytes = _LOWER[self.bytes]
        gap = (self.bytes == 10) if newline else _SPACE[self.bytes]
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.at = np.concatenate(([0], np.cumsum(sizes + 1)))
        if len(gap):
            gap = gap.copy()
            gap[self.at[1:-1] - 1] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.at)
        self.first[-1] = len(self.start)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def spans_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        up, down = _powers(len(self.bytes) + 1)
        sums = np.zeros(len(self.bytes) + 1, _U)
        np.cumsum(_TABLE[self.bytes] * up[: len(self.bytes)], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U))

    def hashes(self) -> np.ndarray:
        return self.spans_hash(self.start, self.end)


def batches(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about BATCH_BYTES together, or one text."""
    begin = size = 0
    for k, t in enumerate(texts):
        if k > begin and size + len(t) > BATCH_BYTES:
            yield begin, k
            begin, size = k, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive hashes (n-1 fewer than there are hashes)."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    out = np.zeros(len(hashes) - n + 1, _U)
    for k in range(n):
        out = mix(out + hashes[k : len(hashes) - n + 1 + k] + _U(k + 1))
    return out


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """For each text its sorted distinct n-word shingles as hashes, A-Z in lower case.

    A text of fewer words has its whole word sequence as its only shingle, one without words none.
    """
    out = []
    for lo, hi in batches(texts):
        w = Words(texts[lo:hi], lower=True)
        h = w.hashes()
        runs = windows(h, n)
        first = w.first
        for d in range(hi - lo):
            a, b = first[d], first[d + 1]
            if b - a >= n:
                out.append(np.unique(runs[a : b - n + 1]))
            elif b > a:
                out.append(windows(h[a:b], b - a) + _U(b - a))
            else:
                out.append(np.zeros(0, _U))
    return out


def as_bytes(column) -> list[bytes]:
    """An Arrow string column's values as UTF-8, null as empty."""
    import pyarrow as pa

    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]
