"""64-bit hashes of many strings of bytes of a text at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
PIECE = 1 << 20
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


class RollingHash:
    """Hashes of all strings of bytes in an array, by prefix sums modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, dtype=_U)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        back = pow(self.base, -1, 1 << 64)
        self.powers = np.cumprod(np.r_[_U(1), np.full(n, self.base, _U)])
        self.inverse = np.cumprod(np.r_[_U(1), np.full(n, back, _U)])

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            self._grow(2 * len(data))
        out = np.zeros(len(data) + 1, _U)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        x = (sums[stop] - sums[start]) * self.inverse[start]
        x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(29))

    def words(self, text: bytes) -> np.ndarray:
        """Of what space and U+0009 to U+000D separate, in the order of the text.

        Long texts are read in pieces that end at a separator.
        """
        data = np.frombuffer(text, np.uint8)
        parts, at = [], 0
        while at < len(data):
            stop = min(at + PIECE, len(data))
            while stop < len(data) and not _SEPARATOR[data[stop]]:
                ahead = np.flatnonzero(_SEPARATOR[data[stop : stop + PIECE]])
                stop = stop + int(ahead[0]) if len(ahead) else min(stop + PIECE, len(data))
            piece = data[at:stop]
            edge = np.flatnonzero(np.diff(_SEPARATOR[piece], prepend=True, append=True))
            parts.append(self.of(self.sums(piece), edge[::2], edge[1::2]))
            at = stop
        return np.concatenate(parts) if parts else np.zeros(0, _U)
