"""Hashes of words and of word shingles, computed for many texts at once with numpy.

Words are runs without the ASCII white space (space and 0x09 to 0x0D), with A-Z lower-cased. A word's
hash is a polynomial over its bytes modulo 2**64, then mixed; a shingle's hash mixes the hashes of
its words in order. A text with fewer words than a shingle is one shingle, its whole sequence; a
text without words has none.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_TURN = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.random.Generator(np.random.PCG64(2024)).integers(1, 2**63, 256, dtype=np.uint64)
_LETTER[ord("A"): ord("Z") + 1] = _LETTER[ord("a"): ord("z") + 1]
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << n.bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


def words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, and for each text the place of its first word."""
    raw = np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)
    up, down = _grow(len(raw))
    space = _SPACE[raw]
    before = np.empty(len(raw) + 1, bool)
    before[0] = True
    before[1:] = space
    edges = np.flatnonzero(before[1:] != before[:-1])
    begin, end = edges[0::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTER[raw] * up, out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _TURN)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t or b"") + 1 for t in texts], out=offsets[1:])
    return hashes, np.searchsorted(begin, offsets)


class Spans:
    """Hashes of spans of bytes in constant time each, from sums over all bytes; letters count as in ``words``."""

    def __init__(self, raw: np.ndarray) -> None:
        self.up, self.down = _grow(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.multiply(_LETTER[raw], self.up[: len(raw)], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)

    def hashes(self, begin: np.ndarray, end: np.ndarray, mark: bytes = b"") -> np.ndarray:
        """The hash of each span; with ``mark``, a byte, of the span and that byte after it."""
        sums = (self.sums[end] - self.sums[begin]) * self.down[begin]
        sizes = end - begin
        if mark:
            sums += _LETTER[mark[0]] * self.up[sizes]
        return mix(sums + (sizes + len(mark)).astype(np.uint64) * _TURN)


def letter_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A code of every byte (A-Z as a-z, all white space alike) and the number of the text it belongs to."""
    raw = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    codes = np.where(_SPACE, _LETTER[0x20], _LETTER)[raw]
    return codes, np.repeat(np.arange(len(texts)), [len(t or b"") for t in texts])


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` words from each place on, also across the ends of texts."""
    found = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for place in range(width):
        found = found * _TURN + hashes[place: place + len(found)]
    return mix(found + np.uint64(width))


def distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, firsts = words(texts)
    shingles = rolled(hashes, width)
    found = []
    for begin, end in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if end - begin >= width:
            found.append(distinct(shingles[begin: end - width + 1]))
        else:
            found.append(rolled(hashes[begin:end], end - begin) if end > begin else hashes[:0])
    return found
