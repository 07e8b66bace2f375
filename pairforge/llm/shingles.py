"""Word shingles of whole texts as sorted sets of 64-bit hashes, by numpy."""

from __future__ import annotations

import hashlib

import numpy as np

_RANDOM = np.random.default_rng(0x5EED)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            factors = np.full(n, _BASE, np.uint64)
            factors[0] = 1
            self.up = np.cumprod(factors)
            factors[1:] = _INVERSE
            self.down = np.cumprod(factors)
        return self.up, self.down


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of byte values times base^place over i <= place < j."""
    up, _ = POWERS.to(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end]; words lie in ascending order.

    The sum of a mixed value of each byte and its place in the word.  Unlike a
    polynomial modulo 2^64 it has no algebra that texts such as the Thue-Morse
    word and its complement could meet in: differing words collide by chance only.
    """
    length = end - start
    first = np.cumsum(length) - length
    shift = np.repeat(start - first, length)
    at = np.arange(len(shift)) + shift
    place = (at - np.repeat(start, length)).astype(np.uint64)
    value = mixed(_BYTE[data[at]] + place * np.uint64(_BASE))
    return mixed(np.add.reduceat(value, first) + length.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The set of each text: hashes of its distinct runs of ``size`` words.

    A-Z is lower-cased; words are separated by ASCII white space.  A text with
    fewer words has their whole sequence as its one shingle; without words, or
    for null, the set is empty.
    """
    data = np.frombuffer(b"\n".join([t or b"" for t in texts] + [b""]).lower(), np.uint8)
    bounds = np.cumsum([len(t or b"") + 1 for t in texts])
    blank = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    word = word_hashes(data, start, end)
    first = np.searchsorted(start, np.concatenate([[0], bounds[:-1]]))
    last = np.append(first[1:], len(start))
    n = len(word) - size + 1
    if n > 0:
        run = np.zeros(n, np.uint64)
        for j in range(size):
            run = mixed(run * np.uint64(3) + word[j : j + n])
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for w in word[a:b]:
                one = mixed(np.array([one], np.uint64) * np.uint64(5) + w)[0]
            out.append(np.array([one], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a set: equal sets, and up to chance no others."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
