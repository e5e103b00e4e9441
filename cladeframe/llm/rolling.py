"""Hashes of all substrings of many byte strings at once, in numpy.

A prefix sum of random numbers per byte times powers of an odd base gives the hash of
any substring by one subtraction and one multiplication, modulo 2**64.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 5
_SEED = 20240229
_random = np.random.Generator(np.random.Philox(_SEED))
#: A random odd number per byte value, the same in every process.
BYTES = _random.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to the ``n``-th."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(2 * n, 1 << 16)
        inverse = pow(_BASE, -1, 2**64)
        grown = []
        for base in (_BASE, inverse):
            factor = np.full(size, base % 2**64, np.uint64)
            factor[0] = 1
            grown.append(np.multiply.accumulate(factor))
        _powers, _inverses = grown
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Prefix:
    """Prefix hashes of a byte array."""

    def __init__(self, data: np.ndarray):
        self.powers, self.inverses = _table(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * self.powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the substrings from ``start`` up to ``stop``."""
        return (self.sums[stop] - self.sums[start]) * self.inverses[start]

    def every(self, n: int) -> np.ndarray:
        """Hashes of all substrings of ``n`` bytes."""
        m = max(0, len(self.sums) - n)
        return (self.sums[n:] - self.sums[:m]) * self.inverses[:m]


#: Prime modulus (fixed value, 2**31 - 1) and two random bases below it.
_PRIME = 2**31 - 1
_PRIME_BASES = tuple(int(b) for b in _random.integers(2**20, _PRIME, 2))
_PRIME_BYTES = _random.integers(1, _PRIME, (2, 256), dtype=np.int64)
_prime_powers: list[list[np.ndarray]] = [[np.ones(1, np.int64)] * 2, [np.ones(1, np.int64)] * 2]


def _powers_of(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo the prime, doubling what is known."""
    out = np.ones(1, np.int64)
    while len(out) < size:
        step = pow(base, len(out), _PRIME)
        out = np.concatenate([out, out * step % _PRIME])
    return out


class PrimePrefix:
    """Prefix hashes modulo a prime, for two bases: 62 bits that have nothing in common
    with those of ``Prefix``."""

    def __init__(self, data: np.ndarray):
        self.sums, self.inverses = [], []
        for k, base in enumerate(_PRIME_BASES):
            if len(_prime_powers[k][0]) <= len(data):
                size = max(2 * len(data), 1 << 16)
                _prime_powers[k] = [_powers_of(base, size), _powers_of(pow(base, -1, _PRIME), size)]
            powers, inverses = _prime_powers[k]
            sums = np.zeros(len(data) + 1, np.int64)
            np.cumsum(_PRIME_BYTES[k][data] * powers[: len(data)] % _PRIME, out=sums[1:])
            self.sums.append(sums)
            self.inverses.append(inverses)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the substrings from ``start`` up to ``stop``."""
        high, low = (
            (sums[stop] - sums[start]) % _PRIME * inverses[start] % _PRIME
            for sums, inverses in zip(self.sums, self.inverses)
        )
        return (high << 31 | low).astype(np.uint64)


#: Bytes at the first places of a word that have their random numbers in a table.
TABLE = 64


def _at_place(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix(mix((place.astype(np.uint64) << np.uint64(8)) + byte + np.uint64(_SEED)) + np.uint64(_BASE))


_places = _at_place(*(x.ravel() for x in np.meshgrid(np.arange(TABLE), np.arange(256, dtype=np.uint64), indexing="ij")))


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of words that ascend and don't overlap: sums of a random number for each
    byte and place in the word.  No product of a base is in them, so that no pattern of
    bytes cancels out."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = stop - start
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    byte = data[place + np.repeat(start, size)].astype(np.int64)
    numbers = _places[np.minimum(place, TABLE - 1) * 256 + byte]
    far = np.flatnonzero(place >= TABLE)
    numbers[far] = _at_place(place[far], byte[far].astype(np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers, dtype=np.uint64)])
    ends = np.cumsum(size)
    return mix(sums[ends] - sums[ends - size])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes one after another and where each text starts, the end last."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
