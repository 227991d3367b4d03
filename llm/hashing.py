"""Hashes of any stretches of a byte array, from prefix sums over it modulo two primes.

Polynomial sums modulo 2 ** 64 collide for any odd base on Thue-Morse texts; modulo a prime with a base drawn at random they
do not. Two primes give 62 bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_PRIMES = tuple(map(np.uint64, (2147483647, 2147483629)))
_RNG = np.random.default_rng(20240229)
_BASES = [int(_RNG.integers(1 << 20, int(p) - 1)) for p in _PRIMES]
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Tables of powers are kept up to this length; for a longer array they are made for it and let go.
_KEPT = 1 << 21
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(base: int, prime: np.uint64, n: int) -> np.ndarray:
    """The first n powers of the base, by doubling."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        some = min(done, n - done)
        out[done : done + some] = out[:some] * np.uint64(pow(base, done, int(prime))) % prime
        done += some
    return out.astype(np.uint32)


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo its prime."""
    found = _powers.get(which)
    if found is None or len(found[0]) < n:
        size = max(n, min(2 * n, _KEPT))
        prime, base = _PRIMES[which], _BASES[which]
        found = _table(base, prime, size), _table(pow(base, -1, int(prime)), prime, size)
        if size <= _KEPT:
            _powers[which] = found
    return found[0][:n], found[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Sums:
    """Prefix sums of the terms value * base ** place, one row for each prime; they do not wrap below 2 ** 33 values."""

    rows: list[np.ndarray]
    down: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.rows[0])


def prefix(values: np.ndarray) -> Sums:
    """Sums from which `stretches` takes hashes. values: uint64."""
    rows, down = [], []
    for which, prime in enumerate(_PRIMES):
        up, inverse = powers(which, len(values) + 1)
        row = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values % prime * up[:-1] % prime, out=row[1:])
        rows.append(row)
        down.append(inverse)
    return Sums(rows, down)


def stretches(sums: Sums, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end]; equal stretches have equal hashes wherever they stand."""
    high, low = ((row[ends] - row[starts]) % prime * down[starts] % prime for row, down, prime in zip(sums.rows, sums.down, _PRIMES, strict=True))
    return mixed((high << np.uint64(31)) | low)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray, spaces: bytes = b" \t\n\x0b\x0c\r") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the n + 1 offsets of the texts among the words."""
    is_space = np.zeros(256, bool)
    is_space[list(spaces)] = True
    full = ~is_space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a text begins, or ends, there
    before = np.r_[False, full[:-1]] if len(full) else full
    after = np.r_[full[1:], False] if len(full) else full
    starts = np.flatnonzero(full & (~before | first[:-1]))
    ends = np.flatnonzero(full & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)
