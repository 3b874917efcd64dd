"""Words, lines and hashes of many texts at once, as numpy arrays over their joined UTF-8 bytes."""

from __future__ import annotations

import numpy as np

U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)
PRIME = (1 << 61) - 1
_BASE = 0x1A2B_59E3_779B_97F5 % PRIME
_SEGMENT = 1 << 22
_state: dict = {}


def byte_table(outside: list[tuple[int, int]]) -> np.ndarray:
    """True for each byte that belongs to a word, from the closed ranges that don't."""
    t = np.ones(256, bool)
    for lo, hi in outside:
        t[lo : hi + 1] = False
    return t


#: Words of [^\x20\x09-\x0D]+ and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+; bytes over 0x7F are of words in both.
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words' places in data, and each text's first word; first has an entry more than texts."""
    w = table[data]
    s, e = w.copy(), w.copy()
    if len(data):
        s[1:] &= ~w[:-1]
        e[:-1] &= ~w[1:]
        full = off[1:] > off[:-1]
        heads, tails = off[:-1][full], off[1:][full] - 1
        s[heads] = w[heads]
        e[tails] = w[tails]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    return starts, ends, np.searchsorted(starts, off)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if _state.get("n", 0) < n:
        size = max(n, 1 << 20) + 128
        with np.errstate(over="ignore"):
            up, down = np.full(size, _ODD, U), np.full(size, _INV, U)
            up[0] = down[0] = 1
            _state.update(n=size - 64, up=np.cumprod(up), down=np.cumprod(down))
        _state["byte"] = np.random.default_rng(20_240_501).integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
    return _state["byte"], _state["up"], _state["down"]


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for any 64-bit x."""
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of numbers below it: by halves of 30 and 31 bits, as 2**61 is 1."""
    low, mid = U((1 << 31) - 1), U((1 << 30) - 1)
    a1, a0, b1, b0 = a >> U(31), a & low, b >> U(31), b & low
    m = a1 * b0 + a0 * b1
    return _folded(((a1 * b1) << U(1)) + (m >> U(30)) + ((m & mid) << U(31)) + _folded(a0 * b0))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = _times(out[:more], np.full(more, step, U))
        have, step = have + more, step * step % PRIME
    return out


def _prime_tables(n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Powers of _BASE modulo PRIME, each in halves of 31 and 30 bits, and their inverses."""
    if _state.get("prime_n", 0) < n:
        size = max(n, 1 << 20) + 128
        up = _powers(_BASE, size)
        halves = [up & U((1 << 31) - 1), up >> U(31)]
        _state.update(prime_n=size - 64, halves=halves, inverse=_powers(pow(_BASE, -1, PRIME), size))
    return _state["halves"], _state["inverse"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a hash's bits, in place."""
    with np.errstate(over="ignore"):
        h ^= h >> U(31)
        h *= U(0xBF58476D1CE4E5B9)
        h ^= h >> U(29)
        h *= U(0x94D049BB133111EB)
        h ^= h >> U(32)
    return h


class Hasher:
    """Hashes of any spans of data: polynomials modulo the prime 2**61 - 1, from prefix sums, then mixed to 64 bits.

    Two different spans of n bytes are alike with a chance of about n / 2**61, whatever their texts' structure;
    modulo a power of two there are texts, as the Thue-Morse sequence and its complement, that are always alike.
    """

    def __init__(self, data: np.ndarray):
        halves, self.inverse = _prime_tables(len(data) + 1)
        code = data.astype(U)
        code += U(1)
        self.sums = []
        for half in halves:
            total = np.zeros(len(data) + 1, U)
            for lo in range(0, len(data), _SEGMENT):  # so that a sum stays below 2**64
                hi = min(len(data), lo + _SEGMENT)
                np.cumsum(code[lo:hi] * half[lo:hi], out=total[lo + 1 : hi + 1])
                if lo:
                    total[lo + 1 : hi + 1] += _folded(total[lo : lo + 1])
            self.sums.append(total)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        a, b = (_folded(total[ends]) + (U(PRIME) - _folded(total[starts])) for total in self.sums)
        b = _folded(b)
        whole = _folded(_folded(a) + ((b & U((1 << 30) - 1)) << U(31)) + (b >> U(30)))  # b times 2**31
        with np.errstate(over="ignore"):
            return mix(_times(whole, self.inverse[starts]) + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


class Rolling:
    """Cheap hashes of the k bytes from each place, modulo 2**64: to choose places by, not to tell texts apart."""

    def __init__(self, data: np.ndarray):
        code, up, self.down = _tables(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, U)
            np.cumsum(code[data] * up[: len(data)], out=self.sums[1:])

    def grams(self, k: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Of the places from lo to hi that have k bytes."""
        n = len(self.sums) - k
        hi = n if hi is None else min(hi, n)
        if hi <= lo:
            return np.zeros(0, U)
        with np.errstate(over="ignore"):
            return mix((self.sums[lo + k : hi + k] - self.sums[lo:hi]) * self.down[lo:hi])


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over each text's words."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
