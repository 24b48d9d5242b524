"""Hashes of words and byte windows of many texts at once, in numpy.

Texts are laid end to end in one byte buffer.  A polynomial hash of any slice
comes from prefix sums, so words and windows of all texts are hashed without a
Python loop over them.  The polynomial is taken modulo two primes near 2**31:
modulo a power of two some texts, such as a Thue-Morse word and its complement,
collide whatever the base is.  What must be exact compares bytes all the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Two primes, each with its base.
PRIMES, BASES = (2**31 - 1, 2**31 - 19), (1345196843, 1778206531)
#: Bytes up to which a prefix sum of unreduced terms stays below 2**64.
UNREDUCED = 1 << 24

_powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint32), np.ones(1, np.uint32))] * 2


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo its prime."""
    if len(_powers[which][0]) < n:
        prime, n = PRIMES[which], -(-n // (1 << 18)) << 18
        made = []
        for base, known in zip((BASES[which], pow(BASES[which], -1, prime)), _powers[which], strict=True):
            out = known.astype(U)
            while len(out) < n:
                out = np.concatenate([out, out[: n - len(out)] * U(pow(base, len(out), prime)) % U(prime)])
            made.append(out.astype(np.uint32))
        _powers[which] = (made[0], made[1])
    return _powers[which]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, elementwise; x is uint64."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Buffer:
    """Texts end to end: data (uint8) and the first byte of each text, with the total at the end."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.starts = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(x) for x in texts], out=self.starts[1:])
        self._prefix: list[np.ndarray | None] = [None, None]

    @classmethod
    def over(cls, raw: bytes, starts: np.ndarray) -> Buffer:
        """A buffer of bytes that are end to end already."""
        out = cls.__new__(cls)
        out.n, out.raw, out.data, out.starts, out._prefix = len(starts) - 1, raw, np.frombuffer(raw, np.uint8), starts, [None, None]
        return out

    def prefix(self, which: int) -> np.ndarray:
        """Sums of the terms before each byte."""
        if self._prefix[which] is None:
            up, _ = powers(which, len(self.data) + 1)
            terms = (self.data.astype(U) + U(1)) * up[: len(self.data)]
            if len(terms) >= UNREDUCED:
                terms %= U(PRIMES[which])
            out = np.zeros(len(self.data) + 1, U)
            np.cumsum(terms, out=out[1:])
            self._prefix[which] = out
        return self._prefix[which]

    def residues(self, which: int, start, end) -> np.ndarray:
        """Of each slice its polynomial modulo one prime, wherever the slice stands."""
        prime = U(PRIMES[which])
        prefix, (_, down) = self.prefix(which), powers(which, len(self.data) + 1)
        return (prefix[end] - prefix[start]) % prime * down[start] % prime

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each slice; equal bytes have equal hashes wherever they stand."""
        both = self.residues(0, start, end) << U(32) | self.residues(1, start, end)
        return mixed(both ^ (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes b with inside[b], never across texts: starts, ends, and the text of each."""
        mask = np.zeros(len(self.data) + 2, bool)
        mask[1:-1] = inside[self.data]
        first = mask[1:] & ~mask[:-1]
        last = mask[:-1] & ~mask[1:]
        edges = self.starts[1:-1]
        edges = edges[(edges > 0) & (edges < len(self.data))]
        both = edges[mask[edges] & mask[edges + 1]]
        first[both] = True
        last[both] = True
        start, end = np.flatnonzero(first), np.flatnonzero(last)
        return start, end, np.searchsorted(self.starts, start, side="right") - 1


#: Bytes of words: ASCII letters, digits, underscore, and all of a non-ASCII character.
WORD_BYTES = np.zeros(256, bool)
for _b in range(256):
    WORD_BYTES[_b] = _b >= 128 or chr(_b).isalnum() or _b == 95


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, and a lone surrogate, which no Parquet string holds, is kept as is."""
    return (text or "").encode("utf-8", "surrogatepass")


def batches(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text stands alone, whole."""
    first = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > limit:
            yield first, i
            first, size = i, 0
        size += len(x)
    if first < len(texts):
        yield first, len(texts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
