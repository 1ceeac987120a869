"""Words of many texts at once: byte positions, 64-bit word hashes and window hashes in numpy.

Texts are joined into one buffer of bounded size, so that numpy works on a megabyte at a time however short
or long the texts of a batch are; a single longer text is a buffer of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np

# Letters A-Z only; every other byte is left alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# White space that ends a word: blank and the controls 9 to 13.
BLANKS = np.zeros(256, bool)
BLANKS[[32, 9, 10, 11, 12, 13]] = True

CHUNK = 1 << 20
# Polynomial hashes modulo 2**64 are told apart by construction only up to some hundred places; what is longer
# than this goes by a cryptographic digest.
LONGEST = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


_HELD: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """``make()``, kept by a Python worker from task to task until it is asked for something else."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Workers live on from stage to stage: without this, idle ones would hold the tables of every stage they were in."""
    _HELD.clear()
    _POWERS.clear()


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * CHUNK:  # very long texts don't leave a table behind
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: Sequence[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes, or of one text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of some texts: ``start`` and ``end`` in the joined bytes, ``doc`` (which text), ``hash``."""

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray = BLANKS):
        self.joined = b" ".join(texts)
        codes = np.frombuffer(self.joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])  # of the texts in the joined bytes
        inside = ~separators[codes]
        edges = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
        self.start, self.end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        # Words of text i are first[i] : first[i + 1].
        self.first = np.searchsorted(self.start, self.offsets)
        self.codes = codes

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word: the word's bytes as digits of an odd base, moved to position 0; of long words a digest."""
        codes, n = self.codes, len(self.codes)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
        value = (total[self.end] - total[self.start]) * powers(_INVERSE, n)[self.start]
        for i in np.flatnonzero(self.end - self.start > LONGEST).tolist():
            value[i] = int.from_bytes(hashlib.blake2b(self.joined[self.start[i] : self.end[i]], digest_size=8).digest(), "little")
        return mix(value)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` consecutive words starting at each word; the last ``width - 1`` have none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(total)


def slices(batch, column: str, limit: int = 4 * CHUNK) -> Iterator:
    """Slices of an Arrow batch with at most ``limit`` bytes in a column, or of one row."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def encoded(texts, lower: bool = False) -> list[bytes]:
    """UTF-8 of the texts; a missing text is empty."""
    made = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    return [t.translate(LOWER) for t in made] if lower else made
