"""Ids of text pieces remembered in numpy arrays: many pieces are looked up and put together at once.

A piece is known by two 64-bit hashes of its code points and its length, a long one by a digest of as many bits. Tables hold up to ``limit`` pieces; a
full one is emptied, so a Python worker's memory is bounded. A group with more different pieces than that is
encoded in runs of at most ``limit`` pieces, one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from .text import LONGEST, mix, powers

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def string(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each piece: its code points as digits of an odd base, moved to position 0; of long ones a digest."""
    made = []
    wide = codes.astype(np.uint64) + np.uint64(1)
    length = (end - start).astype(np.uint64)
    for base in _BASES:
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(wide * powers(base, len(codes)), out=total[1:])
        value = (total[end] - total[start]) * powers(pow(base, -1, 1 << 64), len(codes) + 1)[start]
        made.append(mix(value + length * np.uint64(0xD6E8FEB86659FD93)))
    for i in np.flatnonzero(length > LONGEST).tolist():
        digest = hashlib.blake2b(np.ascontiguousarray(codes[start[i] : end[i]]).tobytes(), digest_size=16).digest()
        made[0][i], made[1][i] = np.frombuffer(digest, np.uint64)
    return made[0] | np.uint64(1), made[1]


class PieceTable:
    """Open addressing over two hashes; the ids of all pieces lie in one pool."""

    def __init__(self, kind: str, limit: int):
        self.kind, self.limit = kind, limit
        self.slots = 1 << (2 * limit - 1).bit_length()
        self.clear()

    def clear(self) -> None:
        self.first = np.zeros(self.slots, np.uint64)  # 0 marks a free slot; hashes are odd
        self.second = np.zeros(self.slots, np.uint64)
        self.entry = np.zeros(self.slots, np.int32)
        self.ends = np.zeros(self.limit + 1, np.int64)
        self.pool = np.zeros(4 * self.limit, self.kind)
        self.count = 0

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 where there is none."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        at = (b & np.uint64(self.slots - 1)).astype(np.int64)
        while len(left):
            seen = self.first[at]
            same = (seen == a[left]) & (self.second[at] == b[left])
            out[left[same]] = self.entry[at[same]]
            on = ~same & (seen != 0)
            left, at = left[on], (at[on] + 1) & (self.slots - 1)
        return out

    def add(self, a: np.ndarray, b: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """Entries of new, different pieces. A full table is emptied first: earlier entries are then void."""
        n, size = len(ids), np.dtype(self.kind).itemsize
        if n > self.limit:
            raise ValueError("more pieces at a time than a table holds")
        lengths = np.fromiter(map(len, ids), np.int64, n) // size
        need = int(self.ends[self.count]) + int(lengths.sum())
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(need, self.kind)])
        entries = np.arange(self.count, self.count + n)
        at0 = int(self.ends[self.count])
        self.ends[self.count + 1 : self.count + n + 1] = at0 + np.cumsum(lengths)
        self.pool[at0:need] = np.frombuffer(b"".join(ids), self.kind)
        self.count += n
        left = np.arange(n)
        at = (b & np.uint64(self.slots - 1)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.first[at] == 0)
            # One of the pieces that want a free slot gets it.
            slots, winner = np.unique(at[free], return_index=True)
            won = free[winner]
            self.first[slots], self.second[slots], self.entry[slots] = a[left[won]], b[left[won]], entries[left[won]]
            keep = np.ones(len(left), bool)
            keep[won] = False
            left, at = left[keep], (at[keep] + 1) & (self.slots - 1)
        return entries

    def room(self, n: int) -> bool:
        return self.count + n <= self.limit

    def lengths(self, entries: np.ndarray) -> np.ndarray:
        return self.ends[entries + 1] - self.ends[entries]

    def ids(self, entries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of all entries, one after another."""
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        place = np.repeat(self.ends[entries] - before, lengths) + np.arange(total)
        return self.pool[place]


def encode(table: PieceTable, codes: np.ndarray, start: np.ndarray, end: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per piece) of pieces ``codes[start:end]``; ``make`` gives the ids of a list of unknown pieces as bytes."""
    a, b = hashes(codes, start, end)
    found = table.find(a, b)
    missing = np.flatnonzero(found < 0)
    if len(missing):
        _, one, which = np.unique(b[missing], return_index=True, return_inverse=True)
        if not table.room(len(one)):
            table.clear()
            if len(start) > table.limit:  # in runs that fit whatever is in them
                return _in_runs(table, codes, start, end, make)
            if len(one) < len(start):  # everything is looked up anew, as new pieces
                return encode(table, codes, start, end, make)
        rows = missing[one]
        whole = string(codes)
        made = make([whole[s:e] for s, e in zip(start[rows].tolist(), end[rows].tolist())])
        if (a[missing] != a[rows][which]).any():
            raise ValueError("two pieces with equal hashes")
        found[missing] = table.add(a[rows], b[rows], made)[which]
    lengths = table.lengths(found)
    return table.ids(found, lengths), lengths


def _in_runs(table: PieceTable, codes: np.ndarray, start: np.ndarray, end: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
    """``encode`` of ``limit`` consecutive pieces at a time."""
    ids, lengths = [], []
    for at in range(0, len(start), table.limit):
        s, e = start[at : at + table.limit], end[at : at + table.limit]
        low, high = int(s.min()), int(e.max())
        made = encode(table, codes[low:high], s - low, e - low, make)
        ids.append(made[0])
        lengths.append(made[1])
    return np.concatenate(ids), np.concatenate(lengths)


def encode_groups(table: PieceTable, groups: list[tuple], make) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``encode`` for several (codes, start, end), whose unknown pieces go to ``make`` in one call."""
    known = [hashes(*group) for group in groups]

    def unknown() -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Hashes of the different unknown pieces, and the pieces."""
        rows = [np.flatnonzero(table.find(a, b) < 0) for a, b in known]
        both = [np.concatenate([pair[k][r] for pair, r in zip(known, rows)] or [np.zeros(0, np.uint64)]) for k in (0, 1)]
        second, one, which = np.unique(both[1], return_index=True, return_inverse=True)
        if (both[0] != both[0][one][which]).any():
            raise ValueError("two pieces with equal hashes")
        order = np.argsort(one)
        second, one = second[order], one[order]
        cuts = np.searchsorted(one, np.cumsum([0, *map(len, rows)]))
        first, strings, done = np.zeros(len(one), np.uint64), [], 0
        for (codes, start, end), (a, _), r, x, y in zip(groups, known, rows, cuts, cuts[1:]):
            if y > x:
                at = r[one[x:y] - done]
                first[x:y] = a[at]
                whole = string(codes)
                strings += [whole[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())]
            done += len(r)
        return first, second, strings

    first, second, new = unknown()
    if not table.room(len(new)):
        table.clear()
        first, second, new = unknown()
    if not table.room(len(new)):  # more pieces than a table holds: one group at a time
        for group in groups:
            yield encode(table, *group, make)
        return
    if new:
        table.add(first, second, make(new))
    for a, b in known:
        found = table.find(a, b)
        lengths = table.lengths(found)
        yield table.ids(found, lengths), lengths
