"""Byte-level BPE by a rank queue made of hierarchical bitmaps.

A pre-token is a linked list of ids, at first of its bytes. Each adjacent pair that has a rank waits in the bucket of that
rank, as the position of its left part. Bitmaps of the used buckets, under a summary bitmap of the bitmaps in
use, give the lowest rank in use by two find-first-set steps. A taken position is checked against the list: if
its parts have merged with others meanwhile, the entry is stale and skipped. A merge thus costs the same
however long the pre-token is, and a run of a million letters takes n log n steps (the log from keeping the
positions of a bucket in order).

Many pre-tokens share one queue: they lie side by side in one list, with no pair across a border, and a bucket's
positions are merged all at once in numpy. Where a merge of several positions of one pre-token brings up a pair
of lower rank, which would have had to go between them, that pre-token is done again by itself.

Equal ranks merge from the left. A pre-token that is itself in the vocabulary is its own id.

Edge cases: a null text is an empty text, without ids; empty and repeated rows are ordinary rows; ids of rows
may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import pieces
from .text import held

SHIFT = 8
WORD = 1 << SHIFT  # ranks of a bitmap
MASK = WORD - 1
BIT = [1 << i for i in range(1 << 14)]  # for ranks up to 2**22
# Rank files are vocabularies of at most this size (a broadcast of some tens of MB).
VOCABULARY_BYTES = 64 << 20
CACHED = 1 << 19  # blank-delimited pieces that a Python worker remembers, by their hashes
WORDS = 150_000  # and pre-tokens
WORD_CHARS = 64  # longer ones are merged each time
TOGETHER = 1 << 18  # characters looked up at a time
LONG = 16 << 20  # longer texts go pre-token by pre-token
BATCH_BYTES = 3 << 20  # of text encoded and returned at a time


class PairTable:
    """Ranks of pairs of ids, for many pairs at once: open addressing in numpy."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.shift = 64 - max(8, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << (64 - self.shift), -1, np.int64)
        self.ranks = np.full(len(self.keys), -1, np.int32)
        at = self._place(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slots], self.ranks[slots] = keys[won], ranks[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._place(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.ranks[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            same = seen == keys[open_]
            out[open_[same]] = self.ranks[at[open_[same]]]
            open_ = open_[~same & (seen != -1)]
        return out


class Encoder:
    """Ids of texts by a table of ranks; the id of a byte string is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        # Rank of two neighbours by their ids: every cut of a vocabulary entry into two others.
        cuts = ((p[:i], p[i:], rank) for p, rank in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks)
        pairs = np.fromiter(((ranks[a] << 32 | ranks[b], rank) for a, b, rank in cuts), np.dtype("i8,i4"))
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every byte")
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.single_ids = np.array(self.single, np.int32)
        self.pairs = PairTable(pairs["f0"], pairs["f1"])
        self.leaf = [0] * (size // WORD + 1)
        self.words: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue: ``bucket`` holds the left positions of pairs by rank (a position, or a heap of several),
        ``leaf`` a bit per rank in use, ``top`` a bit per word of ``leaf`` in use.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        single, leaf, bit, known, name = self.single, self.leaf, BIT, self.ranks.get, self.bytes_of

        def rank_of(left, right):
            return known(name[left] + name[right])

        parts = [single[b] for b in piece]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bucket: dict[int, int | list[int]] = {}
        top = 0
        fresh = [(rank_of(parts[i], parts[i + 1]), i) for i in range(n - 1)]
        while True:
            for rank, i in fresh:
                if rank is None:
                    continue
                held = bucket.get(rank)
                if held is None:
                    bucket[rank] = i
                    top |= bit[rank >> SHIFT]
                    leaf[rank >> SHIFT] |= bit[rank & MASK]
                elif type(held) is int:
                    bucket[rank] = [held, i] if held < i else [i, held]
                else:
                    heappush(held, i)
            if not top:
                return [p for p in parts if p >= 0]
            # The lowest rank in use, by two find-first-set steps, and its leftmost position.
            word = (top & -top).bit_length() - 1
            bits = leaf[word]
            low = bits & -bits
            rank = (word << SHIFT) + low.bit_length() - 1
            held = bucket[rank]
            if type(held) is int:
                i, held = held, None
            else:
                i = heappop(held)
            if not held:
                del bucket[rank]
                bits ^= low
                leaf[word] = bits
                if not bits:
                    top ^= bit[word]
            fresh = ()
            left, j = parts[i], after[i]
            if left < 0 or j >= n or parts[j] < 0 or rank_of(left, parts[j]) != rank:
                continue  # stale: a part is gone or has grown
            parts[i], parts[j] = rank, -1
            j = after[i] = after[j]
            h = before[i]
            if j < n:
                before[j] = i
                if h >= 0:
                    fresh = ((rank_of(rank, parts[j]), i), (rank_of(parts[h], rank), h))
                else:
                    fresh = ((rank_of(rank, parts[j]), i),)
            elif h >= 0:
                fresh = ((rank_of(parts[h], rank), h),)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of many pre-tokens as 32-bit integers, by one queue over all of them."""
        whole = [self.ranks.get(w) for w in words]
        rest = [i for i, r in enumerate(whole) if r is None and words[i]]
        made = [b"" if r is None else array("i", (r,)).tobytes() for r in whole]
        for i, ids in zip(rest, self._merged([words[i] for i in rest])):
            made[i] = ids
        return made

    def _merged(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        parts = self.single_ids[np.frombuffer(b"".join(words), np.uint8)]
        n = len(parts)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = n
        before[ends - sizes] = -1
        find, leaf, bit = self.pairs.find, self.leaf, BIT
        bucket: dict[int, list[np.ndarray]] = {}
        again: set[int] = set()

        def push(ranks: np.ndarray, places: np.ndarray) -> int:
            """Put places into the buckets of their ranks; gives the words of ``leaf`` that are in use now."""
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            used, at = 0, 0
            for rank, end in zip(ranks[np.concatenate([[0], cuts])].tolist(), [*cuts.tolist(), len(ranks)]):
                held = bucket.get(rank)
                if held is None:
                    bucket[rank] = [places[at:end]]
                    used |= bit[rank >> SHIFT]
                    leaf[rank >> SHIFT] |= bit[rank & MASK]
                else:
                    held.append(places[at:end])
                at = end
            return used

        place = np.flatnonzero(after < n)
        ranks = find(parts[place], parts[after[place]])
        have = ranks >= 0
        top = push(ranks[have], place[have].astype(np.int32)) if have.any() else 0
        while top:
            word = (top & -top).bit_length() - 1
            bits = leaf[word]
            low = bits & -bits
            rank = (word << SHIFT) + low.bit_length() - 1
            held = bucket.pop(rank)
            leaf[word] = bits = bits ^ low
            if not bits:
                top ^= bit[word]
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            # Stale entries: a part is gone, reaches the border or has grown.
            j = after[at]
            at = at[(parts[at] >= 0) & (j < n)]
            at = at[find(parts[at], parts[after[at]]) == rank]
            if len(at) > 1:
                chained = after[at[:-1]] == at[1:]
                if chained.any():  # of a chain of overlapping pairs every other one, from the left
                    start = np.flatnonzero(np.concatenate([[True], ~chained]))
                    run = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
                    at = at[run % 2 == 0]
            if not len(at):
                continue
            j = after[at]
            parts[at], parts[j] = rank, -1
            k = after[j]
            after[at] = k
            inner = k < n
            before[k[inner]] = at[inner]
            h = before[at]
            place = np.concatenate([at[inner], h[h >= 0]])
            if len(place):
                ranks = find(parts[place], parts[after[place]])
                have = ranks >= 0
                if have.any():
                    ranks, place = ranks[have], place[have]
                    if len(at) > 1 and ranks.min() < rank:
                        owner = np.searchsorted(ends, at, "right")
                        several = owner[1:][owner[1:] == owner[:-1]]
                        again.update(np.intersect1d(np.searchsorted(ends, place[ranks < rank], "right"), several).tolist())
                    top |= push(ranks, place)
        left = np.flatnonzero(parts >= 0)
        cuts = (4 * np.searchsorted(left, np.concatenate([[0], ends]))).tolist()
        data = parts[left].astype("<i4").tobytes()
        made = [data[x:y] for x, y in zip(cuts, cuts[1:])]
        for i in again:
            made[i] = array("i", self.merge(words[i])).tobytes()
        return made

    def plain(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers: each match of the pattern by itself."""
        return self.plain_all([text])[0]

    def plain_all(self, texts: list[str]) -> list[bytes]:
        known, findall = self.words, self.pattern.findall
        split = [findall(t) for t in texts]
        new = list({m for matches in split for m in matches if m not in known})
        made = dict(zip(new, self.merge_all([m.encode("utf-8", "surrogatepass") for m in new])))
        ids = [b"".join([known[m] if m in known else made[m] for m in matches]) for matches in split]
        if len(known) + len(made) > WORDS:
            known.clear()
        known.update((m, i) for m, i in made.items() if len(m) <= WORD_CHARS)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class SpacedEncoder(Encoder):
    """An encoder that remembers pieces between single blanks.

    For the usual pattern, in which a blank belongs to the letters, digits or signs after it, a blank between
    two characters that are no white space always starts a match. So such pieces can be encoded alone, each
    with its blank. Texts with other runs of white space around a blank go through the pattern whole.
    """

    ODD = re.compile("  | \n|\n |[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(ranks, pattern)
        self.table = pieces.PieceTable("<i4", CACHED)

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of texts without odd white space, their pieces' starts and ends, and each text's first piece."""
        codes = pieces.code_points("\0".join(texts) + "\0")
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        # A piece starts at each blank and at the start of each text, and ends where the next starts.
        starts = codes == 32
        starts[bounds[:-1]] = True
        start = np.flatnonzero(starts)
        end = np.concatenate([start[1:], [len(codes)]])
        first = np.searchsorted(start, bounds)
        end[first[1:] - 1] = bounds[1:] - 1
        return codes, start, end, first

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts as 32-bit integers."""
        texts = [t or "" for t in texts]
        out: list[bytes] = [b""] * len(texts)
        odd = [i for i, t in enumerate(texts) if t and (len(t) > LONG or self.ODD.search(t))]
        for i in odd:
            out[i] = self.plain(texts[i])
        rest = sorted({i for i, t in enumerate(texts) if t}.difference(odd))
        groups: list[list[int]] = [[]]
        size = 0
        for i in rest:
            if groups[-1] and size + len(texts[i]) > TOGETHER:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(texts[i])
        # Unknown pieces of all groups are encoded together, then every group is put together from the table.
        cut = [self._cut([texts[i] for i in group]) for group in groups] if rest else []
        made = pieces.encode_groups(self.table, [c[:3] for c in cut], self.plain_all)
        for group, (_, _, _, first), (ids, lengths) in zip(groups, cut, made):
            cuts = (4 * np.concatenate([[0], np.cumsum(lengths)])[first]).tolist()
            data = ids.tobytes()
            for i, x, y in zip(group, cuts, cuts[1:]):
                out[i] = data[x:y]
        return out

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_all([text])[0]).tolist()


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: a line per piece, base64 and rank. Read on the driver; its size is checked."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, data.splitlines()) if piece}


def _encoder(key: str, shared) -> SpacedEncoder:
    """The encoder of this Python worker."""
    ranks, pattern = shared.value
    return held(("bpe", key, pattern), lambda: SpacedEncoder(ranks, pattern))


def _shared(spark: SparkSession, path: str, pattern: str):
    ranks = read_ranks(spark, path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return key, spark.sparkContext.broadcast((ranks, pattern))


def _parts(batch: pa.RecordBatch, text: str):
    """Slices of a batch of some MB of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + BATCH_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def encode(
    docs: DataFrame, path: str, pattern: str, *, text: str = "text", into: str = "ids", decoded: str | None = None
) -> DataFrame:
    """All columns of ``docs`` but its text, and the ids of the texts as an array ``into``.

    With ``decoded``, the ids are decoded again into a column of that name, in the same pass over the rows.
    """
    from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

    key, shared = _shared(docs.sparkSession, path, pattern)
    added = [StructField(into, ArrayType(IntegerType()), False)]
    if decoded:
        added.append(StructField(decoded, BinaryType(), False))
    left = [f for f in docs.schema.fields if f.name != text]
    clash = [f.name for f in added if f.name in docs.columns and f.name != text]
    if clash:
        raise ValueError(f"the documents have columns {clash} already")

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in batches:
            for part in _parts(batch, text):
                packed = encoder.encode_all(part.column(text).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                values = np.frombuffer(b"".join(packed), np.int32)
                made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
                if decoded:
                    made.append(pa.array([encoder.decode(array("i", p)) for p in packed], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in left), *made], names=[f.name for f in (*left, *added)]
                )

    return docs.mapInArrow(run, StructType([*left, *added]))


def decode(rows: DataFrame, path: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the bytes that its ids stand for. A null list has no bytes; an unknown id raises."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    key, shared = _shared(rows.sparkSession, path, "")
    schema = StructType([*rows.schema.fields, StructField(into, BinaryType(), False)])

    def run(batches):
        encoder = _encoder(key, shared)
        for batch in batches:
            made = [encoder.decode(i) if i else b"" for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, into])

    return rows.mapInArrow(run, schema)


def digests(rows: DataFrame, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens and the digests of decimal ids and of decoded bytes, beside the columns of ``rows``."""
    return rows.withColumns({
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256),
        "decoded_sha256": F.sha2(F.col(decoded), 256),
    })
