"""Ranked lexical search: the best documents of every item, found by grouping documents by the terms they hold.

One pass over the texts keeps, per document, its length and the items' terms in it (an index in the shared
folder). Counts over that index give every term's weight. Then each task takes its documents in shards:

1. every term of the block of items has a bitmap of the shard's documents that hold it, and the largest
   share of a score it gives to any of them;
2. for an item the bitmaps of its terms, turned by 90 degrees, are each document's mask of matched terms;
   documents of equal masks form a group, which can't score more than the sum of its terms' largest shares;
3. groups are evaluated by descending bound. Once the worst of the best documents kept so far scores more than the
   next bound, no document left can enter, and the shard is done. What is kept goes on to the next shard.

The items are a query set held against all documents: they are read in blocks of at most ``BLOCK_BYTES`` of
text, one block at a time, and a block's terms go to the tasks as a broadcast. A document is counted and scored in
64-bit integers; only a term's weight comes from a logarithm.

A task keeps ``top`` documents per item, ties included by their order, so groups of copies cost no memory. The
tasks' lists are merged in two steps, so no task sees more than a share of them.

Edge cases: a null or empty text, or one without a term, is no document and an item of that kind finds
nothing; rows that repeat an id are documents or items of their own; a null document id is the smallest and an item with a
null id is searched for like any other; equal scores go by ascending document id; columns other than the named ones are
not looked at; empty tables give an empty result. Document ids are integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from ..session import materialise

TOP = 50
BLOCK_BYTES = 8 << 20
SHARD = 4096
POSTINGS = 1 << 21
# Cells of the bit matrix of an item that are unpacked at a time.
CELLS = 1 << 24
SLOTS = 64

# Bytes of terms: digits, letters (A-Z lower-cased) and everything beyond ASCII; the others separate.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLDED).split(b" ") if text else []


def counted(text: bytes | None) -> tuple[Counter, int]:
    """Occurrences of every term, and of all."""
    found = Counter(terms_of(text))
    found.pop(b"", None)
    return found, found.total()


class Best:
    """The ``top`` documents of one item so far, by descending score and ascending id."""

    __slots__ = ("score", "known", "doc", "top")

    def __init__(self, top: int):
        self.top = top
        self.score, self.known, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        """The score a document must reach."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, known: np.ndarray, doc: np.ndarray) -> None:
        enough = score >= self.least()
        if not enough.any():
            return
        score = np.concatenate([self.score, score[enough]])
        known = np.concatenate([self.known, known[enough]])
        doc = np.concatenate([self.doc, doc[enough]])
        order = np.lexsort((doc, known, -score))[: self.top]
        self.score, self.known, self.doc = score[order], known[order], doc[order]


class Shard:
    """Postings of some documents: bitmaps and shares of the score by term."""

    def __init__(self, known: np.ndarray, doc: np.ndarray, length: np.ndarray, count: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int, total: int):
        self.known, self.doc = known, doc
        self.size = len(doc)
        m = 50 + (50 * length * n) // total
        holder = np.repeat(np.arange(self.size), count)
        tf = tf.astype(np.int64)
        share = (1_000_000_000 * tf) // (1000 * tf + 20 * m[holder])
        order = np.argsort(term, kind="stable")
        self.holder, self.share = holder[order], share[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.share, first) if len(first) else first
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, k: int) -> np.ndarray:
        made = self.bitmaps.get(k)
        if made is None:
            bits = np.zeros(self.size, bool)
            bits[self.holder[self.first[k] : self.first[k + 1]]] = True
            made = self.bitmaps[k] = np.packbits(bits)
        return made

    def search(self, item: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Hold the shard's documents against one item of different, ascending terms."""
        at = np.searchsorted(self.terms, item)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == item[here]
        at, weight = at[here], weight[here]
        # What can't add to a score needs no bit.
        at, weight = at[weight > 0], weight[weight > 0]
        if not len(at) or int((weight * self.most[at]).sum()) < best.least():
            return
        maps = np.stack([self.bitmap(k) for k in at.tolist()])
        step = max(1, CELLS // (8 * len(at)))
        for low in range(0, maps.shape[1], step):
            self._slice(maps[:, low : low + step], 8 * low, at, weight, best)

    def _slice(self, maps: np.ndarray, start: int, at: np.ndarray, weight: np.ndarray, best: Best) -> None:
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, axis=0)))
        if not len(some):
            return
        masks = np.packbits(np.unpackbits(maps, axis=1)[:, some], axis=0)
        wide = -len(masks) % 8
        masks = np.ascontiguousarray(np.concatenate([masks, np.zeros((wide, len(some)), np.uint8)]).T if wide else masks.T)
        keys = masks.view(np.uint64)[:, 0] if masks.shape[1] == 8 else masks.view(np.dtype((np.void, masks.shape[1])))[:, 0]
        _, one, group = np.unique(keys, return_index=True, return_inverse=True)
        bound = np.unpackbits(masks[one], axis=1)[:, : len(at)].astype(np.int64) @ (weight * self.most[at])
        # Documents by descending bound of their groups.
        falling = np.argsort(-bound, kind="stable")
        place = np.empty(len(falling), np.int64)
        place[falling] = np.arange(len(falling))
        order = np.argsort(place[group], kind="stable")
        bounds = bound[group[order]]
        done, take = 0, best.top
        while done < len(order) and bounds[done] >= best.least():
            # Whole groups, of as many documents as are wanted or more.
            until = int(np.searchsorted(-bounds, -bounds[min(done + take, len(order)) - 1], "right"))
            self._evaluate(np.sort(some[order[done:until]]) + start, at, weight, best)
            done, take = until, 2 * take

    def _evaluate(self, docs: np.ndarray, at: np.ndarray, weight: np.ndarray, best: Best) -> None:
        score = np.zeros(len(docs), np.int64)
        for k, w in zip(at.tolist(), weight.tolist()):
            holder = self.holder[self.first[k] : self.first[k + 1]]
            place = np.searchsorted(holder, docs)
            place[place == len(holder)] = 0
            score += np.where(holder[place] == docs, w * self.share[self.first[k] : self.first[k + 1]][place], 0)
        best.add(score, self.known[docs], self.doc[docs])


def _blocks(items: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """(row, id, terms) of items in blocks of at most ``limit`` bytes of text, one at least."""
    made: list[tuple] = []
    size = 0
    rows = items.select(F.col(item).alias("i"), F.col(text).cast("binary").alias("t")).toLocalIterator()
    for row, (name, data) in enumerate(rows):
        terms = set(terms_of(bytes(data) if data is not None else None)) - {b""}
        if not terms:
            continue
        if made and size + len(data) > limit:
            yield made
            made, size = [], 0
        made.append((row, name, terms))
        size += len(data)
    if made:
        yield made


def postings(docs: DataFrame, vocabulary: dict[bytes, int], *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n (its terms), and the ids and counts of the vocabulary's terms in it; documents without a term are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    if not isinstance(docs.schema[doc].dataType, IntegralType):
        raise TypeError(f"{doc} is no integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            length, ends, terms, counts = [], [0], [], []
            for value in batch.column("text"):
                found, n = counted(value.as_py())
                held = found.keys() & wanted.keys()
                length.append(n)
                terms += [wanted[t] for t in held]
                counts += [found[t] for t in held]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            made = pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(length, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
            ], ["doc", "n", "terms", "counts"])
            yield made.filter(pa.array([n > 0 for n in length], pa.bool_()))

    source = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(run, "doc long, n long, terms array<int>, counts array<long>")


def _weights(index: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and the weight of each of the block's terms."""
    n, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(terms, np.int64)
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for term, df in held.collect():  # a row per term of the block
        weight[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return n, total, weight


def _search_block(docs: DataFrame, block: list[tuple], top: int, doc: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*(terms for *_, terms in block))))}
    index = materialise(postings(docs, vocabulary, doc=doc, text=text), "postings")
    n, total, weight = _weights(index, len(vocabulary))
    wanted = [(row, np.sort(np.fromiter((vocabulary[t] for t in terms), np.int32, len(terms)))) for row, _, terms in block]
    shared = spark.sparkContext.broadcast((wanted, weight, n, total))

    def shards(batches: Iterator[pa.RecordBatch], n: int, total: int) -> Iterator[Shard]:
        held: list[pa.RecordBatch] = []

        def made() -> Shard:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids = whole.column("doc")
            lists = whole.column("terms").combine_chunks()
            return Shard(
                ids.is_valid().to_numpy(), ids.fill_null(0).to_numpy(), whole.column("n").to_numpy(),
                np.asarray(lists.value_lengths()), np.asarray(lists.flatten()),
                np.asarray(whole.column("counts").combine_chunks().flatten()), n, total,
            )

        rows = size = 0
        for batch in batches:
            lengths = np.asarray(batch.column("terms").value_lengths())
            low = 0
            while low < len(lengths):
                room = np.searchsorted(np.cumsum(lengths[low : low + SHARD - rows]), POSTINGS - size, "right")
                if not room and not rows:
                    room = 1
                if room:
                    held.append(batch.slice(low, room))
                    rows, size, low = rows + room, size + int(lengths[low : low + room].sum()), low + room
                if rows >= SHARD or low < len(lengths):
                    yield made()
                    held, rows, size = [], 0, 0
        if rows:
            yield made()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight, n, total = shared.value
        best = [Best(top) for _ in wanted]
        for shard in shards(batches, n, total):
            for (_, item), kept in zip(wanted, best):
                shard.search(item, weight[item], kept)
        for (row, _), kept in zip(wanted, best):
            if len(kept.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(kept.score), row), pa.int64()),
                    pa.array(kept.doc, pa.int64(), mask=~kept.known), pa.array(kept.score, pa.int64()),
                ], ["row", "doc", "score"])

    found = index.where(F.size("terms") > 0).mapInArrow(run, "row long, doc long, score long")
    order = [F.desc("score"), F.col("doc").asc_nulls_first()]
    some = Window.partitionBy("row", "slot").orderBy(*order)
    found = found.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)))
    found = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    every = Window.partitionBy("row").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top)
    return found.select("row", "rank", "doc", "score")


def search(
    docs: DataFrame, items: DataFrame, *, top: int = TOP, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    query: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item, rank, doc and score of the ``top`` documents of every item that score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item]
    results = []
    for block in _blocks(items, item, query, block_bytes):
        found = _search_block(docs, block, top, doc, text)
        # A row per item of the block, which is bounded.
        names = spark.createDataFrame([(row, name) for row, name, _ in block], f"row long, item {kind.dataType.simpleString()}")
        results.append(found.join(F.broadcast(names), "row").select("item", "rank", "doc", "score"))
    made = spark.createDataFrame([], f"item {kind.dataType.simpleString()}, rank int, doc long, score long")
    for found in results:
        made = made.union(found)
    return made.select("item", "rank", F.col("doc").cast(docs.schema[doc].dataType).alias("doc"), "score")
