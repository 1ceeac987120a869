"""Benchmark decontamination: Wu-Manber search for many test passages at once.

A text and a passage are both reduced to lower-case words (ASCII letters, digits and all non-ASCII bytes)
between single blanks, so a run of words occurs exactly where its bytes do, blanks at both ends included.
A passage contributes every window of ``width`` consecutive words; one with fewer words is one window.

Search, per class of windows (whole windows, and short ones by their number of words): let m be the shortest window in bytes and B
the block length. The shift table has, for each block inside the first m bytes of any window, its distance
from the end; a text block that no window holds allows a skip of m - B + 1 bytes. Where the shift is 0, the
block is a suffix of the first m bytes of the windows in its bucket, which are compared directly.

Edge cases: a null or wordless text has n_words 0 and nothing is hit; a null or wordless passage has no
window and never occurs; a passage with a null item_id is searched for like any other (its words are hit words),
but names no item; repeated passages all count in n_items, repeated item_ids once; documents with equal
or null ids keep one row each; an empty table gives an empty result and an empty benchmark hits nothing.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .text import buffers, encoded, held

WIDTH = 10
# Bytes of passages that are searched for in one pass; a larger benchmark takes several passes. A megabyte of passages
# makes about 150 MB of search tables, so this bounds a worker's memory.
PASSAGE_BYTES = 2 << 20

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Patterns:
    """Shift table and suffix buckets of windows that have much the same length."""

    def __init__(self, windows: dict[bytes, list[str]]):
        self.items = windows
        self.m = m = min(map(len, windows))
        distinct = sum(min(len(w), m) for w in windows)
        # Long enough that a block of ordinary text is seldom a block of some window.
        self.block = block = max(1, min(m, math.ceil(math.log(4 * distinct) / math.log(6))))
        self.skip = m - block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = {}
        for window in windows:
            for end in range(block, m + 1):
                key = window[end - block : end]
                if m - end < self.shift.get(key, self.skip):
                    self.shift[key] = m - end
            self.bucket.setdefault(window[m - block : m], []).append(window)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(position, window) of every occurrence in a reduced text."""
        block, m, n, shift, skip, at = self.block, self.m, len(text), self.shift.get, self.skip, self.m
        while at <= n:
            step = shift(text[at - block : at], skip)
            if step:
                at += step
                continue
            for window in self.bucket[text[at - block : at]]:
                if text.startswith(window, at - m):
                    yield at - m, window
            at += 1


def compile_passages(items: list[tuple[str | None, bytes]], width: int = WIDTH) -> list[Patterns]:
    """Search tables of (item, passage): whole windows together, shorter passages by their number of words."""
    classes: dict[int, dict[bytes, list[str]]] = {}
    for item, passage in items:
        words = words_of(passage)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            taken = words[i : i + width]
            holders = classes.setdefault(len(taken), {}).setdefault(b" " + b" ".join(taken) + b" ", [])
            if item is not None and item not in holders:
                holders.append(item)
    return [Patterns(w) for _, w in sorted(classes.items())]


def _tables(key: str, shared) -> list[Patterns]:
    """The search tables of a block of passages, made once per Python worker."""
    return held(("wu_manber", key), lambda: compile_passages(*shared.value))


def merged(found) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def hits(text: bytes, tables: list[Patterns]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged spans of hit words, and the items that occur."""
    words = words_of(text)
    if not words:
        return 0, [], set()
    reduced = b" " + b" ".join(words) + b" "
    items: set[str] = set()
    found: list[tuple[int, int]] = []
    blanks = None
    for table in tables:
        for at, window in table.find(reduced):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(reduced, np.uint8) == 32)
            first = int(np.searchsorted(blanks, at))
            found.append((first, first + window.count(b" ") - 1))
            items.update(table.items[window])
    return len(words), merged(found), items


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Passages in blocks of at most ``limit`` bytes, one at least, each read from the rows when it is asked for."""
    made: list[tuple[str | None, bytes]] = []
    size = 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        if row.t is None:
            continue
        data = row.t.encode("utf-8", "surrogatepass")
        if made and size + len(data) > limit:
            yield made
            made, size = [], 0
        made.append((row.i, data))
        size += len(data)
    yield made


def _drained(held: list) -> Iterator:
    """The elements of ``held``, which lets go of each."""
    while held:
        yield held.pop(0)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, *, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    passage: str = "text", width: int = WIDTH, passage_bytes: int = PASSAGE_BYTES,
) -> DataFrame:
    """Documents with the benchmark passages in them: doc, n_words, hit word spans, items found.

    The benchmark is a query set held against all rows: its search tables go to the tasks as a broadcast of at
    most ``passage_bytes`` of passages; a larger benchmark is searched for block by block, each block in a
    pass of its own over the documents, and the spans and items of the passes are joined by row. Documents are
    not shuffled for a single block.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item, passage, passage_bytes)
    ahead = list(itertools.islice(blocks, 2))
    single = len(ahead) == 1
    # Equal ids hold equal rows only if their texts are equal, so several passes are joined on a digest too.
    sha = F.lit("") if single else F.sha2(F.coalesce(text, F.lit("")), 256)
    source = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), sha.alias("sha"))
    kind = source.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, sha string, n_words long, spans array<struct<first:int,last:int>>, items array<string>"

    def searched(block) -> DataFrame:
        key, shared = uuid.uuid4().hex, spark.sparkContext.broadcast((block, width))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tables = _tables(key, shared)
            for batch in batches:
                rows = [hits(t, tables) for t in encoded(batch["text"])]
                yield pd.DataFrame({
                    "doc": batch["doc"],
                    "sha": batch["sha"],
                    "n_words": [r[0] for r in rows],
                    "spans": [[{"first": a, "last": b} for a, b in r[1]] for r in rows],
                    "items": [sorted(r[2]) for r in rows],
                })

        return source.mapInPandas(run, schema)

    passes = [searched(block).withColumn("pass", F.lit(i)) for i, block in enumerate(itertools.chain(_drained(ahead), blocks))]
    if single:
        return passes[0].drop("sha", "pass")
    every = passes[0]
    for more in passes[1:]:
        every = every.union(more)
    # A row repeated in the documents comes back as often as it went in.
    joined = every.groupBy("doc", "sha").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sum(F.when(F.col("pass") == 0, 1).otherwise(0)).alias("times"),
    )

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["spans"] = [
                [{"first": a, "last": b} for a, b in merged((s["first"], s["last"]) for s in spans)] for spans in batch["spans"]
            ]
            yield batch.loc[batch.index.repeat(batch["times"])]

    return joined.mapInPandas(merge, f"{schema}, times long").drop("sha", "times")


def hit_summary(found: DataFrame) -> DataFrame:
    """n_hit, n_items, digest of the items and the verdict, from what ``find_passages`` returns."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]).cast("long"))
    return found.select(
        "doc", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without any benchmark passage, with all their columns.

    The search runs inside one map over the rows, which pass through whole; nothing is joined back by id, so
    null and repeated ids are safe.
    """
    text = options.get("text", "text")
    blocks = _blocks(benchmark, options.get("item", "item_id"), options.get("passage", "text"), PASSAGE_BYTES)
    spark, width = docs.sparkSession, options.get("width", WIDTH)
    for block in blocks:
        key, shared = uuid.uuid4().hex, spark.sparkContext.broadcast((block, width))

        def run(batches, key=key, shared=shared):
            import pyarrow as pa

            tables = _tables(key, shared)
            for batch in batches:
                texts = encoded(batch.column(text).to_pylist())
                yield batch.filter(pa.array([not hits(t, tables)[1] for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
