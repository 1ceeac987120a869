"""Language-model scores from a lattice of subwords: the probability of a text over all its segmentations.

The model emits pieces of an existing vocabulary one after another, then an end. A text is its words, each with the
vocabulary's word mark before it, so its probability is the product, over its words, of the summed
probabilities of every way to cut a word into pieces, times that of the end. The sum is a forward recursion
over the bytes of a word in log space; every byte is a piece, so any word has a probability.

The vocabulary's own scores weight the segmentations at first (natural logarithms, or ranks, where the r-th
piece weighs 1 / (r + 1)). They are then fitted to the training texts: forward and backward recursions give the
expected number of times each piece is used in all segmentations of all training words, as often as each
occurs, and the new weights are those counts plus the old scores' share of ``PRIOR`` further pieces. Nothing is
added to the vocabulary.

How it runs: words are counted over all texts (map-side, then one shuffle), so a word is cut once, however often it
occurs. The ``HEAD`` most frequent words, which make up most of any text, go to the tasks as a broadcast of
bounded size; every other word of a document is joined with the table of words. Words as long as ``KEY`` bytes go
by a digest there, so that rows are short. What is counted grows with the texts; only sums over pieces, at most one
per piece of the vocabulary, come to the driver.

Edge cases: a null or empty text has no word and is scored by its end alone; rows that repeat an id are scored
one by one; a null id counts as an empty one when rows are told apart for training; without training texts all weights are the
vocabulary's; a word of any length is cut as a whole; columns other than the named ones are not looked at; an empty
table gives an empty result. Sums over words are added in no fixed order, so last digits may differ between runs.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .text import LOWER

MARK = "▁".encode()
PASSES = 2
PRIOR = 1000.0
HEAD = 1 << 17
KEY = 48
# Words up to this size are cut many at a time.
SHORT = 64
BLOCK = 4096
# Different words a task counts before it hands them on.
COUNTED = 1 << 18
# Largest vocabulary read on the driver.
FILE_BYTES = 64 << 20


def words_of(text: bytes | None) -> list[bytes]:
    """Words between white space (blank, 9 to 13), A-Z lower-cased."""
    return text.translate(LOWER).split() if text else []


def key_of(word: bytes) -> bytes:
    """The word, or for long ones its beginning and digest, which is as long as no short word."""
    return word if len(word) < KEY else word[: KEY - 32] + hashlib.sha256(word).digest()


def vocabulary(path: str) -> dict[bytes, float]:
    """Pieces as bytes and their weights, which sum to 1. Pieces of equal bytes are one."""
    import sentencepiece

    if os.path.getsize(path) > FILE_BYTES:
        raise ValueError(f"{path} is larger than {FILE_BYTES} bytes")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in ids if not model.is_byte(i)}
    ranks = all(s == int(s) for s in scores.values())
    weights: Counter = Counter()
    for i, score in scores.items():
        weights[model.id_to_piece(i).encode()] += 1 / (1 - score) if ranks else math.exp(score)
    # A byte weighs as much as the least of the other pieces that are in use.
    least = min((w for w in weights.values() if w > 1e-8), default=1.0)
    for byte in range(256):
        weights[bytes([byte])] += least
    total = sum(weights.values())
    return {piece: weight / total for piece, weight in weights.items()}


class Lattice:
    """A trie of pieces in arrays, and the log weight of each piece and of the end."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = sorted(pieces)
        self.prior = np.array([pieces[p] for p in self.pieces])
        steps: dict[int, int] = {}
        at = {}
        for number, piece in enumerate(self.pieces):
            state = 0
            for byte in piece:
                state = steps.setdefault(state << 8 | byte, len(steps) + 1)
            at[state] = number
        self.keys = np.fromiter(sorted(steps), np.int64, len(steps))
        self.next = np.fromiter((steps[k] for k in self.keys.tolist()), np.int64, len(steps))
        self.piece = np.full(len(steps) + 1, -1, np.int64)
        self.piece[list(at)] = list(at.values())
        self.longest = max(map(len, self.pieces))
        self.log = np.log(self.prior)
        self.end = 0.0
        self._steps: dict[int, int] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_steps": None}

    def weigh(self, expected: np.ndarray, ends: int, prior: float = PRIOR) -> None:
        """New weights from expected counts of the pieces and the number of ends."""
        made = expected + prior * self.prior
        total = made.sum() + ends + 1
        self.log, self.end = np.log(made / total), math.log((ends + 1) / total)

    def _forward(self, codes: np.ndarray, size: np.ndarray, arcs: list | None = None) -> np.ndarray:
        """Log weight of all ways to reach each byte of each word; ``size`` ascends."""
        n, length = codes.shape
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        for i in range(length):
            rows = np.arange(np.searchsorted(size, i, "right"), n)
            state = np.zeros(len(rows), np.int64)
            for j in range(i, min(length, i + self.longest)):
                inside = np.searchsorted(size[rows], j, "right")
                rows, state = rows[inside:], state[inside:]
                wanted = state << 8 | codes[rows, j]
                place = np.searchsorted(self.keys, wanted)
                place[place == len(self.keys)] = 0
                on = self.keys[place] == wanted
                rows, state = rows[on], self.next[place[on]]
                if not len(rows):
                    break
                piece = self.piece[state]
                here = piece >= 0
                r, p = rows[here], piece[here]
                if len(r):
                    alpha[j + 1, r] = np.logaddexp(alpha[j + 1, r], alpha[i, r] + self.log[p])
                    if arcs is not None:
                        arcs.append((i, j + 1, r, p))
        return alpha

    def _matrix(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        codes = np.zeros((len(words), int(size[-1])), np.int64)
        codes[np.arange(codes.shape[1]) < size[:, None]] = flat
        return codes, size

    def _marked(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Places and marked words: blocks of short words by ascending size, then long words one by one."""
        marked = [MARK + w for w in words]
        order = sorted(range(len(words)), key=lambda i: len(marked[i]))
        short = [i for i in order if len(marked[i]) <= SHORT]
        for at in range(0, len(short), BLOCK):
            block = short[at : at + BLOCK]
            yield np.array(block), [marked[i] for i in block]
        for i in order[len(short) :]:
            yield np.array([i]), [marked[i]]

    def _table(self) -> dict[int, int]:
        if self._steps is None:
            self._steps = dict(zip(self.keys.tolist(), self.next.tolist()))
        return self._steps

    def _arcs(self, word: bytes, i: int, log: list[float], piece: list[int]) -> Iterator[tuple[int, int, float]]:
        """(end, piece, log weight) of every piece that starts at byte ``i``."""
        steps, state = self._table(), 0
        for j in range(i, min(len(word), i + self.longest)):
            state = steps.get(state << 8 | word[j])
            if state is None:
                return
            if (p := piece[state]) >= 0:
                yield j + 1, p, log[p]

    @staticmethod
    def _add(x: float, y: float) -> float:
        if x < y:
            x, y = y, x
        return x + math.log1p(math.exp(y - x)) if y > -math.inf else x

    def _long(self, word: bytes) -> tuple[np.ndarray, list[float], list[int]]:
        log, piece = self.log.tolist(), self.piece.tolist()
        alpha = np.full(len(word) + 1, -np.inf)
        alpha[0] = 0
        for i in range(len(word)):
            here = float(alpha[i])
            for j, _, weight in self._arcs(word, i, log, piece):
                alpha[j] = self._add(float(alpha[j]), here + weight)
        return alpha, log, piece

    def log_weights(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, over all its segmentations."""
        out = np.zeros(len(words))
        for places, marked in self._marked(words):
            if len(marked[0]) > SHORT:
                out[places] = self._long(marked[0])[0][-1]
            else:
                codes, size = self._matrix(marked)
                out[places] = self._forward(codes, size)[size, np.arange(len(size))]
        return out

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each piece is used in all segmentations of the words, by their probability."""
        out = np.zeros(len(self.pieces))
        for places, marked in self._marked(words):
            n = times[places].astype(float)
            if len(marked[0]) > SHORT:
                self._expected_long(marked[0], float(n[0]), out)
                continue
            codes, size = self._matrix(marked)
            arcs: list = []
            alpha = self._forward(codes, size, arcs)
            beta = np.full_like(alpha, -np.inf)
            beta[size, np.arange(len(size))] = 0
            whole = alpha[size, np.arange(len(size))]
            used, share = [], []
            for i, j, r, p in reversed(arcs):
                onward = self.log[p] + beta[j, r]
                beta[i, r] = np.logaddexp(beta[i, r], onward)
                used.append(p)
                share.append(n[r] * np.exp(alpha[i, r] + onward - whole[r]))
            out += np.bincount(np.concatenate(used), np.concatenate(share), len(out))
        return out

    def _expected_long(self, word: bytes, times: float, out: np.ndarray) -> None:
        alpha, log, piece = self._long(word)
        beta = np.full(len(word) + 1, -np.inf)
        beta[-1] = 0
        whole = float(alpha[-1])
        for i in range(len(word) - 1, -1, -1):
            for j, p, weight in self._arcs(word, i, log, piece):
                onward = weight + float(beta[j])
                beta[i] = self._add(float(beta[i]), onward)
                out[p] += times * math.exp(float(alpha[i]) + onward - whole)


def count_words(docs: DataFrame) -> DataFrame:
    """word, train and every: occurrences in training texts and in all. ``docs`` has text (binary) and train."""

    def batches_of(train: Counter, held: Counter) -> Iterator[pa.RecordBatch]:
        for words, trained in ((train, True), (held, False)):
            names, counts = list(words), list(words.values())
            for at in range(0, len(names), 1 << 16):
                every = pa.array(counts[at : at + (1 << 16)], pa.int64())
                none = pa.array(np.zeros(len(every), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at : at + (1 << 16)], pa.binary()), every if trained else none, every], ["word", "train", "every"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, held = Counter(), Counter()
        for batch in batches:
            for text, trained in zip(batch.column("text"), batch.column("train").to_pylist()):
                (train if trained else held).update(words_of(text.as_py()))
                if len(train) + len(held) > COUNTED:
                    yield from batches_of(train, held)
                    train, held = Counter(), Counter()
        yield from batches_of(train, held)

    made = docs.select("text", "train").mapInArrow(run, "word binary, train long, every long")
    return made.groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every"))


def _fit(words: DataFrame, lattice: Lattice, ends: int, passes: int) -> Lattice:
    """Weights after ``passes`` rounds over the training words."""
    spark = words.sparkSession
    for _ in range(passes):
        shared = spark.sparkContext.broadcast(lattice)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value
            total = np.zeros(len(held.pieces))
            for batch in batches:
                total += held.expected(batch.column("word").to_pylist(), batch.column("train").to_numpy())
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["piece", "n"])

        sums = words.where("train > 0").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.zeros(len(lattice.pieces))
        for piece, n in sums.collect():  # a row per piece of the vocabulary
            expected[piece] = n
        lattice.weigh(expected, ends)
    return lattice


@dataclass(frozen=True)
class Model:
    """What was learned: the lattice's weights, the table of words, and the counts of the training tokens."""

    lattice: Lattice
    words: DataFrame  # key, train, every, score (log10)
    ends: int
    tokens: int
    distinct: int

    def base(self, count: Column) -> Column:
        return F.log10(count + 0.1)

    @property
    def floor(self) -> float:
        """log10 of what smoothed counts are divided by."""
        return math.log10(self.tokens + 0.1 * (self.distinct + 1))


def fit(docs: DataFrame, path: str, *, passes: int = PASSES) -> Model:
    """Learn from the rows of ``docs`` with ``train``; the words of the other rows are scored along with theirs."""
    words = materialise(count_words(docs), "words")
    ends = docs.where("train").count()
    tokens, distinct = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count(F.when(F.col("train") > 0, 1))).first()
    lattice = Lattice(vocabulary(path))
    if ends:
        lattice = _fit(words, lattice, ends, passes)
    shared = docs.sparkSession.sparkContext.broadcast(lattice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            score = shared.value.log_weights(found) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(key_of, found), pa.binary()), batch.column("train"), batch.column("every"), pa.array(score)],
                ["key", "train", "every", "score"],
            )

    scored = materialise(words.mapInArrow(run, "key binary, train long, every long, score double"), "scored")
    return Model(lattice, scored, ends, tokens + ends, distinct + (ends > 0))


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, at most ``most``: those above a count that leaves no more.

    Counts are binned by quarters of a power of two, so that only the bins' sizes come to the driver.
    """
    level = F.floor(4 * F.log2("every"))
    sizes = words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in sizes:
        total += row.n
        if total > most:
            break
        least = row.level
    return words.where(level >= least if least is not None else F.lit(False))


def score(docs: DataFrame, model: Model, *, head: int = HEAD) -> DataFrame:
    """The columns of ``docs`` but its text, with n_tokens, n_known, base_score and score, all in log10.

    Words that ``fit`` has not seen are no rows of its table: score the rows it was given.
    """
    spark = docs.sparkSession
    base = model.base(F.col("train"))
    words = model.words.select("key", (F.col("train") > 0).cast("long").alias("known"), base.alias("base"), "score", "every")
    shared = spark.sparkContext.broadcast(
        {bytes(r.key): (r.known, r.base, r.score) for r in _frequent(words, head).collect()}  # at most ``head`` rows
    )
    kept = [n for n in docs.columns if n != "text"]
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sums: list[list] = [[], [], [], []]
            ends, keys, counts = [0], [], []
            for text in batch.column("text"):
                found = Counter(words_of(text.as_py()))
                known, total, likely = 0, 0.0, 0.0
                for word, n in found.items():
                    key = word if len(word) < KEY else key_of(word)
                    seen = held.get(key)
                    if seen is None:
                        keys.append(key)
                        counts.append(n)
                    else:
                        known += n * seen[0]
                        total += n * seen[1]
                        likely += n * seen[2]
                ends.append(len(keys))
                for made, value in zip(sums, (found.total(), known, total, likely)):
                    made.append(value)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(batch)), pa.int64()), *(batch.column(n) for n in kept),
                    *(pa.array(v, k) for v, k in zip(sums, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))),
                    pa.ListArray.from_arrays(offsets, pa.array(keys, pa.binary())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                ["__row", *kept, "n_tokens", "n_known", "base_score", "score", "keys", "counts"],
            )
            row += len(batch)

    schema = f"__row long{', ' if kept else ''}{fields}, n_tokens long, n_known long, base_score double, score double, keys array<binary>, counts array<long>"
    begun = materialise(docs.mapInArrow(run, schema), "begun")
    rare = begun.select("__row", F.explode(F.arrays_zip("keys", "counts")).alias("w")).select("__row", F.col("w.keys").alias("key"), F.col("w.counts").alias("n"))
    rare = rare.join(words.select("key", "known", "base", "score"), "key").groupBy("__row").agg(
        F.sum(F.col("n") * F.col("known")).alias("more_known"), F.sum(F.col("n") * F.col("base")).alias("more_base"),
        F.sum(F.col("n") * F.col("score")).alias("more_score"),
    )
    joined = begun.drop("keys", "counts").join(rare, "__row", "left")
    end_base = math.log10(model.ends + 0.1) - model.floor

    def both(name: str, more: str) -> Column:
        return F.col(name) + F.coalesce(F.col(more), F.lit(0))

    return joined.select(
        *kept, (F.col("n_tokens") + 1).alias("n_tokens"), (both("n_known", "more_known") + int(model.ends > 0)).alias("n_known"),
        (both("base_score", "more_base") - F.col("n_tokens") * model.floor + end_base).alias("base_score"),
        (both("score", "more_score") + model.lattice.end / math.log(10)).alias("score"),
    )


def score_documents(docs: DataFrame, path: str, *, train: Column, doc: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """doc, trained, n_tokens, n_known, train_tokens, base_score and score of every row; ``train`` says which rows to learn from."""
    source = docs.select(F.col(doc).alias("doc"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("binary").alias("text"))
    model = fit(source, path)
    made = score(source, model, head=head)
    return made.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
