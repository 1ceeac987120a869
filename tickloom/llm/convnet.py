"""Quality classifier: a byte-level convolutional network in numpy.

Bytes fall into 64 classes (letters, digits, each ASCII sign, upper case, parts of other characters). Filters
over ``WIDTH`` consecutive classes slide over the whole text; their rectified answers are max-pooled over
overlapping chunks of ``CHUNK`` bytes, a step of half a chunk apart. The mean and the maximum of the chunk
vectors go through one hidden layer into one probability. A filter bank over classes is a table look-up per
byte, so a text costs a few additions per byte and filter, whatever its length.

The network is fitted on the driver by Adam, on at most ``SAMPLE`` labelled texts of ``SAMPLE_BYTES`` together (a text that does not fit is left out), half of each label where
there are enough, chosen by a hash over all labelled rows. Fitting and scoring pool alike, over all chunks of
the whole text. The classes of the training texts, a byte each, lie on the driver. Both labels weigh the same in
the loss, whatever their shares among the rows.

Edge cases: a null or empty text is scored as a text of blanks; texts shorter than a chunk are padded with
blanks; rows with a null label train nothing; if all labels agree, or there are none, every score is that
label (1 without labels); repeated rows are ordinary rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import encoded

CLASSES = 64
WIDTH = 6
FILTERS = 16
HIDDEN = 12
CHUNK = 256
STEP = CHUNK // 2
SAMPLE = 3000
SAMPLE_BYTES = 64 << 20
BLOCK = 512  # steps convolved at a time
EPOCHS = 24
RATE = 0.01
THRESHOLD = 0.7


def _classes() -> np.ndarray:
    """0 blank; 1-26 letters; 27 upper case; 28 digit; 29 line feed; 30-61 the 32 ASCII signs; 62 first byte of
    another character; 63 its other bytes. Controls are blanks."""
    table = np.zeros(256, np.uint8)
    sign = 30
    for b in range(256):
        if 97 <= b <= 122:
            table[b] = b - 96
        elif 65 <= b <= 90:
            table[b] = 27
        elif 48 <= b <= 57:
            table[b] = 28
        elif b == 10:
            table[b] = 29
        elif 33 <= b <= 126:
            table[b] = sign
            sign += 1
        elif b >= 192:
            table[b] = 62
        elif b >= 128:
            table[b] = 63
    return table


_TABLE = _classes().tobytes()


def _padded(text: bytes) -> np.ndarray:
    """Classes of a text, filled up with blanks to whole steps (two at least) and the last window's rest."""
    codes = np.frombuffer(text.translate(_TABLE), np.uint8)
    steps = max(2, -(-len(codes) // STEP))
    full = np.zeros(steps * STEP + WIDTH - 1, np.int64)
    full[: len(codes)] = codes
    return full


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x CLASSES x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 2 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    constant: float | None = None

    def __post_init__(self):
        self._pairs = None

    def pairs(self) -> np.ndarray:
        """Answers of two neighbouring classes at once: WIDTH / 2 tables of CLASSES ** 2 rows."""
        if self._pairs is None:
            first, second = self.filters[0::2], self.filters[1::2]
            self._pairs = (first[:, :, None, :] + second[:, None, :, :]).reshape(WIDTH // 2, CLASSES**2, -1).astype(np.float32)
        return self._pairs

    def chunk_maxima(self, codes: np.ndarray) -> np.ndarray:
        """Pooled filter answers, a row per chunk."""
        n = len(codes) - WIDTH + 1
        two = codes[:-1] * CLASSES + codes[1:]
        steps = []
        tables = self.pairs()
        block = BLOCK * STEP
        for start in range(0, n, block):
            stop = min(n, start + block)
            total = tables[0][two[start:stop]]
            for k in range(1, len(tables)):
                total += tables[k][two[start + 2 * k : stop + 2 * k]]
            steps.append(total.reshape(-1, STEP, total.shape[1]).max(1))
        steps = np.concatenate(steps)
        return np.maximum(np.maximum(steps[:-1], steps[1:]) + self.bias, 0)

    def combine(self, pooled: np.ndarray) -> np.ndarray:
        inner = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_bias, -30, 30)))

    def score(self, texts: Sequence[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        pooled = np.zeros((len(texts), 2 * self.filters.shape[2]))
        for i, text in enumerate(texts):
            chunks = self.chunk_maxima(_padded(text))
            pooled[i] = np.concatenate([chunks.mean(0), chunks.max(0)])
        return self.combine(pooled)


def stretches(text: bytes) -> np.ndarray:
    """Classes of all steps of a text with the filters' overhang, as rows; two neighbouring ones are a chunk."""
    codes = _padded(text).astype(np.uint8)
    return np.lib.stride_tricks.sliding_window_view(codes, STEP + WIDTH - 1)[::STEP].copy()


def train(examples: Sequence[np.ndarray], labels: Sequence[int], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """A network from the ``stretches`` of labelled texts."""
    labels = np.asarray(labels, float)
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (WIDTH, CLASSES, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.3, (2 * FILTERS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1),
    )
    if not len(labels) or labels.min() == labels.max():
        net.constant = float(labels[0]) if len(labels) else 1.0
        return net
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    names = ("filters", "bias", "hidden", "hidden_bias", "out", "out_bias")
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(examples))
        for start in range(0, len(order), 32):
            batch = order[start : start + 32]
            grads = _gradients(net, [examples[i] for i in batch], labels[batch], weight[batch])
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for name, grad in zip(names, grads):
                m, v = moments[name]
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad * grad
                value = getattr(net, name)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            net.__post_init__()
    return net


def _step_maxima(net: Network, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest filter answers of each step, and where in it they stand."""
    tables = net.pairs()
    best = np.zeros((len(rows), FILTERS), np.float32)
    place = np.zeros((len(rows), FILTERS), np.int64)
    for at in range(0, len(rows), BLOCK):
        codes = rows[at : at + BLOCK].astype(np.int64)
        two = codes[:, :-1] * CLASSES + codes[:, 1:]
        answers = tables[0][two[:, :STEP]]
        for k in range(1, len(tables)):
            answers += tables[k][two[:, 2 * k : 2 * k + STEP]]
        place[at : at + BLOCK] = answers.argmax(1)
        best[at : at + BLOCK] = answers.max(1)
    return best, place


def _gradients(net: Network, examples: list[np.ndarray], labels: np.ndarray, weight: np.ndarray):
    rows = np.concatenate(examples)
    best, place = _step_maxima(net, rows)
    lengths = np.array([len(e) for e in examples])
    counts = lengths - 1
    owner = np.repeat(np.arange(len(examples)), counts)
    left = np.delete(np.arange(len(rows)), np.cumsum(lengths) - 1)  # the first step of each chunk
    step = left[:, None] + (best[left + 1] > best[left])  # chunk x filter
    place = np.take_along_axis(place, step, 0)
    top = np.take_along_axis(best, step, 0) + net.bias
    chunks = np.maximum(top, 0)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mean = np.add.reduceat(chunks, first) / counts[:, None]
    largest = np.maximum.reduceat(chunks, first)
    pooled = np.concatenate([mean, largest], 1)
    inner = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    score = 1 / (1 + np.exp(-np.clip(inner @ net.out + net.out_bias, -30, 30)))
    error = weight * (score - labels) / len(labels)
    d_inner = (error[:, None] * net.out) * (inner > 0)
    d_pooled = d_inner @ net.hidden.T
    d_chunks = d_pooled[owner, :FILTERS] / counts[owner, None]
    # Neighbouring chunks share a step, so the largest answer is often in two of them.
    at_most = chunks == largest[owner]
    d_chunks += at_most * (d_pooled[:, FILTERS:] / np.add.reduceat(at_most, first, dtype=np.int64))[owner]
    d_chunks *= top > 0
    d_filters = np.zeros_like(net.filters)
    filters = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        np.add.at(d_filters[k], (rows[step, place + k], filters), d_chunks)
    return d_filters, d_chunks.sum(0), pooled.T @ d_inner, d_inner.sum(0), inner.T @ error, np.array([error.sum()])


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Network:
    """A network from labelled texts. ``labels`` are all training rows; the sample is drawn from them, by a hash of
    the key, before any text is read, so what is sent to the texts is bounded."""
    rows = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("k").isNotNull())
    rows = rows.distinct()
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("k", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(sample / 2 / n)).otherwise(share)
    order = [draw, "k", "y"]
    drawn = rows.where(draw < share).orderBy(*order).limit(2 * sample)
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("sha"))
    # Sizes first: whole texts are taken in a fixed order while they fit, so what comes to the driver is bounded in bytes too.
    sized = texts.join(F.broadcast(drawn), "k").select("k", "y", "sha", F.coalesce(F.octet_length("t"), F.lit(0)).alias("size")).distinct()
    taken, total = [], 0
    for r in sized.orderBy(*order, "sha").limit(4 * sample).collect():
        if total + r.size <= SAMPLE_BYTES:
            taken.append((r.k, r.y, r.sha))
            total += r.size
    if not taken:
        return train([], [])
    chosen = docs.sparkSession.createDataFrame(taken, sized.select("k", "y", "sha").schema)

    def cut(batches):
        for batch in batches:
            made = [stretches(t).tobytes() for t in encoded(batch.column("t").to_pylist())]
            columns = [batch.column(c) for c in ("k", "sha", "y")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], names=["k", "sha", "y", "x"])

    kind = chosen.schema["k"].dataType.simpleString()
    wanted = texts.join(F.broadcast(chosen), ["k", "sha"]).select("k", "sha", "y", "t")
    # Rows repeated in the documents were sized once and are taken once.
    once = wanted.dropDuplicates(["k", "sha", "y"]).mapInArrow(cut, f"k {kind}, sha long, y int, x binary")
    found = sorted((bytes(r.x), r.y) for r in once.select("x", "y").collect())
    wide = STEP + WIDTH - 1
    return train([np.frombuffer(x, np.uint8).reshape(-1, wide) for x, _ in found], [y for _, y in found])


def score(docs: DataFrame, network: Network, *, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of label 1."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    if into in docs.columns:
        raise ValueError(f"the documents have a column {into} already")
    schema = StructType([*docs.schema.fields, StructField(into, DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            made = shared.value.score(encoded(batch.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, schema)
