"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed byte n-grams tells the
languages whose bit is 1 from the others: a linear function of n-gram counts, whose weights are log ratios of
the two sides' n-gram frequencies. A text's bit scores are compared with every codeword under an exponential
loss, each bit weighted by how reliably its classifier answers for that language (the share of training texts
it gets right, normalised per language). The nearest codeword wins; if the next one is nearly as near, the text
is flagged as ambiguous.

Codes: with up to five languages all distinct two-way splits (the exhaustive code, distance half its length),
beyond that random bits from a fixed seed, 12 per doubling of the number of languages.

The model is fitted on a bounded sample: about ``per_language`` different texts of each language at most, chosen by
a hash over all training rows; of a language with fewer, all. Copies of a text count once. What comes to the driver
is counts, of languages x buckets; more than ``MAX_LANGUAGES`` languages raise.

Edge cases: a null text, and one without a letter, is ``und`` with score 0; rows whose language is null train
nothing; copies of a row train once and are told one by one; with no training row, or an empty table, everything is ``und``; with
a single language every text with a letter gets it with score 1.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .text import buffers, encoded, let_go, slices

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
PER_LANGUAGE = 3000
MAX_LANGUAGES = 4096
SMOOTHING = 0.5
SHARPNESS = 4.0  # mean log ratio per n-gram that counts as a loss of exp(-SHARPNESS * it)
AMBIGUOUS = 0.6  # a probability of the winner below this is ambiguous
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
# Upper-case ASCII as lower case; controls as blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 32 else b for b in range(256))


def fold(training: Column | str = "doc_id") -> Column:
    """The remainder by 4 of the crc32 of an id as text; 2 marks held-out rows."""
    return F.pmod(F.crc32(F.col(training).cast("string").cast("binary")), F.lit(4))


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams that start at each byte, one array per order."""
    made = []
    for k, n in enumerate(ORDERS):
        if len(codes) < n:
            continue
        value = np.full(len(codes) - n + 1, 1 + k, np.uint32)
        for j in range(n):
            value = value * np.uint32(0x01000193) + codes[j : j + len(value)]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        made.append((value >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return made


def count_grams(texts: Sequence[bytes]) -> np.ndarray:
    """Counts per bucket over some texts; no n-gram spans two of them."""
    total = np.zeros(BUCKETS, np.int64)
    for text in texts:
        codes = np.frombuffer(text.translate(_FOLD), np.uint8).astype(np.uint32)
        for start in range(0, len(codes), 1 << 20):
            for grams in _grams(codes[start : start + (1 << 20) + max(ORDERS) - 1]):
                total += np.bincount(grams[: 1 << 20], minlength=BUCKETS)
    return total


def codewords(languages: int, seed: int = 9) -> np.ndarray:
    """Rows of 0 and 1, one per language; all rows differ and no column is constant."""
    if languages <= 1:
        return np.zeros((languages, 1), np.int8)
    if languages <= 5:
        # The first language has only ones; every other split of the languages occurs once.
        columns = [c for c in itertools.product((1, 0), repeat=languages) if c[0] == 1 and 0 in c]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(seed)
    bits = 12 * (languages - 1).bit_length()
    while True:
        code = rng.integers(0, 2, (languages, bits)).astype(np.int8)
        if len(np.unique(code, axis=0)) == languages and (code.min(0) != code.max(0)).all():
            return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit, -1 or 1
    weights: np.ndarray  # bucket x bit
    reliability: np.ndarray  # language x bit; rows sum to 1

    def bits(self, texts: Sequence[bytes]) -> np.ndarray:
        """Mean weight per n-gram of each text, per bit."""
        out = np.zeros((len(texts), self.code.shape[1]), np.float64)
        for a, b in buffers(texts, 1 << 18):
            part = texts[a:b]
            counts = np.array([max(0, len(t)) for t in part])
            if b - a == 1 and counts[0] > 1 << 18:
                out[a] = count_grams(part) @ self.weights / max(1, sum(max(0, counts[0] - n + 1) for n in ORDERS))
                continue
            # Texts are kept apart by runs of zero bytes, whose n-grams are masked.
            gap = bytes(max(ORDERS))
            codes = np.frombuffer(gap.join(t.translate(_FOLD) for t in part) + gap, np.uint8).astype(np.uint32)
            starts = np.concatenate([[0], np.cumsum(counts + len(gap))])
            seen = np.zeros(len(part))
            for n, grams in zip(ORDERS, _grams(codes)):
                for i in range(len(part)):
                    here = grams[starts[i] : starts[i] + max(0, counts[i] - n + 1)]
                    if len(here):
                        out[a + i] += self.weights[here].sum(0)
                        seen[i] += len(here)
            out[a:b] /= np.maximum(seen, 1)[:, None]
        return out

    def decode(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(winner, probability) of rows of bit scores."""
        if len(self.languages) < 2:
            return np.zeros(len(bits), np.int64), np.ones(len(bits))
        margins = np.clip(SHARPNESS * bits[:, None, :] * self.code[None], -20, 20)
        loss = (np.exp(-margins) * self.reliability[None]).sum(2)
        near = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
        near /= near.sum(1, keepdims=True)
        winner = near.argmax(1)
        return winner, near[np.arange(len(near)), winner]

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        named, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return named, score
        at = [i for i, t in enumerate(texts) if has_letter(t)]
        if at:
            winner, probability = self.decode(self.bits(encoded([texts[i] for i in at])))
            for i, w, p in zip(at, winner, probability):
                named[i], score[i] = self.languages[w], p
        return named, score


def sample(rows: DataFrame, *, text: str, lang: str, per_language: int) -> DataFrame:
    """(lang, text): about ``per_language`` different texts of each language at most, all where there are no more.

    Copies of a text have one hash, so they are drawn together and collapse before texts are compared.
    """
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    rows = rows.withColumn("hash", F.xxhash64("text", F.lit("draw")))
    sizes = rows.select("lang", "hash").distinct().groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = [(r["lang"], per_language / r["count"]) for r in sizes]
    shares = rows.sparkSession.createDataFrame(shares, "lang string, share double")
    draw = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    return drawn.select("lang", "text").distinct()


def fit(rows: DataFrame, *, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from rows of texts with their languages."""
    drawn = sample(rows, text=text, lang=lang, per_language=per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                texts: dict[str, list[str]] = {}
                for name, value in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    texts.setdefault(name, []).append(value)
                for name, some in texts.items():
                    found[name] = found.get(name, 0) + count_grams(encoded(some))
        for name, total in found.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "bucket", "n"]
            )

    counted = drawn.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # at most languages x buckets rows, whatever the input
    names = sorted(table["lang"].unique())
    totals = np.zeros((len(names), BUCKETS))
    totals[table["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(np.int64), table["bucket"].to_numpy(np.int64)] = table["n"]
    code = codewords(len(names))
    share = (totals + SMOOTHING) / (totals + SMOOTHING).sum(1, keepdims=True) if names else totals
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    if len(names) > 1:
        for bit in range(code.shape[1]):
            weights[:, bit] = np.log(share[code[:, bit] == 1].mean(0) / share[code[:, bit] == 0].mean(0))
    signs = 2 * code.astype(np.int8) - 1
    model = Model(names, signs, weights, np.full(code.shape, 1 / max(1, code.shape[1])))
    if len(names) > 1:
        model.reliability = _reliability(drawn, model)
    return model


def _reliability(drawn: DataFrame, model: Model) -> np.ndarray:
    """Share of the sample's texts of each language that each bit classifier gets right, normalised per language."""
    shared = drawn.sparkSession.sparkContext.broadcast(model)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        place = {n: i for i, n in enumerate(model.languages)}
        good, seen = np.zeros(model.code.shape, np.int64), np.zeros(len(place), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                at = np.array([place[n] for n in part.column("lang").to_pylist()], np.int64)
                bits = model.bits(encoded(part.column("text").to_pylist()))
                np.add.at(good, at, (bits * model.code[at] > 0).astype(np.int64))
                np.add.at(seen, at, 1)
        used = np.flatnonzero(seen)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(seen[used], pa.int64()), pa.array(good[used].tolist(), pa.list_(pa.int64()))],
                ["i", "seen", "good"],
            )

    parts = drawn.mapInArrow(right, "i int, seen long, good array<long>")
    parts = parts.select("i", "seen", F.posexplode("good").alias("bit", "good"))
    table = parts.groupBy("i", "bit").agg(F.sum("good").alias("good"), F.sum("seen").alias("seen")).toPandas()
    share = np.full(model.code.shape, 0.5)
    share[table["i"], table["bit"]] = (table["good"] + 1) / (table["seen"] + 2)
    return share / share.sum(1, keepdims=True)


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred, score and ambiguous."""
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    added = {"lang_pred": StringType(), "score": DoubleType(), "ambiguous": BooleanType()}
    clash = [c for c in added if c in docs.columns]
    if clash:
        raise ValueError(f"the documents have columns {clash} already")
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in added.items())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        let_go()
        model = shared.value
        for batch in batches:
            for part in slices(batch, text):
                named, score = model.predict(part.column(text).to_pylist())
                made = [pa.array(named, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *added])

    return docs.mapInArrow(run, schema)
