"""Quality rules as a short-circuit cascade.

Every rule is a function of texts that says which it rejects. On a bounded sample the cost of a rule (seconds
per text) and its selectivity (share rejected) are estimated; rules then run in the order of rejection per
cost, each on the texts that all earlier rules have let through. A text is rejected if any rule rejects it,
whatever the order, so the order changes the time taken and never the verdict.

Edge cases: a null text is an empty text; an empty text has no words, all its counts are 0 and it fails the
base rule; repeated rows and ids are judged row by row; an empty table (or sample) keeps the given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .text import Words, buffers, encoded, mix, windows

SYMBOLS = b"#*$%&|<>"
REPEAT = 8  # words of a window
SAMPLE = 400  # texts on which costs and selectivities are estimated
SAMPLE_CHARS = 16 << 20  # and at most so many characters

Rule = Callable[[Sequence[bytes]], np.ndarray]


def n_words(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([len(t.split()) for t in texts], np.int64)


def word_chars(texts: Sequence[bytes]) -> np.ndarray:
    """Code points outside blanks: bytes that don't continue a character."""
    drop = bytes([32, 9, 10, 11, 12, 13, *range(128, 192)])
    return np.array([len(t.translate(None, drop)) for t in texts], np.int64)


def n_symbols(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line and not line.isspace()]


def n_dup_lines(texts: Sequence[bytes]) -> np.ndarray:
    return np.array([len(lines) - len(set(lines)) for lines in map(_lines, texts)], np.int64)


def n_repeat_words(texts: Sequence[bytes], width: int = REPEAT) -> np.ndarray:
    """Words inside windows of ``width`` words that the same text holds twice or more, first ones included."""
    out = np.zeros(len(texts), np.int64)
    for a, b in buffers(texts):
        words = Words(texts[a:b])
        hashes = windows(words.hashes(), width)
        n = len(hashes)
        if not n:
            continue
        own = words.doc[:n] == words.doc[width - 1 : width - 1 + n]
        at = np.flatnonzero(own)
        keys = mix(hashes[at] ^ mix(words.doc[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(step, at[twice], 1)
        np.add.at(step, at[twice] + width, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(step)[:-1] > 0)])
        out[a:b] = covered[words.first[1:]] - covered[words.first[:-1]]
    return out


def _upper(texts: Sequence[bytes]) -> np.ndarray:
    rest = bytes(b for b in range(256) if not 65 <= b <= 90)
    return np.array([len(t.translate(None, rest)) for t in texts], np.int64)


def _letters(texts: Sequence[bytes]) -> np.ndarray:
    rest = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
    return np.array([len(t.translate(None, rest)) for t in texts], np.int64)


def too_many_symbols(texts):
    return 10 * n_symbols(texts) > n_words(texts)


def too_many_repeated_lines(texts):
    return 100 * n_dup_lines(texts) > 60 * np.array([len(_lines(t)) for t in texts], np.int64)


def odd_word_length(texts):
    words, chars = n_words(texts), word_chars(texts)
    return (chars < 2 * words) | (chars > 15 * words)


def shouting(texts):
    return 100 * _upper(texts) > 40 * _letters(texts)


def exclaiming(texts):
    return np.array([10 * t.count(b"!") for t in texts], np.int64) > n_words(texts)


def stuttering(texts):
    """A word after itself, more than once in five words."""
    found = []
    for text in texts:
        words = text.split()
        found.append(5 * sum(a == b for a, b in zip(words, words[1:])) > len(words))
    return np.array(found, bool)


RULES: dict[str, Rule] = {
    "symbols": too_many_symbols,
    "repeated_lines": too_many_repeated_lines,
    "word_length": odd_word_length,
    "shouting": shouting,
    "exclaiming": exclaiming,
    "stuttering": stuttering,
}


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float = field(compare=False)
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate(texts: Sequence[bytes], rules: dict[str, Rule] = RULES) -> list[Estimate]:
    """Rules in the order they should run, with cost and selectivity on ``texts``."""
    found = []
    for name, rule in rules.items():
        start = time.thread_time()
        bad = rule(texts) if len(texts) else np.zeros(0, bool)
        spent = (time.thread_time() - start) / max(1, len(texts))
        found.append(Estimate(name, spent, float(bad.mean()) if len(texts) else 0.0))
    return sorted(found, key=lambda e: -e.worth)


def plan(docs: DataFrame, *, text: str = "text", rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> list[Estimate]:
    """The cascade for ``docs``, estimated on at most ``sample`` whole texts, drawn by a hash over the whole table."""
    total = docs.count()
    drawn = docs.select(F.col(text).alias("t"))
    if total > 2 * sample:
        share = int(2.0 * sample / total * (1 << 30))
        drawn = drawn.where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < share)
    held, size = [], 0
    for row in drawn.limit(sample).toLocalIterator():
        size += len(row.t or "")
        if size > SAMPLE_CHARS:
            break
        held.append(row.t)
    return estimate(encoded(held), rules)


def cascade(texts: Sequence[bytes], order: Sequence[str], rules: dict[str, Rule] = RULES, alive: np.ndarray | None = None) -> np.ndarray:
    """Index in ``order`` of the rule that rejected each text, -1 where none did; -2 for texts not ``alive``."""
    verdict = np.full(len(texts), -1, np.int64)
    if alive is not None:
        verdict[~alive] = -2
    for k, name in enumerate(order):
        left = np.flatnonzero(verdict == -1)
        if not len(left):
            break
        verdict[left[rules[name]([texts[i] for i in left])]] = k
    return verdict


def apply_rules(docs: DataFrame, *, text: str = "text", rules: dict[str, Rule] = RULES, base: bool = True) -> DataFrame:
    """All columns of ``docs`` with the base counts, base_failed, kept and the rule that rejected first."""
    import pyarrow as pa
    from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

    added = {
        "n_words": LongType(), "word_chars": LongType(), "n_symbols": LongType(), "n_dup_lines": LongType(),
        "n_repeat_words": LongType(), "base_failed": BooleanType(), "kept": BooleanType(), "rejected_by": StringType(),
    }
    clash = [c for c in added if c in docs.columns]
    if clash:
        raise ValueError(f"the documents have columns {clash} already")
    order = [e.name for e in plan(docs, text=text, rules=rules)]
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in added.items())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = encoded(part.column(text).to_pylist())
                words, repeated = n_words(texts), n_repeat_words(texts)
                failed = (words < 20) | (100 * repeated > 30 * words)
                verdict = cascade(texts, order, rules, ~failed if base else None)
                made = [
                    pa.array(words), pa.array(word_chars(texts)), pa.array(n_symbols(texts)), pa.array(n_dup_lines(texts)),
                    pa.array(repeated), pa.array(failed), pa.array(verdict == -1),
                    pa.array([order[v] if v >= 0 else "base" if v == -2 else None for v in verdict], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *added])

    return docs.mapInArrow(run, schema)
