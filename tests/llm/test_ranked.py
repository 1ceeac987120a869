"""Ranked search, subword lattices and the prefix trie against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tickloom.llm import lattice, prefix_trie, ranked_search

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SOME = ["the", "The", "of", "rain", "b2", "Été", "naïve", "x", "fall", "12", "zz-top", "...", "_a_"]


def _lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def _text(rng, n):
    return " ".join(rng.choice(SOME) for _ in range(n))


def brute_ranks(docs, items, top):
    found = [(d, Counter(TERM.findall(_lower(t)))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n, total = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    rows = []
    for item, text in items:
        scored = []
        for d, c in found:
            m = 50 + (50 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(TERM.findall(_lower(text))) if t in c
            )
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        rows += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda r: r[:3])[:top], 1)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("block, shard, cells", [(1 << 20, 4096, 1 << 24), (30, 16, 64)])
def test_best_documents_of_every_item(spark, monkeypatch, block, shard, cells):
    monkeypatch.setattr(ranked_search, "SHARD", shard)
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    rng = random.Random(5)
    docs = [(i, _text(rng, rng.choice([0, 1, 3, 40]))) for i in range(120)]
    docs += [(200 + i, "rain fall b2") for i in range(40)] + [(7, "rain x"), (7, "rain x"), (None, "rain x"), (None, None), (300, "")]
    docs += [(301, "rain " * 50_000 + "only")]
    items = [(i, _text(rng, n)) for i, n in enumerate([1, 4, 9, 30, 0])]
    items += [(2, "Rain"), (None, "rain rain X"), (9, None), (10, "..."), (11, "nowhere"), (12, "only")]
    left = spark.createDataFrame([(d, t, 1.5) for d, t in docs], "doc_id int, text string, score double").repartition(5)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    rows = ranked_search.search(left, right, top=10, block_bytes=block).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_ranks(docs, items, 10)


def test_masks_of_more_than_64_terms(spark):
    rng = random.Random(8)
    names = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(rng.sample(names, rng.choice([3, 20, 90])))) for i in range(300)]
    items = [(0, " ".join(names[:140])), (1, " ".join(names[100:]))]
    rows = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), top=7
    )
    assert sorted(map(tuple, rows.collect()), key=repr) == brute_ranks(docs, items, 7)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "rain")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rain")], "item_id long, text string")
    assert ranked_search.search(docs.limit(0), items).collect() == []
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    with pytest.raises(TypeError):
        ranked_search.search(docs.withColumn("doc_id", F.lit("a")), items)


# Lattice


def brute_word(pieces, word):
    """Probability of a word over all segmentations, and expected uses of its pieces."""
    whole = "▁".encode() + word

    @lru_cache(None)
    def cuts(at):
        if at == len(whole):
            return [(1.0, ())]
        made = []
        for end in range(at + 1, len(whole) + 1):
            w = pieces.get(whole[at:end])
            if w:
                made += [(w * p, (whole[at:end], *rest)) for p, rest in cuts(end)]
        return made

    ways = cuts(0)
    total = sum(p for p, _ in ways)
    used = Counter()
    for p, way in ways:
        for piece in way:
            used[piece] += p / total
    return total, used


PIECES = {bytes([b]): 0.001 for b in range(256)} | {
    "▁".encode(): 0.05, "▁a".encode(): 0.1, b"ab": 0.07, b"abc": 0.03, b"bc": 0.05, "é".encode(): 0.02, b"cc": 0.01, "▁abc".encode(): 0.004,
}


@pytest.mark.parametrize("short", [64, 3])
def test_lattice_sums_all_segmentations(monkeypatch, short):
    monkeypatch.setattr(lattice, "SHORT", short)
    words = [b"a", b"abc", b"abcabc", "été".encode(), b"x", b"ccabc", b"\x00\xff"]
    made = lattice.Lattice(PIECES)
    plain = [brute_word(PIECES, w) for w in words]
    assert np.allclose(made.log_weights(words), [math.log(p) for p, _ in plain], atol=1e-12)
    times = np.array([3, 1, 2, 5, 1, 1, 4])
    expected = Counter()
    for n, (_, used) in zip(times, plain):
        for piece, k in used.items():
            expected[piece] += n * k
    got = made.expected(words, times)
    assert np.allclose(got, [expected[p] for p in made.pieces], atol=1e-9)
    made.weigh(got, 5)
    assert math.isclose(np.exp(made.log).sum() + math.exp(made.end), 1)


def test_very_long_word_has_a_probability():
    made = lattice.Lattice(lattice.vocabulary(P.path("piece_bpe_32k.model")))
    value = made.log_weights([b"ab" * 30_000, b"ab"])
    assert np.isfinite(value).all() and value[0] < value[1] < 0


@pytest.mark.parametrize("head", [1 << 17, 2])
def test_documents_scored_like_a_plain_version(spark, head):
    rng = random.Random(2)
    docs = [(i, _text(rng, rng.choice([0, 1, 6, 50]))) for i in range(60)] + [(None, "Rain rain"), (70, None), (70, ""), (71, "q" * 500), (71, "q" * 500)]
    docs += [(72, "été x\x0bABC  "), (73, "unseen wordlets")]

    def trained(d):
        return bool(zlib.crc32(str(d).encode()) % 10 if d is not None else 0)

    path = P.path("piece_bpe_32k.model")
    left = spark.createDataFrame([(d, t, 5) for d, t in docs], "doc_id long, text string, __row int").repartition(3)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    rows = lattice.score_documents(left, path, train=train, head=head).collect()
    words = [lattice.words_of((t or "").encode()) for _, t in docs]
    assert words[-2] == ["été x".encode(), b"abc"]
    seen, ends = Counter(), 0
    for (d, _), w in zip(docs, words):
        if trained(d):
            seen.update(w)
            ends += 1
    n, v = seen.total() + ends, len(seen) + 1
    model = lattice.Lattice(lattice.vocabulary(path))
    for _ in range(lattice.PASSES):
        total = sum((c * model.expected([w], np.array([1])) for w, c in seen.items()), np.zeros(len(model.pieces)))
        model.weigh(total, ends)
    alone = {w: model.log_weights([w])[0] for ws in words for w in ws}
    expected = []
    for (d, _), w in zip(docs, words):
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(seen[x] for x in w), ends])
        score = (sum(alone[x] for x in w) + model.end) / math.log(10)
        expected.append((d, trained(d), len(w) + 1, sum(seen[x] > 0 for x in w) + 1, n, base, score))
    got = [(r.doc, r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows]
    got, expected = (sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])) for x in (got, expected))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9)


def test_scores_without_training_texts_and_without_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    path = P.path("piece_bpe_32k.model")
    rows = lattice.score_documents(docs, path, train=F.lit(False)).collect()
    assert {(r.doc, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert all(math.isfinite(r.score) and math.isclose(r.base_score, 0, abs_tol=1e-12) for r in rows)
    assert lattice.score_documents(docs.limit(0), path, train=F.lit(True)).collect() == []


# Trie


def brute_trie(convs):
    """Rows of the trie of {conv: [(role, text), ...]}."""
    members, ended = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ended[tuple(turns)].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, held in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(held) - 1) * len(n[-1][1].encode()) if n else 0
    return sorted((
        (min(held), len(n), min(members[n[:-1]]) if n else None, len(held), children[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ended[n]))).encode()).hexdigest())
        for n, held in members.items()
    ), key=repr)


@pytest.mark.parametrize("turns, convs", [(1 << 16, 4096), (7, 4), (1, 1)])
def test_trie_of_conversations(spark, turns, convs):
    rng = random.Random(4)
    said = [("user", "hé"), ("assistant", "no"), ("user", ""), ("", "x"), ("use", "rhé")]
    made = {c: [rng.choice(said[: rng.choice([1, 2, 5])]) for _ in range(rng.choice([1, 2, 3, 9]))] for c in range(-20, 60)}
    made |= {100 + i: [said[0]] * 40 for i in range(30)} | {200: [said[0]] * 300, 201: [said[0]] * 300 + [said[1]]}
    rows = [(c, i, r or None, t or None, 1) for c, all_ in made.items() for i, (r, t) in enumerate(all_)]
    rows += [(None, 1, "user", "x", 1)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, depth int").repartition(4)
    steps = prefix_trie.steps_of(prefix_trie.numbered_turns(table))
    # Conversations without a turn are members of the root.
    more = spark.createDataFrame([(c, 0) for c in (900, 901)], "conv long, part int")
    steps = steps.unionByName(more, allowMissingColumns=True)
    got = prefix_trie.trie(steps, turns=turns, conversations=convs).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(made | {900: [], 901: []})


def test_turns_in_order_and_ties(spark):
    rows = [(1, 2, "b", "2"), (1, None, "z", "0"), (1, 1, "b", "1"), (1, 1, "a", "1"), (1, 1, "a", "1")]
    table = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")
    got = prefix_trie.build(table).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie({1: [("z", "0"), ("a", "1"), ("a", "1"), ("b", "1"), ("b", "2")]})
    assert prefix_trie.build(table.limit(0)).collect() == []
