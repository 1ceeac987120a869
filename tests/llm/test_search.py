"""Passage search, rules, language codes and the quality network against plain versions."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tickloom.llm import convnet, ecoc, rules, wu_manber
from tickloom.llm.text import encoded

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = ["the", "of", "a", "b2", "Été", "x", "rain", "Fall", "naïve", "12"]


def _text(rng, n):
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", ", ", "\n", " -- "]) for _ in range(n))


def words_of(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute_hits(text, items, width=10):
    words = words_of(text)
    hit, found = set(), set()
    for item, passage in items:
        own = words_of(passage)
        n = min(width, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_passages_are_found_in_one_pass_and_in_several(spark, block):
    rng = random.Random(3)
    items = [(i, _text(rng, n)) for i, n in enumerate([14, 25, 3, 1, 10, 0, 12])] + [(7, None), (8, "Rain, FALL!"), (8, "rain fall")]
    docs = [(i, _text(rng, rng.choice([0, 2, 30, 200]))) for i in range(40)] + [(None, "x"), (50, None), (50, ""), (50, "of")]
    docs += [(60, "zz " + items[0][1] + " zz"), (60, "zz " + items[0][1] + " zz"), (61, items[1][1].upper())]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id int, text string")
    rows = wu_manber.hit_summary(wu_manber.find_passages(left, right, passage_bytes=block)).collect()
    from hashlib import sha256

    expected = []
    for doc, text in docs:
        n, hit, found = brute_hits(text, items)
        expected.append((doc, n, hit, len(found), sha256(",".join(found).encode()).hexdigest(), hit > 0))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    kept = wu_manber.clean_documents(left.withColumnRenamed("doc_id", "items"), right)
    assert kept.columns == ["items", "text"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((d for d in docs if not brute_hits(d[1], items)[1]), key=repr)


def test_nothing_is_hit_without_passages_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert [r.n_hit for r in wu_manber.hit_summary(wu_manber.find_passages(docs, none)).collect()] == [0]
    some = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert wu_manber.find_passages(docs.limit(0), some).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_passages_without_an_id_are_hit_but_name_no_item(spark, block):
    docs = [(1, "x rain falls y"), (2, "sun and moon"), (3, "rain falls, sun and moon"), (4, "rain")]
    items = [(None, "Rain falls"), (7, "sun and"), (None, "sun and"), (None, None)]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id int, text string")
    found = wu_manber.hit_summary(wu_manber.find_passages(left, right, passage_bytes=block))
    got = sorted((r.doc, r.n_hit, r.n_items, r.contaminated) for r in found.collect())
    assert got == [(1, 2, 0, True), (2, 2, 1, True), (3, 4, 1, True), (4, 0, 0, False)]
    assert [r.doc_id for r in wu_manber.clean_documents(left, right).collect()] == [4]


def test_blocks_of_passages_are_read_when_they_are_broadcast(spark, monkeypatch):
    read, sent, own, send = [], [], wu_manber._blocks, type(spark.sparkContext).broadcast

    def blocks(*args):
        for block in own(*args):
            read.append(block)
            yield block

    def broadcast(context, value):
        sent.append(len(read))
        return send(context, value)

    monkeypatch.setattr(wu_manber, "_blocks", blocks)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    docs = spark.createDataFrame([(1, "w3 x")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"w{i}") for i in range(6)], "item_id int, text string")
    found = wu_manber.find_passages(docs, items, passage_bytes=2)
    assert sent == [2, 2, 3, 4, 5, 6] and [r["items"] for r in found.collect()] == [["3"]]


def test_overlapping_and_repeated_windows():
    tables = wu_manber.compile_passages([("1", b"a a a")], 2)
    assert wu_manber.hits(b"a a a a b a", tables) == (6, [(0, 4)], {"1"})


def _brute_repeats(text, width=8):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    return len({i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(width)})


def test_counts_of_rules():
    rng = random.Random(5)
    texts = [_text(rng, n) for n in (0, 1, 8, 9, 40, 300)] + ["a " * 30, "é ü\tx", "x\ny\nx\n\n \nx", "#a *$%&|<>", "  \x1c"]
    assert rules.n_repeat_words(encoded(texts)).tolist() == [_brute_repeats(t) for t in texts]
    assert rules.word_chars(encoded(texts)).tolist() == [len(re.sub(r"[\x20\x09-\x0D]", "", t)) for t in texts]
    assert rules.n_words(encoded(texts)).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert rules.n_dup_lines(encoded(["x\ny\nx\n\n \nx"])).tolist() == [2]
    assert rules.n_symbols(encoded(["#a *$%&|<>"])).tolist() == [8]


def test_cascade_order_changes_no_verdict_and_skips_rejected_texts():
    seen = []

    def rule(name, bad):
        def run(texts):
            seen.append((name, len(texts)))
            return np.array([t in bad for t in texts])

        return run

    own = {"a": rule("a", {b"1", b"2"}), "b": rule("b", {b"3"}), "c": rule("c", set())}
    texts = [b"1", b"2", b"3", b"4"]
    first = rules.cascade(texts, ["a", "b", "c"], own)
    assert first.tolist() == [0, 0, 1, -1] and seen == [("a", 4), ("b", 2), ("c", 1)]
    assert ((rules.cascade(texts, ["c", "b", "a"], own) == -1) == (first == -1)).all()
    order = [e.name for e in rules.estimate(texts, own)]
    assert order[-1] == "c"


def test_rules_on_odd_rows(spark):
    rows = [(1, None, "k"), (1, "", None), (None, "word " * 50, "k"), (2, " ".join(f"w{i} other" for i in range(30)), "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    made = rules.apply_rules(docs)
    assert made.columns[:3] == docs.columns
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in made.collect()), key=repr)
    assert got == sorted([(1, 0, True, False), (1, 0, True, False), (None, 50, True, False), (2, 60, False, True)], key=repr)
    assert rules.apply_rules(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        rules.apply_rules(docs.withColumnRenamed("extra", "kept"))


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 30])
def test_codewords_differ(n):
    code = ecoc.codewords(n)
    assert len({tuple(r) for r in code}) == n
    assert all(0 < c.sum() < n for c in code.T)


LANGUAGES = {"en": "the and of that with was is ", "fr": "le la des que avec était être ", "de": "der und die nicht über schön "}


def test_languages(spark):
    rng = random.Random(1)

    def text(lang, n):
        words = LANGUAGES[lang].split()
        return " ".join(rng.choice(words) for _ in range(n))

    train = [(i, text(lang, 30), lang) for i in range(20) for lang in LANGUAGES] + [(99, None, "en"), (98, "zzz", None)]
    model = ecoc.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), per_language=15)
    assert model.languages == ["de", "en", "fr"]
    rows = [(i, text(lang, 12), lang) for i in range(10) for lang in LANGUAGES]
    rows += [(1, None, "und"), (1, "", "und"), (None, "12 -- !", "und")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = ecoc.predict(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in told) and all(0 <= r.score <= 1 for r in told)
    long = "der und die nicht " * 60_000
    assert model.predict([long])[0] == ["de"]
    # Alone or among others, whole or in stretches, a text has the same bits.
    texts = encoded([t for _, t, _ in rows if t] + [long])
    apart = np.concatenate([model.bits([t]) for t in texts])
    assert np.allclose(apart, model.bits(texts), atol=1e-5)
    mixed = model.predict(["le la des que avec der und die nicht über"])[1]
    assert mixed[0] < model.predict(["le la des que avec"])[1][0]


def test_copies_of_texts_neither_fill_the_sample_nor_empty_it(spark, monkeypatch):
    rows = [(f"der und die nicht {i}", "de") for i in range(4)] * 500 + [(f"the and of {i}", "en") for i in range(200)]
    rows += [("the and of that", "en")] * 2000 + [(None, "fr"), ("x", None)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    drawn = [tuple(r) for r in ecoc.sample(docs, text="text", lang="lang", per_language=40).collect()]
    assert sorted(t for k, t in drawn if k == "de") == sorted({t for t, k in rows if k == "de"})
    assert 10 < sum(k == "en" for k, _ in drawn) < 80 and len(set(drawn)) == len(drawn)
    assert ecoc.fit(docs, per_language=40).languages == ["de", "en"]
    monkeypatch.setattr(ecoc, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        ecoc.fit(docs)


def test_languages_without_training(spark):
    none = spark.createDataFrame([], "text string, lang string")
    model = ecoc.fit(none)
    assert model.predict(["abc", None])[0] == ["und", "und"]
    one = ecoc.fit(spark.createDataFrame([("abc", "xx")], "text string, lang string"))
    assert one.predict(["abc", "1"])[0] == ["xx", "und"]
    assert ecoc.predict(none.drop("lang"), one).count() == 0


def test_held_out_fold_is_crc32_of_the_id(spark):
    got = spark.range(50).select("id", ecoc.fold("id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in got)


def test_network_learns_and_covers_whole_texts(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["rain", "falls", "on", "plain", "hills"]) for _ in range(80)) for _ in range(120)]
    bad = [" ".join(rng.choice(["rain###", "falls$$$", "on%%%"]) for _ in range(60)) for _ in range(120)]
    rows = [(t, 1) for t in good] + [(t, 0) for t in bad] + [("x", None), (None, 1)]
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, quality int")
    net = convnet.fit(numbered.select("doc_id", "text"), numbered.select("doc_id", "quality"))
    fresh = [" ".join(rng.choice(["rain", "hills", "plain"]) for _ in range(n)) for n in (3, 40, 900)]
    dirty = [" ".join(rng.choice(["rain###", "on%%%"]) for _ in range(n)) for n in (40, 900)]
    high, low = net.score(encoded(fresh)), net.score(encoded(dirty))
    assert (high > 0.7).all() and (low < 0.3).all()
    tail = fresh[2] + " rain###" * 60
    assert not np.allclose(net.score([tail.encode()]), net.score([fresh[2].encode()]), atol=1e-9)
    docs = spark.createDataFrame([(1, None), (1, ""), (2, fresh[2])], "doc_id long, text string")
    scored = convnet.score(docs, net).collect()
    assert len(scored) == 3 and all(0 <= r.score <= 1 for r in scored)
    assert convnet.score(docs.limit(0), net).count() == 0


def test_pooling_equals_a_plain_convolution():
    rng = np.random.default_rng(0)
    net = convnet.train([convnet.stretches(b"a" * 300), convnet.stretches(b"#" * 300)], [1, 0], epochs=1)
    text = bytes(rng.integers(32, 127, 1000).astype(np.uint8))
    codes = convnet._padded(text)
    n = len(codes) - convnet.WIDTH + 1
    plain = np.stack([sum(net.filters[k][codes[i + k]] for k in range(convnet.WIDTH)) for i in range(n)])
    chunks = [plain[s : s + convnet.CHUNK].max(0) for s in range(0, n - convnet.STEP, convnet.STEP)]
    assert np.allclose(net.chunk_maxima(codes), np.maximum(np.array(chunks) + net.bias, 0), atol=1e-4)


def test_fitting_pools_whole_texts_as_scoring_does():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in (10, 300, 9_000, 40_000)]
    examples, labels, weight = [convnet.stretches(t) for t in texts], np.array([1.0, 0, 1, 0]), np.ones(4)
    net = convnet.train(examples, labels, epochs=1)

    def loss():
        p = net.score(texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    grads = dict(zip(("filters", "bias", "hidden", "hidden_bias", "out", "out_bias"), convnet._gradients(net, examples, labels, weight)))
    for name in ("bias", "hidden", "hidden_bias", "out", "out_bias"):
        value, grad = getattr(net, name).reshape(-1), grads[name].reshape(-1)
        for i in range(0, len(value), 7):
            held, seen = value[i], []
            for move in (1e-5, -1e-5):
                value[i] = held + move
                seen.append(loss())
            value[i] = held
            assert abs((seen[0] - seen[1]) / 2e-5 - grad[i]) < 1e-4


def test_every_byte_of_a_training_text_counts():
    rng = random.Random(4)
    words = ["rain", "falls", "on", "plain", "hills"]
    made = [" ".join(rng.choice(words) for _ in range(1300)).encode()[:6000] for _ in range(60)]
    texts = [t if i % 2 else t[:500] + b"#$%" * 30 + t[590:] for i, t in enumerate(made)]
    net = convnet.train([convnet.stretches(t) for t in texts[:40]], [i % 2 for i in range(40)])
    assert [p > 0.5 for p in net.score(texts[40:])] == [bool(i % 2) for i in range(20)]


def test_network_without_both_labels():
    assert convnet.train([convnet.stretches(b"a")], [0]).score([b"x"]).tolist() == [0.0]
    assert convnet.train([], []).score([b"x"]).tolist() == [1.0]


def _plain_buckets(text):
    """Buckets of all n-grams of a text, one n-gram at a time in whole numbers."""
    data = [c + 32 if 65 <= c <= 90 else 32 if c < 32 else c for c in text.encode()]
    made = []
    for k, n in enumerate(ecoc.ORDERS):
        for i in range(len(data) - n + 1):
            value = 1 + k
            for c in data[i : i + n]:
                value = (value * 0x01000193 + c) % (1 << 32)
            value ^= value >> 15
            made.append((value * 0x2C1B3C6D % (1 << 32)) >> (32 - ecoc.BUCKETS.bit_length() + 1))
    return made


def test_language_query_equals_a_plain_fit_and_decoding(spark):
    from collections import Counter
    from math import exp, log

    from tickloom.llm import catalog

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    grams = {t: _plain_buckets(t) for _, t, _ in docs}
    train = sorted({(lang, t) for d, t, lang in docs if zlib.crc32(str(d).encode()) % 4 != 2 and lang is not None})
    names = sorted({lang for lang, _ in train})
    code = [[c[i] for c in itertools.product((1, 0), repeat=len(names)) if c[0] == 1 and 0 in c] for i in range(len(names))]
    bits = range(len(code[0]))
    counts = {lang: Counter() for lang in names}
    for lang, t in train:
        counts[lang].update(grams[t])
    total = {lang: counts[lang].total() + ecoc.SMOOTHING * ecoc.BUCKETS for lang in names}

    def share(bucket, bit, side):
        some = [(counts[lang][bucket] + ecoc.SMOOTHING) / total[lang] for lang, c in zip(names, code) if c[bit] == side]
        return sum(some) / len(some)

    weight = {}
    for bucket in {b for g in grams.values() for b in g}:
        weight[bucket] = [log(share(bucket, bit, 1) / share(bucket, bit, 0)) for bit in bits]
    answers = {t: [sum(weight[b][bit] for b in g) / max(1, len(g)) for bit in bits] for t, g in grams.items()}
    sign = [[2 * c - 1 for c in row] for row in code]
    trust = []
    for i, lang in enumerate(names):
        own = [t for name, t in train if name == lang]
        right = [(sum(answers[t][bit] * sign[i][bit] > 0 for t in own) + 1) / (len(own) + 2) for bit in bits]
        trust.append([r / sum(right) for r in right])
    expected = {}
    for d, t, _ in docs:
        loss = [sum(trust[i][bit] * exp(-min(20, max(-20, ecoc.SHARPNESS * answers[t][bit] * sign[i][bit]))) for bit in bits) for i in range(len(names))]
        near = [exp(-4 * (x - min(loss))) for x in loss]
        best = max(range(len(names)), key=near.__getitem__)
        told = any(c.isalpha() for c in t)
        expected[d] = (names[best], near[best] / sum(near)) if told else (ecoc.UNKNOWN, 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in catalog.QUERIES["op9_language_codes"](spark, folder).collect()}
    assert {d: n for d, (n, _) in got.items()} == {d: n for d, (n, _) in expected.items()}
    assert {d: s for d, (_, s) in got.items()} == pytest.approx({d: s for d, (_, s) in expected.items()}, rel=1e-4)
