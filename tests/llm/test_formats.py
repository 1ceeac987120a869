"""Byte-level BPE, token records, archives and conversations: round trips and plain versions."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers as P
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.llm import bpe, chat, line_dedup, ngram_join, pieces, records, rules, text, warc, wu_manber
from tickloom.session import new_path

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "\n\n a", "tab\tx", "don't we'll I'M 's 't", "x" * 3000,
    "ab" * 2000, "1234 56", "é è́ ß Σίσυφος", " x y　z", "日本語テキスト", "😀👩‍👩‍👧", "\x00\x1c\x1d\x85", "A.B,C.,", "foo\nbar baz.\nqux",
    "<|endoftext|> x", "İstanbul ŁÓDŹ ÇA", "thé. La, X. (y) z.,", "á. b", "Ünï, cödé.", "𝔘𝔫𝔦", "퟿", "word's. x",
]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(spark):
    return bpe.SpacedEncoder(bpe.read_ranks(spark, RANKS), P.PATTERN)


def test_ids_equal_the_library(reference, encoder):
    for text in ODD:
        assert encoder.encode(text) == reference.encode_ordinary(text), repr(text)
        assert encoder.decode(encoder.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cé.\n\t'sS12 # 日", max_size=40))
def test_ids_equal_the_library_on_any_text(reference, encoder, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_merge_against_plain_merging(encoder):
    def plain(piece):
        if piece in encoder.ranks:
            return [encoder.ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(encoder.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not pairs or min(pairs)[0] == 1 << 60:
                return [encoder.ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    for _ in range(200):
        piece = bytes(rng.choice(b"aaabcther\xc3\xa9") for _ in range(rng.randrange(1, 40)))
        assert encoder.merge(piece) == plain(piece)
        assert not any(encoder.leaf)


def test_bpe_rows(spark, reference):
    docs = spark.createDataFrame([(1, t, "k") for t in ODD] + [(None, None, None)], "doc_id long, text string, n_chars string")
    docs = docs.withColumn("again", F.col("text"))
    rows = bpe.digests(bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS)).collect()
    assert rows == bpe.digests(bpe.encode(docs, RANKS, P.PATTERN, decoded="decoded")).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        assert r.ids == reference.encode_ordinary(r.again or "") and bytes(r.decoded) == (r.again or "").encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.again or "").encode()).hexdigest()
    assert bpe.encode(docs.limit(0), RANKS, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("n_chars", "ids"), RANKS, P.PATTERN)


def _ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    own = records.WordEncoder(open(WORDS).read())
    for got, text in zip(own.encode_all(ODD), ODD):
        assert np.frombuffer(got, own.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abÀé.,\n\t'sS12 # 日İΣ́", max_size=40))
def test_word_ids_equal_the_library_on_any_text(text):
    if "own" not in _WORDS:
        _WORDS["own"] = records.WordEncoder(open(WORDS).read())
    own = _WORDS["own"]
    assert np.frombuffer(own.encode_all([text])[0], own.kind).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


_WORDS = {}


@pytest.mark.parametrize("limit", [1, 8, 64])
def test_texts_with_more_pieces_than_a_table_holds(spark, reference, limit):
    repeated = " ".join(f"{i % 40}" for i in range(300))
    texts = ["a b", " ".join(map(str, range(100))), repeated, None, "x7 " * 50 + repeated, " ".join(f"w{i}" for i in range(90))]
    encoder = bpe.SpacedEncoder(bpe.read_ranks(spark, RANKS), P.PATTERN)
    encoder.table = pieces.PieceTable("<i4", limit)
    words = records.WordEncoder(open(WORDS).read())
    words.table = pieces.PieceTable(words.kind, limit)
    for some in ([t] for t in texts), [texts], [texts]:
        for part in some:
            got = [np.frombuffer(ids, "<i4").tolist() for ids in encoder.encode_all(part)]
            assert got == [reference.encode_ordinary(t or "") for t in part]
            expected = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
            assert [np.frombuffer(ids, words.kind).tolist() for ids in words.encode_all(part)] == expected


def test_records_read_back(spark):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, "null key"), (99, None)]
    random.Random(4).shuffle(docs)
    path = new_path(spark, "records")
    records.write_records(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), WORDS, path, end_id=2)
    index = records.read_index(spark, path)
    digests = records.read_digests(spark, path).join(index.select("file", "offset", "start"), ["file", "offset"]).collect()
    got = sorted((r.start, r.key, r.n_tokens, r.ids_crc32) for r in digests)
    expected, start = [], 0
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] or "")):
        ids = _ids(text) + [2]
        expected.append((start, None if key is None else str(key), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    whole = {(r.file, r.offset): r.ids for r in records.read_records(spark, path).collect()}
    some = index.orderBy(F.xxhash64("offset", "file")).limit(7)
    read = records.read_at(spark, path, some).collect()
    assert len(read) == 7 and all(whole[r.file, r.offset] == r.ids for r in read)
    empty = new_path(spark, "records")
    records.write_records(spark.createDataFrame([], "doc_id long, text string"), WORDS, empty)
    assert records.read_index(spark, empty).count() == 0 and records.read_digests(spark, empty).count() == 0


def test_damaged_frames_raise():
    frame = records.frame("7", np.array([1, 10, 300], "<u2").tobytes(), 2)
    assert records.unframe(frame, 0)[0] == "7" and records.unframe(frame, 0)[1].tolist() == [1, 10, 300]
    for i in range(len(frame)):
        with pytest.raises(Exception):
            records.unframe(frame[:i] + bytes([frame[i] ^ 1]) + frame[i + 1 :], 0)


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 5])
def test_archive(spark, least):
    pages = [(1, "u1", "same"), (2, "u2", "same"), (9, "u3\r\nX: y", "longer payload é"), (4, None, "longer payload é"), (5, "u", None),
             (6, "u", ""), (7, "u", "alone"), (8, "a", "twice over"), (8, "a", "twice over"), (None, "n", "alone"), (11, "v", "WARC-Type: revisit\r\n\r\n")]
    path = new_path(spark, "archive")
    warc.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), path, min_bytes=least)
    rows = warc.read_archive(spark, path).select(
        warc.header_field("WARC-Page-ID").cast("long").alias("page"), "payload_bytes", "payload_digest",
        warc.header_field("WARC-Type").alias("kind"), warc.header_field("WARC-Refers-To-Page-ID").cast("long").alias("to"), "payload", "header",
    ).collect()
    assert len(rows) == len(pages)
    expected = []
    left = {}
    for page, _, text in pages:
        size = len((text or "").encode())
        top = max((p for p, _, t in pages if (t or "") == (text or "") and p is not None))
        first = size < least or (page == top and left.setdefault(text or "", page) is page and (text, page) not in left)
        left[text, page] = 1
        expected.append((page, size, _digest(text), "response" if first else "revisit", None if first else top))
    key = lambda r: repr(r)
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.kind, r.to) for r in rows), key=key) == sorted(expected, key=key)
    stored = [bytes(r.body) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert len(stored) == len(set(stored)) == len({t or "" for _, _, t in pages})
    for r in warc.records(spark, path).collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        length = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert body[length:] == b"\r\n\r\n"


def test_archive_notices_damage(spark):
    path = new_path(spark, "archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), path)
    spark.read.parquet(f"{path}/payloads").select("sha256", F.lit(b"abd").alias("body")).write.parquet(f"{path}/bad")
    bad = spark.read.parquet(f"{path}/bad")
    bad.write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, path).collect()


def test_empty_archive(spark):
    path = new_path(spark, "archive")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).count() == 0


TREE = [
    # tree, node, parent, score, role, text
    ("t", 1, None, 0.0, "user", "root"),
    ("t", 2, 1, 1.0, "assistant", "low"),
    ("t", 3, 1, 2.0, "assistant", "high </s>"),
    ("t", 4, 3, 0.5, "user", None),
    ("t", 5, 4, 0.1, "assistant", "end"),
    ("t", 6, 2, 5.0, "tool] ", "[ROLE:x] \\ "),
    ("c", 1, 2, 0.0, "user", "cycle"),
    ("c", 2, 1, 0.0, "user", "cycle"),
    ("o", 7, 99, 0.0, None, "orphan"),
    (None, 1, None, None, "system", "<<SYS>>"),
    ("t", 5, 4, 0.1, "assistant", "end"),
]


def _messages(spark, rows=TREE):
    return spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")


def test_best_branch_of_a_tree(spark):
    made = {(r.tree, r.leaf): r for r in chat.format_trees(_messages(spark)).collect()}
    assert set(made) == {("t", 6), ("o", 7), (None, 1)}
    assert chat.parse(made["t", 6].formatted) == [("user", "root"), ("assistant", "low"), ("tool] ", "[ROLE:x] \\ ")]
    assert chat.parse(made["o", 7].formatted) == [(None, "orphan")]
    both = {(r.tree, r.leaf): r for r in chat.format_trees(_messages(spark), branches=None).collect()}
    long = both["t", 5]
    assert chat.parse(long.formatted) == [("user", "root"), ("assistant", "high </s>"), ("user", ""), ("assistant", "end")]
    assert chat.masked_text(long.formatted, [(s.start, s.end) for s in long.loss]) == "high </s>end"
    assert chat.format_trees(_messages(spark, [])).count() == 0


def test_long_chain(spark):
    rows = [("x", i, i - 1 if i else None, 0.0, "user" if i % 2 else "assistant", str(i)) for i in range(300)]
    made = chat.format_trees(_messages(spark, rows)).collect()
    assert len(made) == 1 and [t for _, t in chat.parse(made[0].formatted)] == [str(i) for i in range(300)]


def test_escapes_are_undone(spark):
    pieces = ["<", "</", "s>", "<s>", "</s>", "[INST]", "[/INST]", "[", "\\", "\\\\", "<<SYS>>", "<</SYS>>", " ", "\n", "[ROLE", "[/ROLE]", "é", "INST]"]
    rng = random.Random(6)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(8))) for _ in range(300)]
    rows = [(str(i), j, j - 1 if j else None, 0.0, role, t) for i, t in enumerate(texts) for j, role in enumerate(("system", "user", "assistant", "other"))]
    for r in chat.format_trees(_messages(spark, rows)).collect():
        text = texts[int(r.tree)]
        assert chat.parse(r.formatted) == [("system", text), ("user", text), ("assistant", text), ("other", text)]
        assert chat.masked_text(r.formatted, [(s.start, s.end) for s in r.loss]) == text


def _thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


@pytest.mark.parametrize("n", [256, 1024, 4096])
def test_words_made_to_collide_are_told_apart(reference, encoder, n):
    """Such a word and its complement have equal polynomial hashes modulo 2**64, whatever the base."""
    one = _thue_morse(n)
    other = one.translate(str.maketrans("ab", "ba"))
    for text in (one, other, f"x {one} y {other}"):
        assert encoder.encode(text) == reference.encode_ordinary(text)
        test_word_ids_equal_the_library_on_any_text.hypothesis.inner_test(text)
    a, b = ngram_join.shingle_sets([one.encode(), other.encode()])
    assert a[0] != b[0]
    window = "a b c d e f g"
    assert rules.n_repeat_words([f"{window} {one} {window} {other}".encode()])[0] == 0
    assert rules.n_repeat_words([f"{window} {one} {window} {one}".encode()])[0] == 16


HELPERS = ["sieve_word", "sieve_bit", "sieve_bits", "__sha", "__doc", "__other", "sha", "doc", "n_lines", "n_removed", "gone", "line"]


def test_columns_named_like_helpers_stay(spark):
    texts = ["a b c d e f g", "a b c d e f g", "x y z", None, "one two three four\nx y z"]
    rows = [(i, t, *(10 * i + k for k in range(len(HELPERS)))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *HELPERS])
    plain = docs.select("doc_id", "text")
    for clean in (ngram_join.keep_one, line_dedup.clean_documents):
        got = clean(docs)
        assert got.columns == docs.columns
        expected = {r.doc_id: r.text for r in clean(plain).collect()}
        assert {r.doc_id: r.text for r in got.collect()} == expected
        kept = {r.doc_id: r[2:] for r in got.collect()}
        assert kept == {i: row[2:] for i, row in ((r[0], r) for r in rows) if i in expected}


def test_an_url_cannot_forge_a_header(spark):
    signs = ["\n", "\r\n", "\x85", "\u2028", "\u2029", "\x0b", "\x00"]
    rows = [(i, f"http://a/{c}WARC-Page-ID: 99{c}WARC-Type: none{c}WARC-Refers-To-Page-ID: 98", "same") for i, c in enumerate(signs)]
    path = new_path(spark, "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.read_archive(spark, path).select(*(warc.header_field(n).alias(n.replace("-", "")) for n in ("WARC-Page-ID", "WARC-Type", "WARC-Refers-To-Page-ID")))
    last = str(len(signs) - 1)
    assert sorted(map(tuple, got.collect())) == sorted((str(i), "response" if str(i) == last else "revisit", None if str(i) == last else last) for i, _, _ in rows)


def test_a_worker_keeps_the_tables_of_one_stage():
    """What was made last is kept, by whatever operator; a stage that keeps nothing lets go of it."""
    made = []
    text.let_go()
    assert [text.held((k,), lambda: made.append(k) or k) for k in "aabba"] == list("aabba") and made == list("aba")
    shared = type("Shared", (), {"value": ([("i", b"one two")], 10)})
    tables = wu_manber._tables("key", shared)
    assert list(text._HELD.values()) == [tables] and wu_manber._tables("key", shared) is tables
    encoder = bpe._encoder("key", type("Shared", (), {"value": ({bytes([b]): b for b in range(256)}, "x")}))
    assert list(text._HELD.values()) == [encoder]
    text.let_go()
    assert not text._HELD and not text._POWERS
