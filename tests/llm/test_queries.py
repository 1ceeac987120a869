"""Registered queries against their SQL, and the pipeline against a plain version."""

import base64
import hashlib

import pytest
import public_tokenizers as P

import corpus_pipeline
from tests.compare import database, differences
from tests.llm.test_copies import brute_lines, expected_components
from tests.llm.test_search import brute_hits
from tickloom.llm import catalog, ecoc

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, name):
    assert differences(spark, database(FOLDER), FOLDER, name, catalog.SQL[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_gives_a_row_per_document(spark, name):
    rows = catalog.QUERIES[name](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert rows.count() == docs.count() and rows.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0


def _held_out(spark, name, truth):
    rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.01").where("held_out")
    return rows.join(truth, "doc_id").collect()


def test_held_out_languages(spark):
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = _held_out(spark, "op9_language_codes", truth)
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_held_out_quality(spark):
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = _held_out(spark, "op7_quality_convnet", truth)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_pipeline_equals_a_plain_version(spark):
    import tiktoken

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = ecoc.fit(docs.where(ecoc.fold("doc_id") != 2))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    named, score = model.predict([t for _, t in rows])
    rows = [r for r, n, s in zip(rows, named, score) if n != ecoc.UNKNOWN and s >= ecoc.AMBIGUOUS]
    rows = [(d, left) for (d, t), left in zip(rows, brute_lines(rows)) if left == t or left.strip(" \t\r\n\x0b\x0c")]
    rows = [r for r, (_, n, least) in zip(rows, expected_components(rows, 5, 80)[0]) if not n or least == r[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [r for r in rows if not brute_hits(r[1], items)[1]]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {d: (library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows}
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == expected


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns


def test_stages_of_odd_documents(spark):
    """Null and repeated ids, null and empty texts, columns named like helpers, no n_chars."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").limit(40).collect()}
    rows = [(i, t, "en", "s", f"c{i}", 1, "x", 2.0) for i, t in texts.items()]
    some = rows[0][1]
    rows += [(None, some, "en", "s", "n1", 1, "x", 2.0), (None, some, "en", "s", "n2", 1, "x", 2.0), (None, None, None, None, "n3", 1, "x", 2.0)]
    rows += [(rows[0][0], "", "en", "s", "e", 1, "x", 2.0), (rows[1][0], rows[1][1], "en", "s", "again", 1, "x", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, n_lines int, lang_pred string, sieve_word double")
    own = {r[4]: r for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
        got = stage(spark, docs, FOLDER)
        if name != "tokens":
            assert got.columns == docs.columns
            assert all(tuple(r)[2:] == own[r.score][2:] and r.doc_id == own[r.score][0] for r in got.collect())
        marks = [r.score for r in got.collect()] if name != "tokens" else []
        if name == "language":
            assert "n3" not in marks and "e" not in marks
        if name == "near_copies":
            assert {"n3", "e"} <= set(marks) and not {"n1", "n2"} & set(marks) and len({"c1", "again"} & set(marks)) <= 1
        if name == "tokens":
            assert got.count() == len(rows)
