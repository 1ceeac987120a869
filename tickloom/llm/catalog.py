"""The operators of this package as queries over the test tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialise, new_path
from . import bpe, chat, convnet, ecoc, lattice, line_dedup, ngram_join, prefix_trie, ranked_search, records, rules, warc, wu_manber

QUERIES = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of its 4-word shingles."""
    found = ngram_join.join(table(spark, folder, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query
def op2_bpe_rank_queue(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text and what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")
    return bpe.digests(rows).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_warc_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a WARC record of a content-addressed archive, read back."""
    path = new_path(spark, "archive")
    pages = table(spark, folder, "pages")
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archive(spark, path).select(
        warc.header_field("WARC-Page-ID").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        warc.header_field("WARC-Type").alias("record_type"),
        warc.header_field("WARC-Refers-To-Page-ID").cast(kind).alias("refers_to"),
    )


@query
def op4_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as a reply tree without branches, formatted and read back; one more holds control strings."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    messages = rows.union(more).select(
        F.col("conv_id").alias("tree"), F.row_number().over(turns).alias("node"), F.lit(0.0).alias("score"), "role", "text"
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    return chat.read_back(chat.format_trees(messages)).withColumnRenamed("tree", "conv_id")


@query
def op5_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document written as framed records and read back, by the offset index."""
    path = new_path(spark, "records")
    docs = table(spark, folder, "documents")
    records.write_records(docs, public_tokenizers.path("word_bpe_49k.json"), path, end_id=2)
    kind = docs.schema["doc_id"].dataType
    index = records.read_index(spark, path).select("file", "offset", "start")
    rows = records.read_digests(spark, path).join(index, ["file", "offset"])
    return rows.select(F.col("key").cast(kind).alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query
def op6_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that repeat another line of the corpus, or nearly so."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


@query
def op7_quality_convnet(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text, learned from labelled rows outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality").where(ecoc.fold("doc_id") != 2)
    network = convnet.fit(docs, labels)
    scored = convnet.score(docs, network)
    return scored.select(
        "doc_id", (ecoc.fold("doc_id") == 2).alias("held_out"), "score",
        (F.col("score") >= convnet.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op8_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every text and the verdict of the cascade."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return rules.apply_rules(docs).drop("text", "rejected_by")


@query
def op9_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from texts outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = ecoc.fit(docs.where(ecoc.fold("doc_id") != 2))
    return ecoc.predict(docs.drop("lang"), model).select(
        "doc_id", (ecoc.fold("doc_id") == 2).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query
def op10_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = wu_manber.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return wu_manber.hit_summary(found).withColumnRenamed("doc", "doc_id")


@query
def op11_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every text over all segmentations of its words, and that of its words by smoothed counts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tenth = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10))
    path = public_tokenizers.path("piece_bpe_32k.model")
    scored = lattice.score_documents(docs, path, train=tenth != 0)
    return scored.select(
        F.col("doc").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of conversations that begin like the first of every five."""
    turns = materialise(prefix_trie.numbered_turns(table(spark, folder, "conversations")), "turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    begun = turns.where("pos = 1").select(F.col("conv").alias("c"), h.alias("h"), (F.col("conv") - F.col("conv") % 5).alias("conv"))
    heads = turns.where((F.col("pos") < 9) & (F.col("conv") % 5 == 0)).join(begun, "conv").where(F.col("pos") <= F.col("h"))
    own = turns.where(F.col("pos") > h)
    parts = heads.select(F.col("c").alias("conv"), F.lit(1).alias("part"), "pos", "key", "bytes").union(
        own.select("conv", F.lit(2).alias("part"), "pos", "key", "bytes")
    )
    return prefix_trie.trie(prefix_trie.steps_of(turns, parts))


@query
def op13_mask_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    found = ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


SQL["op1_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(words, i, i + 3) AS k
  FROM w, unnest(range(1, greatest(2, len(words) - 2))) AS t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(seen) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

SQL["op3_warc_store"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, html, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS h,
    max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""

SQL["op4_reply_trees"] = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learn,
    length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>|</?SYS>>)', '<\\\1', 'g'),
      '\[(/?INST\]|/?ROLE)', '[\\\1', 'g'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 16 + 2 * octet_length(encode(role)) END AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(learn)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learn, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL["op8_quality_cascade"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (
  SELECT r, i, list_slice(words, i, i + 7) AS k FROM w, unnest(range(1, len(words) - 6)) AS t(i) WHERE len(words) >= 8),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
hit AS (
  SELECT r, count(DISTINCT i + o) AS n FROM rep, unnest(range(0, 8)) AS t(o) GROUP BY r),
b AS (
  SELECT w.doc_id, w.text, w.lines, w.words, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN hit USING (r)),
v AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
    (10 * n_symbols > n_words
      OR 100 * n_dup_lines > 60 * len(lines)
      OR word_chars < 2 * n_words OR word_chars > 15 * n_words
      OR 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 40 * length(regexp_replace(text, '[^A-Za-z]', '', 'g'))
      OR 10 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
      OR 5 * len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) > n_words) AS bad
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND NOT bad) AS kept
FROM v
"""

SQL["op10_wu_manber"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
pw AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + least(10, len(words)) - 1) AS k, least(10, len(words)) AS n
  FROM p, unnest(range(1, greatest(2, len(words) - 8))) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM pw),
dw AS (
  SELECT r, i, n, list_slice(words, i, i + n - 1) AS k FROM d, sizes, unnest(range(1, len(words) - n + 2)) AS t(i)
  WHERE len(words) >= n),
m AS (SELECT dw.r, dw.i, dw.n, pw.item_id FROM dw JOIN pw ON dw.n = pw.n AND dw.k = pw.k),
hit AS (SELECT r, count(DISTINCT i + o) AS n_hit FROM m, unnest(range(0, n)) AS t(o) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS s FROM m GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""

SQL["op12_conversation_trie"] = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM t),
crc AS (
  SELECT c, s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM ids
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(v, CAST(ascii(substr(s, i // 9 + 1, 1)) AS BIGINT))
    ELSE xor(v >> 1, CASE WHEN v % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END) END
  FROM crc WHERE i < 9 * length(s)),
h AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h, c - c % 5 AS base FROM crc WHERE i = 9 * length(s)),
r AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM (
    SELECT c, 1 AS part, pos, role, text FROM h JOIN t ON conv_id = base AND pos <= h
    UNION ALL SELECT c, 2, pos, role, text FROM h JOIN t ON conv_id = c AND pos > h)),
p AS (
  SELECT c, d, CAST(octet_length(encode(text)) AS BIGINT) AS bytes,
    string_agg(sha256(octet_length(encode(role)) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS path FROM r
  UNION ALL SELECT c, 0, 0, '' FROM ids),
n AS (SELECT path, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY path, d),
last AS (SELECT c, max(d) AS d FROM p GROUP BY c),
e AS (SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ends FROM p JOIN last USING (c, d) GROUP BY path),
ch AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, coalesce(ends, '') AS ends FROM n LEFT JOIN ch USING (path) LEFT JOIN e USING (path)),
x AS (
  SELECT left(path, 64 * k) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN x USING (path) LEFT JOIN n AS q ON m.depth > 0 AND q.path = left(m.path, 64 * (m.depth - 1))
"""

SQL["op13_mask_search"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (
  SELECT item_id, row_number() OVER () AS q,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS words FROM benchmark),
a AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS total FROM d WHERE len(words) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM f, a),
m AS (SELECT r, doc_id, 50 + (50 * len(words) * n) // total AS m FROM d, a WHERE len(words) > 0),
s AS (
  SELECT q, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM (SELECT q, unnest(words) AS term FROM p) JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY q, r),
k AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k JOIN p USING (q) WHERE rank <= 50
"""
