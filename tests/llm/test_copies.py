"""Near copies of documents and lines against plain versions, and the helpers below them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import line_dedup, ngram_join
from tickloom.llm.components import components
from tickloom.llm.sieve import may_hold, may_not_hold, sieve


def union_find(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 300
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(180)] + [(i, i + 1) for i in range(60)] + [(200, i) for i in range(210, 290)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    expected = union_find(n, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: expected[i] for i in touched}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sieve_loses_no_row(spark):
    rows = spark.range(5000).withColumn("k", F.when(F.col("id") % 7 > 0, F.col("id")))
    some = rows.where("id % 50 = 0")
    held = sieve(some, "k")
    through = may_hold(rows, held, "k")
    assert some.select("k").distinct().exceptAll(through.select("k").distinct()).count() == 0
    assert through.count() + may_not_hold(rows, held, "k").count() == 5000 and through.count() < 1500


WORDS = ["rain", "falls", "On", "the", "plain", "é", "x1", "hill", "and", "valley", "sun", "moon", "sea", "tide"]


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def corpus(rng, families=12):
    docs = []
    for _ in range(families):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 20, 60, 200]))]
        docs.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS).upper()
            docs.append(rng.choice([" ", "\n", "\t "]).join(copy + [rng.choice(WORDS)] * rng.randrange(3)))
            base = rng.choice([base, copy])
    return docs


def expected_components(docs, width, percent):
    sets = [shingles(t, width) for _, t in docs]
    links = [
        (i, j) for i in range(len(docs)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    roots = union_find(len(docs), links)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[roots[i]] = min(doc, least.get(roots[i], doc))
    return [(doc, len(s), least.get(r) if s else doc) for (doc, _), s, r in zip(docs, sets, roots)], roots, sets


@pytest.mark.parametrize("seed,width,percent,group", [(1, 4, 85, 2000), (2, 2, 60, 3), (3, 5, 80, 5)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, width, percent, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rng = random.Random(seed)
    texts = corpus(rng) + ["", None, "   ", "one", "ONE", "two words", "one"]
    docs = list(enumerate(texts)) + [(None, texts[0]), (5, texts[1]), (5, texts[1])]
    rng.shuffle(docs)
    rows = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, n string").repartition(3)
    got = ngram_join.join(rows, width=width, percent=percent)
    expected, roots, sets = expected_components(docs, width, percent)
    assert sorted(((r.doc, r.n_shingles, r.component) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    kept = ngram_join.keep_one(rows, width=width, percent=percent)
    assert kept.columns == rows.columns
    assert kept.count() == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)


def test_frequent_shingles_go_last_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 4)
    rng = random.Random(9)
    shared = " ".join(rng.choice(WORDS) for _ in range(40))
    docs = [(i, shared + " " + " ".join(rng.choice(WORDS) for _ in range(rng.choice([2, 5, 40])))) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert len(ngram_join.frequent(rows, "text", 4)) > 20
    got = sorted((r.doc, r.n_shingles, r.component) for r in ngram_join.join(rows).collect())
    assert got == sorted(expected_components(docs, 4, 85)[0])


def test_join_of_nothing(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(rows).count() == 0 and ngram_join.keep_one(rows).count() == 0


def test_tree_drops_only_what_cannot_link():
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(1, 1 << 62), rng.choice([5, 30, 300]))) for _ in range(30)]
    for s in list(sets):
        cut = [t for t in s if rng.random() > 0.05]
        sets.append(sorted(set(cut) | set(rng.sample(range(1, 1 << 62), 1))))
    import numpy as np

    arrays = [np.array(s, np.uint64) for s in sets]
    true = {
        (i, j) for j in range(len(sets)) for i in range(j)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))
    }

    def tree():
        return ngram_join.SignatureTree([ngram_join._Member(i, len(a), 0, ngram_join.bitmap(a), 0, 0, a) for i, a in enumerate(arrays)])

    partnered = set(tree().with_partners())
    assert len(true) > 10 and {i for pair in true for i in pair} <= partnered
    links = tree().links()
    assert set(links) <= true and union_find(len(sets), links) == union_find(len(sets), true)


def line_shingles(line, k=line_dedup.SHINGLE):
    units = line.encode("utf-16-be")
    return {units[2 * i : 2 * (i + k)] for i in range(max(1, len(units) // 2 - k + 1))}


def brute_lines(docs, percent=80):
    """Kept text of each document by all pairs of lines; documents in the order of their ids."""
    where = [
        (d, at, line.strip(" \t\r\x0b\x0c").lower())
        for d, (_, text) in enumerate(docs) if text is not None
        for at, line in enumerate(text.split("\n"))
    ]
    where = [w for w in where if w[2]]
    sets = [line_shingles(w[2]) for w in where]
    links = [(i, j) for i in range(len(where)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    roots = union_find(len(where), links)
    gone = {where[i][:2] for i, r in enumerate(roots) if r != i}
    return [
        None if text is None else "\n".join(line for at, line in enumerate(text.split("\n")) if (d, at) not in gone)
        for d, (_, text) in enumerate(docs)
    ]


def line_corpus(rng, n=25):
    lines = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 4, 25, 60]))) + f" {i}" for i in range(25)]
    docs = []
    for i in range(n):
        own = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(lines)
            if rng.random() < 0.4:
                at = rng.randrange(len(line))
                line = line[:at] + "Q" + line[at + 1 :]
            own.append(rng.choice(["", "  "]) + (line.upper() if rng.random() < 0.1 else line))
        docs.append((i, "\n".join(own)))
    return docs


def test_lines_against_all_pairs(spark):
    rng = random.Random(1)
    docs = line_corpus(rng, 80) + [(100, None), (101, ""), (102, "\n \n"), (103, "short\nshort\nshort"), (104, "x" * 9 + "\U0001f600" * 3)]
    rows = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, at string").repartition(3)
    made = {r.doc_id: r for r in line_dedup.dedup_lines(rows).collect()}
    assert len(made) == len(docs)
    extra = 0
    for (doc, text), left in zip(docs, brute_lines(docs)):
        assert made[doc].n_lines == (0 if text is None else text.count("\n") + 1)
        if text is None:
            assert made[doc].text is None
            continue
        # What all pairs would keep is kept; a pair of a similarity near the threshold may be missed.
        kept, expected = made[doc].text.split("\n") if made[doc].text else [], left.split("\n") if left else []
        for line in expected:
            kept.remove(line)
        extra += len(kept)
    total = sum(t.count("\n") + 1 for _, t in docs if t)
    assert extra <= 0.02 * total
    texts = {r.doc_id: r.text for r in line_dedup.clean_documents(rows).collect()}
    assert all(r.text == texts[d] if d in texts else r.n_removed and not (r.text or "").strip() for d, r in made.items())
    assert made[103].text == "short" and made[102].text == "\n \n"


def test_lines_of_repeated_and_null_ids(spark):
    rows = [(None, "first line here\nsecond line"), (7, "first line here\nother"), (7, "totally different\nfirst line here")]
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, rows[0][1]), (7, "other"), (7, "totally different")], key=repr)
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_lines_like_one_another_give_one_pair_each(spark):
    rng = random.Random(8)
    base = [rng.choice(WORDS) for _ in range(80)]
    docs = []
    for i in range(120):
        own = list(base)
        own[rng.randrange(80)] = f"w{i}"
        docs.append((i, " ".join(own)))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert sum(r.text != "" for r in line_dedup.dedup_lines(rows).collect()) == sum(t != "" for t in brute_lines(docs))


def test_bridges_between_families_of_other_heads_are_found(spark, monkeypatch):
    def one_group(lines):
        keys = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        marks = F.array(*[F.lit(0).cast("tinyint")] * (line_dedup.BANDS * line_dedup.ROWS))
        return keys.select("key", "n", F.array(F.lit(1)).cast("array<bigint>").alias("bands"), marks.alias("marks"))

    monkeypatch.setattr(line_dedup, "_signatures", one_group)
    monkeypatch.setattr(line_dedup, "BRIDGING", 2)
    rng = random.Random(6)
    docs = []
    for _ in range(4):  # every line is like its neighbours only
        line = "".join(rng.choice("abcdefghij") for _ in range(220))
        for i in range(10):
            docs.append((len(docs), line))
            line = line[: 20 * i + 5] + "Z" + line[20 * i + 6 : 20 * i + 15] + "Z" + line[20 * i + 16 :]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [r.text for r in line_dedup.dedup_lines(rows).orderBy("doc_id").collect()]
    assert got == brute_lines(docs)


def test_native_plan(spark):
    rows = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(rows)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_recall_of_the_bands(spark):
    """Share of pairs just above the threshold that share a band and agree in enough marks."""
    rng = random.Random(12)
    pairs = []
    while len(pairs) < 1200:
        n = rng.choice([14, 20, 40, 90, 250])
        one = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).strip()
        other = one
        for _ in range(40):
            at = rng.randrange(len(other))
            changed = other[:at] + rng.choice("ABCDEFGH").lower() + other[at + rng.choice([0, 1]) :]
            a, b = line_shingles(one), line_shingles(changed)
            if 100 * len(a & b) < 80 * len(a | b):
                break
            other = changed
        a, b = line_shingles(one), line_shingles(other)
        if one != other and 80 <= 100 * len(a & b) / len(a | b) < 86:
            pairs.append((one, other))
    lines = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "at long, line string")
    signed = line_dedup._signatures(lines.select(F.col("at").cast("string").cast("binary").alias("key"), "line"))
    held = {int(bytes(r.key).decode()): (set(r.bands), r.marks) for r in signed.collect()}
    found = 0
    for i in range(len(pairs)):
        (bands, marks), (others, more) = held[2 * i], held[2 * i + 1]
        found += bool(bands & others) and sum(x == y for x, y in zip(marks, more)) >= line_dedup.AGREEING
    assert found >= 0.95 * len(pairs)


def test_only_rows_that_pass_the_sieve_are_shuffled(spark, monkeypatch):
    """A semi or anti join over the sieve's join would be moved in front of it, and every row shuffled."""
    seen = {}

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    def entries(reps, made=ngram_join._entries):
        seen["reps"] = plan(reps)
        return made(reps)

    def materialise(df, name="stage", made=line_dedup.materialise):
        seen.setdefault(name, plan(df))
        return made(df, name)

    monkeypatch.setattr(ngram_join, "_entries", entries)
    monkeypatch.setattr(line_dedup, "materialise", materialise)
    base = [f"{' '.join(random.Random(i).choices(WORDS, k=40))} {i}" for i in range(6)]
    rows = spark.createDataFrame([(i, base[i % 6]) for i in range(8)], "doc_id long, text string")
    kept = ngram_join.keep_one(rows)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(6))
    assert line_dedup.clean_documents(rows).count() == 6
    for text in (seen["reps"], seen["texts"], plan(kept)):
        assert "sieve_bits" in text and not re.search("Left(Semi|Anti)", text)


def test_all_pairs_of_a_small_group_are_tested_at_once(spark, monkeypatch):
    """Lines that share a band but are not alike took a round of heads for every doubling of the heads."""
    names = []

    def one_group(lines):
        marks = F.array(*[F.lit(0).cast("tinyint")] * (line_dedup.BANDS * line_dedup.ROWS))
        keys = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        return keys.select("key", "n", F.array(F.lit(1)).cast("array<bigint>").alias("bands"), marks.alias("marks"))

    def materialise(df, name="stage", made=line_dedup.materialise):
        names.append(name)
        return made(df, name)

    monkeypatch.setattr(line_dedup, "_signatures", one_group)
    monkeypatch.setattr(line_dedup, "materialise", materialise)
    rng = random.Random(21)
    lines = ["".join(rng.choice("abcdefghij ") for _ in range(rng.choice([3, 60, 150]))) for _ in range(18)]
    lines += [lines[2] + "x" * 5, lines[3][:-2], "\U0001f600" * 40, "\U0001f600" * 44 + "b"]
    docs = list(enumerate(lines))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [r.text for r in line_dedup.dedup_lines(rows).orderBy("doc_id").collect()]
    assert got == brute_lines(docs)
    assert names.count("tested") == 1 and "led" not in names


def test_lines_are_hashed_without_a_shuffle_of_their_texts(spark):
    lines = line_dedup._lines(spark.createDataFrame([(1, "a\nb\na"), (2, " a ")], "doc_id long, text string"), "doc_id", "text")
    signed = line_dedup._signatures(lines)
    assert "SortAggregate" not in signed._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n for r in signed.collect()) == [1, 3]


def test_lines_of_a_large_group_that_cannot_be_alike_are_not_compared_exactly(spark, monkeypatch):
    """All pairs of a group that agree in enough hashes were compared by their texts, their number growing as its square."""
    tested = []

    def one_group(lines):
        marks = F.array(*[F.lit(0).cast("tinyint")] * (line_dedup.BANDS * line_dedup.ROWS))
        keys = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        return keys.select("key", "n", F.array(F.lit(1)).cast("array<bigint>").alias("bands"), marks.alias("marks"))

    def materialise(df, name="stage", made=line_dedup.materialise):
        made = made(df, name)
        if name == "tested":
            tested.append(made.count())
        return made

    monkeypatch.setattr(line_dedup, "_signatures", one_group)
    monkeypatch.setattr(line_dedup, "materialise", materialise)
    rng = random.Random(31)
    base = "".join(rng.choice("abcdefghij ") for _ in range(300))
    lines = []
    for i in range(45):  # two of them share about half of their shingles
        own = list(base)
        for at in rng.sample(range(300), 6):
            own[at] = "XYZ"[i % 3]
        lines.append("".join(own))
    lines += [lines[7] + "x" * 5, lines[9][:-4], "\U0001f600" * 40, "\U0001f600" * 44 + "b"]
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = [r.text for r in line_dedup.dedup_lines(rows).orderBy("doc_id").collect()]
    assert got == brute_lines(list(enumerate(lines)))
    assert sum(tested) <= 0.1 * len(lines) * (len(lines) - 1) / 2


def test_bitmaps_keep_every_pair_that_is_alike(spark):
    rng = random.Random(14)
    lines = []
    for n in [1, 4, 12, 30, 120, 400, 3000, 9000]:
        line = "".join(rng.choice("abcde é") for _ in range(n)) + "."
        for _ in range(4):
            lines.append(line)
            line = line[: len(line) // 2] + rng.choice("QRS") + line[len(line) // 2 + rng.choice([0, 1]) :] + "w" * rng.randrange(n // 20 + 1)
    sets = [line_shingles(line) for line in lines]
    rows = spark.createDataFrame(list(enumerate(lines)), "at long, line string")
    texts = line_dedup._texts(rows.select(F.col("at").cast("string").cast("binary").alias("key"), "line"))
    assert {int(bytes(r.key)): r.shingles for r in texts.collect()} == {i: len(s) for i, s in enumerate(sets)}
    drawn = line_dedup._sketches(texts)
    pairs = drawn.toDF("a", "na", "sa").crossJoin(drawn.toDF("b", "nb", "sb")).where("a < b")
    near = {frozenset((int(bytes(r.a)), int(bytes(r.b)))) for r in pairs.where(line_dedup._near("na", "nb", "sa", "sb", 80)).select("a", "b").collect()}
    alike = {frozenset((i, j)) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert alike and alike <= near and len(near) < 0.5 * len(sets) * (len(sets) - 1) / 2


def test_packed_marks_agree_as_often_as_the_marks(spark):
    rng = random.Random(15)
    count = line_dedup.BANDS * line_dedup.ROWS
    rows = []
    for _ in range(200):
        one = [rng.choice([0, 1, 64, 126, 127, rng.randrange(128)]) for _ in range(count)]
        rows.append((one, [m if rng.random() < 0.5 else rng.choice([0, 1, 127, rng.randrange(128)]) for m in one]))
    df = spark.createDataFrame(rows, "a array<tinyint>, b array<tinyint>")
    for k in "ab":
        df = df.withColumns({f"{k}_{p}": word for p, word in zip(line_dedup.PACKED, line_dedup._packed(k))})
    got = df.select("a", "b", line_dedup._agreeing("a_", "b_").alias("n")).collect()
    assert len(got) == 200 and all(r.n == sum(x == y for x, y in zip(r.a, r.b)) for r in got)


def test_components_grow_as_if_made_anew(spark):
    rng = random.Random(16)
    first = [(rng.randrange(200), rng.randrange(200)) for _ in range(70)]
    first = [(a, b) for a, b in first if a != b]
    for more in ([(a, b) for a, b in ((rng.randrange(260), rng.randrange(260)) for _ in range(50)) if a != b], first[:5], [(300, 301)], []):
        known = components(spark.createDataFrame(first, "a long, b long"))
        links = spark.createDataFrame(more, "a long, b long")
        expected = union_find(310, first + more)
        touched = {x for link in first + more for x in link}
        assert dict(map(tuple, line_dedup._merged(known, links).collect())) == {i: expected[i] for i in touched}
