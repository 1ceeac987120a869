"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

Lines are compared in lower case, without blanks at their ends. Their features are all runs of ``SHINGLE``
characters (UTF-16 units; a shorter line is one run). Two lines are alike if the Jaccard similarity of these
sets is at least ``PERCENT`` / 100.

1. Equal lines collapse to one row with a count, by their digest.
2. Every line is blown up into its shingles' 64-bit hashes; for each of ``BANDS * ROWS`` fixed random
   words, the hash nearest to that word (smallest exclusive-or) is kept. Two lines keep the same hash with a
   probability equal to their similarity, as with random permutations. ``ROWS`` of them make a band.
3. Lines sharing a band are candidates. If at least ``AGREEING`` of all kept hashes agree, the two are compared by
   exact Jaccard on the full shingle sets. In a band group of ``SMALL`` lines at most, all pairs are candidates.
   In a larger one, a bitmap of all shingles of each line comes first: two of them differ in no more bits than the sets
   in shingles, so pairs whose bitmaps differ in too many can't be alike and are left out.
4. In a larger group, every line is held against one head: the line with the most partners over all its
   bands. While some lines are like no head yet, ``FASTER`` times as many of them as before head the next round (or
   more, to ``FASTER ** 2``, where lines met few heads they may be like), against all lines of the group, until every line is like a head or has been one. So a group of lines
   that are alike, or like one of them, takes one pair per line; only lines that are like none of the
   others are held against each other.
5. Verified pairs are edges; components come from a distributed union-find. Two lines of a larger group that are
   each like another head may still bridge two components: as long as lines of a group that have not been heads
   lie in several components, those outside its largest one head further rounds. In the end any two lines
   of a group have been tested, are ruled out by step 3 or are in one component.
6. Of each component, the first line in the order of (document id, line number) stays and the others go.

At a similarity of 0.8 a pair shares a band with a probability of 98.6 %, at 0.9 of 99.96 %; it then has fewer
than ``AGREEING`` hashes in common with one of 0.4 % and 0.0004 %.

Edge cases: a null text stays null; lines without a character other than blanks are never removed or
compared; a document whose lines all go gets an empty text (``clean_documents`` drops it); a text that was
empty stays. Documents are told apart by id and text, so repeated ids are safe; rows that repeat both id and
text are one document to this operator and come out alike. Null ids sort first. An empty table gives an empty
result. Further columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .components import components
from .sieve import fresh, holds, may_hold, may_not_hold, sieve

SHINGLE = 10
PERCENT = 80
BANDS = 6
ROWS = 3
AGREEING = 10  # of BANDS * ROWS
STRIDE = 16  # shingles hashed per exploded row
SMALL = 32  # lines of a band group that are all held against each other
FASTER = 4
SPARE = 8  # comparisons per line that a round of heads may take, as far as the one before tells
SKETCH = 64  # 64-bit words of the bitmap of a line's shingles
LANES = 7  # marks of a packed word, a byte each
PACKED = [f"p{i}" for i in range(-(-BANDS * ROWS // LANES))]
BRIDGING = 16  # lines of a group that first look for bridges; four times as many in each further round


def _probes(count: int) -> list[int]:
    """Fixed random 64-bit words."""
    state, made = 0x2545F4914F6CDD1D, []
    for _ in range(count):
        state ^= (state << 13) & 0xFFFFFFFFFFFFFFFF
        state ^= state >> 7
        state ^= (state << 17) & 0xFFFFFFFFFFFFFFFF
        made.append(state - (1 << 64) if state >> 63 else state)
    return made


def _normal(line: Column) -> Column:
    blanks = " \t\r\x0b\x0c"
    # Few lines have blanks at their ends, and looking there is far cheaper than trimming.
    ends = [end(line, F.lit(b)) for b in blanks for end in (F.startswith, F.endswith)]
    return F.lower(F.when(reduce(Column.__or__, ends), F.btrim(line, F.lit(blanks))).otherwise(line))


def _lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, sha, at, key, line): every line that has a character, with its number and the digest of its normal form."""
    sha = F.xxhash64(F.col(text))
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(doc).alias("doc"), sha.alias("sha"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line")
    )
    rows = rows.select("doc", "sha", "at", _normal(F.col("line")).alias("line")).where(F.col("line") != "")
    return rows.select("doc", "sha", "at", F.unhex(F.md5(F.col("line").cast("binary"))).alias("key"), "line")


def _shingle_count(units: Column) -> Column:
    return F.greatest(F.lit(1), (F.octet_length(units) / 2).cast("int") - SHINGLE + 1)


def _hashed(lines: DataFrame) -> DataFrame:
    """(key, first, h0, h1, ...): hashes of ``STRIDE`` shingles a row; the last row of a line repeats its last one."""
    def shingle(at: Column) -> Column:
        return F.xxhash64(F.substring(F.col("units"), 2 * at + 1, F.lit(2 * SHINGLE)))

    spread = lines.select("key", "units", (_shingle_count(F.col("units")) - 1).alias("last"))
    spread = spread.select("key", "units", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STRIDE))).alias("i"))
    hashes = [shingle(F.least(F.col("i") + j, F.col("last"))).alias(f"h{j}") for j in range(STRIDE)]
    return spread.select("key", (F.col("i") == 0).alias("first"), *hashes)


def _signatures(lines: DataFrame) -> DataFrame:
    """(key, n, bands, marks): copies, band hashes and the last bits of the kept hashes of every different line."""
    # Copies keep the same hashes, so they meet after hashing: texts are neither sorted nor shuffled.
    hashed = _hashed(lines.select("key", F.encode("line", "UTF-16BE").alias("units")))
    nearest = [
        F.min(F.least(*(F.col(f"h{j}").bitwiseXOR(F.lit(p)) for j in range(STRIDE)))).alias(f"m{i}")
        for i, p in enumerate(_probes(BANDS * ROWS))
    ]
    signed = hashed.groupBy("key").agg(F.sum(F.col("first").cast("long")).alias("n"), *nearest)
    bands = [F.xxhash64(F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS)]
    marks = F.array(*(F.col(f"m{i}").bitwiseAND(F.lit(127)).cast("tinyint") for i in range(BANDS * ROWS)))
    return signed.select("key", "n", F.array(*bands).alias("bands"), marks.alias("marks"))


def _shingle_hashes(units: str) -> Column:
    """Hashes of all shingles of a column of UTF-16 units, with repeats."""
    # A column is copied whole each time a lambda reads it, a lambda's own variable is not: hence the array of one.
    def hashes(u: Column) -> Column:
        at = F.sequence(F.lit(1), 2 * _shingle_count(u) - 1, F.lit(2))
        return F.transform(at, lambda i: F.xxhash64(F.substring(u, i, F.lit(2 * SHINGLE))))

    return F.get(F.transform(F.array(units), hashes), F.lit(0))


def _texts(lines: DataFrame) -> DataFrame:
    """(key, units, shingles): UTF-16 units and number of different shingles of every different line."""
    texts = lines.dropDuplicates(["key"]).select("key", F.encode("line", "UTF-16BE").alias("units"))
    return texts.withColumn("shingles", F.size(F.array_distinct(_shingle_hashes("units"))))


def _sketches(texts: DataFrame) -> DataFrame:
    """(key, shingles, sketch): number of different shingles, and a bitmap of the hashes of all, of every line of ``texts``."""
    places = [F.expr(f"cast(shiftrightunsigned(h{j}, 6) & {SKETCH - 1}L as int) as w{j}") for j in range(STRIDE)]
    bits = [F.expr(f"shiftleft(1L, cast(h{j} & 63L as int)) as b{j}") for j in range(STRIDE)]
    words = [F.expr(f"bit_or({' | '.join(f'if(w{j} = {w}, b{j}, 0L)' for j in range(STRIDE))}) as s{w}") for w in range(SKETCH)]
    drawn = _hashed(texts).select("key", *places, *bits).groupBy("key").agg(*words)
    drawn = drawn.select("key", F.array(*(f"s{w}" for w in range(SKETCH))).alias("sketch"))
    return texts.select("key", "shingles").join(drawn, "key")


def _near(na: str, nb: str, sa: str, sb: str, percent: int) -> Column:
    """False only for lines that can't be alike, by the sizes and bitmaps of their sets."""
    # A bit that only one of them has stands for a shingle, at least, that the other hasn't.
    apart = F.expr(" + ".join(f"bit_count(get({sa}, {w}) ^ get({sb}, {w}))" for w in range(SKETCH)))
    return _near_sizes(na, nb, percent) & ((100 + percent) * apart <= (100 - percent) * (F.col(na) + F.col(nb)))


def _near_sizes(na: str, nb: str, percent: int) -> Column:
    """False only for sets of too different sizes to be alike, whatever they share."""
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``alike``, by exact Jaccard of full shingle sets."""
    left = texts.select(F.col("key").alias("a"), F.col("units").alias("ua"), F.col("shingles").alias("na"))
    right = texts.select(F.col("key").alias("b"), F.col("units").alias("ub"), F.col("shingles").alias("nb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect(_shingle_hashes("ua"), _shingle_hashes("ub")))
    alike = (100 + percent) * shared >= percent * (F.col("na") + F.col("nb"))
    return both.select("a", "b", F.when(_near_sizes("na", "nb", percent), alike).otherwise(F.lit(False)).alias("alike"))


def _packed(marks: str) -> list[Column]:
    """The marks as words of ``LANES`` bytes; places behind the last mark are the same in all lines."""
    def word(first: int) -> Column:
        places = range(first, min(first + LANES, BANDS * ROWS))
        return reduce(Column.bitwiseOR, (F.shiftleft(F.get(marks, F.lit(i)).cast("long"), 8 * (i - first)) for i in places))

    return [word(first).alias(f"p{first // LANES}") for first in range(0, BANDS * ROWS, LANES)]


def _agreeing(x: str, y: str) -> Column:
    """How many of the kept hashes of two lines agree, as far as their last bits tell; ``x`` and ``y`` are prefixes of the packed marks."""
    low, high = (sum(b << 8 * lane for lane in range(LANES)) for b in (0x7F, 0x80))
    # A byte of 7 bits, not zero, reaches its eighth bit when 127 is added.
    differ = [
        F.bit_count((F.col(f"{x}p{i}").bitwiseXOR(F.col(f"{y}p{i}")) + F.lit(low)).bitwiseAND(F.lit(high)))
        for i in range(len(PACKED))
    ]
    return F.lit(BANDS * ROWS) - reduce(Column.__add__, differ)


def _tested(led: DataFrame, done: DataFrame | None, texts: DataFrame, percent: int) -> DataFrame:
    """The verified pairs of ``led`` that are not in ``done`` yet."""
    pairs = led.select("a", "b").distinct()
    if done is not None:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    pairs = materialise(pairs, "pairs")
    # Only texts of these pairs are shuffled.
    texts = may_hold(texts, sieve(pairs.select(F.explode(F.array("a", "b")).alias("key")), "key"), "key")
    return materialise(_verified(pairs, texts, percent), "tested")


def _led(members: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """(band, key, a, b): lines and heads of one group that may be alike; those of one family are connected already."""
    led = members.join(heads, "band").where(F.col("family") != F.col("head_family"))
    led = led.where((_agreeing("", "head_") >= AGREEING) & _near("shingles", "head_shingles", "sketch", "head_sketch", percent))
    return led.select("band", "key", F.least("head_key", "key").alias("a"), F.greatest("head_key", "key").alias("b"))


def _heads(rows: DataFrame, order: list, count: int) -> DataFrame:
    """The first ``count`` of ``rows`` in each group."""
    rank = F.row_number().over(Window.partitionBy("band").orderBy(*order))
    heads = rows.withColumn("rank", rank).where(F.col("rank") <= count)
    names = ("key", *PACKED, "family", "shingles", "sketch")
    return materialise(heads.select("band", *(F.col(c).alias(f"head_{c}") for c in names)), "heads")


def _with_families(members: DataFrame, known: DataFrame) -> DataFrame:
    families = known.withColumnRenamed("node", "key").withColumnRenamed("component", "family")
    named = members.drop("family").join(families, "key", "left")
    return named.withColumn("family", F.coalesce("family", "key")).select(*members.columns)


def _pairs(members: DataFrame) -> DataFrame:
    """(a, b): all lines of one group that agree in enough hashes."""
    left, right = (members.select("band", F.col("key").alias(k), *(F.col(p).alias(f"{k}_{p}") for p in PACKED)) for k in "ab")
    return left.join(right, "band").where(F.col("a") < F.col("b")).where(_agreeing("a_", "b_") >= AGREEING).select("a", "b")


def _members(signatures: DataFrame) -> DataFrame:
    """(band, key, p0, p1, ..., size): lines of groups of two and more, with their packed marks."""
    banded = signatures.select("key", *_packed("marks"), F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialise(shared, "bands")
    return materialise(may_hold(banded, sieve(shared, "band"), "band").join(shared, "band"), "members")


def _faster(led: DataFrame, members: DataFrame) -> int:
    """How many times the heads of this round lead the next: more where they met few lines that may be like them."""
    return max(FASTER, min(FASTER**2, SPARE * members.count() // max(1, led.count())))


def _merged(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): ``known`` after further ``links`` (a, b)."""
    family = known.withColumnRenamed("component", "family")
    named = links.join(family.withColumnsRenamed({"node": "a", "family": "fa"}), "a", "left")
    named = named.join(family.withColumnsRenamed({"node": "b", "family": "fb"}), "b", "left")
    named = named.select(F.coalesce("fa", "a").alias("a"), F.coalesce("fb", "b").alias("b")).where("a <> b").distinct()
    named = materialise(named, "links")
    if named.isEmpty():
        return known
    # Only the components that the links join are gone through again, each as one node: its smallest.
    grown = materialise(components(named), "grown").select(F.col("node").alias("family"), F.col("component").alias("larger"))
    moved = family.join(grown, "family", "left").select("node", F.coalesce("larger", "family").alias("component"))
    others = grown.join(known, grown["family"] == known["node"], "left_anti")
    return materialise(moved.union(others.select(F.col("family").alias("node"), F.col("larger").alias("component"))), "known")


def _families(members: DataFrame, degrees: DataFrame, small: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the different lines that are like another one; ``members`` are those of larger groups."""
    alike = materialise(_verified(small, texts, percent), "tested").where("alike").select("a", "b")
    # All lines of such a group may meet: bitmaps spare most of those that are not alike the exact comparison.
    sketches = _sketches(may_hold(texts, sieve(degrees, "key"), "key"))
    # Lines with the most partners lead: what many lines are copies of is met by all of them at once.
    members = members.join(degrees, "key").join(sketches, "key").withColumns({"open": F.lit(True), "family": F.col("key")})
    members = every = materialise(members, "members")
    if members.isEmpty():
        return components(alike)
    order = [F.desc("degree"), "key"]
    heads_at_once, been, known, done, later = 1, None, None, None, None
    while True:
        heads = _heads(members.where("open"), order, heads_at_once)
        named = heads.select("band", F.col("head_key").alias("key"))
        been = named if been is None else been.union(named)
        led = materialise(_led(members, heads, percent), "led")
        tested = _tested(led, done, texts, percent)
        done = tested if done is None else done.union(tested)
        found = led.join(done.where("alike").select("a", "b"), ["a", "b"]).select("band", "key")
        same = heads.select("band", F.col("head_family").alias("family")).distinct()
        found = found.union(members.where("open").join(same, ["band", "family"], "left_semi").select("band", "key"))
        settled = found.union(named).distinct().withColumn("settled", F.lit(True))
        # Groups that no line is open in have no head any more.
        now = members.join(named.select("band").distinct(), "band", "left_semi").join(settled, ["band", "key"], "left").withColumn("open", F.col("open") & F.col("settled").isNull()).drop("settled")
        tested = tested.where("alike").select("a", "b")
        if known is None:  # most families are known after the first round
            known = materialise(components(alike.union(tested)), "known")
            now = _with_families(now, known)
        else:
            later = tested if later is None else later.union(tested)
        now = materialise(now.select(*members.columns), "members")
        heads_at_once *= _faster(led, members)
        members = now
        if now.where("open").isEmpty():
            break
    known = known if later is None else _merged(known, later)
    return _bridged(every.join(been, ["band", "key"], "left_anti"), known, done, texts, percent, order)


def _bridged(members: DataFrame, known: DataFrame, done: DataFrame, texts: DataFrame, percent: int, order: list) -> DataFrame:
    """(node, component) after lines that have not been heads met those of other components in their groups."""
    heads_at_once = BRIDGING
    while True:
        named = _with_families(members, known)
        parts = named.groupBy("band", "family").agg(F.count(F.lit(1)).alias("n"))
        apart = parts.groupBy("band").agg(
            F.max_by("family", F.struct("n", "family")).alias("largest"), F.count(F.lit(1)).alias("parts")
        )
        members = materialise(named.join(apart.where("parts > 1").drop("parts"), "band"), "members")
        if members.isEmpty():
            return known
        # Lines of the largest family need not lead: all others meet them.
        heads = _heads(members.where("family <> largest"), order, heads_at_once)
        led = materialise(_led(members, heads, percent), "led")
        tested = _tested(led, done, texts, percent)
        known, done = _merged(known, tested.where("alike").select("a", "b")), done.union(tested)
        heads_at_once *= _faster(led, members)
        been = heads.select("band", F.col("head_key").alias("key"))
        members = members.join(been, ["band", "key"], "left_anti").drop("largest")


def removed_lines(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc, sha, gone): for each document that loses lines, their numbers from 0."""
    lines = _lines(docs, doc, text)
    signatures = materialise(_signatures(lines), "signatures")
    members = _members(signatures)
    small = materialise(_pairs(members.where(F.col("size") <= SMALL)).distinct(), "small")
    degrees = members.groupBy("key").agg(F.sum("size").alias("degree"), F.max("size").alias("largest"))
    degrees = materialise(degrees.where(F.col("largest") > SMALL).select("key", "degree"), "degrees")
    met = small.select(F.explode(F.array("a", "b")).alias("key")).union(degrees.select("key"))
    copies = signatures.where("n > 1").select("key")
    # Lines that may be compared or repeat are cut once more, the former with their texts; only these are shuffled from
    # here on. Spark would move a semi join in front of the sieve, and so shuffle every line.
    rows = may_hold(lines, sieve(copies.union(met), "key"), "key")
    rows = holds(rows, sieve(met, "key"), "met", "key").withColumn("line", F.when(F.col("met"), F.col("line"))).drop("met")
    rows = materialise(rows, "texts")
    texts = materialise(_texts(rows.where(F.col("line").isNotNull()).select("key", "line")), "units")
    joined = _families(members.where(F.col("size") > SMALL), degrees, small, texts, percent)
    affected = joined.select(F.col("node").alias("key"), "component").union(
        copies.join(joined, copies["key"] == joined["node"], "left_anti").select("key", F.col("key").alias("component"))
    )
    affected = materialise(affected, "affected")
    found = materialise(rows.join(affected, "key").select("component", "doc", "sha", "at"), "occurrences")
    first = found.groupBy("component").agg(F.min(F.struct("doc", "at", "sha")).alias("first"))
    kept = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("at") == F.col("first.at")) & (F.col("sha") == F.col("first.sha"))
    gone = found.join(first, "component").where(~kept)
    return gone.groupBy("doc", "sha").agg(F.collect_set("at").alias("gone"))


def dedup_lines(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", percent: int = PERCENT, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """``docs`` with the lines that repeat another line, or nearly so, taken out of ``text``; two counts are added.

    Only documents that may lose a line are shuffled. Columns that are named like the counts already raise.
    """
    n_lines, n_removed = counts
    clash = [c for c in counts if c in docs.columns]
    if clash:
        raise ValueError(f"the documents have columns {clash} already")
    gone = materialise(removed_lines(docs, doc=doc, text=text, percent=percent), "gone")
    held = sieve(gone, "doc", "sha")
    split = F.split(F.col(text), "\n", -1)
    count = F.coalesce(F.size(split), F.lit(0)).cast("long")
    count = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(count)
    key = (F.col(doc), F.xxhash64(F.col(text)))
    whole = may_not_hold(docs, held, *key).withColumns({n_lines: count, n_removed: F.lit(0).cast("long")})
    some = may_hold(docs, held, *key).alias("d").join(
        gone.alias("g"), F.col(f"d.{doc}").eqNullSafe(F.col("g.doc")) & (F.xxhash64(F.col(f"d.{text}")) == F.col("g.sha")), "left"
    )
    split = F.split(F.col(f"d.{text}"), "\n", -1)
    left = F.array_join(F.filter(split, lambda line, i: ~F.array_contains("g.gone", i)), "\n")
    count = F.when(F.col(f"d.{text}").isNull(), F.lit(0)).otherwise(F.size(split)).cast("long")
    texts = F.when(F.col("g.gone").isNull(), F.col(f"d.{text}")).otherwise(left)
    columns = [texts.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns]
    cut = some.select(*columns, count.alias(n_lines), F.coalesce(F.size("g.gone"), F.lit(0)).cast("long").alias(n_removed))
    return whole.union(cut)


def clean_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without repeated lines; documents of which no line with a character is left go, those that had none stay."""
    text = options.get("text", "text")
    counts = tuple(fresh(docs.columns, "n_lines", "n_removed"))
    cut = dedup_lines(docs, counts=counts, **options)
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\r\n\x0b\x0c")) == ""
    return cut.where((F.col(counts[1]) == 0) | ~bare).select(*docs.columns)
