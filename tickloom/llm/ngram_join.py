"""N-gram Jaccard join by signature trees.

A text's set holds the hashes of its distinct shingles of ``WIDTH`` words. Two texts link if 100 * shared >=
``PERCENT`` * united. The result is exact (up to collisions of 64-bit hashes): every pair that passes is
connected.

Where trees stand: texts with equal sets are one class. All sets are ordered alike, shingles that very many
texts hold last, others by a table of counts, rare ones first, and by their hash; two sets that link must share one of their first
n - ceil(PERCENT * n / 100) + 1 shingles. So classes meet in groups, one per such shingle; shingles with the same
members are one group. Over the members of a group stands a signature tree: members sorted by set size, leaves of
a few of them, nodes holding the OR of their members' bitmaps, their range of sizes and the most shingles any
member has beyond its set bits.

Dual traversal: a pair of nodes is dropped if no sizes in it can reach the threshold, or if the set bits they
share, and the excess, allow too small an overlap. At the leaves pairs are tested by their own bitmaps and by the
shingle's places in the order. Groups are traversed twice:

1. on bitmaps alone, to find the members that have any partner; node pairs whose members all have one are dropped;
2. with the texts of those members, pairs being counted exactly on the full sets. For that, groups that have
   members in common are taken together, so that each text is read once. A link joins its components
   at once and node pairs within one component are dropped. The member with the most shared shingles meets all
   others first, so a group of copies of it is one component after a test each.

Either pass gives at most a row per member of a group, never its pairs.

At scale: the order's last shingles (``HOT`` texts or more, at most ``HOT_MOST`` of them, 8 bytes each), the table of
counts and the sieves, both of fixed size, are the only things broadcast. Groups of more than ``GROUP`` rows or ``TOKENS`` shingles are cut
into blocks, and blocks meet in pairs of tasks. Counts are combined before shuffles. Tables whose size depends on
the data are joined by shuffles.

Edge cases: a null text and one without words have an empty set, link with nothing and are their own component;
fewer words than ``WIDTH`` are one shingle; null and repeated ids are rows of their own (a component is named by
its smallest id that is not null); equal sets link; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .components import components
from .sieve import fresh, may_hold, may_not_hold, sieve
from .text import Words, buffers, encoded, let_go, mix, windows

WIDTH = 4
PERCENT = 85
HOT = 64
HOT_MOST = 200_000
COUNTED = 1 << 22  # shingles counted together before the frequent ones are reported
TABLE, PARTS = 1 << 21, 64  # counters that order the others by how rare they are
LEAST_BITS, MOST_BITS = 256, 1 << 16
GROUP = 4000
TOKENS = 1 << 21
LEAF = 6


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in buffers(texts):
        words = Words(texts[a:b])
        hashes = words.hashes()
        runs = windows(hashes, width)
        first = words.first
        for i in range(b - a):
            start, end = first[i], first[i + 1]
            if end - start >= width:
                yield np.unique(mix(runs[start : end - width + 1] + np.uint64(width)))
            elif end > start:
                yield mix(windows(hashes[start:end], end - start) + np.uint64(end - start))
            else:
                yield np.zeros(0, np.uint64)


def ordered(tokens: np.ndarray, hot: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """Sorted hashes with the rare ones, as far as ``counts`` tell, before the others and the hot ones last."""
    late = np.zeros(len(tokens), bool)
    if len(hot) and len(tokens):
        at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
        late = hot[at] == tokens
    first = tokens[~late]
    if counts is not None:
        first = first[np.argsort(counts[first & np.uint64(len(counts) - 1)], kind="stable")]
    return np.concatenate([first, tokens[late]])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + 1 - -(-percent * n // 100) if n else 0


def bitmap(tokens: np.ndarray, each: int = 2, most: int = MOST_BITS) -> bytes:
    """One bit per hash, modulo a power of two of at least ``each`` times their number, within bounds."""
    size = min(most, max(LEAST_BITS, 1 << (each * max(1, len(tokens)) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _counts(docs: DataFrame, text: str, width: int, least: int) -> DataFrame:
    """(token, n) of shingles in ``least`` texts or more of every stretch, and (part, counts) of the stretch's table of counts.

    Every task counts the shingles of some millions at a time. A table has ``TABLE`` counters of a byte, each shared by the shingles
    of equal last bits; it is cut into parts, so that tables are summed part by part.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held, size = [], 0

        def report():
            every = np.concatenate(held)
            found, n = np.unique(every, return_counts=True)
            often = n >= least
            table = np.minimum(np.bincount((every & np.uint64(TABLE - 1)).astype(np.int64), minlength=TABLE), 255).astype(np.uint8)
            parts = [p.tobytes() for p in np.split(table, PARTS)]
            some = int(often.sum())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(found[often].view(np.int64)), pa.nulls(PARTS, pa.int64())]),
                pa.concat_arrays([pa.array(n[often], pa.int64()), pa.nulls(PARTS, pa.int64())]),
                pa.concat_arrays([pa.nulls(some, pa.int32()), pa.array(range(PARTS), pa.int32())]),
                pa.concat_arrays([pa.nulls(some, pa.binary()), pa.array(parts, pa.binary())]),
            ], names=["token", "n", "part", "counts"])

        for batch in batches:
            for tokens in shingle_sets(encoded(batch.column("t").to_pylist(), lower=True), width):
                held.append(tokens)
                size += len(tokens)
                if size >= COUNTED:
                    yield from report()
                    held, size = [], 0
        if size:
            yield from report()

    found = docs.select(F.col(text).alias("t")).mapInArrow(count, "token long, n long, part int, counts binary")
    return materialise(found, "counts")


def _hot(counts: DataFrame) -> np.ndarray:
    found = counts.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT)
    rows = found.orderBy(F.desc("n"), "token").limit(HOT_MOST).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(np.int64).view(np.uint64))


def _table(counts: DataFrame) -> np.ndarray:
    """The sum of all tables of counts: of a fixed size, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("counts")):
                table = np.frombuffer(data.as_buffer(), np.uint8).astype(np.uint32)
                sums[part] = sums[part] + table if part in sums else table
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([t.tobytes() for t in sums.values()], pa.binary())], names=["part", "counts"]
            )

    dealt = counts.where("part is not null").select("part", "counts").repartition("part")
    made = np.zeros((PARTS, TABLE // PARTS), np.uint32)
    for row in dealt.mapInArrow(add, "part int, counts binary").collect():
        made[row.part] = np.frombuffer(row.counts, np.uint32)
    return made.ravel()


def frequent(docs: DataFrame, text: str, width: int, least: int = 5) -> np.ndarray:
    """Sorted hashes of the most frequent shingles: at most HOT_MOST, each in HOT texts or more.

    The reports of all stretches are summed. A shingle rare in every stretch may be missed, which costs time only: any set of
    shingles may go last, as long as it is the same for all texts.
    """
    return _hot(_counts(docs, text, width, least))


def signatures(docs: DataFrame, doc: str, text: str, width: int, percent: int) -> DataFrame:
    """(row, doc, sha, n, digest, prefix, bits) of every row, written to the shared folder."""
    counts = _counts(docs, text, width, least=5)
    shared = docs.sparkSession.sparkContext.broadcast((_hot(counts), _table(counts)))
    source = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("sha"))
    kind = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, digests, prefixes, bits = [], [], [], []
                for tokens in shingle_sets(encoded(part.column("t").to_pylist(), lower=True), width):
                    sizes.append(len(tokens))
                    digests.append(digest(tokens))
                    prefixes.append(ordered(tokens, *shared.value)[: prefix_length(len(tokens), percent)].view(np.int64))
                    bits.append(bitmap(tokens))
                made = [
                    part.column("doc"), part.column("sha"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(made, names=["doc", "sha", "n", "digest", "prefix", "bits"])

    rows = source.mapInArrow(
        run, f"doc {kind}, sha long, n long, digest binary, prefix array<long>, bits binary"
    )
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "signatures")


def _folded(bits: int, size: int, to: int) -> int:
    while size > to:
        size //= 2
        bits = (bits | bits >> size) & ((1 << size) - 1)
    return bits


class _Node:
    __slots__ = ("low", "high", "bits", "size", "excess", "same", "children", "members")

    def __init__(self, members=None, children=None):
        self.members, self.children, self.same = members, children, None
        parts = members or children
        self.low, self.high = min(p.low for p in parts), max(p.high for p in parts)
        self.size = min(p.size for p in parts)
        self.bits = 0
        for p in parts:
            self.bits |= _folded(p.bits, p.size, self.size)
        # Folding a bitmap may raise its excess; without equal widths the bits bound nothing here.
        self.excess = max(p.excess for p in parts) if all(p.size == self.size for p in parts) else self.high


class _Member:
    __slots__ = ("id", "low", "place", "bits", "size", "excess", "side", "partner", "tokens", "degree")

    def __init__(self, id, n, place, bits: bytes, side=0, degree=0, tokens=None):
        self.id, self.low, self.place, self.side, self.degree, self.tokens = id, n, place, side, degree, tokens
        self.bits, self.size = int.from_bytes(bits, "little"), 8 * len(bits)
        self.excess = n - self.bits.bit_count()
        self.partner = False

    @property
    def high(self):
        return self.low


class SignatureTree:
    """Members of a group. With ``sides``, members of the same side don't pair."""

    def __init__(self, members: list[_Member], percent: int = PERCENT, sides: bool = False, leaf: int = LEAF):
        self.percent, self.sides = percent, sides
        self.members = sorted(members, key=lambda m: (m.low, m.id))
        nodes = [_Node(members=self.members[i : i + leaf]) for i in range(0, len(members), leaf)]
        while len(nodes) > 1:
            nodes = [_Node(children=nodes[i : i + leaf]) for i in range(0, len(nodes), leaf)]
        self.root = nodes[0]

    def _far(self, x, y) -> bool:
        """No member of x can link with one of y, by sizes and bits."""
        p = self.percent
        if 100 * x.high < p * y.low or 100 * y.high < p * x.low:
            return True
        if x.size != y.size:
            return False
        most = (x.bits & y.bits).bit_count() + min(x.excess, y.excess)
        return (100 + p) * most < p * (x.low + y.low)

    def _near(self, a: _Member, b: _Member) -> bool:
        """The bounds allow a pair of members to link."""
        p = self.percent
        if self.sides and a.side == b.side or 100 * a.low < p * b.low or 100 * b.low < p * a.low:
            return False
        need = p * (a.low + b.low)
        if (100 + p) * min(a.low - a.place, b.low - b.place) < need:
            return False
        size = min(a.size, b.size)
        x, y = _folded(a.bits, a.size, size), _folded(b.bits, b.size, size)
        common = x & y
        most = min(a.low - (x ^ common).bit_count(), b.low - (y ^ common).bit_count())
        return (100 + p) * most >= need

    def _traverse(self, test, settled) -> None:
        """Call ``test`` for all pairs of members that no bound on nodes excludes and that are not ``settled``."""

        def within(x):
            if settled(x, x):
                return
            if x.members:
                for i, a in enumerate(x.members):
                    for b in x.members[i + 1 :]:
                        test(a, b)
                return
            for c in x.children:
                within(c)
            for i, c in enumerate(x.children):
                for d in x.children[i + 1 :]:
                    between(c, d)

        def between(x, y):
            if self._far(x, y) or settled(x, y):
                return
            if x.members and y.members:
                for a in x.members:
                    for b in y.members:
                        test(a, b)
            elif x.members:
                for d in y.children:
                    between(x, d)
            else:
                for c in x.children:
                    between(c, y)

        within(self.root)

    def with_partners(self) -> list[int]:
        """Ids of the members that the bounds allow a partner."""

        def all_have(node: _Node) -> bool:
            if not node.same:
                node.same = all(m.partner for m in node.members) if node.members else all(map(all_have, node.children))
            return node.same

        def test(a, b):
            if not (a.partner and b.partner) and self._near(a, b):
                a.partner = b.partner = True

        self._traverse(test, lambda x, y: all_have(x) and all_have(y))
        return [m.id for m in self.members if m.partner]

    def links(self) -> list[tuple[int, int]]:
        """Links that connect all members which links connect, by exact counts on their tokens."""
        parent = {m.id: m.id for m in self.members}
        found: list[tuple[int, int]] = []
        percent = self.percent

        def find(i):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        def same(node: _Node):
            """The component of all members of a node, or None."""
            if node.same is not None:
                return find(node.same)
            parts = [find(m.id) for m in node.members] if node.members else list(map(same, node.children))
            if parts[0] is None or any(p != parts[0] for p in parts):
                return None
            node.same = parts[0]
            return parts[0]

        def test(a, b):
            x, y = find(a.id), find(b.id)
            if x == y or not self._near(a, b):
                return
            few, many = (a.tokens, b.tokens) if len(a.tokens) < len(b.tokens) else (b.tokens, a.tokens)
            at = np.minimum(np.searchsorted(many, few), len(many) - 1)
            shared = int((many[at] == few).sum())
            if 100 * shared >= percent * (len(few) + len(many) - shared):
                parent[max(x, y)] = min(x, y)
                found.append((min(a.id, b.id), max(a.id, b.id)))

        def settled(x, y):
            one = same(x)
            return one is not None and (x is y or one == same(y))

        head = max(self.members, key=lambda m: (m.degree, -m.id))
        for other in self.members:
            if other is not head:
                test(head, other)
        self._traverse(test, settled)
        return found


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []

    def made():
        return pa.Table.from_batches(held).to_pydict()

    last = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns)):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield made()
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield made()


def _blocks(entries: DataFrame) -> DataFrame:
    """Entries of a group (group, row, ..., members, total) dealt to pairs of blocks (x, y) of the group."""
    blocks = F.ceil(F.greatest(F.col("members") / GROUP, F.col("total") / TOKENS)).cast("int")
    own = F.pmod(F.xxhash64("row"), blocks).cast("int")
    cut = entries.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    return cut.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other", "members", "total")


def _sized(entries: DataFrame) -> DataFrame:
    """Entries with the members and the shingles of their group; groups of one are left out."""
    sizes = entries.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total")).where("members > 1")
    return entries.join(sizes.hint("merge"), "group")


def _with_like_sizes(entries: DataFrame, percent: int) -> DataFrame:
    """Sized entries whose row has a set size near that of another row of the group.

    In the order of sizes the nearest others are the neighbours. Groups above ``GROUP`` rows pass as they are.
    """
    order = Window.partitionBy("group").orderBy("n", "row")
    smaller, larger = F.lag("n").over(order), F.lead("n").over(order)
    near = (100 * smaller >= percent * F.col("n")) | (100 * F.col("n") >= percent * larger)
    some = entries.where(F.col("members") <= GROUP).withColumn("near", near).where("near").drop("near")
    return some.union(entries.where(F.col("members") > GROUP))


def _partnered(entries: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The entries (group, row) whose row may have a partner in its group."""
    like = _with_like_sizes(_sized(entries), percent)
    cut = _blocks(like.join(rows.select("row", "bits").hint("merge"), "row"))
    sorted_rows = cut.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: tuple[list[int], list[int]] = ([], [])
        for run in _runs(batches, ["group", "x", "y"]):
            if len(run["row"]) > 1:
                columns = (run[c] for c in ("row", "n", "place", "bits", "own"))
                members = [_Member(*values) for values in zip(*columns)]
                kept = SignatureTree(members, percent, run["x"][0] != run["y"][0]).with_partners()
                names[0].extend(run["group"][:1] * len(kept))
                names[1].extend(kept)
                if len(names[0]) > 50_000:
                    yield _pairs(*names, "group", "row")
                    names = ([], [])
        if names[0]:
            yield _pairs(*names, "group", "row")

    return sorted_rows.mapInArrow(run, "group long, row long").distinct()


def _pairs(a: list[int], b: list[int], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=list(names))


def _families(entries: DataFrame) -> DataFrame:
    """(group, row, n, degree, place): rows that possible partners connect as one group, each row once.

    ``degree`` is the number of groups a row was in; the places of single shingles bound nothing here.
    """
    heads = entries.groupBy("group").agg(F.min("row").alias("head"))
    known = components(entries.join(heads.hint("merge"), "group"), "row", "head")
    rows = entries.groupBy("row").agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("degree"))
    rows = rows.join(known.select(F.col("node").alias("row"), F.col("component").alias("group")).hint("merge"), "row")
    return materialise(rows.withColumn("place", F.lit(0)), "families")


def _links(entries: DataFrame, rows: DataFrame, docs: DataFrame, doc: str, text: str, width: int, percent: int) -> DataFrame:
    """Links (a, b) among the rows of each family, on the full sets of their texts."""
    asked = _sized(_families(entries)).join(rows.select("row", "doc", "sha", "digest").hint("merge"), "row")
    asked = materialise(_blocks(asked), "asked")
    texts = docs.select(F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("of"), F.col(text).alias("t"))
    texts = may_hold(texts, sieve(asked, "doc", "sha"), F.col("id"), F.col("of"))
    # Rows of one id are told apart by their text's hash before they meet.
    met = texts.join(asked.hint("merge"), F.col("doc").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("of"))).drop("id", "doc", "of", "sha")
    met = met.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["group", "x", "y"]):
            sets = shingle_sets(encoded(run["t"], lower=True), width)
            members, seen = [], set()
            for row, n, place, side, degree, known, tokens in zip(*(run[c] for c in ("row", "n", "place", "own", "degree", "digest")), sets):
                # Another text under the same id, or the same text once more.
                if row not in seen and digest(tokens) == known:
                    seen.add(row)
                    # Wide bitmaps cost no shuffle here and leave little to count exactly.
                    members.append(_Member(row, n, place, bitmap(tokens, 16, 1 << 20), side, degree, tokens))
            if len(members) > 1:
                found = SignatureTree(members, percent, run["x"][0] != run["y"][0]).links()
                if found:
                    yield _pairs(*map(list, zip(*found)), "a", "b")

    return met.mapInArrow(run, "a long, b long")


def _entries(reps: DataFrame) -> DataFrame:
    """(group, row, n, place): groups of rows that share a shingle of their first ones, each set of members once."""
    spread = reps.select("row", "n", F.posexplode("prefix").alias("place", "token"))
    shared = spread.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("token")
    shared = materialise(shared, "shared")
    members = may_hold(spread, sieve(shared, "token", expected=shared.count()), "token").join(shared.hint("merge"), "token")
    members = materialise(members, "members")
    # Shingles held by the same rows: two hashes over the rows and their number tell them.
    who = members.groupBy("token").agg(
        F.bit_xor(F.xxhash64("row")).alias("h"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("k"), F.count(F.lit(1)).alias("c")
    )
    first = who.groupBy("h", "k", "c").agg(F.min("token").alias("group"))
    named = materialise(who.join(first.hint("merge"), ["h", "k", "c"]).select("token", "group"), "named")
    return members.join(named.hint("merge"), "token").groupBy("group", "row").agg(F.min("n").alias("n"), F.min("place").alias("place"))


def _representatives(full: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each class; only rows that may be of a class with copies are looked up."""
    held = sieve(classes.where("copies > 1"), "digest")
    first = may_hold(classes, held, "digest").select(F.col("node").alias("row"))
    # Spark would move a semi join in front of the sieve, and so shuffle every row.
    again = may_hold(full, held, "digest").join(first.hint("merge"), "row")
    return may_not_hold(full, held, "digest").union(again.select(*full.columns))


def join(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc, sha, n_shingles, component, group): one row per row of ``docs``.

    ``component`` is the smallest id among the texts reachable by links, ``group`` a number of the same component
    that is null for empty sets only, ``sha`` a hash of the text.
    """
    rows = signatures(docs, doc, text, width, percent)
    full = rows.where("n > 0")
    classes = materialise(full.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc").alias("least"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = _representatives(full, classes)

    entries = materialise(_entries(reps), "entries")
    partnered = materialise(_partnered(entries, reps, percent), "partnered")
    left = materialise(entries.join(partnered.hint("merge"), ["group", "row"], "left_semi"), "left")
    known = materialise(components(_links(left, reps, docs, doc, text, width, percent)), "components")

    named = classes.join(known, classes["node"] == known["node"], "left").select(
        classes["digest"], "least", F.coalesce("component", classes["node"]).alias("group")
    )
    least = named.groupBy("group").agg(F.min("least").alias("component"))
    named = materialise(named.drop("least").join(least, "group"), "named")
    result = full.select("doc", "sha", "n", "digest").join(named, "digest").select("doc", "sha", "n", "component", "group")
    empty = rows.where("n = 0").select("doc", "sha", "n", F.col("doc").alias("component"), F.lit(None).cast("long").alias("group"))
    return result.union(empty).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null ids last), of equal ids one.

    Rows without a set stay.
    """
    found = join(docs, doc=doc, text=text, width=width, percent=percent).where(F.col("group").isNotNull())
    found = materialise(found.groupBy("doc", "sha", "group").agg(F.count(F.lit(1)).alias("n")), "found")
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "sha")
    first = found.groupBy("group").agg(F.min(order).alias("first"))
    stays = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("sha") == F.col("first.sha"))
    told = materialise(found.join(first, "group").select("doc", "sha", "n", stays.alias("stays")), "told")
    gone, repeated = told.where("not stays"), told.where("stays and n > 1")
    sha, one, other = fresh(docs.columns, "__sha", "__doc", "__other")
    named = docs.withColumn(sha, F.xxhash64(F.col(text)))

    def within(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        o = others.select(F.col("doc").alias(one), F.col("sha").alias(other))
        return rows.join(o, F.col(doc).eqNullSafe(F.col(one)) & (F.col(sha) == F.col(other)), how)

    held = sieve(gone, "doc", "sha")
    key = (F.col(doc), F.col(sha))
    # Not an anti join, which Spark would move in front of the sieve.
    asked = within(may_hold(named, held, *key), gone, "left").where(F.col(other).isNull()).select(*named.columns)
    kept = may_not_hold(named, held, *key).union(asked)
    if not repeated.isEmpty():
        twice = within(kept, repeated, "left_semi").dropDuplicates([doc, sha])
        kept = within(kept, repeated, "left_anti").union(twice)
    return kept.select(*docs.columns)
