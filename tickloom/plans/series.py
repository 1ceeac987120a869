"""How ordered series are spread over tasks.

A series is the set of rows that share ``keys``, ordered by ``order``. When every series fits one task
the plan is a plain ``Window.partitionBy(keys)``: one shuffle. When a series is longer than
``block_rows`` its rows are numbered across the cluster and cut into blocks of that many rows; each
block carries a copy of the few neighbouring rows its frames reach into, so one series, however long,
is worked on by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.session import materialise

# Lookup tables up to this many rows are broadcast; larger ones are joined through a shuffle.
BROADCAST_ROWS = 200_000
# Up to this many long series are listed on the driver; a longer list stays a table.
LISTED_SERIES = 10_000


@dataclass(frozen=True)
class Series:
    """Names the series and bounds the rows of one series that a single task may hold.

    ``ties`` are further columns that order rows of equal ``order``; without them such rows have no order and
    stay in one task, so copies belong removed first (clean.dedup_keep_last).
    ``one_row_per_day`` states that a series has at most one row per calendar day. That proves a bound: a
    century is 36,525 rows, and all the days a DATE can hold are 3.7 million. ``fits`` states that
    ``measured`` has checked the length. Both save a counting job per operator.
    ``materialise`` writes a derived input to the shared folder before a long series is split, because
    the split reads its input several times.
    """

    keys: tuple[str, ...] = ("series_key",)
    order: str = "date"
    ties: tuple[str, ...] = ()
    block_rows: int = 1_000_000
    one_row_per_day: bool = False
    fits: bool = False
    materialise: bool = True

    @property
    def ordering(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in (self.order, *self.ties)]

    @property
    def bounded(self) -> bool:
        return self.fits or self.one_row_per_day

    def measured(self, df: DataFrame) -> Series:
        """Count once for several operators on ``df`` or on subsets of its rows."""
        if self.bounded or long_series(df, self).count():
            return self
        return replace(self, fits=True)


DAILY = Series(one_row_per_day=True)


@dataclass(frozen=True)
class Lane:
    """The rows one window sees: whole series, or one block of a series with its copied neighbours."""

    by: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    # A column that never falls along the order; frames sort by it first and so share its sort.
    cell: str | None = None

    def in_cells(self, cell: str) -> Lane:
        return replace(self, cell=cell)

    @property
    def ordering(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in self.order]

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*self.ordering)

    @property
    def framed(self) -> WindowSpec:
        first = [self.cell] if self.cell else []
        return Window.partitionBy(*self.by).orderBy(*first, *self.ordering)

    @property
    def reverse(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*[F.col(c).desc_nulls_first() for c in self.order])

    def last_rows(self, n: int) -> WindowSpec:
        return self.framed.rowsBetween(-(n - 1), 0)

    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, 0)

    def from_here(self) -> WindowSpec:
        """Current row to the end, walked backwards so that Spark grows the frame row by row."""
        return self.reverse.rowsBetween(Window.unboundedPreceding, 0)


def whole_lane(series: Series) -> Lane:
    return Lane(series.keys, (series.order, *series.ties), False)


def block_lane(series: Series) -> Lane:
    return Lane((*series.keys, "_block"), ("_rn",), True)


@dataclass(frozen=True)
class Arranged:
    df: DataFrame
    series: Series
    split: bool
    # Most blocks the split series can have.
    blocks: int = 0


def lookup(df: DataFrame, table: DataFrame, names: list[str], rows: int | None) -> DataFrame:
    """Left join ``table`` on ``names`` (NULL equals NULL); broadcast only when ``rows`` is known and small.

    Beyond that it is a shuffle join whose left side adaptive execution splits where a key is hot.
    """
    renamed = table.select(*[F.col(n).alias(f"_on_{n}") for n in names], *[c for c in table.columns if c not in names])
    if rows is not None and rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    condition = F.lit(True)
    for name in names:
        condition = condition & df[name].eqNullSafe(F.col(f"_on_{name}"))
    return df.join(renamed, condition, "left").drop(*[f"_on_{n}" for n in names])


def long_series(df: DataFrame, series: Series) -> DataFrame:
    """Series longer than a block, with their rows. Counts combine map-side, so no series gathers anywhere."""
    return df.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > series.block_rows)


def list_long(df: DataFrame, series: Series) -> tuple[DataFrame, int, int]:
    """The long series, their number and their rows, from one count over ``df``."""
    found = long_series(df, series)
    listed = found.limit(LISTED_SERIES + 1).toArrow()
    if listed.num_rows <= LISTED_SERIES:
        long = df.sparkSession.createDataFrame(listed, schema=found.schema)
        return long, listed.num_rows, sum(listed["_rows"].to_pylist())
    long = materialise(found, "long")
    total = long.agg(F.count(F.lit(1)).alias("series"), F.sum("_rows").alias("rows")).first()
    return long, total["series"], total["rows"]


def arrange(df: DataFrame, series: Series, weight: str | None = None, number: bool = True) -> Arranged:
    """Add ``_rn``, the 0-based position of a row in its series, and ``_n``, the length of the series.

    With ``weight`` a row stands for that many equal rows. ``number=False`` leaves both out when no
    series has to be split, for operators that need only the ordering.
    """
    if not series.bounded:
        long, count, rows = list_long(df, series)
        if count:
            if series.materialise:
                df = materialise(df, "series")
            numbered = _number_split(df, series, weight, long, count, rows)
            return Arranged(numbered, series, True, blocks=rows // series.block_rows + count)
    if not number:
        return Arranged(df, series, False)
    whole = Window.partitionBy(*series.keys)
    ordered = whole.orderBy(*series.ordering)
    if weight:
        start = F.coalesce(F.sum(weight).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        total = F.sum(weight).over(whole)
    else:
        start = F.row_number().over(ordered).cast("long") - 1
        total = F.count(F.lit(1)).over(whole)
    return Arranged(df.withColumns({"_rn": start, "_n": total}), series, False)


def _number_split(
    df: DataFrame, series: Series, weight: str | None, long: DataFrame, count: int, rows: int
) -> DataFrame:
    """Number rows without ever bringing a long series together.

    Range partitions over keys, order and ties cut the long series into slices of about half a block, so rows of
    one order value are split too where ties tell them apart; they are written, as every later step has to see
    the same slices. Slice sizes (a map-side combined count) give each slice its starting position; rows are
    numbered inside slices.
    """
    keys = list(series.keys)
    slices = 2 * math.ceil(rows / series.block_rows)
    marked = lookup(df, long.select(*keys, F.lit(True).alias("_long")), keys, count)
    spread = marked.filter("_long").repartitionByRange(slices, *map(F.col, keys), *series.ordering)
    spread = materialise(spread.withColumn("_slice", F.spark_partition_id()), "slices")
    sliced = spread.unionByName(marked.filter("_long is null").withColumn("_slice", F.lit(0)))
    size = F.sum(weight) if weight else F.count(F.lit(1))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy(*keys, "_slice")
        .agg(size.alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .withColumn("_length", F.sum("_size").over(Window.partitionBy(*keys)))
        .drop("_size")
    )
    placed = lookup(sliced, starts, [*keys, "_slice"], slices + count)
    within = Window.partitionBy(*keys, "_slice")
    ordered = within.orderBy(*series.ordering)
    if weight:
        local = F.coalesce(F.sum(weight).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        total = F.sum(weight).over(within)
    else:
        local = F.row_number().over(ordered).cast("long") - 1
        total = F.count(F.lit(1)).over(within)
    return placed.withColumns(
        {
            "_rn": F.coalesce(F.col("_start"), F.lit(0)) + local,
            "_n": F.coalesce(F.col("_length"), total),
        }
    ).drop("_long", "_slice", "_start", "_length")


def _block_of(series: Series) -> Column:
    return F.floor(F.col("_rn") / F.lit(series.block_rows)).cast("long")


def over_series(
    df: DataFrame,
    series: Series,
    build: Callable[[DataFrame, Lane], DataFrame],
    back: int = 0,
    ahead: int = 0,
    number: bool = False,
) -> DataFrame:
    """Run ``build`` where each row sees at least ``back`` rows before and ``ahead`` rows after it.

    ``number=True`` makes ``_rn`` and ``_n`` available to ``build``. Columns that ``build`` adds under a
    name with a leading underscore are helpers and removed from the result.
    """
    arranged = arrange(df, series, number=number)
    out = build_over(arranged, build, back, ahead)
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in df.columns])


def build_over(
    arranged: Arranged, build: Callable[[DataFrame, Lane], DataFrame], back: int = 0, ahead: int = 0
) -> DataFrame:
    series = arranged.series
    # Checked whatever the data: a call must not depend on how long its series happen to be.
    if not series.bounded and max(back, ahead) > series.block_rows:
        raise ValueError(f"block_rows={series.block_rows} is shorter than the {max(back, ahead)} rows a frame reaches")
    if not arranged.split:
        return build(arranged.df, whole_lane(series))
    size = series.block_rows
    home, offset = _block_of(series), F.col("_rn") % F.lit(size)
    copies = F.array(
        home,
        F.when(offset >= size - back, home + 1),
        F.when((offset < ahead) & (home > 0), home - 1),
    )
    spread = arranged.df.withColumn("_block", F.explode(F.filter(copies, lambda b: b.isNotNull())))
    built = build(spread, block_lane(series))
    return built.filter(F.col("_block") == home)


def position(lane: Lane, reverse: bool = False) -> Column:
    """A row's place on an axis that grows by one per row; only differences inside a lane are meaningful."""
    if lane.split:
        return F.col("_rn")
    if reverse:
        return -F.row_number().over(lane.reverse).cast("long")
    return F.row_number().over(lane.window).cast("long")


def known_neighbours(arranged: Arranged, columns: list[str], after: bool = True) -> DataFrame:
    """Add ``_prev_<c>`` and ``_next_<c>``: (steps, value) of the nearest non-NULL value at or before/after.

    ``steps`` counts rows between; without ``after`` only the backward look is built. In a split series
    each block hands its outermost known values to the other blocks through a one-row-per-block table.
    The numbered rows are read twice for that, so they are written to the shared folder in between.
    """
    series = arranged.series

    def build(df: DataFrame, lane: Lane) -> DataFrame:
        if after:
            df = df.withColumn("_at", position(lane, reverse=True))
            df = df.withColumns({f"_next_{c}": F.last(_known(c), True).over(lane.from_here()) for c in columns})
            df = _steps(df, columns, "_next") if not lane.split else df
        df = df.withColumn("_at", position(lane))
        df = df.withColumns({f"_prev_{c}": F.last(_known(c), True).over(lane.so_far()) for c in columns})
        return _steps(df, columns, "_prev") if not lane.split else df

    if not arranged.split:
        return build(arranged.df, whole_lane(series))

    keys = list(series.keys)
    blocked = materialise(arranged.df, "numbered").withColumn("_block", _block_of(series))
    ends = []
    for c in columns:
        place = F.when(F.col(c).isNotNull(), F.col("_rn"))
        pair = F.struct(F.col("_rn").alias("at"), F.col(c).alias("value"))
        ends += [F.max_by(pair, place).alias(f"_last_{c}"), F.min_by(pair, place).alias(f"_first_{c}")]
    # Only series of several blocks have anything to hand over.
    several = blocked.filter(F.col("_n") > series.block_rows)
    blocks = several.groupBy(*keys, "_block").agg(*ends)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_carry_prev_{c}": F.last(f"_last_{c}", True).over(before) for c in columns}
    if after:
        carried |= {f"_carry_next_{c}": F.last(f"_first_{c}", True).over(behind) for c in columns}
    table = blocks.withColumns(carried).select(*keys, "_block", *carried)
    # Joined after the windows: the shuffle by block does not carry what blocks hand over.
    out = lookup(build(blocked, block_lane(series)), table, [*keys, "_block"], arranged.blocks)
    for side in ("_next", "_prev") if after else ("_prev",):
        out = out.withColumns({f"{side}_{c}": F.coalesce(f"{side}_{c}", f"_carry{side}_{c}") for c in columns})
        out = _steps(out, columns, side)
    return out


def _known(column: str) -> Column:
    return F.when(
        F.col(column).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(column).alias("value"))
    )


def _steps(df: DataFrame, columns: list[str], side: str) -> DataFrame:
    place = F.col("_at")
    made = {}
    for c in columns:
        near = F.col(f"{side}_{c}")
        made[f"{side}_{c}"] = F.when(
            near.isNotNull(), F.struct(F.abs(near["at"] - place).alias("steps"), near["value"].alias("value"))
        )
    return df.withColumns(made)
