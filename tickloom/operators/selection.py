"""Selection of values by rank: the bits of the ordered value are found from the top, a few per pass.

Every value has a 64-bit integer of the same order (of a double, its IEEE bits). A pass counts, per group, the next bits of the
values that begin like the one looked for; the counts tell which bits come next. So only counts are shuffled,
at most ``2 ** BITS`` per group and pass, however many rows and different values there are. A group is done when the
values left are equal, and after all 64 bits at the latest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, TimestampType

from tickloom.plans.series import Series, list_long, lookup
from tickloom.session import materialise

BITS = 12
# Fixed values of IEEE doubles: bits of the fraction, offset of the exponent, exponent of what is no finite number.
FRACTION, OFFSET, BEYOND = 52, 1023, 2047


def ordered_bits(x: Column, kind: DataType) -> Column:
    """A LONG in the order of the values; equal values, and both zeros, have equal ones. NaN comes last."""
    if isinstance(kind, IntegralType):
        return x.cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(x)
    if isinstance(kind, DateType):
        return F.unix_date(x).cast("long")
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return (x * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    if not isinstance(kind, (DoubleType, FloatType)):
        raise TypeError(f"{kind.simpleString()} has no order by bits")
    x = x.cast("double")
    size = F.abs(x)
    about = F.floor(F.log2(size))
    # The logarithm may be rounded across a power of two.
    exponent = about + F.when(size >= F.pow(F.lit(2.0), about + 1), 1).when(size < F.pow(F.lit(2.0), about), -1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * float(2**FRACTION)
    normal = (exponent + OFFSET) * F.lit(2**FRACTION) + fraction.cast("long")
    small = (size * 2.0**537 * 2.0**537).cast("long")
    bits = (
        F.when(F.isnan(x), F.lit((BEYOND << FRACTION) + 1))
        .when(size == float("inf"), F.lit(BEYOND << FRACTION))
        .when(size < 2.0 ** (1 - OFFSET), small)
        .otherwise(normal)
    )
    return F.when((x < 0) & ~F.isnan(x), -bits).otherwise(bits)


def from_bits(bits: Column, kind: DataType) -> Column:
    """The value of a LONG made by ``ordered_bits``."""
    if isinstance(kind, IntegralType):
        return bits.cast(kind)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(bits)
    if isinstance(kind, DateType):
        return F.date_from_unix_date(bits.cast("int"))
    if isinstance(kind, DecimalType):
        return (bits.cast("decimal(19,0)") / F.lit(10**kind.scale).cast("decimal(19,0)")).cast(kind)
    size = F.abs(bits)
    exponent, fraction = F.shiftright(size, FRACTION), size % F.lit(2**FRACTION)
    normal = (1 + fraction / float(2**FRACTION)) * F.pow(F.lit(2.0), exponent - OFFSET)
    x = (
        F.when((exponent == BEYOND) & (fraction > 0), F.lit(float("nan")))
        .when(exponent == BEYOND, F.lit(float("inf")))
        .when(exponent == 0, fraction.cast("double") * 2.0**-537 * 2.0**-537)
        .otherwise(normal)
    )
    return F.when(bits < 0, -x).otherwise(x).cast(kind)


def _chosen(counts: DataFrame, keys: list[str], sides: dict[str, Column]) -> DataFrame:
    """Per group and side the bits in which its rank falls: ``<side>_bits``, _rank (inside them), _low and _high (of the values there).

    ``counts`` has _before (the bits so far), _next, _rows, _low and _high; ``sides`` says which rank is wanted.
    """
    ahead = Window.partitionBy(*keys, "_before").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_less", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
    made = []
    for side, rank in sides.items():
        on = (rank >= F.col("_less")) & (rank < F.col("_less") + F.col("_rows"))
        if f"{side}_bits" in counts.columns:
            on = on & (F.col("_before") == F.col(f"{side}_bits"))
        found = F.struct(F.col("_next").alias("bits"), (rank - F.col("_less")).alias("rank"), F.col("_low").alias("low"), F.col("_high").alias("high"))
        made.append(F.max(F.when(on, found)).alias(side))
    return counts.groupBy(*keys).agg(*made).select(
        *keys, *[F.col(f"{side}.{part}").alias(f"{side}_{part}") for side in sides for part in ("bits", "rank", "low", "high")]
    )


def select_by_bits(rows: DataFrame, keys: list[str], groups: int, ranks: dict[str, Column], bits: int = BITS) -> DataFrame:
    """Per group, the values at some ranks (from 0): ``<side>_low``, its bits, and ``<side>_rank``, how many equal ones lie before.

    ``rows`` has the keys and ``_bits`` and is read once per pass; ``ranks`` are expressions of ``_n``, the size of the group, and
    a rank outside gives NULL. ``groups`` is the number of groups, or an upper bound.
    """
    shift, sides = 64 - bits, list(ranks)
    ends = [F.count(F.lit(1)).alias("_rows"), F.min("_bits").alias("_low"), F.max("_bits").alias("_high")]
    first = rows.groupBy(*keys, F.shiftright("_bits", shift).alias("_next")).agg(*ends).withColumn("_before", F.lit(0))
    first = first.withColumn("_n", F.sum("_rows").over(Window.partitionBy(*keys)))
    known = materialise(_chosen(first, keys, ranks), "ranks")
    apart = " or ".join(f"{s}_low <> {s}_high" for s in sides)
    while shift and not known.where(apart).isEmpty():
        done, shift = shift, max(0, shift - bits)
        # Groups whose ranks are found need no further look.
        still = known.where(apart)
        wanted = lookup(rows, still.select(*keys, *[f"{s}_bits" for s in sides]), keys, groups)
        wanted = wanted.withColumn("_before", F.shiftright("_bits", done))
        any_side = [F.col("_before") == F.col(f"{s}_bits") for s in sides]
        wanted = wanted.where(reduce(Column.__or__, any_side))
        counts = wanted.groupBy(*keys, "_before", F.shiftright("_bits", shift).alias("_next")).agg(*ends)
        counts = lookup(counts, still.select(*keys, *[f"{s}_{p}" for s in sides for p in ("bits", "rank")]), keys, groups)
        found = _chosen(counts, keys, {s: F.col(f"{s}_rank") for s in sides})
        known = materialise(known.where(f"not coalesce({apart}, false)").unionByName(found), "ranks")
    return known.select(*keys, *[f"{s}_{p}" for s in sides for p in ("low", "rank")])


def middle_by_bits(df: DataFrame, column: str, keys: list[str], groups: int, bits: int = BITS) -> DataFrame:
    """keys, ``low`` and ``high``: the values on both sides of the middle of every group, equal where its size is odd.

    ``df`` holds no NULL in the column.
    """
    kind = df.schema[column].dataType
    rows = materialise(df.select(*keys, ordered_bits(F.col(column), kind).alias("_bits")), "bits")
    n = F.col("_n")
    known = select_by_bits(rows, keys, groups, {"a": F.floor((n - 1) / 2), "b": F.floor(n / 2)}, bits)
    return known.select(*keys, from_bits(F.col("a_low"), kind).alias("low"), from_bits(F.col("b_low"), kind).alias("high"))


def exact_median(df: DataFrame, column: str, keys: tuple[str, ...] = (), block_rows: int = 1_000_000, bits: int = BITS) -> DataFrame:
    """Median per key (or overall) without gathering a group; NULLs don't count.

    Values of a group of up to ``block_rows`` rows are counted and ranked in one task; a larger group is searched by its
    values' bits.
    """
    keys = list(keys)
    grouped = keys or ["_all"]
    table = df if keys else df.withColumn("_all", F.lit(0))
    table = table.filter(F.col(column).isNotNull()).select(*grouped, column)
    long, count, _ = list_long(table, Series(tuple(grouped), column, block_rows=block_rows))
    if not count:
        return _ranked(table, column, grouped).drop("_all")
    marked = lookup(table, long.select(*grouped, F.lit(True).alias("_long")), grouped, count)
    large = middle_by_bits(marked.filter("_long").drop("_long"), column, grouped, count, bits)
    large = large.select(*grouped, ((F.col("low") + F.col("high")) / 2).alias("median"))
    return large.union(_ranked(marked.filter("_long is null"), column, grouped)).drop("_all")


def _ranked(table: DataFrame, column: str, grouped: list[str]) -> DataFrame:
    counted = table.groupBy(*grouped, column).agg(F.count(F.lit(1)).alias("_copies"))
    whole = Window.partitionBy(*grouped)
    ahead = whole.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumns({"_rn": F.coalesce(F.sum("_copies").over(ahead), F.lit(0)), "_n": F.sum("_copies").over(whole)})
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    middle = ranked.filter((F.col("_rn") <= high) & (F.col("_rn") + F.col("_copies") > low))
    return middle.groupBy(*grouped).agg(((F.min(column) + F.max(column)) / 2).alias("median"))
