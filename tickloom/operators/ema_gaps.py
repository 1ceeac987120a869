"""Exponentially weighted means over gaps, as a scan of affine maps.

A value that comes g missing rows after the one before re-normalises the weights: with q = 1 - a the mean becomes
``(q**(g+1) * before + a*x) / (q**(g+1) + a)``, which is the plain mean where g = 0. A missing row keeps the mean before
it. Every value is thus an affine map of the mean before, and maps compose: with P the running sum of the logarithms of
their factors, what a map adds reaches a later row times exp(P there - P here).

Rows are cut into cells by P, so that weights grow inside a cell by at most ``exp(3 * CELL)``; what lies two cells back weighs less
than a double resolves. That holds however many rows are missing, as P falls with values only.

In blocks of a long series the scan starts at a block's first value. A table of a row per block, with the block's whole map, is
scanned in the same way and tells each block the mean it starts from; so no block looks back beyond its own rows, however long
a gap is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.rolling import finite
from tickloom.plans.series import Lane, Series, arrange, block_lane, lookup, whole_lane
from tickloom.session import materialise

# -log of the share that a cell leaves of what was before it.
CELL = -math.log(1e-18)


def _map(q: float, x: Column, gap: Column) -> tuple[Column, Column]:
    """Logarithm of the factor, and the addend, of the map of a value after ``gap`` missing rows."""
    if q == 0:  # a span of 1: what was before counts for nothing
        return F.lit(-2 * CELL), x
    kept = F.exp((gap + 1) * math.log(q))
    scale = kept + (1 - q)
    return _bounded((gap + 1) * math.log(q) - F.log(scale)), (1 - q) * x / scale


def _bounded(log: Column) -> Column:
    """A factor no double resolves is as good as any smaller one, and its inverse stays finite."""
    return F.when(log.isNotNull(), F.greatest(log, F.lit(-2 * CELL)))


def _scan(df: DataFrame, by: list[str], window: WindowSpec, ordering: list, names: list[str]) -> DataFrame:
    """Add, per name, ``_<name>_own`` (what the maps so far make of 0) and ``_<name>_left`` (the factor of what came before).

    ``_<name>_log`` and ``_<name>_add`` hold the maps, NULL where a row changes nothing. Rows with ``at`` order the windows.
    """
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"_{n}_p": F.coalesce(F.sum(f"_{n}_log").over(so_far), F.lit(0.0)) for n in names})
    df = df.withColumns({f"_{n}_cell": F.floor(-F.col(f"_{n}_p") / CELL).cast("long") for n in names})
    inside = {
        n: Window.partitionBy(*by, f"_{n}_cell").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0) for n in names
    }
    # Summed anew inside the cell, where it stays within thrice CELL and so keeps its precision.
    df = df.withColumns({f"_{n}_in": F.coalesce(F.sum(f"_{n}_log").over(inside[n]), F.lit(0.0)) for n in names})
    df = df.withColumns({
        f"_{n}_sum": F.coalesce(F.sum(F.col(f"_{n}_add") * F.exp(-F.col(f"_{n}_in"))).over(inside[n]), F.lit(0.0)) for n in names
    })
    df = df.withColumns({f"_{n}_value": F.exp(F.col(f"_{n}_in")) * F.col(f"_{n}_sum") for n in names})
    carried = {}
    for n in names:
        before = Window.partitionBy(*by).orderBy(f"_{n}_cell").rangeBetween(-1, -1)
        carried[f"_{n}_carry"] = F.max_by(f"_{n}_value", F.col("_at")).over(before)
    df = df.withColumns(carried)
    made = {}
    for n in names:
        made[f"_{n}_own"] = F.col(f"_{n}_value") + F.exp(F.col(f"_{n}_in")) * F.coalesce(F.col(f"_{n}_carry"), F.lit(0.0))
        made[f"_{n}_left"] = F.exp(F.col(f"_{n}_p"))
    return df.withColumns(made).drop(*[f"_{n}_{part}" for n in names for part in ("p", "cell", "in", "sum", "value", "carry")])


def _in_lane(df: DataFrame, lane: Lane, means: dict[str, tuple[str, float]], shrink: dict[str, float]) -> DataFrame:
    """The scan from the first value a lane has: ``_<name>_own``, ``_<name>_left`` and ``_first_<source>``."""
    sources = dict.fromkeys(s for s, _ in means.values())
    df = df.withColumn("_at", F.col("_rn"))
    df = df.withColumns({f"_x_{s}": finite(F.col(s)) for s in sources})
    df = df.withColumns({f"_place_{s}": F.when(F.col(f"_x_{s}").isNotNull(), F.col("_at")) for s in sources})
    earlier = lane.window.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_before_{s}": F.last(f"_place_{s}", True).over(earlier) for s in sources}
                        | {f"_first_{s}": F.first(f"_x_{s}", True).over(lane.so_far()) for s in sources})
    maps = {}
    for n, (s, _) in means.items():
        log, add = _map(shrink[n], F.col(f"_x_{s}"), F.col("_at") - F.col(f"_before_{s}") - 1)
        step = F.col(f"_x_{s}").isNotNull() & F.col(f"_before_{s}").isNotNull()
        maps |= {f"_{n}_log": F.when(step, log), f"_{n}_add": F.when(step, add)}
    return _scan(df.withColumns(maps), list(lane.by), lane.window, lane.ordering, list(means))


def _block_starts(built: DataFrame, series: Series, means: dict[str, tuple[str, float]], shrink: dict[str, float]) -> DataFrame:
    """Per block of a split series and mean: ``_<name>_from``, the mean after its first value, and ``_<name>_came``, that before the block."""
    keys, sources = list(series.keys), dict.fromkeys(s for s, _ in means.values())
    several = built.filter(F.col("_n") > series.block_rows)
    ends = [f(f"_place_{s}").alias(f"_{w}_{s}") for s in sources for w, f in (("low", F.min), ("high", F.max))]
    ends += [F.min_by(f"_x_{s}", f"_place_{s}").alias(f"_head_{s}") for s in sources]
    ends += [F.max_by(f"_{n}_own", "_at").alias(f"_{n}_rest") for n in means]
    ends += [F.sum(f"_{n}_log").alias(f"_{n}_fall") for n in means]
    table = several.groupBy(*keys, "_block").agg(*ends).withColumn("_at", F.col("_block"))
    order = Window.partitionBy(*keys).orderBy("_at")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumns({f"_prior_{s}": F.last(f"_high_{s}", True).over(earlier) for s in sources})
    heads, whole = {}, {}
    for n, (s, _) in means.items():
        log, add = _map(shrink[n], F.col(f"_head_{s}"), F.col(f"_low_{s}") - F.col(f"_prior_{s}") - 1)
        some, follows = F.col(f"_low_{s}").isNotNull(), F.col(f"_prior_{s}").isNotNull()
        # The first block with a value starts the mean: what comes in counts for nothing.
        heads |= {
            f"_{n}_head_log": F.when(some, F.when(follows, log).otherwise(F.lit(-2 * CELL))),
            f"_{n}_head_add": F.when(some, F.when(follows, add).otherwise(F.col(f"_head_{s}"))),
        }
        fall = F.coalesce(F.col(f"_{n}_fall"), F.lit(0.0))
        whole |= {
            f"_{n}_log": _bounded(F.col(f"_{n}_head_log") + fall),
            f"_{n}_add": F.col(f"_{n}_head_add") * F.exp(fall) + F.col(f"_{n}_rest"),
        }
    table = _scan(table.withColumns(heads).withColumns(whole), keys, order, ["_at"], list(means))
    came = {f"_{n}_came": F.lag(F.when(F.coalesce(f"_high_{s}", f"_prior_{s}").isNotNull(), F.col(f"_{n}_own"))).over(order) for n, (s, _) in means.items()}
    table = table.withColumns(came)
    start = {
        f"_{n}_from": F.when(F.col(f"_{n}_came").isNull(), F.col(f"_head_{s}")).otherwise(
            F.exp(f"_{n}_head_log") * F.col(f"_{n}_came") + F.col(f"_{n}_head_add")
        )
        for n, (s, _) in means.items()
    }
    return table.withColumns(start).select(*keys, "_block", *[f"_{n}_{part}" for n in means for part in ("from", "came")])


def ewm_mean_gaps(df: DataFrame, means: dict[str, tuple[str, float]], series: Series = Series()) -> DataFrame:
    """Add one column per ``name: (source, span)``; sources may have gaps anywhere.

    Rows before the first value stay NULL, later missing rows keep the mean before them; an infinite value counts as missing.
    """
    if any(span < 1 for _, span in means.values()):
        raise ValueError("span must be at least 1")
    shrink = {n: 1 - 2 / (span + 1) for n, (_, span) in means.items()}
    arranged = arrange(df, series)
    if not arranged.split:
        built = _in_lane(arranged.df, whole_lane(series), means, shrink)
        start = {n: F.col(f"_first_{s}") for n, (s, _) in means.items()}
        came = {n: F.lit(None).cast("double") for n in means}
    else:
        blocked = arranged.df.withColumn("_block", F.floor(F.col("_rn") / F.lit(series.block_rows)).cast("long"))
        # Read twice: for the table of blocks, and with what it hands back.
        built = materialise(_in_lane(blocked, block_lane(series), means, shrink), "scanned")
        built = lookup(built, _block_starts(built, series, means, shrink), [*series.keys, "_block"], arranged.blocks)
        start = {n: F.coalesce(f"_{n}_from", f"_first_{s}") for n, (s, _) in means.items()}
        came = {n: F.col(f"_{n}_came") for n in means}
    made = {
        n: F.when(F.col(f"_first_{s}").isNotNull(), F.col(f"_{n}_own") + F.col(f"_{n}_left") * start[n]).otherwise(came[n])
        for n, (s, _) in means.items()
    }
    return built.withColumns(made).select(*df.columns, *made)
