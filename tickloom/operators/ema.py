"""Exponentially weighted mean, ``y = a*x + (1-a)*y_before``, as window sums.

The recurrence unrolls to a sum with weights that shrink by ``q = 1-a`` per row. Rows are cut into cells
long enough that a whole cell shrinks a weight by 1e-18. Inside a cell the sum is a running sum of
``x * q**-p`` (p = place in the cell) scaled back by ``q**p``. Of earlier cells the last is enough: what
lies before it weighs less than the resolution of a double, relative to the largest value there. So the
mean needs only ``LOOK_BACK_CELLS`` cells of history, and a long series can be cut into blocks like any
rolling window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import finite
from tickloom.operators.ema_gaps import ewm_mean_gaps
from tickloom.plans.series import Lane, Series, over_series
from tickloom.plans.stages import Levels, add_levels
from tickloom.schema import EMA_SPANS

CELL_SHRINK = 1e-18
LOOK_BACK_CELLS = 2
# Largest growth q**-p may reach inside a cell, far from overflow.
MAX_GROWTH = 1e200


def _q(span: float) -> float:
    if span < 1:
        raise ValueError("span must be at least 1")
    return 1 - 2 / (span + 1)


def cell_rows(span: float) -> int:
    q = _q(span)
    return 1 if q == 0 else math.ceil(math.log(CELL_SHRINK) / math.log(q))


def look_back(span: float) -> int:
    return LOOK_BACK_CELLS * cell_rows(span)


def _fits(span: float, cell: int) -> bool:
    q = _q(span)
    return q == 0 or -cell * math.log(q) < math.log(MAX_GROWTH)


def start_levels(lane: Lane, source: str) -> Levels:
    """``_starts_<source>``: the row holds the first value of its series."""
    in_middle = F.col("_has_before") & F.col(_before(source)).isNull()
    return [
        {
            "_has_before": F.lag(F.lit(True), 1, False).over(lane.window),
            _before(source): F.lag(finite(F.col(source))).over(lane.window),
        },
        {f"_starts_{source}": finite(F.col(source)).isNotNull() & ((F.col("_rn") == 0) | in_middle)},
    ]


def _before(source: str) -> str:
    return f"_{source}_finite_before"


def cell_name(cell: int) -> str:
    return f"_cell_{cell}"


def cell_level(cell: int) -> dict:
    return {cell_name(cell): F.floor(F.col("_rn") / cell).cast("long")}


def mean_levels(lane: Lane, means: dict[str, tuple[str, float]], cell: int, origin: str) -> Levels:
    """Means on cells that are already numbered.

    ``origin`` is the column whose start and gaps hold for the sources too: a source itself, or the
    column all of them are computed from.
    """
    number = cell_name(cell)
    in_cell = Window.partitionBy(*lane.by, number).orderBy(*lane.ordering)
    running = in_cell.rowsBetween(Window.unboundedPreceding, 0)
    one_cell_back = Window.partitionBy(*lane.by).orderBy(number).rangeBetween(-1, -1)
    place = F.col("_rn") % cell
    weighted, sums, earlier, result = {}, {}, {}, {}
    for name, (source, span) in means.items():
        q, x = _q(span), finite(F.col(source))
        if q == 0:
            result[name] = x
            continue
        share = F.when(F.col(f"_starts_{origin}"), x).otherwise(x * (1 - q))
        weighted[f"_weighted_{name}"] = share * F.pow(F.lit(q), -place)
        sums[f"_sum_{name}"] = F.sum(f"_weighted_{name}").over(running)
        # The running sum at the end of the cell before.
        earlier[f"_carry_{name}"] = F.max_by(f"_sum_{name}", "_rn").over(one_cell_back)
        carried = F.coalesce(F.col(f"_carry_{name}"), F.lit(0.0)) * (q**cell)
        mean = F.pow(F.lit(q), place) * (F.col(f"_sum_{name}") + carried)
        gap = F.raise_error(F.lit(f"{name}: {source} has a gap after its first value; interpolate it first, or ask for gaps"))
        result[name] = F.when(x.isNotNull(), mean).when(F.col(_before(origin)).isNotNull(), gap.cast("double"))
    return [weighted, sums, earlier, result]


def add_ewm(df: DataFrame, lane: Lane, means: dict[str, tuple[str, float]]) -> DataFrame:
    """Add one column per ``name: (source, span)``; needs ``_rn``.

    Rows before the first value of the source stay NULL and the first value starts the mean. After that
    the source must have no gaps (see clean.interpolate_linear); a gap raises when the query runs. An infinite
    value counts as missing.
    """
    df = add_levels(df, *[start_levels(lane, source) for source in dict.fromkeys(s for s, _ in means.values())])
    cell = cell_rows(max(span for _, span in means.values()))
    groups: dict[tuple[str, int], dict] = {}
    for name, (source, span) in means.items():
        size = cell if _fits(span, cell) else cell_rows(span)
        groups.setdefault((source, size), {})[name] = (source, span)
    for (source, size), group in groups.items():
        df = add_levels(df, [cell_level(size), *mean_levels(lane, group, size, source)])
    return df


def ewm_mean(df: DataFrame, means: dict[str, tuple[str, float]], series: Series = Series(), gaps: bool = False) -> DataFrame:
    """Add one column per ``name: (source, span)``.

    Without ``gaps`` a source must have none after its first value (a gap raises when the query runs); with it a gap
    re-normalises the weights, see operators.ema_gaps.
    """
    if gaps:
        return ewm_mean_gaps(df, means, series)
    reach = max(look_back(span) for _, span in means.values())
    return over_series(df, series, lambda d, lane: add_ewm(d, lane, means), back=reach, number=True)


def ema(df: DataFrame, spans: tuple[int, ...] = EMA_SPANS, series: Series = Series(), gaps: bool = False) -> DataFrame:
    return ewm_mean(df, {f"ema_{n}": ("close", n) for n in spans}, series, gaps)
