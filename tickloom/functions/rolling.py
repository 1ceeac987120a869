"""Window primitives: Column expressions over a Lane (see plans.series)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.plans.series import Lane


# Frames up to this many rows are summed directly, unless they share the pieces of other frames.
SHORT_FRAME = 32
# Piece lengths tried first, so that frames of 14, 20, 21, 30, 50 or 200 rows share their pieces.
SHARED_PIECES = (10, 7)
MAX_SHARED = 20
# Frames up to this many rows are added up from looks at their rows, which cost less than a sliding aggregate.
LOOKED = 10


def finite(x: Column) -> Column:
    """Infinities and NaN count as missing in frames and recursive means."""
    return F.when(F.abs(x) < float("inf"), x)


def known(x: Column) -> Column:
    """NaN, as of an infinity less another, counts as missing."""
    return F.when(~F.isnan(x), x)


def _full(x: Column, n: int, lane: Lane, value: Column) -> Column:
    """``value`` where all ``n`` rows of the frame hold a number, else NULL."""
    return F.when(F.count(x).over(lane.last_rows(n)) == n, value)


def rolling_sum(x: Column, n: int, lane: Lane) -> Column:
    x = finite(x)
    return _full(x, n, lane, F.sum(x).over(lane.last_rows(n)))


def rolling_mean(x: Column, n: int, lane: Lane) -> Column:
    return rolling_sum(x, n, lane) / n


def rolling_std(x: Column, n: int, lane: Lane) -> Column:
    x = finite(x)
    return _full(x, n, lane, F.stddev_samp(x).over(lane.last_rows(n)))


def frame_pieces(n: int) -> list[tuple[int, int]]:
    """Cut a frame of ``n`` rows into (rows, rows back) pieces, most of them of one length.

    Spark adds up a sliding frame anew for every row. A long frame is therefore the sum of short frames
    taken at earlier rows, a look each: in the order of ``sqrt(n)`` steps per row in place of ``n``.
    """
    piece = _shared_piece(n)
    if piece is None and n <= SHORT_FRAME:
        return [(n, 0)]
    if piece is None:
        piece = min(range(2, n), key=lambda c: 2 * c + n // c + n % c)
    rest = n % piece
    return [(piece, k * piece) for k in range(n // piece)] + ([(rest, n - rest)] if rest else [])


def _shared_piece(n: int) -> int | None:
    return next((c for c in SHARED_PIECES if n % c == 0 and n // c <= MAX_SHARED), None)


def _piece(name: str, back: int) -> Column:
    return F.col(f"{name}_{back}" if back else name)


def _earlier(name: str, back: int, lane: Lane) -> dict[str, Column]:
    return {f"{name}_{back}": F.lag(name, back).over(lane.framed)} if back else {}


def _looks(column: str, rows: int, lane: Lane) -> dict[str, Column]:
    """Looks at the earlier rows of a short frame; frames over one column share them."""
    x = finite(F.col(column).cast("double"))
    return {f"_at_{column}_{k}": F.lag(x, k).over(lane.framed) for k in range(1, rows)} if rows <= LOOKED else {}


def _values(column: str, rows: int) -> list[Column]:
    """The rows of a short frame, oldest first."""
    return [*(F.col(f"_at_{column}_{k}") for k in range(rows - 1, 0, -1)), finite(F.col(column).cast("double"))]


def _total(column: str, rows: int, lane: Lane) -> Column:
    """Sum over a frame; NULL if one of its rows is missing."""
    return reduce(add, _values(column, rows)) if rows <= LOOKED else rolling_sum(F.col(column), rows, lane)


def _variance(column: str, rows: int, lane: Lane) -> Column:
    """Population variance over a frame."""
    if rows > LOOKED or rows == 1:
        return F.var_pop(finite(F.col(column))).over(lane.last_rows(rows))
    # Values are taken relative to the newest, as the means of pieces below.
    *others, newest = _values(column, rows)
    offsets = [x - newest for x in others]
    shifted = reduce(add, offsets)
    return (reduce(add, [o * o for o in offsets]) - shifted * shifted / rows) / rows


def rolling_mean_levels(column: str, means: dict[str, int], lane: Lane) -> list[dict[str, Column]]:
    """Four levels, looks, frames, earlier frames and results, for means of ``name: rows``.

    Means that need the same piece share it.
    """
    looks, frames, earlier, results = {}, {}, {}, {}
    for name, n in means.items():
        total = F.lit(0.0)
        for rows, back in frame_pieces(n):
            piece = f"_sum_{column}_{rows}"
            looks |= _looks(column, rows, lane)
            frames[piece] = _total(column, rows, lane)
            earlier |= _earlier(piece, back, lane)
            total = total + _piece(piece, back)
        results[name] = total / n
    return [looks, frames, earlier, results]


def rolling_std_levels(column: str, deviations: dict[str, int], lane: Lane) -> list[dict[str, Column]]:
    """Four levels, as above, for sample deviations of ``name: rows``.

    A frame is merged from frames of equal length by their means and variances, which keeps the
    precision of a direct pass: the spread inside the pieces plus the spread of their means.
    """
    looks, frames, earlier, results = {}, {}, {}, {}
    for name, n in deviations.items():
        divisors = [c for c in range(2, n + 1) if n % c == 0]
        rows = _shared_piece(n) or min(divisors, key=lambda c: 2 * c + 2 * (n // c), default=n)
        total, spread = f"_sum_{column}_{rows}", f"_var_{column}_{rows}"
        looks |= _looks(column, rows, lane)
        frames[total] = _total(column, rows, lane)
        frames[spread] = _variance(column, rows, lane)
        backs = range(0, n, rows)
        for back in backs:
            earlier |= _earlier(total, back, lane) | _earlier(spread, back, lane)
        # Means are taken relative to the newest piece, whose own offset is 0. So subtracting the squared
        # sum loses no more than a factor of the number of pieces, and equal pieces give exactly 0.
        offsets = [(_piece(total, back) - F.col(total)) / rows for back in backs[1:]]
        between = sum((o * o for o in offsets), F.lit(0.0))
        if offsets:
            shift_sum = sum(offsets[1:], offsets[0])
            between = between - shift_sum * shift_sum / len(backs)
        inside = sum((_piece(spread, back) for back in backs[1:]), F.col(spread))
        results[name] = F.when(F.col(total).isNotNull(), F.sqrt((inside + between) * rows / (n - 1)))
    return [looks, frames, earlier, results]


def shift(x: Column, k: int, lane: Lane) -> Column:
    """Value ``k`` rows earlier; a negative ``k`` looks ahead."""
    return F.lag(x, k).over(lane.window) if k >= 0 else F.lead(x, -k).over(lane.window)


def diff(x: Column, k: int, lane: Lane) -> Column:
    return x - shift(x, k, lane)


def pct_change(x: Column, k: int, lane: Lane) -> Column:
    """``x / x[k rows earlier] - 1``; infinite when only the earlier value is 0, NULL when both are."""
    base = shift(x, k, lane)
    return ratio(x, base) - 1


def ratio(x: Column, base: Column) -> Column:
    """Division with the IEEE result for a zero divisor, except that 0/0 is missing."""
    infinite = F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf")))
    return F.when(base == 0, infinite).otherwise(F.try_divide(x, base))


def row_max(*columns: Column) -> Column:
    """Largest non-NULL argument."""
    return F.greatest(*columns)


def where(x: Column, condition: Column, other: float) -> Column:
    """``x`` where the condition holds; ``other`` where it fails or is unknown."""
    return F.when(condition, x).otherwise(F.lit(other))
