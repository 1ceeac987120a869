"""The same results in DuckDB SQL over the given tables, written independently of the Spark code."""

from __future__ import annotations

from tickloom import schema as S
from tickloom.catalog.places import PLACES
from tickloom.catalog.tables import PRIORITIES


def _bars(key: str, table: str = "orders", date: str = "cast(o_orderdate as date)", price: str = "o_totalprice",
          sequence: str = "o_orderkey") -> str:
    return (
        f"select {key} as series_key, {date} as date, arg_min({price}, {sequence}) as open, max({price}) as high, "
        f"min({price}) as low, arg_max({price}, {sequence}) as close, cast(count(*) as double) as volume "
        f"from {table} group by 1, 2"
    )


DAILY = _bars("'ALL'")
KEYED = _bars("o_orderpriority")
SUPPLIER = _bars("cast(l_suppkey as varchar)", "lineitem", "cast(l_shipdate as date)", "l_extendedprice",
                 "l_orderkey * 8 + l_linenumber")
HOURLY = _bars("event_type", "events", "date_trunc('hour', ts)", "value", "ts")
DIRTY = f"""with b as ({KEYED})
select series_key, date, 0 as seq,
       case when dayofyear(date) % 29 = 0 then 0.0 else open end as open, high,
       case when dayofyear(date) % 41 = 0 then -low else low end as low,
       case when dayofyear(date) % 17 = 0 then null else close end as close,
       case when dayofyear(date) % 31 = 0 then 0.0 else volume end as volume from b
union all
select series_key, date, 1, open, high, low, close + 1, volume from b where dayofyear(date) % 23 = 0"""
TICKS = """select 'ALL' as series_key, ts as date, value as open, value + 1 as high, value - 1 as low, value as close,
cast(event_id % 10 as double) as volume, case when event_id % 7 <> 0 then value end as patchy from events"""
QUOTES = """select event_id as quote_id, ts as timestamp,
case when event_id % 50 = 0 then 0.0 else value * 1000 end as price_usd from events"""
DEDUP_TIES = f"""select * from (select * replace (case when dayofyear(date) % 2 = 0 then cast(0 as integer) end as seq) from ({DIRTY}))
qualify row_number() over (partition by series_key, date order by seq desc nulls last, open desc nulls last, high desc nulls last,
low desc nulls last, close desc nulls last, volume desc nulls last) = 1"""
DEDUP = f"""select series_key, date, open, high, low, close, volume from ({DIRTY})
qualify row_number() over (partition by series_key, date order by seq desc) = 1"""


def _prices(bars: str) -> str:
    return f"select series_key, cast(date as timestamp) as timestamp, close as price from ({bars})"


W = "over (partition by series_key order by date)"


def _frame(n: int) -> str:
    return f"over (partition by series_key order by date rows between {n - 1} preceding and current row)"


def _mean(x: str, n: int) -> str:
    return f"case when count({x}) {_frame(n)} = {n} then avg({x}) {_frame(n)} end"


def _std(x: str, n: int) -> str:
    return f"case when count({x}) {_frame(n)} = {n} then stddev_samp({x}) {_frame(n)} end"


SMA = {f"sma_{n}": _mean("close", n) for n in S.SMA_SPANS}
RSI = {"rsi_14": "case when ml = 0 then case when mg > 0 then 100.0 end else 100 - 100 / (1 + mg / ml) end"}
MIDDLE, SPREAD = _mean("close", 20), f"2 * {_std('close', 20)}"
BANDS = {
    "bb_middle": MIDDLE,
    "bb_upper": f"{MIDDLE} + {SPREAD}",
    "bb_lower": f"{MIDDLE} - {SPREAD}",
    "bb_width": f"({MIDDLE} + {SPREAD}) - ({MIDDLE} - {SPREAD})",
}
VOLATILITY = {f"volatility_{n}": _std("ret", n) for n in S.VOLATILITY_ROWS}
VOLUME = {"volume_sma_20": _mean("volume", 20), "volume_ratio": f"volume / nullif({_mean('volume', 20)}, 0)"}
TARGET = {
    "target_next_close": f"lead(close) {W}",
    "target_pct_change": f"(close / lead(close) {W} - 1) * 100",
    "target_direction": f"cast(coalesce(lead(close) {W} > close, false) as integer)",
}


def _calendar(d: str) -> dict[str, str]:
    last = f"cast({d} as date) = last_day(cast({d} as date))"
    return {
        "day_of_week": f"cast(isodow({d}) - 1 as integer)",
        "day_of_month": f"cast(day({d}) as integer)",
        "week_of_year": f"cast(weekofyear({d}) as integer)",
        "month": f"cast(month({d}) as integer)",
        "quarter": f"cast(quarter({d}) as integer)",
        "year": f"cast(year({d}) as integer)",
        "day_sin": f"sin(2 * pi() * (isodow({d}) - 1) / 7)",
        "day_cos": f"cos(2 * pi() * (isodow({d}) - 1) / 7)",
        "month_sin": f"sin(2 * pi() * month({d}) / 12)",
        "month_cos": f"cos(2 * pi() * month({d}) / 12)",
        "is_weekend": f"cast(isodow({d}) >= 6 as integer)",
        "is_month_start": f"cast(day({d}) = 1 as integer)",
        "is_month_end": f"cast({last} as integer)",
        "is_quarter_start": f"cast(day({d}) = 1 and month({d}) in (1, 4, 7, 10) as integer)",
        "is_quarter_end": f"cast({last} and month({d}) in (3, 6, 9, 12) as integer)",
    }


CALENDAR = _calendar("date")


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f"{x} as {name}" for name, x in columns.items())


def _rounded(columns: dict[str, str]) -> str:
    return ", ".join(f"round({x}, {PLACES[n]}) as {n}" if n in PLACES else f"{x} as {n}" for n, x in columns.items())


def _names(columns) -> str:
    return _rounded({c: c for c in columns})


def _over(bars: str, columns: dict[str, str], key: str = "series_key, date") -> str:
    return f"select {key}, {_rounded(columns)} from ({bars})"


def _recursion(bars: str, spans: dict[str, int], macd: bool = False) -> str:
    """CTEs ``numbered`` and ``ew``: the recursive means, one step per row of a series."""
    first = ", ".join(f"close as {name}" for name in spans)
    step = ", ".join(f"{2 / (n + 1)!r} * b.close + {1 - 2 / (n + 1)!r} * ew.{name}" for name, n in spans.items())
    if macd:
        a, q = 2 / 10, 1 - 2 / 10
        line = " - ".join(
            f"({2 / (n + 1)!r} * b.close + {1 - 2 / (n + 1)!r} * ew.{name})" for name, n in spans.items()
        )
        first += ", cast(0 as double) as macd_signal"
        step += f", {a!r} * ({line}) + {q!r} * ew.macd_signal"
    return f"""numbered as (select *, row_number() {W} as rn from ({bars})),
ew as (select series_key, date, rn, {first} from numbered where rn = 1
       union all
       select b.series_key, b.date, b.rn, {step} from ew join numbered b on b.series_key = ew.series_key and b.rn = ew.rn + 1)"""


EMA_SPANS = {f"ema_{n}": n for n in S.EMA_SPANS}
MACD = {
    "macd": "ema_12 - ema_26",
    "macd_signal": "macd_signal",
    "macd_histogram": "(ema_12 - ema_26) - macd_signal",
}
EMA = {"ema_12": "ema_12", "ema_26": "ema_26"}


def _ewm(bars: str, columns: dict[str, str], spans: dict[str, int], macd: bool, key: str = "series_key, date") -> str:
    return f"with recursive {_recursion(bars, spans, macd)} select {key}, {_rounded(columns)} from ew"


def _ewm_gaps(source: str, column: str, spans: dict[str, int]) -> str:
    """Recursion over rows: each mean, and the weight (relative to a new value's) that is left of it."""
    start = ", ".join(f"x as {n}, cast(1 as double) as w_{n}" for n in spans)
    steps = []
    for n, span in spans.items():
        q = 1 - 2 / (span + 1)
        steps.append(f"""case when s.x is null then e.{n} when e.{n} is null then s.x
            else (e.w_{n} * {q!r} * e.{n} + {1 - q!r} * s.x) / (e.w_{n} * {q!r} + {1 - q!r}) end,
            case when s.x is null and e.{n} is not null then e.w_{n} * {q!r} else 1 end""")
    return f"""with recursive src as (select series_key, date, {column} as x,
    row_number() over (partition by series_key order by date) as rn from ({source})),
ew as (select series_key, date, rn, {start} from src where rn = 1
union all select s.series_key, s.date, s.rn, {', '.join(steps)} from ew e join src s on s.series_key = e.series_key and s.rn = e.rn + 1)"""


CHANGES = f"""select *, close - lag(close) {W} as delta, lag(close) {W} as prev,
case when lag(close) {W} = 0 then null else close / lag(close) {W} - 1 end as ret from src"""
STEPS = f"""select *, coalesce(case when delta > 0 then delta end, 0) as gain,
coalesce(case when delta < 0 then -delta end, 0) as loss,
greatest(high - low, abs(high - prev), abs(low - prev)) as tr from changes"""


def _rsi_source(bars: str) -> str:
    return f"""with src as ({bars}), changes as ({CHANGES}), steps as ({STEPS}),
means as (select *, {_mean('gain', 14)} as mg, {_mean('loss', 14)} as ml from steps)"""


ATR = {"atr_14": _mean("tr", 14)}


def _features(bars: str) -> str:
    """CTE list ending in ``features``: bars, technical, calendar and target columns."""
    made = {**SMA, **RSI, **BANDS, **VOLATILITY, **ATR, **VOLUME, **TARGET, **CALENDAR}
    order = [*S.TECHNICAL, *S.CALENDAR, *S.TARGETS]
    return f"""recursive {_recursion(bars, EMA_SPANS, True)},
src as (select series_key, date, open, high, low, close, volume from ({bars})), changes as ({CHANGES}), steps as ({STEPS}),
means as (select *, {_mean('gain', 14)} as mg, {_mean('loss', 14)} as ml from steps),
windowed as (select series_key, date, open, high, low, close, volume, {_cols(made)} from means),
recursed as (select series_key, date, {_cols(EMA)}, {_cols(MACD)} from ew),
features as (select series_key, date, open, high, low, close, volume, {', '.join(order)}
             from windowed join recursed using (series_key, date))"""


NOT_NULL = " and ".join(f"{c} is not null" for c in [*S.BAR_VALUES, *S.TECHNICAL, *S.CALENDAR, *S.TARGETS])
FEATURES = f"with {_features(KEYED)}"
COMPLETE = f"{FEATURES}, complete as (select * from features where {NOT_NULL})"
PREPARED = f"""{COMPLETE}, prepared as (select *, case when row_number() {W} <= floor(count(*) over (partition by series_key) * 0.8)
then 'train' else 'test' end as split from complete)"""
INPUTS = [*S.TECHNICAL, *S.CALENDAR, "target_direction"]
FEATURE_ROW = f"series_key, date, open, high, low, close, volume, {_names([*S.TECHNICAL, *S.CALENDAR, *S.TARGETS])}"


def _rule(name: str, severity: str, violations: str, limit: int, source: str) -> str:
    return (
        f"select series_key, '{name}' as rule, '{severity}' as severity, cast(coalesce({violations}, 0) as bigint) as violations, "
        f"coalesce({violations}, 0) <= {limit} as passed from ({source}) group by series_key"
    )


NEGATIVE = "count(*) filter (where open < 0 or high < 0 or low < 0 or close < 0 or volume < 0)"
HIGH_LOW = "count(*) filter (where high < low)"
ZERO_VOLUME = "count(*) filter (where volume = 0)"


def _gaps(bars: str) -> str:
    return f"select series_key, date_diff('day', lag(date) {W}, date) as gap from ({bars})"


def _padded(bars: str) -> str:
    return f"""select series_key, c, lag(c) {W} as p from
(select series_key, date, last_value(close ignore nulls) over (partition by series_key order by date
rows between unbounded preceding and current row) as c from ({bars}))"""


GAPS, PADDED = _gaps(DEDUP), _padded(DEDUP)
OUTLIERS = "count(*) filter (where (p = 0 and c <> 0) or abs(c / nullif(p, 0) - 1) > 0.5)"


def _all_rules(bars: str) -> str:
    return " union all ".join(
        [
            _rule("negative", "error", NEGATIVE, 0, bars),
            _rule("high_low", "error", HIGH_LOW, 0, bars),
            _rule("zero_volume", "error", ZERO_VOLUME, 10, bars),
            _rule("date_gap", "warning", "max(gap)", 3, _gaps(bars)),
            _rule("outlier_change", "warning", OUTLIERS, 0, _padded(bars)),
        ]
    )


RULES = _all_rules(DEDUP)


def _interpolated(rows: str, column: str) -> str:
    before = "over (partition by series_key order by date rows between unbounded preceding and current row)"
    after = "over (partition by series_key order by date rows between current row and unbounded following)"
    return f"""select * replace (coalesce({column}, pv + (nv - pv) * (rn - pr) / (nr - pr), pv) as {column}) from (
select *, last_value({column} ignore nulls) {before} as pv, last_value(kr ignore nulls) {before} as pr,
first_value({column} ignore nulls) {after} as nv, first_value(kr ignore nulls) {after} as nr from (
select *, case when {column} is not null then rn end as kr from (select *, row_number() {W} as rn from ({rows}))))"""


def _zero_filled(rows: str, columns: tuple[str, ...] = S.PRICES) -> str:
    before = "over (partition by series_key order by date rows between unbounded preceding and current row)"
    filled = ", ".join(f"case when {c} = 0 then last_value(nullif({c}, 0) ignore nulls) {before} else {c} end as {c}" for c in columns)
    return f"select * replace ({filled}) from ({rows})"


FILLED = f"""select series_key, date, open, high, low, close, volume from ({_interpolated(DEDUP, 'close')})"""


def _numbered(prices: str) -> str:
    return f"""select *, row_number() over (partition by series_key order by timestamp) - 1 as rn,
count(*) over (partition by series_key) as n from ({prices})"""


def _sequences(prices: str, t: int = 30) -> str:
    w = "over (partition by series_key order by timestamp)"
    lags = ", ".join(f"lead(price, {k}) {w} as lag_{t - k}" for k in range(t))
    return f"""select series_key, rn as seq, n - {t} as sequences, {lags}, lead(price, {t}) {w} as label,
lead(timestamp, {t}) {w} as label_time from ({_numbered(prices)}) qualify rn + {t} < n"""


def _folds(prices: str, t: int = 30, folds: int = 5, step: int = 1) -> str:
    """CTEs ``num``, ``pairs``, ``fold`` (start of each) and ``scaler``."""
    w = "over (partition by series_key order by timestamp)"
    return f"""num as ({_numbered(prices)}),
pairs as (select series_key, rn - {t - 1} as seq, price as x, lead(price) {w} as y, lead(timestamp) {w} as y_time from num),
fold as (select series_key, f as fold, max(n) - {t + 2} - ({folds - 1} - f) * {step} as start from num, range({folds}) r(f) group by 1, 2
         having max(n) - {t + 2} - ({folds - 1} - f) * {step} >= 1),
scaler as (select fold.series_key, fold, start, min(price) as price_min, max(price) as price_max
           from fold join num on num.series_key = fold.series_key and rn <= start + {t - 2} group by 1, 2, 3)"""


def _held(prices: str, t: int = 30) -> str:
    return f"""with {_folds(prices, t)}
select s.series_key, cast(s.fold as integer) as fold, case rn - start - {t} when 0 then 'test' else 'validation' end as role,
rn - {t} as seq, price_min, price_max, price as label,
round((price - price_min) / case when price_max = price_min then 1 else price_max - price_min end, 10) as scaled
from scaler s join num on num.series_key = s.series_key and rn - start - {t} in (0, 1)"""


def _lr2(prices: str, folds: int = 5, step: int = 1) -> str:
    """Least squares on two lags in closed form, per series and fold."""
    w = "over (partition by series_key order by timestamp)"
    return f"""with {_folds(prices, 2, folds, step)},
q as (select series_key, rn - 1 as seq, lag(price) {w} as a, price as b, lead(price) {w} as y, lead(timestamp) {w} as time from num),
g as (select s.series_key, s.fold, var_pop(a) as vaa, var_pop(b) as vbb, covar_pop(a, b) as vab, covar_pop(a, y) as vay,
  covar_pop(b, y) as vby, avg(a) as ma, avg(b) as mb, avg(y) as my
  from scaler s join q on q.series_key = s.series_key and q.seq >= 0 and q.seq < s.start group by 1, 2)
select s.series_key, cast(s.fold as integer) as fold, q.time, q.y as actual,
round(my + (vay * vbb - vby * vab) / (vaa * vbb - vab * vab) * (q.a - ma)
  + (vby * vaa - vay * vab) / (vaa * vbb - vab * vab) * (q.b - mb), 4) as predicted
from scaler s join g using (series_key, fold) join q on q.series_key = s.series_key and q.seq = s.start + 1"""


def _ar1(prices: str, folds: int = 5, step: int = 1) -> str:
    """CTE list ending in ``forecasts``."""
    return f"""{_folds(prices, 30, folds, step)},
scaled as (select s.series_key, s.fold, s.start, p.seq, p.y_time, p.y as actual, price_min, price_max,
  (p.x - price_min) / (price_max - price_min) as x, (p.y - price_min) / (price_max - price_min) as y
  from scaler s join pairs p on p.series_key = s.series_key and p.seq between 0 and s.start + 1),
fit as (select series_key, fold, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept
        from scaled where seq < start group by 1, 2),
forecasts as (select series_key, cast(fold as integer) as fold, y_time as time, actual,
  (intercept + slope * x) * (price_max - price_min) + price_min as predicted
  from scaled join fit using (series_key, fold) where seq = start + 1)"""


def _union_values(source: str, table: str, columns: list[str], values: dict[str, str]) -> str:
    rows = " union all ".join(
        f"select cast({i} as integer) as position, '{c}' as feature, "
        + ", ".join(f"{x.format(c=c)} as {name}" for name, x in values.items())
        + f" from {table}"
        for i, c in enumerate(columns, 1)
    )
    return f"{source} {rows}"


CORRELATED = [*S.BAR_VALUES, *S.TECHNICAL, *S.CALENDAR, *S.TARGETS]
CORRELATION = _union_values(
    FEATURES, "features", CORRELATED,
    {"correlation": "case when stddev_pop({c}) > 0 then corr({c}, target_direction) end"},
)

KEYED_PRICES, DAILY_PRICES = _prices(KEYED), _prices(DAILY)
TICK_PRICES = f"select series_key, date as timestamp, close as price from ({TICKS})"
PAYLOAD = """select event_id as quote_id, value * 1000 as price_usd,
case when event_id % 7 <> 0 then value * 10 else 0 end as volume_24h,
case when event_id % 11 <> 0 then value / 100 else 0 end as change_24h,
case when event_id % 13 <> 0 then cast(date_trunc('second', ts) as timestamp) else timestamp '1970-01-01' end as last_updated
from events"""
STAMPED = "select series_key, cast(date as timestamp) as date, open, high, low, close, volume"


def oracle_sql() -> dict[str, str]:
    sql = {
        # Sources, sinks, payloads
        "scan_parquet": "select o_orderkey, o_totalprice, o_orderdate from orders",
        "sink_parquet": f"{STAMPED} from ({KEYED})",
        "scan_latest_snapshot": f"{STAMPED} from ({KEYED})",
        "scan_latest_partition": f"{STAMPED} from ({KEYED})",
        "sma_bucketed": _over(KEYED, SMA),
        "sink_csv": KEYED_PRICES,
        "scan_csv": DAILY_PRICES,
        "sink_json_quote": "select ts as timestamp, value * 1000 as price_usd from events",
        "scan_json_quotes": """select ts as timestamp, value * 1000 as price_usd, value * 10 as volume_24h, value / 100 as change_24h,
            cast(date_trunc('second', ts) as timestamp) as last_updated from events""",
        "decode_market_chart": f"""with p as (select *, lag(date_trunc('month', timestamp)) over (partition by series_key order by timestamp) as before
            from ({DAILY_PRICES})) select series_key, timestamp, price from p
            union all select series_key, timestamp, price from p where before < date_trunc('month', timestamp)""",
        "market_chart_history": f"""select series_key, timestamp + interval 1 hour as timestamp, price from ({DAILY_PRICES})
            qualify row_number() over (partition by series_key order by timestamp desc) > 1""",
        "decode_quote": PAYLOAD,
        "decode_ticker": f"select quote_id, price_usd as price from ({QUOTES})",
        "require_non_empty": KEYED,
        # Series assembly and scalars
        "epoch_ms_to_ts": "select event_id, cast(date_trunc('millisecond', ts) as timestamp) as ts from events",
        "shift_hours": "select event_id, ts + interval 1 hour as ts from events",
        "drop_last_row": f"""select * from ({KEYED_PRICES})
            qualify row_number() over (partition by series_key order by timestamp desc) > 1""",
        "append_row": f"{DAILY_PRICES} union all select 'ALL', timestamp, price_usd from ({QUOTES})",
        "round_price": "select event_id, round_even(value * 0.125 * 100, 0) / 100 as price from events",
        "cast_datetime": "select o_orderkey, cast(cast(o_orderdate as varchar) as timestamp) as date from orders",
        "sort_by_date": f"select series_key, date, close, row_number() {W} - 1 as row_no from ({HOURLY})",
        # Cleaning
        "count_duplicates": f"select count(*) - count(distinct (series_key, date)) as duplicates from ({DIRTY})",
        "dedup_keep_last": f"""select series_key, date, seq, open, high, low, close, volume from ({DIRTY})
            qualify row_number() over (partition by series_key, date order by seq desc) = 1""",
        "dedup_ties": DEDUP_TIES,
        "null_census": f"select 'close' as column_name, count(*) as nulls from ({DIRTY}) where close is null having count(*) > 0",
        "interpolate_linear": f"select * replace (round(close, 6) as close) from ({FILLED})",
        "invalid_price_census": " union all ".join(
            f"select '{c}' as column_name, count(*) filter (where {c} <= 0) as invalid from ({DIRTY})" for c in S.PRICES
        ),
        "zero_to_previous": _zero_filled(DEDUP),
        "clean_metrics": f"""select count(*) as rows_in, count(distinct (series_key, date)) as rows_out,
            count(*) - count(distinct (series_key, date)) as rows_removed from ({DIRTY})""",
        "clean_bars": f"select * replace (round(close, 6) as close) from ({_zero_filled(FILLED)})",
        # Validation
        "val_negative": _rule("negative", "error", NEGATIVE, 0, DIRTY),
        "val_high_low": _rule("high_low", "error", HIGH_LOW, 0, DIRTY),
        "val_date_gap": _rule("date_gap", "warning", "max(gap)", 3, GAPS),
        "val_outlier_change": _rule("outlier_change", "warning", OUTLIERS, 0, PADDED),
        "val_zero_volume": _rule("zero_volume", "error", ZERO_VOLUME, 10, DIRTY),
        "validate_bars": RULES,
        "validate_by_supplier": _all_rules(SUPPLIER),
        "val_verdict": f"""select series_key, count(*) filter (where not passed and severity = 'error') as errors,
            count(*) filter (where not passed and severity = 'warning') as warnings,
            count(*) filter (where not passed and severity = 'error') = 0 as valid from ({RULES}) group by 1""",
        "val_quote": f"""select *, case when price_usd is null or price_usd <= 0 then 'error'
            when price_usd < 1000 or price_usd > 500000 then 'warning' else 'ok' end as severity from ({QUOTES})""",
        # Window primitives
        "rolling_mean": _over(KEYED, {"mean_5": f"round({_mean('close', 5)}, 6)"}),
        "rolling_std": _over(KEYED, {"std_5": f"round({_std('close', 5)}, 4)"}),
        "ewm_mean": _ewm(KEYED, {"ewm_5": "round(ewm_5, 4)"}, {"ewm_5": 5}, False),
        "rolling_infinite": f"""with x as (select series_key, date, case when dayofyear(date) % 31 = 0 then null else 1.0 end as x from ({KEYED}))
            select series_key, date, round({_mean('x', 5)}, 8) as mean_5, round({_std('x', 5)}, 6) as std_5 from x""",
        "diff": _over(KEYED, {"change": f"round(close - lag(close) {W}, 6)"}),
        "shift": _over(KEYED, {"before": f"lag(close, 2) {W}", "after": f"lead(close, 2) {W}"}),
        "pct_change": _over(KEYED, {"change": f"round(close / lag(close) {W} - 1, 8)"}),
        "row_max": _over(KEYED, {"highest": f"greatest(lag(high) {W}, close, open)"}),
        "where": _over(KEYED, {"gain": f"round(case when close > lag(close) {W} then close - lag(close) {W} else 0 end, 6)"}),
        # Indicators
        "sma": _over(KEYED, SMA),
        "ewm_mean_gappy": _ewm_gaps(f"""select * replace (case when dayofyear(date) % 7 <> 0 and month(date) <> 5 then close end as close)
            from ({KEYED})""", "close", {"ewm_5": 5, "ewm_26": 26})
        + " select series_key, date, round(ewm_5, 4) as ewm_5, round(ewm_26, 4) as ewm_26 from ew",
        "ewm_mean_gappy_long": _ewm_gaps(TICKS, "patchy", {"ewm_12": 12}) + " select date, round(ewm_12, 6) as ewm_12 from ew",
        "ema": _ewm(KEYED, EMA, EMA_SPANS, False),
        "rsi": f"{_rsi_source(KEYED)} select series_key, date, {_rounded(RSI)} from means",
        "macd": _ewm(KEYED, MACD, EMA_SPANS, True),
        "bollinger": _over(KEYED, BANDS),
        "volatility": f"{_rsi_source(KEYED)} select series_key, date, {_rounded(VOLATILITY)} from means",
        "atr": f"{_rsi_source(KEYED)} select series_key, date, {_rounded(ATR)} from means",
        "volume_features": _over(KEYED, VOLUME),
        "technical_features": f"{FEATURES} select series_key, date, open, high, low, close, volume, {_names(S.TECHNICAL)} from features",
        "technical_by_supplier": f"with {_features(SUPPLIER)} select series_key, date, {_names(S.TECHNICAL)} from features",
        # One long series
        "sma_long": _over(TICKS, SMA, "date"),
        "macd_long": _ewm(TICKS, MACD, EMA_SPANS, True, "date"),
        "interpolate_long": f"select date, round(patchy, 6) as patchy from ({_interpolated(TICKS, 'patchy')})",
        "split_long": f"""select date, case when row_number() {W} <= floor(count(*) over (partition by series_key) * 0.8)
            then 'train' else 'test' end as split from ({TICKS})""",
        "targets_long": f"""select date, target_next_close, round(target_pct_change, 6) as target_pct_change, target_direction
            from (select date, {_cols(TARGET)} from ({TICKS}))""",
        "sequences_long": f"select seq, lag_30, lag_2, lag_1, label, label_time from ({_sequences(TICK_PRICES)})",
        # Calendar
        "cal_parts": _over(KEYED, {c: CALENDAR[c] for c in S.CALENDAR_PARTS}),
        "cal_cyclic": _over(KEYED, {c: CALENDAR[c] for c in S.CALENDAR_CYCLES}),
        "cal_flags": _over(KEYED, {c: CALENDAR[c] for c in S.CALENDAR_FLAGS}),
        "calendar_features": f"select event_id, ts, {_rounded(_calendar('ts'))} from events",
        # Targets
        "target_next_close": _over(KEYED, {"target_next_close": TARGET["target_next_close"]}),
        "target_pct_change": _over(KEYED, {"target_pct_change": TARGET["target_pct_change"]}),
        "target_direction": _over(KEYED, {"target_direction": TARGET["target_direction"]}),
        "forward_return": _over(KEYED, {"forward_return": f"round((lead(close) {W} / close - 1) * 100, 8)"}),
        "target_stats": f"""with src as ({KEYED}), x as (select close, lead(close) {W} as nxt from src)
            select round(avg(nxt), 6) as mean_next_close, round(avg((close / nxt - 1) * 100), 6) as mean_pct_change,
            count(*) filter (where nxt > close) as days_up, count(*) - count(*) filter (where nxt > close) as days_down,
            round(count(*) filter (where nxt > close) * 100.0 / count(*), 6) as share_up,
            round((count(*) - count(*) filter (where nxt > close)) * 100.0 / count(*), 6) as share_down from x""",
        # Data set
        "feature_rows": f"{FEATURES} select {FEATURE_ROW} from features",
        "drop_incomplete_rows": f"{COMPLETE} select series_key, date, {_names(["sma_200", "rsi_14"])} from complete",
        "drop_incomplete_hourly": f"with {_features(HOURLY)} select series_key, date, {_names(["sma_200", "rsi_14"])} from features where {NOT_NULL}",
        "select_features": f"{FEATURES} select series_key, date, {_names(INPUTS)} from features",
        "select_features_without_label": f"{FEATURES} select series_key, date, {_names(INPUTS[:-1])} from features",
        "label_column": f"{FEATURES} select series_key, date, target_direction as target from features",
        "reference_prices": f"{FEATURES} select series_key, date, close, target_next_close from features",
        "temporal_split": f"{PREPARED} select series_key, date, split from prepared",
        "split_periods": f"""{PREPARED} select split, count(*) as "rows", min(date) as first_date, max(date) as last_date,
            round(avg(close), 6) as mean_close, cast(sum(target_direction) as bigint) as days_up,
            cast(count(*) - sum(target_direction) as bigint) as days_down from prepared group by split""",
        "write_bundle": f"""{PREPARED} select series_key, date, round(sma_7, 6) as sma_7, round(rsi_14, 6) as rsi_14, month,
            cast({len(INPUTS)} as integer) as features, split, target_direction as target, close, target_next_close from prepared""",
        # Profiles and reports
        "load_summary": f"""select count(*) as "rows", min(date) as first_date, max(date) as last_date, round(avg(close), 6) as mean_close,
            max(high) as max_high, min(low) as min_low, cast(7 as integer) as columns from ({KEYED})""",
        "price_report": f"""select count(*) as "rows", max(high) as max_high, min(low) as min_low, round(avg(close), 6) as mean_close,
            round(stddev_samp(close), 4) as std_close from ({KEYED})""",
        "price_report_by_supplier": f"""select series_key, count(*) as "rows", max(high) as max_high, min(low) as min_low,
            round(avg(close), 5) as mean_close, round(stddev_samp(close), 4) as std_close from ({SUPPLIER}) group by 1""",
        "target_profile_by_supplier": f"""with src as ({SUPPLIER}), x as (select series_key, (close / lead(close) {W} - 1) * 100 as pct,
            coalesce(lead(close) {W} > close, false) as up from src)
            select series_key, count(*) filter (where up) as days_up, count(*) filter (where not up) as days_down, round(avg(pct), 6) as mean,
            round(stddev_samp(pct), 6) as std, round(max(pct), 6) as max, round(min(pct), 6) as min, round(median(pct), 6) as median
            from x group by 1""",
        "target_correlation_by_supplier": " union all ".join(
            f"""select series_key, cast({i} as integer) as position, '{c}' as feature,
            round(case when stddev_pop({c}) > 0 and stddev_pop(t) > 0 then corr({c}, t) end, 6) as correlation
            from (select *, case when coalesce(lead(close) {W} > close, false) then 1.0::double else 0.0::double end as t from ({SUPPLIER})) group by 1"""
            for i, c in enumerate(("open", "close", "volume"), 1)
        ),
        "quote_vs_mean": f"""with m as (select series_key, avg(close) as mean from ({KEYED}) group by 1),
            q as (select *, {list(PRIORITIES)}[quote_id % 5 + 1] as series_key from ({QUOTES}))
            select series_key, quote_id, price_usd, round(mean, 4) as mean_close, case when price_usd > mean then '+' when price_usd is not null and mean is not null then '-' end as sign,
            round(abs(price_usd - mean), 4) as difference, round(abs((price_usd - mean) / mean * 100), 6) as percent
            from q left join m using (series_key)""",
        "feature_report": f"""{PREPARED}, sizes as (select count(*) filter (where split = 'train') as train,
            count(*) filter (where split = 'test') as test from prepared),
            b as (select count(*) as n, sum(target_direction) as up, avg((close / target_next_close - 1) * 100) as pct from features)
            select unnest(['features', 'technical_features', 'calendar_features', 'train_rows', 'test_rows', 'train_percent',
              'test_percent', 'days_up', 'days_down', 'percent_up', 'percent_down', 'mean_pct_change']) as metric,
            round(unnest([{len(INPUTS)}::double, {len(S.TECHNICAL)}::double, {len(S.CALENDAR)}::double, train::double, test::double,
              train * 100.0::double / (train + test), test * 100.0::double / (train + test), up::double, (n - up)::double,
              up * 100.0::double / n, (n - up) * 100.0::double / n, pct]), 6) as value from sizes, b""",
        "rsi_stats": f"""{_rsi_source(KEYED)}, r as (select case when ml = 0 then case when mg > 0 then 100.0 end
            else 100 - 100 / (1 + mg / ml) end as x from means) select round(avg(x), 6) as mean, round(min(x), 6) as min,
            round(max(x), 6) as max, count(*) filter (where x > 70) as overbought, count(*) filter (where x < 30) as oversold from r""",
        "macd_stats": f"""with recursive {_recursion(KEYED, EMA_SPANS, True)} select round(avg(ema_12 - ema_26), 4) as mean,
            count(*) filter (where ema_12 - ema_26 > macd_signal) as bullish,
            count(*) filter (where ema_12 - ema_26 < macd_signal) as bearish from ew""",
        "volatility_stats": f"{_rsi_source(KEYED)}, v as (select {', '.join(f'{_std('ret', n)} as v{n}' for n in S.VOLATILITY_ROWS)} from means) select "
        + ", ".join(f"round(avg(v{n}), 8) as mean_volatility_{n}" for n in S.VOLATILITY_ROWS)
        + " from v",
        "target_profile": f"""with src as ({KEYED}), x as (select (close / lead(close) {W} - 1) * 100 as pct,
            coalesce(lead(close) {W} > close, false) as up from src)
            select count(*) filter (where up) as days_up, count(*) filter (where not up) as days_down, round(avg(pct), 6) as mean,
            round(stddev_samp(pct), 6) as std, round(max(pct), 6) as max, round(min(pct), 6) as min, round(median(pct), 6) as median from x""",
        "exact_median": "select l_returnflag, round(median(l_extendedprice), 6) as median from lineitem group by 1",
        "exact_median_long": "select round(median(l_extendedprice), 6) as median from lineitem",
        "class_balance": f"""{PREPARED}, c as (select count(*) filter (where target_direction = 0) as a,
            count(*) filter (where target_direction = 1) as b, count(*) as n from prepared)
            select a as class_0, b as class_1, round(a * 100.0::double / n, 6) as percent_0, round(b * 100.0::double / n, 6) as percent_1,
            round(least(a, b)::double / greatest(a, b), 6) as ratio, least(a, b)::double / greatest(a, b) > 0.4 as balanced from c""",
        "describe_features": _union_values(
            PREPARED + ", train as (select * from prepared where split = 'train')", "train", INPUTS,
            {"mean": "round(avg({c}), 4)", "std": "round(stddev_samp({c}), 4)",
             "min": "round(min({c})::double, 6)", "max": "round(max({c})::double, 6)"},
        ),
        "target_correlation": f"select position, feature, round(correlation, 8) as correlation from ({CORRELATION})",
        "top_k_correlation": f"""with c as ({CORRELATION}), r as (select *, row_number() over (order by correlation desc nulls last, position) as rank,
            count(*) over () as total from c)
            select 'highest' as side, cast(rank as integer) as place, feature, round(correlation, 8) as correlation
            from r where rank <= 15 and feature <> 'target_direction'
            union all select 'lowest', cast(rank - (total - 15) as integer), feature, round(correlation, 8)
            from r where rank > total - 15 and feature not in ('target_next_close', 'target_pct_change', 'target_direction')""",
        "nan_census": "select * from ("
        + _union_values(FEATURES, "features", INPUTS, {"missing": "count(*) filter (where {c} is null)"})
        + f" union all select 0, 'total', cast({' + '.join(f'count(*) filter (where {c} is null)' for c in INPUTS)} as bigint) from features)",
        "inf_census": """select cast(1 as integer) as position, 'event_id' as feature, cast(0 as bigint) as infinite
            union all select 2, 'share', count(*) filter (where event_id % 5 = 0 and value <> 0) from events
            union all select 3, 'value', 0""",
        "duplicate_rows": """select count(*) - (select count(*) from (select distinct l_partkey, l_suppkey, l_quantity from lineitem)) as duplicates
            from lineitem""",
        "feature_ranges": _union_values(
            PREPARED + ", train as (select * from prepared where split = 'train')", "train", INPUTS,
            {"min": "round(min({c})::double, 6)", "max": "round(max({c})::double, 6)", "mean": "round(avg({c}), 4)"},
        ),
        # Sequences and forecasts
        "make_sequences": f"select * exclude (sequences) from ({_sequences(KEYED_PRICES)})",
        "minmax_scale": _held(KEYED_PRICES),
        "inverse_minmax": f"select series_key, fold, role, seq, round(label, 6) as price from ({_held(KEYED_PRICES)})",
        "walk_forward_folds": f"""select * from (select series_key, seq, cast(f as integer) as fold,
            case when seq < sequences - 6 + f then 'train' when seq = sequences - 6 + f then 'test'
            when seq = sequences - 5 + f then 'validation' end as role
            from ({_sequences(DAILY_PRICES)}), range(5) r(f)) where role is not null""",
        "walk_forward_forecast": f"""with {_ar1(KEYED_PRICES)}
            select series_key, fold, time, actual, round(predicted, 4) as predicted from forecasts""",
        "walk_forward_long": f"""with {_ar1(TICK_PRICES)}
            select series_key, fold, time, actual, round(predicted, 6) as predicted from forecasts""",
        "walk_forward_folds_stride": f"""select * from (select series_key, seq, cast(f as integer) as fold,
            unnest(list_filter([case when seq < sequences - 2 - (6 - f) * 20 then 'train' end,
            case when seq = sequences - 2 - (6 - f) * 20 then 'test' end,
            case when seq = sequences - 1 - (6 - f) * 20 then 'validation' end], lambda x: x is not null)) as role
            from ({_sequences(KEYED_PRICES)}), range(7) r(f) where sequences - 2 - (6 - f) * 20 >= 1)""",
        "fold_spans": f"""with s as (select series_key, seq, sequences, f, sequences - 2 - (6 - f) * 20 as start
            from ({_sequences(KEYED_PRICES)}), range(7) r(f))
            select series_key, seq, cast(min(f) filter (start >= 1 and seq < start) as integer) as train_from,
            cast(min(f) filter (start >= 1 and seq = start) as integer) as test_fold,
            cast(min(f) filter (start >= 1 and seq = start + 1) as integer) as validation_fold from s group by 1, 2""",
        "sequence_blocks": f"""with num as ({_numbered(TICK_PRICES)}),
            b as (select series_key, rn, price, timestamp, n - 30 as sequences, unnest([rn // 500, rn // 500 - 1]) as block, rn % 500 as off,
            rn // 500 as home from num)
            select block * 500 as first, cast(least(500, max(sequences) - block * 500) as integer) as count, max(sequences) as sequences,
            cast(count(*) as integer) as stored, round(sum(price), 4) as total, max(timestamp) as newest
            from b where block = home or (off < 30 and block >= 0) group by series_key, block having block * 500 < max(sequences)""",
        "walk_forward_stride": f"""with {_ar1(KEYED_PRICES, 7, 20)}
            select series_key, fold, time, actual, round(predicted, 4) as predicted from forecasts""",
        "walk_forward_lr_stride": _lr2(KEYED_PRICES, 12, 25),
        "walk_forward_lr_long": f"select * exclude (series_key) from ({_lr2(TICK_PRICES, 40, 30)})",
        "walk_forward_lr": _lr2(KEYED_PRICES),
        "walk_forward_by_supplier": f"""with {_ar1(_prices(SUPPLIER))}
            select series_key, fold, time, actual, round(predicted, 3) as predicted from forecasts""",
        "sequences_gappy": f"""select * exclude (sequences) from ({_sequences(
            f"select series_key, timestamp, case when dayofyear(timestamp) % 7 <> 0 then price end as price from ({KEYED_PRICES})", 4)})""",
        "forecast_error": f"""with {_ar1(KEYED_PRICES)} select series_key, fold, time, actual, round(predicted, 4) as predicted,
            round(actual - predicted, 4) as error from forecasts""",
        "error_summary": f"""with {_ar1(KEYED_PRICES)} select series_key, count(*) as folds, round(avg(abs(actual - predicted)), 4) as mae,
            round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) as rmse from forecasts group by 1""",
        "quote_deviation": f"""with {_ar1(KEYED_PRICES)}, q as (select series_key, arg_max(price, timestamp) as current from ({KEYED_PRICES}) group by 1)
            select series_key, current, round(predicted, 4) as predicted, round(abs(current - predicted) / current * 100, 6) as percent_off
            from forecasts join q using (series_key) where fold = 4""",
    }
    return sql
