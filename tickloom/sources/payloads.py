"""Decoders for landed price-provider payloads (JSON text columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import epoch_ms_to_ts, shift_hours

QUOTE_FIELDS = "MAP<STRING, STRUCT<usd: DOUBLE, usd_24h_vol: DOUBLE, usd_24h_change: DOUBLE, last_updated_at: BIGINT>>"


def decode_market_chart(df: DataFrame, payload: str = "payload", complete: bool = False) -> DataFrame:
    """``{"prices": [[epoch_ms, price], ...]}`` to one row per pair, with its place in the payload.

    A payload without prices raises while the query runs. ``complete`` leaves out the last pair of each
    payload, the period that was unfinished when it landed.
    """
    parsed = F.from_json(F.col(payload), "prices ARRAY<ARRAY<DOUBLE>>")["prices"]
    parsed = F.coalesce(parsed, _refuse("no prices", payload).cast("array<array<double>>"))
    if complete:
        parsed = F.slice(parsed, 1, F.greatest(F.size(parsed) - 1, F.lit(0)))
    rest = [c for c in df.columns if c != payload]
    pairs = df.select(*rest, F.posexplode(parsed).alias("position", "pair"))
    return pairs.select(
        *rest,
        "position",
        epoch_ms_to_ts(F.col("pair")[0]).alias("timestamp"),
        F.col("pair")[1].alias("price"),
    )


def market_chart_history(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Decoded history without the unfinished last period of each payload, shifted to local time."""
    complete = decode_market_chart(df, payload, complete=True).drop("position")
    return complete.withColumn("timestamp", shift_hours(F.col("timestamp"), 1))


def _refuse(what: str, payload: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what} in "), F.coalesce(F.col(payload), F.lit("NULL"))))


def _checked(df: DataFrame, price: Column, what: str, payload: str, on_missing: str) -> tuple[DataFrame, Column]:
    if on_missing == "raise":
        return df, F.coalesce(price, _refuse(what, payload).cast("double"))
    if on_missing == "drop":
        return df.filter(price.isNotNull()), price
    raise ValueError(f"on_missing is 'raise' or 'drop', not {on_missing!r}")


def _entity(df: DataFrame, payload: str, entity: str) -> DataFrame:
    return df.withColumn("_entity", F.try_element_at(F.from_json(F.col(payload), QUOTE_FIELDS), F.lit(entity)))


def decode_quote(df: DataFrame, entity: str, payload: str = "payload", on_missing: str = "raise") -> DataFrame:
    """Quote of ``entity``: a missing volume or change is 0, a missing update time is the epoch.

    A payload without the entity or its price raises while the query runs, or is left out with
    ``on_missing="drop"``; ``rejected_quotes`` lists those.
    """
    found, price = _checked(
        _entity(df, payload, entity), F.col("_entity.usd"), f"no quote of {entity}", payload, on_missing
    )
    zero = F.lit(0.0)
    return found.withColumns(
        {
            "price_usd": price,
            "volume_24h": F.coalesce(F.col("_entity.usd_24h_vol"), zero),
            "change_24h": F.coalesce(F.col("_entity.usd_24h_change"), zero),
            "last_updated": F.timestamp_seconds(F.coalesce(F.col("_entity.last_updated_at"), F.lit(0))),
        }
    ).drop("_entity", payload)


def rejected_quotes(df: DataFrame, entity: str, payload: str = "payload") -> DataFrame:
    return _entity(df, payload, entity).filter(F.col("_entity.usd").isNull()).drop("_entity")


def decode_ticker(df: DataFrame, payload: str = "payload", on_missing: str = "raise") -> DataFrame:
    """``{"price": "<decimal text>"}`` to a number; a payload without one raises or, with "drop", is left out."""
    price = F.get_json_object(F.col(payload), "$.price").try_cast("double")
    found, price = _checked(df, price, "no price", payload, on_missing)
    return found.withColumn("price", price).drop(payload)
