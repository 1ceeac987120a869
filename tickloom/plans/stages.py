"""Columns that build on each other, merged level by level.

An indicator is a list of levels, each a ``name -> Column`` mapping that may refer to earlier levels:
looks at neighbouring rows, values of a row, frames over rows, results. Building several indicators
level by level lets Spark compute all looks in one window pass and all frames in another; a helper two
indicators share is computed once.
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame

Levels = list[dict[str, Column]]


def add_levels(df: DataFrame, *indicators: Levels) -> DataFrame:
    for level in zip_longest(*indicators, fillvalue={}):
        merged: dict[str, Column] = {}
        for columns in level:
            merged |= columns
        if merged:
            df = df.withColumns(merged)
    return df
