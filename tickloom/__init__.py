"""Ordered time-series features on Spark: clean, validate, enrich, split, profile and forecast bar tables."""

from tickloom.plans.series import DAILY, Series
from tickloom.session import build_session

__all__ = ["DAILY", "Series", "build_session"]
