"""Incremental windows (ST-2): the part of an incremental load that decides
which arriving rows are new for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_start(stored: DataFrame, key: list[str], ts: str, start: str | None) -> DataFrame:
    """Per key: the later of (stored max date + 1 day) and ``start``."""
    hw = stored.groupBy(*key).agg(F.date_add(F.max(F.to_date(ts)), 1).alias("_hw"))
    s = F.to_date(F.lit(start)) if start else None
    first = F.greatest(F.col("_hw"), s) if s is not None else F.col("_hw")
    return hw.select(*key, first.alias("window_start"))


def arriving_after_high_water(arriving: DataFrame, stored: DataFrame, key: list[str], ts: str,
                              start: str | None) -> DataFrame:
    """Arriving rows on or after their key's window start; keys with no
    stored rows start at ``start`` (or take everything when no start)."""
    ws = window_start(stored, key, ts, start)
    j = arriving.join(ws, key, "left")
    s = F.to_date(F.lit(start)) if start else None
    begin = F.coalesce(F.col("window_start"), s) if s is not None else F.col("window_start")
    keep = begin.isNull() | (F.to_date(ts) >= begin)
    return j.where(keep).drop("window_start")
