"""Shared helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def broadcast_fixed(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is fixed by construction (a literal seed
    list, a k x k model table, the 25-row nation / 5-row region tables)."""
    return F.broadcast(df)
