"""Dense ranks and look-ups that no hot key and no single task can hold up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

# A key is hot with more than one in HOT_SHARE of all rows, so that fewer than
# HOT_SHARE keys are: the bound of what is broadcast.
HOT_SHARE = 1000
_IN_PART = (1 << 33) - 1      # monotonically_increasing_id: partition above, row below


def ordered(df: DataFrame, order: list[Column], at: str = "__at") -> DataFrame:
    """``df`` sorted over the cluster, with the place of each row as ``at``
    (partition and row within it) and checkpointed, so that places stay."""
    return cut_lineage(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()))


def ranks(placed: DataFrame, by: list[str], at: str = "__at", rank: str = "rank") -> DataFrame:
    """0-based rank of each row of an ``ordered`` table among the rows of its
    ``by`` (the leading columns of the order; may be empty), in place of
    ``at``.  What meets in one task is one row per (partition, ``by``)."""
    part = F.shiftright(at, 33)
    runs = placed.groupBy(part.alias("__part"), *by).agg(F.min(at).alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("__part", *[F.col(c).alias(f"__{c}") for c in by],
                       (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    same = (part == F.col("__part"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    kept = [F.col(c) for c in placed.columns if c != at]
    return placed.join(runs, same).select(*kept, (F.col(at) + F.col("__shift")).alias(rank))


def look_up(rows: DataFrame, found: DataFrame, keys: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``found`` (one row per ``keys``, ``n`` of
    ``rows`` each; dropped) of its keys, null-safe.

    Keys with more than one in HOT_SHARE of the ``total`` rows, fewer than
    HOT_SHARE of them, are broadcast and never shuffled; no other key holds
    more than that share of a shuffled join.  ``how``: inner or left.
    """
    extra = [c for c in found.columns if c not in (*keys, n)]
    side = found.select(*[F.col(k).alias(f"__{k}") for k in keys], *extra, n)
    is_hot = F.col(n) * HOT_SHARE > total
    hot, cold = side.where(is_hot).drop(n), side.where(~is_hot).drop(n)

    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = [F.col(c) for c in (*rows.columns, *extra)]
    near = rows.join(F.broadcast(hot), same, "inner").select(*out)
    rest = rows.join(F.broadcast(hot.select(*[f"__{k}" for k in keys])), same, "left_anti")
    return near.unionByName(rest.join(cold, same, how).select(*out))
