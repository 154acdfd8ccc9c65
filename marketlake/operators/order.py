"""Order-dependent operators and set operations (WIN-*, SET-*).

De-duplication uses ``max_by`` / ``min_by`` aggregation (partial, skew safe)
instead of a ``row_number`` window over the key.

Time-ordered fills and lags use a *segmented scan*: the window runs per
(key, time bucket), so one hot key is spread over as many tasks as it has
buckets; a small per-bucket summary (one row per key and bucket) carries
the last / first non-null value across bucket edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --------------------------------------------------------------------- WIN-1
def keep_last(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    """One row per key: the row that is last in ``seq`` order (ties broken by
    every other column, so the result is deterministic)."""
    others = [c for c in df.columns if c not in key]
    order = F.struct(*[F.col(c) for c in seq], *[F.col(c) for c in others if c not in seq])
    best = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_r"))
    return best.select(*key, "_r.*")


# --------------------------------------------------------------------- WIN-2
def keep_first(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    others = [c for c in df.columns if c not in key]
    order = F.struct(*[F.col(c) for c in seq], *[F.col(c) for c in others if c not in seq])
    best = df.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_r"))
    return best.select(*key, "_r.*")


# ------------------------------------------------------------- segmented scan
def _carry_table(local: DataFrame, key: list[str], bucket: str, values: list[str]) -> DataFrame:
    """Per (key, bucket): the values carried in from earlier buckets (last
    non-null) and from later buckets (first non-null).

    Built from the windowed frame, which is already partitioned by
    (key, bucket): the per-bucket summary needs no shuffle, and the window
    over buckets runs on one row per bucket, not on data rows."""
    aggs = []
    for v in values:
        aggs += [F.max_by(F.col(f"_ff_{v}"), F.col("_rank")).alias(f"_last_{v}"),
                 F.min_by(F.col(f"_bf_{v}"), F.col("_rank")).alias(f"_first_{v}")]
    s = local.groupBy(*key, bucket).agg(*aggs)
    w = Window.partitionBy(*key).orderBy(bucket)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    return s.select(*key, bucket, *[
        c for v in values for c in (
            F.last(f"_last_{v}", ignorenulls=True).over(before).alias(f"_cin_{v}"),
            F.first(f"_first_{v}", ignorenulls=True).over(after).alias(f"_cout_{v}"))])


def ffill_bfill(df: DataFrame, key: list[str], order: str, values: list[str], bucket: Column | str,
                backward: bool = True, keep_prev: bool = False) -> DataFrame:
    """Forward fill (then backward fill when ``backward``) of ``values`` per
    key in ``order``.  ``bucket`` is a coarse time grain (e.g. month of the
    date) that splits each key's sequence into independent window tasks.
    ``keep_prev`` also returns ``<v>__prev``: the padded value strictly
    before each row (what a lag of the forward-filled column would give).
    """
    b = "_bucket"
    d = df.withColumn(b, F.col(bucket) if isinstance(bucket, str) else bucket)
    w = Window.partitionBy(*key, b).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    local = d.select(*d.columns, F.row_number().over(w).alias("_rank"), *[
        c for v in values for c in (
            [F.last(v, ignorenulls=True).over(upto).alias(f"_ff_{v}"),
             F.first(v, ignorenulls=True).over(fwd).alias(f"_bf_{v}")]
            + ([F.last(v, ignorenulls=True).over(prev).alias(f"_pv_{v}")] if keep_prev else []))])
    carry = _carry_table(local, key, b, values)
    j = local.join(carry, [*key, b], "left")
    out = [c for c in df.columns if c not in values]
    for v in values:
        ff = F.coalesce(F.col(f"_ff_{v}"), F.col(f"_cin_{v}"))
        filled = F.coalesce(ff, F.col(f"_bf_{v}"), F.col(f"_cout_{v}")) if backward else ff
        out.append(filled.alias(v))
        if keep_prev:
            out.append(F.coalesce(F.col(f"_pv_{v}"), F.col(f"_cin_{v}")).alias(f"{v}__prev"))
    return j.select(*out)


def segmented_lag(df: DataFrame, key: list[str], order: list[str], value: Column | str,
                  bucket: Column | str, out: str = "prev") -> DataFrame:
    """``lag(value)`` per key in ``order`` without a window over the whole
    key: lag inside (key, bucket); a bucket's first row takes the last
    value of the key's previous non-empty bucket (one summary row per
    bucket, built from the windowed frame)."""
    b = "_bucket"
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn(b, F.col(bucket) if isinstance(bucket, str) else bucket).withColumn("_v", v)
    w = Window.partitionBy(*key, b).orderBy(*order)
    local = d.withColumn("_lag", F.lag("_v").over(w)).withColumn("_rn", F.row_number().over(w))
    last = local.groupBy(*key, b).agg(F.max_by(F.col("_v"), F.col("_rn")).alias("_last"))
    carry = last.select(*key, b, F.lag("_last").over(Window.partitionBy(*key).orderBy(b)).alias("_cin"))
    j = local.join(carry, [*key, b], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_cin")).otherwise(F.col("_lag"))
    return j.select(*df.columns, prev.alias(out))


# --------------------------------------------------------------------- WIN-4
def default_bucket(df: DataFrame, order: str) -> Column:
    """A grain of ``order`` that keeps its order, to split a key's rows by."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.StringType):
        return F.substring(order, 1, 7)
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(order) / 4096)
    return F.date_trunc("month", F.col(order))


def change_history(df: DataFrame, key: list[str], order: str, tracked: list[str],
                   bucket: Column | str | None = None) -> DataFrame:
    """Snapshot history (SCD-2): rows where any tracked value differs from
    the previous row of the same key, with ``valid_from`` = the row's order
    value and ``valid_to`` = the next change's (null for the current one).
    ``bucket``: by default a month of a date, 4096 of a whole number, the first
    seven characters of a text (a month of an ISO date).

    Segmented: windows run per (key, bucket); a bucket's first row compares
    with the last row of the key's previous non-empty bucket, and a bucket's
    last change closes at the first change of a later bucket.  Both carries
    come from one-row-per-bucket summaries.
    """
    b = "_bucket"
    bucket = default_bucket(df, order) if bucket is None else bucket
    d = df.withColumn(b, F.col(bucket) if isinstance(bucket, str) else bucket)
    cur = F.struct(*[F.col(c) for c in tracked])
    w = Window.partitionBy(*key, b).orderBy(order)
    local = (d.withColumn("_prev_local", F.lag(cur).over(w))
              .withColumn("_rn", F.row_number().over(w))
              .withColumn("_is_first", F.col("_rn") == 1))
    # last row of each bucket, from the windowed frame (already partitioned
    # by (key, bucket)), carried to the next bucket of the key
    last_row = (local.groupBy(*key, b).agg(F.max_by(cur, F.col("_rn")).alias("_last"))
                     .withColumn("_cin", F.lag("_last").over(Window.partitionBy(*key).orderBy(b))).drop("_last"))
    x = local.join(last_row, [*key, b], "left")
    prev = F.when(F.col("_is_first"), F.col("_cin")).otherwise(F.col("_prev_local"))
    changed = x.where(prev.isNull() | ~cur.eqNullSafe(prev)).select(*key, b, *tracked,
                                                                     F.col(order).alias("valid_from"))
    first_change = (changed.groupBy(*key, b).agg(F.min("valid_from").alias("_f"))
                           .withColumn("_cout", F.first("_f", ignorenulls=True).over(
                               Window.partitionBy(*key).orderBy(b).rowsBetween(1, Window.unboundedFollowing)))
                           .drop("_f"))
    w2 = Window.partitionBy(*key, b).orderBy("valid_from")
    y = changed.withColumn("_next_local", F.lead("valid_from").over(w2)).join(first_change, [*key, b], "left")
    return y.select(*key, *tracked, "valid_from",
                    F.coalesce(F.col("_next_local"), F.col("_cout")).alias("valid_to"))


# --------------------------------------------------------------------- WIN-6
def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Global top-n: ``orderBy().limit()`` plans as TakeOrderedAndProject,
    which keeps n rows per task and merges them (no full sort)."""
    return df.orderBy(*order).limit(n)


# --------------------------------------------------------------------- SET-1/2
def union_align(frames: list[DataFrame], sort_columns: bool = False) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*sorted(out.columns)) if sort_columns else out


# --------------------------------------------------------------------- SET-3/5
def distinct_sorted(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def distinct_union(frames: list[DataFrame], col: str) -> DataFrame:
    u = reduce(lambda a, b: a.union(b), [f.select(F.col(f.columns[0]).alias(col)) for f in frames])
    return u.where(F.col(col).isNotNull()).distinct().orderBy(col)


def difference(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """SET-4: rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*key), key, "left_anti")
