"""Aggregations (AGG-*).

Every aggregate here is algebraic (count, sum, min, max, max_by, min_by,
avg, stddev_pop) so Spark combines partial results map-side: a key that
holds a third of all rows costs one partial row per input partition, not a
third of the data in one task.  ``collect_list`` appears only where the
group is bounded (catalogue members) and is flagged where used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import regime_name
from ..session import cut_lineage


# --------------------------------------------------------------------- AGG-1
def high_water(df: DataFrame, key: str, date_text_col: str, out: str = "next_start") -> DataFrame:
    """Max parsed date per key (unparseable dates skipped) plus one day, as
    'yyyy-MM-dd' text."""
    d = F.col(date_text_col)
    parsed = d.cast("date") if df.schema[date_text_col].dataType.typeName() != "string" \
        else F.try_to_date(d, "yyyy-MM-dd")
    return (df.groupBy(key).agg(F.max(parsed).alias("_max"))
              .where(F.col("_max").isNotNull())
              .select(key, F.date_format(F.date_add("_max", 1), "yyyy-MM-dd").alias(out)))


# --------------------------------------------------------------------- AGG-2
def branch_totals(analysis: DataFrame) -> DataFrame:
    return analysis.agg(
        F.count_if(F.col("is_branch")).alias("total_branches"),
        F.count_if(~F.col("is_branch")).alias("total_leaves"),
        F.count(F.lit(1)).alias("total_categories"))


# --------------------------------------------------------------------- AGG-4
def pivot_first(df: DataFrame, row_key: str, pivot_col: str, values: list[str],
                value_col: str, seq: list[str]) -> DataFrame:
    """row_key x pivot value -> first non-null value in ``seq`` order.
    Explicit pivot values (no extra job to discover them); ``min_by`` is
    partially aggregated."""
    seq_s = F.struct(*[F.col(c) for c in seq])
    return (df.where(F.col(value_col).isNotNull())
              .groupBy(row_key).pivot(pivot_col, values)
              .agg(F.min_by(F.col(value_col), seq_s)))


# --------------------------------------------------------------------- AGG-5
def state_distribution(df: DataFrame, state_col: str = "state") -> DataFrame:
    return df.groupBy(state_col).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- AGG-6
def regime_characteristics(df: DataFrame, regime_col: str, features: list[str], k: int,
                           decimals: int | None = None) -> DataFrame:
    """Per non-empty regime and feature: n, mean, population std, min, max
    (long form: one row per regime x feature).  One partial aggregation
    over all features at once; regimes with no rows do not appear."""
    aggs = [F.count(F.lit(1)).alias("n_observations")]
    for i, f in enumerate(features):
        aggs += [F.avg(f).alias(f"mean_{i}"), F.stddev_pop(f).alias(f"std_{i}"),
                 F.min(f).alias(f"min_{i}"), F.max(f).alias(f"max_{i}")]
    g = df.groupBy(regime_col).agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"),
                 F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max"))
        for i, f in enumerate(features)]))
    out = g.select(F.col(regime_col).alias("regime_idx"), "n_observations", stacked.alias("s"))
    r = lambda c: F.round(c, decimals) if decimals is not None else c
    return out.select(regime_name(k, F.col("regime_idx")).alias("regime"), "regime_idx", "n_observations",
                      F.col("s.feature").alias("feature"), r(F.col("s.mean")).alias("mean"),
                      r(F.col("s.std")).alias("std"), r(F.col("s.min")).alias("min"),
                      r(F.col("s.max")).alias("max"))


# --------------------------------------------------------------------- AGG-7
def members(df: DataFrame, group_col: str, member_col: str, sep: str = ",") -> DataFrame:
    """Group -> sorted member list (as text), member count and unique count.
    The list is a catalogue-sized value per group (funds per benchmark);
    ``member_rows`` lists groups without a bound."""
    return df.groupBy(group_col).agg(
        F.array_join(F.array_sort(F.collect_list(member_col)), sep).alias("members"),
        F.count(member_col).alias("n_members"),
        F.count_distinct(member_col).alias("n_unique"))


def member_rows(df: DataFrame, group_col: str, member_col: str, per_row: int = 10_000) -> DataFrame:
    """The members of groups of any size, in rows of at most ``per_row``:
    (group, part, members: sorted array).  The pairs are sorted over the
    cluster and cut by their place, so a group with a third of all rows is in
    as many rows and tasks as it needs; parts of a group ascend in order but
    need not be full.  Null members are left out, repeated ones stay."""
    at = F.monotonically_increasing_id()
    placed = cut_lineage(df.where(F.col(member_col).isNotNull()).select(group_col, member_col)
                         .orderBy(group_col, member_col).withColumn("_at", at))
    part = F.floor(F.col("_at") / per_row)
    return placed.groupBy(group_col, part.alias("part")).agg(F.array_sort(F.collect_list(member_col)).alias("members"))


# --------------------------------------------------------------------- AGG-8
def tally(df: DataFrame, outcome_col: str, by: list[str] | None = None) -> DataFrame:
    """success / failed / skipped / total counts of a job-result table."""
    o = F.col(outcome_col)
    aggs = [F.count_if(o == "success").alias("success"), F.count_if(o == "failed").alias("failed"),
            F.count_if(o == "skipped").alias("skipped"), F.count(F.lit(1)).alias("total")]
    return df.groupBy(*(by or [])).agg(*aggs)


# --------------------------------------------------------------------- AGG-9
def completeness(index_side: DataFrame, stored_side: DataFrame, year_col: str, form_col: str) -> DataFrame:
    """Per (year, form) and per year ('TOTAL'): index count, stored count,
    complete flag.  Both sides are rolled up (partial aggregation) and
    full-joined on the small rolled-up keys."""
    def roll(df, name):
        r = (df.rollup(year_col, form_col).agg(F.count(F.lit(1)).alias(name))
               .where(F.col(year_col).isNotNull()))
        return r.select(year_col, F.coalesce(F.col(form_col), F.lit("TOTAL")).alias("filing_type"), name)
    a = roll(index_side, "sec_index_count")
    b = roll(stored_side, "db_count")
    j = a.join(b, [year_col, "filing_type"], "full")
    si = F.coalesce(F.col("sec_index_count"), F.lit(0)).cast("long")
    db = F.coalesce(F.col("db_count"), F.lit(0)).cast("long")
    return j.select(F.col(year_col).alias("year"), "filing_type", si.alias("sec_index_count"),
                    db.alias("db_count"), (si == db).alias("is_complete"))


# -------------------------------------------------------------------- AGG-10
def distinct_values(df: DataFrame, col: str, alias: str, name_alias: str | None = None) -> DataFrame:
    out = df.select(F.col(col).alias(alias)).where(F.col(alias).isNotNull()).distinct()
    return out.withColumn(name_alias, F.col(alias)) if name_alias else out


# -------------------------------------------------------------------- AGG-11
def global_min(df: DataFrame, cols: list[str]) -> DataFrame:
    """One-row frame with the minimum over all columns."""
    return df.agg(F.least(*[F.min(c) for c in cols]).alias("global_min"))


# -------------------------------------------------------------------- AGG-12
def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: mean and population std per column; a std of 0 (or null)
    becomes 1 so that scaling never divides by zero."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    s = df.agg(*aggs)
    return s.select(*[F.col(f"{c}__mean") for c in cols],
                    *[F.when(F.coalesce(F.col(f"{c}__std"), F.lit(0.0)) == 0, F.lit(1.0))
                       .otherwise(F.col(f"{c}__std")).alias(f"{c}__std") for c in cols])


def standardize(df: DataFrame, cols: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with statistics from ``scaler_stats``.  The one-row
    statistics (2 numbers per column) come to the driver and go back as
    literals, so the data side is never joined or shuffled."""
    stats = stats if stats is not None else scaler_stats(df, cols)
    row = stats.first()
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[((F.col(c) - F.lit(row[f"{c}__mean"])) / F.lit(row[f"{c}__std"])).alias(c)
                              for c in cols])


# -------------------------------------------------------------------- AGG-13
def totals(named: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as (key, value) text metadata, one
    global aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).cast("string").alias("value"))
               .select(F.lit(f"{name}_count").alias("key"), "value") for name, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
