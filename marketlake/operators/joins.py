"""Joins (JOIN-*).

N-way outer alignment is one pivot (one shuffle on date) instead of N
joins; anti joins are ``left_anti`` so stored keys are never collected;
lookups against small catalogues broadcast only after a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as FV



# --------------------------------------------------------------------- JOIN-1
def align_series(long_df: DataFrame, series_ids: list[str], id_col: str = "series_id",
                 date_col: str = "date", value_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """Full-outer alignment of N series on date: one column per series id,
    one row per date that any series has, sorted by date.

    Long rows are pivoted with explicit values: a single shuffle on the
    date key with partial aggregation, whatever N is.  With ``drop_empty``
    an id without rows adds no column (as an outer merge of only the
    non-empty series would); finding them costs one small distinct job.
    """
    ids = present_ids(long_df, series_ids, id_col) if drop_empty else list(series_ids)
    wanted = long_df.where(F.col(id_col).isin(ids))
    pivoted = (wanted.groupBy(date_col)
                     .pivot(id_col, ids)
                     .agg(F.first(value_col, ignorenulls=True)))
    return pivoted.orderBy(date_col)


PANELS = {"macro": FV.KEY_MACRO_SERIES, "gdp": FV.GDP_COMPONENT_SERIES}


def indicator_panel(long_df: DataFrame, panel: str, id_col: str = "series_id", date_col: str = "date",
                    value_col: str = "value") -> DataFrame:
    """JOIN-2: a named panel (``PANELS``) aligned on date; series of it that
    have no rows add no column."""
    if panel not in PANELS:
        raise ValueError(f"unknown panel {panel!r}, not one of {sorted(PANELS)}")
    return align_series(long_df, PANELS[panel], id_col, date_col, value_col, drop_empty=True)


def present_ids(long_df: DataFrame, series_ids: list[str], id_col: str = "series_id") -> list[str]:
    """Ids among ``series_ids`` that have at least one row (at most
    len(series_ids) small values reach the driver)."""
    rows = long_df.where(F.col(id_col).isin(series_ids)).select(id_col).distinct().collect()
    found = {r[0] for r in rows}
    return [s for s in series_ids if s in found]


# --------------------------------------------------------------------- JOIN-3
def series_under_categories(category_ids: DataFrame, series: DataFrame,
                            end_col: str = "observation_end", min_end: str = "2025-01-01",
                            key: str = "category_id") -> DataFrame:
    """Distinct categories joined to series with a recent end (text
    comparison, as stored)."""
    recent = series.where(F.col(end_col).cast("string") >= F.lit(min_end))
    # semi join: each series once per matching category, no distinct needed
    return recent.join(category_ids.select(key), key, "left_semi")


# --------------------------------------------------------------- JOIN-4/5/6
def branch_flags(categories: DataFrame, id_col: str = "category_id",
                 parent_col: str = "parent_id") -> DataFrame:
    """is_branch (EXISTS child) and child_count (scalar COUNT) as one
    pre-aggregated left join: children are counted per parent with partial
    aggregation, so a parent with millions of children is not one task."""
    children = (categories.where(F.col(parent_col).isNotNull())
                          .groupBy(F.col(parent_col).alias(id_col))
                          .agg(F.count(F.lit(1)).alias("child_count")))
    out = categories.join(children, id_col, "left")
    cc = F.coalesce(F.col("child_count"), F.lit(0)).cast("long")
    return out.withColumn("child_count", cc).withColumn("is_branch", cc > 0)


# --------------------------------------------------------------------- JOIN-7
def new_only(incoming: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key is present (not blank) and not stored."""
    nonblank = None
    for k in key:
        p = F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")
        nonblank = p if nonblank is None else nonblank & p
    return incoming.where(nonblank).join(existing.select(*key), key, "left_anti")


# --------------------------------------------------------------------- JOIN-8
def quarter_calendar(spark, start_year: int, as_of) -> DataFrame:
    """(year, 'QTRn') from ``start_year`` Q1 up to the quarter of ``as_of``
    (a date literal; injectable for tests).  Bounded: 4 rows per year."""
    d = F.to_date(F.lit(str(as_of)))
    end_idx = F.year(d) * 4 + F.quarter(d) - 1
    q = (spark.range(1)
         .select(F.explode(F.sequence(F.lit(start_year * 4), end_idx)).alias("qi")))
    return q.select((F.floor(F.col("qi") / 4)).cast("int").alias("year"),
                    F.concat(F.lit("QTR"), ((F.col("qi") % 4) + 1).cast("string")).alias("quarter"))


def quarters_todo(calendar: DataFrame, loaded: DataFrame, ledger: DataFrame) -> DataFrame:
    """Calendar minus quarters with data, then keep quarters whose ledger
    status is missing, pending or failed."""
    left = calendar.join(loaded.select("year", "quarter"), ["year", "quarter"], "left_anti")
    j = left.join(ledger.select("year", "quarter", "status"), ["year", "quarter"], "left")
    return j.where(F.col("status").isNull() | F.col("status").isin("pending", "failed"))


# --------------------------------------------------------------------- JOIN-9
def combine_first(existing: DataFrame, incoming: DataFrame, key: list[str],
                  prefer: str = "existing") -> DataFrame:
    """Full outer merge on ``key``: for every column, the preferred side's
    value when not null, else the other side's; columns and rows of both
    sides are kept."""
    e_cols = [c for c in existing.columns if c not in key]
    n_cols = [c for c in incoming.columns if c not in key]
    e = existing.select(*key, *[F.col(c).alias(f"__e_{c}") for c in e_cols])
    n = incoming.select(*key, *[F.col(c).alias(f"__n_{c}") for c in n_cols])
    j = e.join(n, key, "full")
    out = [F.col(k) for k in key]
    for c in e_cols + [c for c in n_cols if c not in e_cols]:
        ev = F.col(f"__e_{c}") if c in e_cols else None
        nv = F.col(f"__n_{c}") if c in n_cols else None
        if ev is not None and nv is not None:
            v = F.coalesce(ev, nv) if prefer == "existing" else F.coalesce(nv, ev)
        else:
            v = ev if ev is not None else nv
        out.append(v.alias(c))
    return j.select(*out)


# -------------------------------------------------------------------- JOIN-10
def group_reuse(funds: DataFrame, key_col: str, group_col: str, file_col: str,
                seq_col: str) -> DataFrame:
    """Last file per group (by ``seq``) shared by every member of the group;
    ``is_reused`` when a member takes a file it did not produce; ``needs``
    when its group has no file at all."""
    last = (funds.where(F.col(file_col).isNotNull())
                 .groupBy(group_col)
                 .agg(F.max_by(F.col(file_col), F.col(seq_col)).alias("group_file")))
    # ``last`` has one row per group and is only known after the aggregate
    # runs: AQE measures it and broadcasts it when small (then a hot group
    # never meets in one join task); beyond the threshold the sort-merge
    # join's skew handling splits a hot group's partition.  An explicit size
    # check here would aggregate the whole table a second time.
    j = funds.join(last, group_col, "left")
    return j.select(
        key_col, group_col,
        F.col("group_file").alias(file_col),
        (F.col("group_file").isNotNull() & (F.coalesce(F.col(file_col), F.lit("")) != F.col("group_file")))
        .alias("is_reused"),
        F.col("group_file").isNull().alias("needs_file"),
    )


# -------------------------------------------------------------------- JOIN-11
def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, name_col: str,
                        label: str = "Category ", out_col: str = "category_name") -> DataFrame:
    """Left lookup; a missing name becomes '<label><id>'.  Whether the lookup
    side is broadcast follows from its measured bytes (AQE)."""
    j = df.join(lookup.select(key, name_col), key, "left")
    label_col = F.coalesce(F.col(name_col), F.concat(F.lit(label), F.col(key).cast("string")))
    out = j.withColumn(out_col, label_col)
    return out.drop(name_col) if name_col != out_col else out


# -------------------------------------------------------------------- JOIN-12
def orphans(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str] | None = None) -> DataFrame:
    pk = pk or fk
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)])
    return child.join(p, fk, "left_anti")


def cascade_keep(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str] | None = None) -> DataFrame:
    """Rows that survive deleting parents absent from ``parent``."""
    pk = pk or fk
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)])
    return child.join(p, fk, "left_semi")
