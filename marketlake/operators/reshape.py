"""Reshape (RSH-*): unpivot / pivot with explicit values, explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import banking_period_date, european_period_date
from ..functions.scalars import classify_label


# --------------------------------------------------------------------- RSH-1
def melt_with_dimensions(df: DataFrame, id_cols: list[str], value_cols: list[str],
                         dimension_names: dict[str, dict[str, str]] | None = None,
                         var_name: str = "variable", value_name: str = "value",
                         date_col: str | None = None) -> DataFrame:
    """Wide -> long: every value column becomes a row with a ``dimensions``
    map (multi-level names give one entry per level, else a single
    'dimension' entry).  Null values and unparseable dates are dropped;
    values become double."""
    dimension_names = dimension_names or {}
    if len({df.schema[c].dataType.simpleString() for c in value_cols}) > 1:
        # mixed cell types (numbers and text): unpivot as text, parse below
        df = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in value_cols])
    long = df.unpivot(id_cols, value_cols, var_name, value_name)
    entries = []
    for c in value_cols:
        levels = dimension_names.get(c, {"dimension": c})
        entries.append((c, F.create_map(*[x for k, v in levels.items() for x in (F.lit(k), F.lit(v))])))
    dims = None
    for c, m in entries:
        dims = F.when(F.col(var_name) == c, m) if dims is None else dims.when(F.col(var_name) == c, m)
    from pyspark.sql.types import NumericType
    vcol = F.col(value_name)
    as_double = vcol.cast("double") if isinstance(long.schema[value_name].dataType, NumericType) \
        else F.trim(vcol.cast("string")).try_cast("double")
    out = long.withColumn("dimensions", dims).withColumn(value_name, as_double)
    out = out.where(F.col(value_name).isNotNull())
    if date_col:
        out = out.where(F.col(date_col).isNotNull())
    return out


# Names that a time column goes by.
TIME_NAMES = ("time", "time_period", "time period", "period", "date", "obs_time", "year")
# Formats tried on a column's values, in this order.
TIME_FORMATS = {
    "european": european_period_date,
    "banking": banking_period_date,
    "compact": lambda c: F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd")),
    "day first": lambda c: F.when(c.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(c, "dd/MM/yyyy")),
}


def _time_value(df: DataFrame, column: str, how: str) -> Column:
    if how == "date":
        return F.col(column).cast("date")
    return TIME_FORMATS[how](F.trim(F.col(column).cast("string")))


def detect_time_column(df: DataFrame, least: float = 0.9) -> tuple[str, str] | None:
    """(column, format) of the time column: a date or timestamp, or the column
    of which the largest share of values reads as periods in one of
    ``TIME_FORMATS``, at least ``least`` of those not null.  Columns named as in
    ``TIME_NAMES`` come before others, then dates, then the larger share, then
    the earlier; numbers count only under such a name.  One aggregate over all
    columns; the driver gets one count per column and format."""
    named = {c for c in df.columns if c.strip().lower() in TIME_NAMES}
    kinds = {c: df.schema[c].dataType for c in df.columns}
    dates = [c for c, k in kinds.items() if isinstance(k, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    texts = [c for c, k in kinds.items() if isinstance(k, T.StringType) or c in named and isinstance(k, T.IntegralType)]
    tried = [(c, how) for c in texts for how in TIME_FORMATS]
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(texts)],
                    *[F.count(_time_value(df, c, how)).alias(f"t{i}") for i, (c, how) in enumerate(tried)]).first() if texts else {}
    rows = {c: counts[f"n{i}"] for i, c in enumerate(texts)}
    found = [(c, "date", 1.0) for c in dates]
    found += [(c, how, counts[f"t{i}"] / rows[c]) for i, (c, how) in enumerate(tried) if rows[c]]
    at, formats = {c: i for i, c in enumerate(df.columns)}, ["date", *TIME_FORMATS]
    fit = [x for x in found if x[2] >= least]
    best = min(fit, key=lambda x: (x[0] not in named, x[1] != "date", -x[2], at[x[0]], formats.index(x[1])), default=None)
    return best and best[:2]


def melt_detected(df: DataFrame, dimension_names: dict[str, dict[str, str]] | None = None,
                  time: tuple[str, str] | None = None) -> DataFrame:
    """RSH-1 on a table as it landed: its time column is found and parsed to
    ``date``, every other column becomes rows (date, variable, value,
    dimensions); rows without a date or a number are dropped.  ``time`` gives
    the column and format instead.  ValueError where no column holds times."""
    time = time or detect_time_column(df)
    if time is None:
        raise ValueError(f"no column of {df.columns} holds times")
    rest = [c for c in df.columns if c != time[0]]
    dated = df.select(_time_value(df, *time).alias("date"), *rest).where(F.col("date").isNotNull())
    return melt_with_dimensions(dated, ["date"], rest, dimension_names, date_col="date")


# --------------------------------------------------------------------- RSH-2
def to_long_map(df: DataFrame, id_cols: list[str], extra_cols: list[str] | None = None) -> DataFrame:
    """Free columns -> one map<string,string> column (stored long form)."""
    extra = extra_cols or [c for c in df.columns if c not in id_cols]
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in extra]),
                          F.array(*[F.col(c).cast("string") for c in extra]))
    return df.select(*id_cols, F.map_filter(m, lambda k, v: v.isNotNull()).alias("fields"))


def widen(df: DataFrame, id_cols: list[str], fields_col: str, keys: list[str]) -> DataFrame:
    """Map column -> one string column per requested key (no pivot job)."""
    return df.select(*id_cols, *[F.element_at(F.col(fields_col), F.lit(k)).alias(k) for k in keys])


# --------------------------------------------------------------------- RSH-3
def explode_observations(obs_map_df: DataFrame, map_col: str, dim_ids: list[str],
                         keep: list[str] | None = None) -> DataFrame:
    """SDMX-style observations {"0:1:2": [v, ...]} -> rows with named
    dimension indexes and the first value; null or non-numeric dropped."""
    keep = keep or []
    e = obs_map_df.select(*keep, F.explode(F.col(map_col)).alias("obs_key", "obs_values"))
    parts = F.split(F.col("obs_key"), ":")
    dims = F.map_from_arrays(F.array(*[F.lit(d) for d in dim_ids]),
                             F.slice(parts, 1, len(dim_ids)))
    v = F.try_element_at(F.col("obs_values"), F.lit(1)).cast("string").try_cast("double")
    return e.select(*keep, "obs_key", dims.alias("dimensions"), v.alias("value")).where(F.col("value").isNotNull())


# --------------------------------------------------------------------- RSH-4
def matrix_to_rows(df: DataFrame, id_cols: list[str], label_col: str, period_cols: list[str],
                   rules, fields: list[str]) -> DataFrame:
    """Metric x period matrix -> one row per period: the label picks the
    field (first rule that matches), the cell becomes that field's value.
    unpivot -> classify -> pivot with explicit field values."""
    long = df.unpivot([*id_cols, label_col], period_cols, "period", "cell")
    tagged = long.withColumn("field", classify_label(F.col(label_col), rules)).where(F.col("field").isNotNull())
    return (tagged.groupBy(*id_cols, "period").pivot("field", fields)
                  .agg(F.max_by(F.col("cell").cast("string"), F.col(label_col))))


# --------------------------------------------------------------------- RSH-5
def two_feeds(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


# --------------------------------------------------------------------- RSH-6
def ohlc(df: DataFrame, key: list[str], bar: str, ts: str, price: str, tiebreak: str | None = None,
         volume: str | None = None) -> DataFrame:
    """Bars per key and period: open/close by time order (min_by/max_by,
    partially aggregated), high/low, optional volume."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    aggs = [F.min_by(price, order).alias("open"), F.max(price).alias("high"),
            F.min(price).alias("low"), F.max_by(price, order).alias("close")]
    if volume:
        aggs.append(F.sum(volume).alias("volume"))
    return df.groupBy(*key, bar).agg(*aggs)


# --------------------------------------------------------------------- RSH-7
def sections_to_rows(df: DataFrame, id_cols: list[str], section: str, pairs_col: str) -> DataFrame:
    """(id, section, array<struct<key,value>>) -> (id, section, key, value)."""
    return df.select(*id_cols, F.lit(section).alias("section"), F.explode(pairs_col).alias("kv")) \
             .select(*id_cols, "section", "kv.key", "kv.value")
