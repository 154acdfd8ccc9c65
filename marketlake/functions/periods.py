"""Period codes -> DATE (FN-4, FN-5, FN-6) as Column expressions.

Invalid combinations (month 13 from 'Q05', bad years) become null rather
than raising: every date goes through ``try_to_date``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ymd(year: Column, month: Column, day: Column | None = None) -> Column:
    """Date from text parts through a parse (used where the day may be
    invalid)."""
    day = day if day is not None else F.lit("01")
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"),
                       F.lpad(day.cast("string"), 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def _month_start(year: Column, month: Column) -> Column:
    """First day of a month; null unless 1 <= month <= 12 (no text parse:
    ``make_date`` is only reached with valid parts)."""
    y, m = year.cast("int"), month.cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def labour_period_date(year, period) -> Column:
    """'M01'..'M12' -> that month; 'Qn' -> first month of quarter n;
    'Sn' -> month 1 or 7; 'M13', 'A..' and unknown codes -> January 1.
    A number that does not parse after M/Q/S also gives January 1;
    impossible months (Q05, S03) give null."""
    y = F.trim(_c(year).cast("string")).try_cast("int")
    p = F.trim(_c(period))
    n = F.substr(p, F.lit(2)).try_cast("int")
    month = (F.when(p.startswith("M"), F.when(n.between(1, 12), n).otherwise(F.lit(1)))
              .when(p.startswith("Q"), F.when(n.isNull(), F.lit(1)).otherwise((n - 1) * 3 + 1))
              .when(p.startswith("S"), F.when(n.isNull(), F.lit(1)).otherwise((n - 1) * 6 + 1))
              .otherwise(F.lit(1)))
    return _month_start(y, month)


# a day, alone or with a time of day
ISO_DAY = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _iso(s: Column) -> Column:
    return F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")


def european_period_date(x, iso_week: bool = False) -> Column:
    """'2020-01-15' (ISO) | '2020Q1' | '2020M01' | '2020-01' | '2020' |
    '2020-W05' -> period start.  Weeks map to January 1 unless
    ``iso_week`` asks for the Monday of that ISO week.  Each branch is
    guarded by one cheap pattern test of the whole text; parts are cut by
    position."""
    s = F.trim(_c(x).cast("string"))
    y4 = F.substring(s, 1, 4)
    if iso_week:
        jan4 = F.make_date(y4.cast("int"), F.lit(1), F.lit(4))  # ISO week 1 holds January 4
        week = F.date_add(F.date_trunc("week", jan4).cast("date"), (F.substring(s, 7, 2).cast("int") - 1) * 7)
    else:
        week = _month_start(y4, F.lit(1))
    return (F.when(s.rlike(ISO_DAY), _iso(s))
             .when(s.rlike(r"^\d{4}[Qq][1-4]$"), _month_start(y4, (F.substring(s, 6, 1).cast("int") - 1) * 3 + 1))
             .when(s.rlike(r"^\d{4}[Mm]\d{2}$"), _month_start(y4, F.substring(s, 6, 2)))
             .when(s.rlike(r"^\d{4}-\d{2}$"), _month_start(y4, F.substring(s, 6, 2)))
             .when(s.rlike(r"^\d{4}$"), _month_start(y4, F.lit(1)))
             .when(s.rlike(r"^\d{4}-[Ww]\d{2}$"), week))


def banking_period_date(x) -> Column:
    """'2020-01-15' (ISO) | '2020-Q1' | '2020-01' | '2020' -> period start."""
    s = F.trim(_c(x).cast("string"))
    y4 = F.substring(s, 1, 4)
    return (F.when(s.rlike(ISO_DAY), _iso(s))
             .when(s.rlike(r"^\d{4}-[Qq][1-4]$"), _month_start(y4, (F.substring(s, 7, 1).cast("int") - 1) * 3 + 1))
             .when(s.rlike(r"^\d{4}-\d{2}$"), _month_start(y4, F.substring(s, 6, 2)))
             .when(s.rlike(r"^\d{4}$"), _month_start(y4, F.lit(1))))
