"""Scalar rules as JVM Column expressions (FN-1 .. FN-24).

Every function takes and returns ``pyspark.sql.Column`` so the rules stay
inside whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as FV


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """'' (after trim) -> null, other values unchanged (text columns)."""
    c = _c(x)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def first_present(*cols) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


# --------------------------------------------------------------------- FN-1
def normalize_cik(x) -> Column:
    """Registry id: digits only, leading zeros dropped, left padded to 10.

    Ids longer than 10 digits keep all digits (plain ``lpad`` would cut them).
    Non-digit input gives null.
    """
    s = F.trim(_c(x).cast("string"))
    digits = F.regexp_replace(s, r"^0+(?=[0-9])", "")
    return (F.when(~s.rlike(r"^[0-9]+$"), F.lit(None).cast("string"))
             .when(F.length(digits) >= 10, digits)
             .otherwise(F.lpad(digits, 10, "0")))


# --------------------------------------------------------------------- FN-2
def filed_date(x) -> Column:
    """'YYYYMMDD' or 'YYYY-MM-DD' text -> DATE; anything else -> null."""
    s = F.trim(_c(x))
    iso = (F.when(s.rlike(r"^[0-9]{8}$"),
                  F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)))
            .when((F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-"), s))
    return F.try_to_date(iso, "yyyy-MM-dd")


# --------------------------------------------------------------------- FN-3
def accession_from_path(x) -> Column:
    """Last path segment without '.txt' when the path has >= 4 segments;
    null (row to drop) otherwise or when that segment is empty."""
    parts = F.split(_c(x), "/", -1)
    last = F.regexp_replace(F.element_at(parts, -1), r"\.txt$", "")
    return F.when(F.size(parts) >= 4, F.nullif(last, F.lit("")))


# --------------------------------------------------------------------- FN-7
def quarter_label(d) -> Column:
    return F.concat(F.lit("QTR"), F.quarter(_c(d)).cast("string"))


# --------------------------------------------------------------------- FN-8
def country_of(series_id, geography=None, compat: bool = False) -> Column:
    """Country from geography text, else from the series id, else default.

    ``compat=False`` tries longer codes first so that 'AUS' is not read as
    'US'; ``compat=True`` keeps the source order.
    """
    codes = list(FV.COUNTRY_CODES)
    if not compat:
        codes = sorted(codes, key=lambda kv: -len(kv[0]))  # stable: ties keep order
    sid = F.upper(F.coalesce(_c(series_id).cast("string"), F.lit("")))
    branches = []
    if geography is not None:
        geo = F.upper(F.coalesce(_c(geography), F.lit("")))
        branches += [F.when(geo.contains(code), F.lit(name)) for code, name in codes]
    branches += [F.when(sid.contains(code), F.lit(name)) for code, name in codes]
    states = F.array(*[F.lit(s) for s in FV.US_STATES])
    branches.append(F.when((F.length(sid) >= 2) & F.array_contains(states, F.substring(sid, -2, 2)),
                           F.lit(FV.DEFAULT_COUNTRY)))
    branches.append(F.lit(FV.DEFAULT_COUNTRY))
    return F.coalesce(*branches)


# --------------------------------------------------------------------- FN-9
def survey_of(series_id) -> Column:
    sid = _c(series_id)
    expr = None
    for prefixes, survey in FV.SURVEY_PREFIXES:
        cond = reduce(lambda a, b: a | b, [sid.startswith(p) for p in prefixes])
        expr = F.when(cond, F.lit(survey)) if expr is None else expr.when(cond, F.lit(survey))
    return expr.otherwise(F.lit(FV.SURVEY_UNKNOWN))


# -------------------------------------------------------------------- FN-10
def id_grid(prefix, suffixes: list[str]) -> Column:
    """Candidate ids: one per fixed suffix for each input prefix (a bounded
    per-row fan-out via ``explode``, not a join)."""
    return F.explode(F.transform(F.array(*[F.lit(s) for s in suffixes]),
                                 lambda s: F.concat(_c(prefix), s)))


# -------------------------------------------------------------------- FN-11
def detect_ticker(cells) -> Column:
    """First cell that, upper-cased and trimmed, is 1-5 alphanumerics."""
    cleaned = F.transform(_c(cells), lambda c: F.trim(F.upper(c)))
    hits = F.filter(cleaned, lambda c: (F.length(c) > 0) & (F.length(c) <= 5)
                    & c.rlike(r"^[\p{L}\p{N}]+$"))
    return F.try_element_at(hits, F.lit(1))


def detect_name(cells, ticker) -> Column:
    """First cell longer than 5 characters that differs from the ticker."""
    t = _c(ticker)
    hits = F.filter(_c(cells), lambda c: (F.length(c) > 5) & (t.isNull() | (c != t)))
    return F.try_element_at(hits, F.lit(1))


# -------------------------------------------------------------------- FN-12
def header_field(headers, cells, aliases: list[str]) -> Column:
    """Cell under the first header containing any alias; null when that cell
    is missing or empty."""
    pattern = "|".join(_quote_re(a) for a in aliases)
    flags = F.transform(_c(headers), lambda h: F.lower(h).rlike(pattern))
    pos = F.array_position(flags, F.lit(True))
    cell = F.when(pos > 0, F.try_element_at(_c(cells), pos.cast("int")))
    return F.nullif(cell, F.lit(""))


def _quote_re(s: str) -> str:
    import re
    return re.escape(s)


# -------------------------------------------------------------------- FN-13
def classify_label(label, rules) -> Column:
    low = F.lower(_c(label))
    expr = None
    for field, alternatives in rules:
        cond = reduce(lambda a, b: a | b,
                      [reduce(lambda x, y: x & y, [low.contains(w) for w in alt]) for alt in alternatives])
        expr = F.when(cond, F.lit(field)) if expr is None else expr.when(cond, F.lit(field))
    return expr


# -------------------------------------------------------------------- FN-14
def strip_tags(html) -> Column:
    no_script = F.regexp_replace(_c(html), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    no_tags = F.regexp_replace(no_script, r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(no_tags, r"\s+", " "))


def as_of_date(text) -> Column:
    """Date text after 'As of' if present, else after 'Date:', else the first
    date-looking token (patterns are case-insensitive)."""
    t = _c(text)
    found = [F.nullif(F.regexp_extract(t, "(?i)" + p, 1), F.lit("")) for p in FV.ASOF_PATTERNS]
    return F.coalesce(*found)


# -------------------------------------------------------------------- FN-15
def absolute_url(href, base_url: str) -> Column:
    h = _c(href)
    return (F.when(h.startswith("http"), h)
             .when(h.startswith("/"), F.concat(F.lit(base_url), h))
             .otherwise(F.concat(F.lit(base_url + "/"), h)))


def host_of(url) -> Column:
    return F.regexp_extract(_c(url), r"^(https?://[^/?#]+)", 1)


# -------------------------------------------------------------------- FN-16
def benchmark_key(*names) -> Column:
    return F.trim(first_present(*names))


# -------------------------------------------------------------------- FN-17
def join_notes(arr, sep: str = ", ") -> Column:
    """List -> 'a, b'; an empty or missing list -> null."""
    return F.nullif(F.array_join(_c(arr), sep), F.lit(""))


# -------------------------------------------------------------------- FN-19
def dims_to_json(m) -> Column:
    """Map -> canonical JSON text (keys sorted), null map -> '{}'."""
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries(_c(m))))
    return F.coalesce(F.to_json(sorted_map), F.lit("{}"))


def json_to_dims(s) -> Column:
    return F.coalesce(F.from_json(_c(s), "map<string,string>"),
                      F.create_map().cast("map<string,string>"))


# -------------------------------------------------------------------- FN-20
def to_double(x) -> Column:
    """Missing or non-numeric text -> null (ANSI-safe)."""
    return F.trim(_c(x).cast("string")).try_cast("double")


# -------------------------------------------------------------------- FN-21
def stringify(x, integral: bool = False) -> Column:
    """Value -> text; null and NaN stay null; ``integral`` renders volumes
    without decimals."""
    c = _c(x)
    if integral:
        return c.try_cast("long").cast("string")
    return F.when(F.isnan(c.cast("double")), F.lit(None)).otherwise(c.cast("string"))


# -------------------------------------------------------------------- FN-22
def describe_code(name, code) -> Column:
    return F.format_string("%s (%s)", _c(name), _c(code))


def series_description(series_id, source: str = "BLS") -> Column:
    return F.concat(F.lit(f"{source} Series "), _c(series_id))


# -------------------------------------------------------------------- FN-24
def first_link(hrefs, markers=None) -> Column:
    markers = markers or FV.FUND_LINK_MARKERS
    hits = F.filter(_c(hrefs), lambda h: reduce(lambda a, b: a | b, [h.contains(m) for m in markers]))
    return F.try_element_at(hits, F.lit(1))


# --------------------------------------------------------------------- HMM-8
def regime_name(k: int, idx) -> Column:
    names = FV.REGIME_NAMES.get(k)
    i = _c(idx)
    if names is None:
        return F.concat(F.lit(FV.REGIME_FALLBACK_PREFIX), (i + 1).cast("string"))
    return F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))


def fund_row_fields(headers, cells) -> Column:
    """FN-11 + FN-12 together: every fund field from one table row.  The
    header mapping wins when its cell is non-empty; ticker and name fall
    back to the cells detected by shape."""
    ticker = detect_ticker(cells)
    name = detect_name(cells, ticker)
    fields = []
    for field, aliases in FV.HEADER_ALIASES:
        v = header_field(headers, cells, aliases)
        if field == "ticker":
            v = F.coalesce(v, ticker)
        elif field == "name":
            v = F.coalesce(v, name)
        fields.append(v.alias(field))
    return F.struct(*fields)
