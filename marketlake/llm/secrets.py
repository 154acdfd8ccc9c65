"""Secret scans: fixed credential patterns plus sliding-window entropy.

DataFrame functions only.  Matches are found by putting a mark character
around each match, splitting at the marks and summing piece lengths, which
gives offsets in code points.  Candidate strings (long runs of key-like
characters, base spans and allow-listed stretches cut out) are then judged by the Shannon entropy of every window of
``window`` characters; the counts of a window follow from those of the window
before (one character leaves, one enters), so a candidate costs one pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, let, query, table, text_or_empty

# The base kinds, in their listed order.  A hex or access match
# is a whole run of its class, so the minimal length can stand in the pattern;
# an assign match that fails its length still uses up its characters.
_ASSIGNED = r"((?i)password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = _ASSIGNED + r"([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA([A-Z0-9]{16,})"
HEX = r"(?<![0-9a-f])([0-9a-f]{24,})"
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN = 6
_BASE = "|".join([_ASSIGNED + f"[A-Za-z0-9+/_.=-]{{{MIN_ASSIGN},}}", ACCESS, HEX])

# Key-like characters, and the placeholders that are no secret.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = r"(?<![A-Za-z0-9+_-])([A-Za-z0-9+_-][A-Za-z0-9+/_-]{22,}[A-Za-z0-9+_-])"
# Placeholders: a stretch between slashes that holds one is no secret.
ALLOW = (
    "(?i:example)",
    "(?i:placeholder)",
    "(?i:your[_-]?(api|key|token|secret))",
    "(?i:x{8})",
    "0123456789",
    "(?i:abcdefghij)",
    r"(?i:\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b)",
)
# Least bits per character for a random-looking window, by character class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.5, "mixed": 3.9}
WINDOW = 24
STRETCH = 256

_SPAN = "array<struct<start:int,rank:int,`end`:int,kind:string,hit:string,value_chars:int>>"


def _none() -> Column:
    return F.lit(None).cast(_SPAN)


def running_sums(lengths: Column) -> Column:
    """Sum of the elements before each element.  Arrays are copied as they
    grow, so sums run over stretches of ``STRETCH`` elements and then over the
    stretches."""
    def sums(a):
        zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(a, zero, lambda s, n: F.struct(
            (s["total"] + n).alias("total"), F.concat(s["out"], F.array(s["total"])).alias("out")))

    def joined(stretches):
        return let(sums(F.transform(stretches, lambda x: x["total"]))["out"], lambda first: F.flatten(
            F.transform(stretches, lambda x, i: F.transform(x["out"], lambda v: v + F.get(first, i)))))
    at = F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / STRETCH).cast("int"), F.lit(0)))
    return let(F.transform(at, lambda b: sums(F.slice(lengths, b * STRETCH + 1, F.lit(STRETCH)))), joined)


def _pieces(text: Column, pattern: str, mark: str) -> Column:
    """The text cut around each match: pieces at odd places are matches, shown
    as ``mark``."""
    return F.split(F.regexp_replace(F.translate(text, "\x01\x02", "\x03\x03"), pattern, F.lit(f"\x01{mark}\x01")), "\x01", -1)


def matches(text: Column, pattern: str, kind: str, value_group: int) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` with code-point offsets."""
    # a match shows as the hit, \x02, its value group
    hit = lambda p: F.substring_index(p, "\x02", 1)

    def spans(pieces):
        lengths = F.transform(pieces, lambda p, i: F.length(F.when(i % 2 == 1, hit(p)).otherwise(p)))

        def located(starts):
            def span(p, i):
                start, n = F.get(starts, i), F.length(hit(p))
                return F.when(i % 2 == 1, F.struct(
                    start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + n).alias("end"),
                    F.lit(kind).alias("kind"), hit(p).alias("hit"), (F.length(p) - n - 1).alias("value_chars")))
            return F.filter(F.transform(pieces, span), lambda x: x.isNotNull())
        return let(running_sums(lengths), located)
    found = let(_pieces(text, pattern, f"$0\x02${value_group}"), spans)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def blanked(text: Column, pattern: str) -> Column:
    """``text`` with every match of ``pattern`` turned into as many spaces."""
    parts = F.transform(_pieces(text, pattern, "$0"),
                        lambda p, i: F.when(i % 2 == 1, F.repeat(F.lit(" "), F.length(p))).otherwise(p))
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def best_window_entropy(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits per character) of any ``window``
    neighbouring characters of ``s``; null where ``s`` is shorter.

    With n_c the count of character c, H = log2(w) - sum(n_c log2 n_c) / w, so
    a step only touches the counts of the two characters that change.
    """
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)])

    def count(c, text):
        return F.length(text) - F.length(F.replace(text, c, F.lit("")))

    def step(st, c):
        full = F.length(st["win"]) == window
        rest = F.when(full, F.substring(st["win"], 2, window)).otherwise(st["win"])
        gone = F.when(full, count(F.left(st["win"], F.lit(1)), st["win"])).otherwise(F.lit(0))
        less = F.when(gone > 0, F.get(weight, gone) - F.get(weight, gone - 1)).otherwise(F.lit(0.0))

        def moved(x):
            total = st["g"] - x["less"] + F.get(weight, x["n"] + 1) - F.get(weight, x["n"])
            now = F.concat(x["rest"], c)
            return F.struct(now.alias("win"), total.alias("g"), F.when(
                F.length(now) == window, F.greatest(st["best"], F.lit(math.log2(window)) - total / window))
                .otherwise(st["best"]).alias("best"))
        return let(let(F.struct(rest.alias("rest"), less.alias("less")), lambda r: F.struct(
            r["rest"].alias("rest"), r["less"].alias("less"), count(c, r["rest"]).alias("n"))), moved)
    zero = F.struct(F.lit("").alias("win"), F.lit(0.0).alias("g"), F.lit(None).cast("double").alias("best"))
    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), zero, step, lambda st: st["best"])


def char_class(s: Column) -> Column:
    """hex, alnum (one letter case and digits) or mixed (both cases and
    digits); null for runs without a digit or letter, which are words or rules."""
    digit, low, up = s.rlike("[0-9]"), s.rlike("[a-z]"), s.rlike("[A-Z]")
    return (F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & (low | up), F.lit("hex"))
            .when(digit & low & up, F.lit("mixed"))
            .when(digit & (low | up), F.lit("alnum")))


def base_spans(text: Column) -> Column:
    assign = F.filter(matches(text, ASSIGN, "assign", 2), lambda m: m["value_chars"] >= MIN_ASSIGN)
    return F.sort_array(F.concat(assign, matches(text, ACCESS, "access", 1), matches(text, HEX, "hex", 1)))


def entropy_spans(text: Column, window: int = WINDOW, thresholds: dict | None = None,
                  allow: tuple[str, ...] = ALLOW) -> Column:
    """Candidates with a window at or over their class's entropy threshold, in
    what is left of the text without base matches and allow-listed stretches."""
    limits = thresholds or THRESHOLDS
    # a whole stretch between slashes that holds a pattern, tried once a stretch
    part = "[A-Za-z0-9+_-]"
    allowed = f"(?<!{part})(?={part}*?(?:{'|'.join(allow)})){part}+"

    def is_secret(m):
        limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[char_class(m["hit"])]
        return F.when(limit.isNotNull(), best_window_entropy(m["hit"], window) >= limit).otherwise(False)

    found = let(blanked(blanked(text, _BASE), allowed), lambda left: F.filter(
        matches(left, CANDIDATE, "entropy", 1), lambda m: F.coalesce(is_secret(m), F.lit(False))))
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(_SPAN))


def scan(df: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: all spans of a row's whole text, by start then kind:
    array<struct<start,rank,end,kind,hit,value_chars>> (code points, end
    exclusive).  A null or empty text has none, an empty table no rows; every
    column is kept: where one is named ``out`` already, the new column gets an
    underscore behind its name.  Repeated rows are scanned each for itself;
    spans of several kinds may overlap; the cost is near linear in a text's
    length and hits."""
    text = text_or_empty(text_col)
    every = F.sort_array(F.concat(base_spans(text), entropy_spans(text)))
    return df.withColumn(free_name(df, out), every)


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each span (or run of overlapping spans) replaced by ``mask``."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(s, m):
        cut = F.struct(m["end"].alias("pos"),
                       F.concat(s["out"], F.substr(text, s["pos"] + 1, m["start"] - s["pos"]), F.lit(mask)).alias("out"))
        joined = F.struct(F.greatest(s["pos"], m["end"]).alias("pos"), s["out"].alias("out"))
        return F.when((m["start"] >= s["pos"]), cut).otherwise(joined)

    done = F.aggregate(spans, zero, step,
                       lambda s: F.concat(s["out"], F.substr(text, s["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(kind):
        return F.size(F.filter("secrets", lambda m: m["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda m: m["kind"] != "entropy")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
                        n("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("secrets")).alias("spans"), n("entropy").alias("n_entropy"))
