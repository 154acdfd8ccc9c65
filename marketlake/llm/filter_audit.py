"""Filter interaction audit: what each filter removes in every order.

Every document fails a set of the filters.  Per part the documents are
counted by that set (a mask cell), so at most 2^n cells are left of a part
whatever its size.  A walk in Gray-code order then visits every subset of
filters, toggling one filter a step: each mask cell counts its active failing
filters, and a cell enters or leaves the survivors as its counter reaches or
leaves 0.  With the survivors of all subsets stored, any step of any order is
a difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

from .common import query, ship_package, table, text_or_empty
from .ranks import look_up

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SYMBOLS = "[#$%&*|]"
FILTERS = "ABCDE"


# ------------------------------------------------------------------- filters

def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself."""
    words = F.array_remove(F.split(text, SPACE, -1), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
            "C": 100 * capitals.cast("long") > MAX_CAPITAL_PERCENT * F.length(text).cast("long"),
            "D": text.rlike(SYMBOLS)}


def _mask(failures: dict[str, Column], filters: str = FILTERS) -> Column:
    out = F.lit(0)
    for f, failed in failures.items():
        out = out + F.when(failed, F.lit(1 << filters.index(f))).otherwise(F.lit(0))
    return out


def failing_masks(docs: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, mask) of each row: bit k of ``mask`` is set where the row
    fails filter k of ``FILTERS``.  Filter E fails a row whose whole text is
    that of a row with a smaller id anywhere in the table; a null id is
    smaller than none, and none is smaller than it.  Texts are compared by
    their SHA-256.  Null text is empty; a null part is the empty string."""
    text = text_or_empty(text_col)
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                      text.alias("text"))
    rows = cut_lineage(own.select("id", "part", _mask(text_failures(F.col("text"))).alias("mask"),
                                  F.unhex(F.sha2("text", 256)).alias("sha")))
    first = rows.groupBy("sha").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    copied = cut_lineage(first.where("n > 1"))
    # texts that occur once have no row in ``copied``
    found = look_up(rows, copied, ["sha"], "n", rows.count(), how="left")
    repeated = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return found.select("id", "part", (F.col("mask") + _mask({"E": repeated})).alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part by the filters they
    fail, and those labelled quality 1 and toxic 1 (of repeated labels the
    largest counts; null or missing labels count as 0).  Rows alike are summed
    before they meet the labels, so no id is a hot key."""
    counted = masks.groupBy("id", "part", "mask").agg(F.count("*").alias("n"))
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = counted.join(flags, "id", "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])


# ---------------------------------------------------------------------- walk

def survivors_of_subsets(masks: np.ndarray, counts: np.ndarray, n_filters: int) -> np.ndarray:
    """Survivors of each subset of filters (row: the subset as a bit mask;
    columns as in ``counts``), given the rows of each mask cell.  One filter
    is toggled a step; ``active`` holds each cell's failing active filters."""
    cells = np.asarray(masks, np.int64)
    rows = np.asarray(counts, np.int64)
    active = np.zeros(len(cells), np.int64)
    now, state = rows.sum(axis=0), 0
    out = np.zeros((1 << n_filters, rows.shape[1]), np.int64)
    out[0] = now
    for step in range(1, 1 << n_filters):
        toggled = (step & -step).bit_length() - 1       # the bit in which neighbouring Gray codes differ
        state ^= 1 << toggled
        failing = (cells >> toggled) & 1 == 1
        if state >> toggled & 1:
            now = now - rows[failing & (active == 0)].sum(axis=0)
            active[failing] += 1
        else:
            active[failing] -= 1
            now = now + rows[failing & (active == 0)].sum(axis=0)
        out[state] = now
    return out


def audit_rows(masks, counts, filters: str = FILTERS) -> Iterator[tuple]:
    """(order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of every step of every order of ``filters``."""
    n = len(filters)
    left = survivors_of_subsets(masks, counts, n)
    everything = (1 << n) - 1
    orders = [tuple(filters.index(f) for f in p) for p in permutations(sorted(filters))]
    steps = []
    for order in orders:
        done = 0
        for f in order:
            steps.append((order, f, left[done | 1 << f], left[done] - left[done | 1 << f]))
            done |= 1 << f
    over_orders = [sum(int(lost[0]) for _, f, _, lost in steps if f == k) for k in range(n)]
    for i, (order, f, kept, lost) in enumerate(steps):
        fails = int(left[0][0] - left[1 << f][0])
        alone = int(left[everything ^ 1 << f][0] - left[everything][0])
        yield ("".join(filters[k] for k in order), i % n + 1, filters[f], int(kept[0]), int(lost[0]), fails - int(lost[0]),
               alone, int(lost[1]), int(lost[2]), over_orders[f])


OUT = ("part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
       "unique_fails long, good_lost long, toxic_lost long, shapley long")
_NAMES = [c.split()[0] for c in OUT.split(", ")]


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, filter order and step (``OUT``).  ``labels (doc_id,
    quality, toxic)``.  Repeated rows are documents of their own; texts of any
    length are read whole; no documents give no parts and no rows; other
    columns are ignored, whatever their names.  The cells of a part, at most
    2^n, are all that one task holds of it."""
    cells = mask_cells(failing_masks(docs, part), labels)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def walk(batches):
        for batch in batches:
            for row in batch.to_pylist():
                masks = [c["mask"] for c in row["cells"]]
                counts = [(c["n"], c["good"], c["toxic"]) for c in row["cells"]]
                found = [(row["part"], *r) for r in audit_rows(masks, counts)]
                yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r)) for r in found], schema=_schema())
    return parts.mapInArrow(walk, OUT)


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in OUT.split(", ")])


_WORDS = r"list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY x) AS first FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
      CASE WHEN 100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * len(x) THEN 'C' END,
      CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' END, CASE WHEN w.doc_id > first THEN 'E' END) AS fails
  FROM w LEFT JOIN l USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
-- the step that removes a cell's rows: the first letter of the order that they fail
gone AS (SELECT *, len(regexp_extract(filter_order, CASE WHEN fails = '' THEN '^.*$' ELSE '^[^' || fails || ']*' END)) + 1 AS hit
  FROM cells, orders),
steps AS (SELECT unnest(range(1, 6)) AS step),
r AS (SELECT part, filter_order, step::INT AS step, filter_order[step] AS filter,
    sum(n) FILTER (WHERE hit > step) AS kept, sum(n) FILTER (WHERE hit = step) AS removed,
    sum(n) FILTER (WHERE contains(fails, filter_order[step]) AND hit < step) AS redundant,
    sum(n) FILTER (WHERE fails = filter_order[step]) AS unique_fails,
    sum(good) FILTER (WHERE hit = step) AS good_lost, sum(toxic) FILTER (WHERE hit = step) AS toxic_lost
  FROM gone, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, filter, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM r
"""


@query(SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))
