"""Keyed writes (UPS-*) as pure (existing, incoming) -> new-table functions.

Each upsert is one union of both sides followed by one keyed aggregation
(``max_by`` / ``min_by`` over a (side, seq) order): a single shuffle on the
key with map-side partial aggregation, so a hot key never gathers its rows
in one task.  ``sources.sink`` writes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import dims_to_json
from .order import keep_last
from .joins import combine_first, new_only

SIDE = "_side"   # 0 = stored, 1 = incoming
SEQ = "_seq"


def _tag(df: DataFrame, side: int, seq: Column | None) -> DataFrame:
    return df.withColumn(SEQ, seq if seq is not None else F.lit(0).cast("long")).withColumn(SIDE, F.lit(side))


def _row_hash(df: DataFrame, cols: list[str]) -> Column:
    """Last resort in an order: rows that tie in all else compare by a hash of
    their values, so the same rows always give the same winner."""
    plain = [F.to_json(F.col(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in cols]
    return F.xxhash64(*plain) if plain else F.lit(0)


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str],
           incoming_seq: Column | None = None, keep_from_existing: list[str] | None = None,
           existing_seq: Column | None = None) -> DataFrame:
    """UPS-1/UPS-2: insert new keys; on conflict the incoming row replaces
    every column except ``keep_from_existing`` (e.g. created_at), which keeps
    the stored value.  Duplicate keys inside the batch: the last by
    ``incoming_seq`` wins (D-19).  Nulls stay null (D-22)."""
    keep_from_existing = keep_from_existing or []
    cols = [c for c in existing.columns if c not in key]
    seq = incoming_seq if incoming_seq is not None else F.lit(0)
    inc = incoming.select(*key, *[
        (F.col(c) if c in incoming.columns else F.lit(None)).cast(existing.schema[c].dataType).alias(c)
        for c in cols], seq.alias(SEQ)).withColumn(SIDE, F.lit(1))
    seq_type = inc.schema[SEQ].dataType
    ex = _tag(existing.select(*key, *cols), 0,
              (existing_seq if existing_seq is not None else F.lit(None)).cast(seq_type))
    u = ex.unionByName(inc)
    order = F.struct(F.col(SIDE), F.col(SEQ), _row_hash(existing, cols))
    aggs = [F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_new")]
    for c in keep_from_existing:
        # first row in (side, seq) order: the stored row when there is one
        aggs.append(F.min_by(F.col(c), order).alias(f"_keep_{c}"))
    g = u.groupBy(*key).agg(*aggs)
    out = [F.col(k) for k in key]
    for c in cols:
        out.append((F.col(f"_keep_{c}") if c in keep_from_existing else F.col(f"_new.{c}")).alias(c))
    return g.select(*out)


def dims_key(dims_col: str = "dimensions") -> Column:
    """UPS-3: canonical text key of a map column (keys sorted), usable as a
    join / group key where a map itself is not allowed."""
    return dims_to_json(F.col(dims_col))


def upsert_dimensional(existing: DataFrame, incoming: DataFrame, code: str = "code",
                       date: str = "date", dims_col: str = "dimensions",
                       incoming_seq: Column | None = None) -> DataFrame:
    """UPS-3: key (code, date, dimensions) with key order inside the map
    ignored."""
    e = existing.withColumn("dim_key", dims_key(dims_col))
    i = incoming.withColumn("dim_key", dims_key(dims_col))
    return upsert(e, i, [code, date, "dim_key"], incoming_seq)


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: list[str],
                  incoming_seq: Column | None = None) -> DataFrame:
    """UPS-4: stored rows stay; new keys are added, the first in batch order
    when the batch repeats a key."""
    cols = [c for c in existing.columns if c not in key]
    seq = incoming_seq if incoming_seq is not None else F.lit(0)
    inc = incoming.select(*key, *cols, seq.alias(SEQ)).withColumn(SIDE, F.lit(1))
    u = _tag(existing.select(*key, *cols), 0, F.lit(None).cast(inc.schema[SEQ].dataType)).unionByName(inc)
    order = F.struct(F.col(SIDE), F.col(SEQ), _row_hash(existing, cols))
    g = u.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
    return g.select(*key, "_r.*")


def append_new(existing: DataFrame, incoming: DataFrame, key: list[str],
               dedupe_batch: bool = True, incoming_seq: list[str] | None = None) -> DataFrame:
    """UPS-5: drop incoming rows with a blank or stored key, append the rest.
    ``dedupe_batch`` keeps only the first row per key inside the batch."""
    new = new_only(incoming, existing, key)
    if dedupe_batch:
        from .order import keep_first
        new = keep_first(new, key, incoming_seq or key)
    return existing.unionByName(new.select(*existing.columns))


def existing_wins(existing: DataFrame, incoming: DataFrame, key: list[str] | None,
                  seq: list[str]) -> DataFrame:
    """UPS-6: keep-last on both sides, drop incoming keys already stored,
    append; without a key it is a plain append."""
    if not key:
        return existing.unionByName(incoming, allowMissingColumns=True)
    e = keep_last(existing, key, seq)
    i = keep_last(incoming, key, seq)
    i = i.join(e.select(*key), key, "left_anti")
    return e.unionByName(i, allowMissingColumns=True)


def merge(existing: DataFrame, incoming: DataFrame, key: list[str], update_existing: bool,
          prefer: str = "existing") -> DataFrame:
    """UPS-7: null-filling merge (JOIN-9) or append of new keys."""
    if update_existing:
        return combine_first(existing, incoming, key, prefer=prefer)
    new = new_only(incoming, existing, key)
    return existing.unionByName(new, allowMissingColumns=True)


def kv_upsert(existing: DataFrame, incoming: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """UPS-8: key/value metadata.  Incoming values replace stored ones;
    seed rows fill keys that neither side has."""
    out = upsert(existing, incoming, ["key"])
    if seed is not None:
        out = out.unionByName(seed.join(out.select("key"), "key", "left_anti").select(*out.columns))
    return out


# --------------------------------------------------------------------- UPS-9
def ledger_fold(outcomes: DataFrame, key: list[str], ts: str, outcome: str, error: str,
                tiebreak: str | None = None) -> DataFrame:
    """Download ledger state per key from its ordered outcome events.

    success: status=success, downloaded_at=ts, retry_count=0, error=null;
    failed:  status=failed, failed_at=ts, error=message, retry_count+1;
    other outcomes (pending, skipped): status and last_attempt only, no error;
    other fields keep their previous value.

    Expressed as aggregates instead of a sequential fold:
      last event        -> status, last_attempt (max_by)
      last success time -> downloaded_at; last failure time -> failed_at
      retry_count       -> failures after the last success
      error_message     -> message of the last event if it failed
    Two partial aggregations and one join on the key; no key's events are
    ever gathered in one place.
    """
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.struct(F.col(ts))
    ok, failed = F.col(outcome) == "success", F.col(outcome) == "failed"
    s1 = outcomes.groupBy(*key).agg(
        F.max_by(F.col(outcome), order).alias("status"),
        F.max_by(F.col(error), order).alias("_last_error"),
        F.max(F.when(ok, order)).alias("_last_ok"),
        F.max(F.when(ok, F.col(ts))).alias("downloaded_at"),
        F.max(F.when(failed, F.col(ts))).alias("failed_at"),
        F.max(F.col(ts)).alias("last_attempt"))
    j = outcomes.select(*key, order.alias("_o"), failed.alias("_failed")).join(s1.select(*key, "_last_ok"), key, "inner")
    retries = j.groupBy(*key).agg(
        F.count_if(F.col("_failed") & (F.col("_last_ok").isNull() | (F.col("_o") > F.col("_last_ok"))))
        .alias("retry_count"))
    out = s1.join(retries, key, "inner")
    return out.select(*key, "status", "downloaded_at", "failed_at",
                      F.when(F.col("status") == "failed", F.col("_last_error")).alias("error_message"),
                      F.col("retry_count").cast("int").alias("retry_count"), "last_attempt")


def ledger_lookup(ledger: DataFrame, **key_values) -> DataFrame:
    """UPS-10: one row or none."""
    pred = F.lit(True)
    for k, v in key_values.items():
        pred = pred & (F.col(k) == F.lit(v))
    return ledger.where(pred)
