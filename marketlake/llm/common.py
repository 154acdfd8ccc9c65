"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import ship_package  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; ``sql`` is its DuckDB twin."""
    def deco(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql.strip()
        return f
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """Null text counts as the empty text everywhere in this subpackage."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it while a column of ``df`` has that
    name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses
    it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crc_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n`` (a null id counts as the empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def bounded_sample(rows: DataFrame, n: int, max_chars: int, long_rows: int, seed: str) -> DataFrame:
    """At most ``n`` of ``rows (id, chars, ...)``, drawn by a hash of the id
    from those of up to ``max_chars``; where these are fewer, the shortest
    longer ones too, at most ``long_rows`` of them."""
    short = F.col("chars") <= max_chars
    drawn = rows.orderBy((~short).cast("int"), F.when(short, F.xxhash64("id", F.lit(seed))).otherwise(F.col("chars")), "id").limit(n)
    return drawn.where(short).unionByName(drawn.where(~short).orderBy("chars", "id").limit(long_rows))


def row_chars(docs: DataFrame) -> DataFrame:
    """(id, chars) of each id: the length of its shortest text, null counted as
    empty."""
    return (docs.select(F.col("doc_id").alias("id"), F.length(text_or_empty("text")).alias("chars"))
            .where("id is not null").groupBy("id").agg(F.min("chars").alias("chars")))
