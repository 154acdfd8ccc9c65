"""Hierarchies (HIER-*): paths, depth, branch/leaf analysis, closure.

Pointer doubling: every row knows the stretch of its path from itself up to,
but without, some ancestor.  A round puts the ancestor's own stretch before
it, so stretches double and a tree of depth n takes log2(n) rounds, each one
equi join of a table with itself.  Rows whose stretch begins at a root are
done.  A stretch that would hold an id twice is a cycle and is dropped; rows
below a parent that does not exist find none and go too.

Every round is written to the checkpoint folder, so plans do not grow with the
depth and a lost executor costs one round; one boolean a round reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def clean_edges(categories: DataFrame, id_col: str = "category_id",
                parent_col: str = "parent_id") -> DataFrame:
    """D-5/D-6: self edges dropped; parent null, '' or 0 (when no row 0
    exists) means root; when a row 0 exists, rows hanging from it keep parent
    0, and rows with a null or '' parent are roots beside it."""
    p = F.col(parent_col)
    return categories.withColumn(
        parent_col, F.when(p.isNull() | (p.cast("string") == "") | (p == F.col(id_col)), F.lit(None))
        .otherwise(p.cast("long")))


def _with_ancestor(edges: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """``edges`` with ``_anc``: the parent, null for roots.  A parent 0 that
    has no row (the conventional root id) makes its rows roots."""
    zero = edges.agg(F.coalesce(F.max(F.col(id_col) == 0), F.lit(False)).alias("_has_zero"))
    up = F.when((F.col(parent_col) == 0) & ~F.col("_has_zero"), F.lit(None)).otherwise(F.col(parent_col))
    return edges.crossJoin(F.broadcast(zero)).withColumn("_anc", up).drop("_has_zero")      # one row


def paths(categories: DataFrame, id_col: str = "category_id", name_col: str = "name",
          parent_col: str = "parent_id", sep: str = " / ") -> DataFrame:
    """HIER-1/HIER-2: every reachable category with its name path, id path
    and depth (roots have depth 0).  A category under several parents has a
    row for each path."""
    edges = clean_edges(categories, id_col, parent_col).select(id_col, name_col, parent_col)
    now = _with_ancestor(edges, id_col, parent_col).select(
        id_col, name_col, parent_col, "_anc", F.array(F.col(id_col)).alias("path"),
        F.array(F.col(name_col).cast("string")).alias("_names"))
    while True:
        above = now.select(F.col(id_col).alias("_id"), F.col("_anc").alias("_up"), F.col("path").alias("_path"),
                           F.col("_names").alias("_above"))
        grown = (now.where(F.col("_anc").isNotNull()).join(above, F.col("_anc") == F.col("_id"))
                 .where(~F.arrays_overlap("_path", "path"))
                 .select(id_col, name_col, parent_col, F.col("_up").alias("_anc"), F.concat("_path", "path").alias("path"),
                         F.concat("_above", "_names").alias("_names")))
        now = cut_lineage(now.where(F.col("_anc").isNull()).unionByName(grown))
        if now.where(F.col("_anc").isNotNull()).isEmpty():
            break
    # a null name leaves no path, as in a concatenation
    whole = F.when(~F.exists("_names", lambda n: n.isNull()), F.array_join("_names", sep))
    return now.select(id_col, name_col, parent_col, whole.alias("full_path"), "path",
                      (F.size("path") - 1).alias("depth"))


def distances(edges: DataFrame, is_source: Column, id_col: str = "category_id") -> DataFrame:
    """(id, depth): fewest steps down from a source row to each row that can
    be reached, by pointer doubling on ``_anc`` without the paths.  Rows in or
    below a cycle come near a source within as many steps as there are rows or
    never, which ends the rounds."""
    now = edges.select(F.col(id_col).alias("_id"), F.when(~is_source, F.col("_anc")).alias("_up"),
                       F.when(is_source, 0).otherwise(1).alias("_hops")).where(is_source | F.col("_up").isNotNull())
    rows, reach = None, 1
    while True:
        above = now.select(F.col("_id").alias("_over"), F.col("_up").alias("_next"), F.col("_hops").alias("_more"))
        grown = (now.where(F.col("_up").isNotNull()).join(above, F.col("_up") == F.col("_over"))
                 .select("_id", F.col("_next").alias("_up"), (F.col("_hops") + F.col("_more")).alias("_hops")))
        now = cut_lineage(now.where(F.col("_up").isNull()).unionByName(grown)
                          .groupBy("_id", "_up").agg(F.min("_hops").alias("_hops")))
        reach *= 2
        if now.where(F.col("_up").isNotNull()).isEmpty():
            break
        rows = edges.count() if rows is None else rows
        if reach > rows:
            break
    return now.where(F.col("_up").isNull()).select(F.col("_id").alias(id_col), F.col("_hops").alias("depth"))


def category_analysis(categories: DataFrame, id_col: str = "category_id", name_col: str = "name",
                      parent_col: str = "parent_id") -> DataFrame:
    """HIER-2 with JOIN-4/5/6: is_branch, child_count, parent_count (= depth,
    0 when the category is unreachable)."""
    from .joins import branch_flags
    edges = clean_edges(categories, id_col, parent_col)
    flags = branch_flags(edges, id_col, parent_col)
    up = _with_ancestor(edges, id_col, parent_col)
    depth = distances(up, F.col("_anc").isNull(), id_col).withColumnRenamed("depth", "_d")
    j = flags.join(depth, id_col, "left")
    return j.select(id_col, name_col, parent_col, "is_branch", "child_count",
                    F.coalesce(F.col("_d"), F.lit(0)).alias("parent_count"))


def closure(categories: DataFrame, root_id: int, id_col: str = "category_id",
            name_col: str = "name", parent_col: str = "parent_id", default_name: str = "Category ") -> DataFrame:
    """HIER-4: the root and every descendant (visited once), with the
    distance from the root; missing names get '<default><id>'."""
    edges = clean_edges(categories, id_col, parent_col).select(id_col, name_col, parent_col)
    below = distances(edges.withColumn("_anc", F.col(parent_col)), F.col(id_col) == root_id, id_col)
    one = edges.groupBy(id_col).agg(F.min(F.struct(parent_col, name_col)).alias("_row"))
    name = F.coalesce(F.col(f"_row.{name_col}"), F.concat(F.lit(default_name), F.col(id_col).cast("string")))
    return below.join(one, id_col).select(id_col, name.alias(name_col), F.col(f"_row.{parent_col}").alias(parent_col), "depth")


def register_views(df: DataFrame, names: list[str]) -> None:
    """D-7: register one result under every name user SQL refers to (the
    path view is read under two names)."""
    for n in names:
        df.createOrReplaceTempView(n)


def stored_parent(categories: DataFrame, id_col: str = "category_id", parent_col: str = "parent_id") -> DataFrame:
    """UPS-1 storage rule for categories: a missing parent is stored as 0
    (the root id); the root row itself keeps 0.  ``clean_edges`` undoes it
    for traversal."""
    return categories.withColumn(parent_col, F.coalesce(F.col(parent_col).cast("long"), F.lit(0).cast("long")))
