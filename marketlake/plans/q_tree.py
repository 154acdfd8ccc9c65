"""Registered queries: hierarchies (HIER-*, SET-6, JOIN-3..6, AGG-2/3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs as AG
from ..operators import joins as J
from ..operators import tree as TR
from .oracle import CATEGORY_TREE
from .registry import query
from .tables import category_tree, read

TREE_SQL = "WITH RECURSIVE " + CATEGORY_TREE + """,
cats AS (
  SELECT category_id, name,
         CASE WHEN parent_id IS NULL OR parent_id = category_id THEN NULL ELSE parent_id END AS parent_id
  FROM categories
),
roots AS (
  SELECT * FROM cats WHERE parent_id IS NULL
  UNION ALL
  SELECT * FROM cats WHERE parent_id = 0 AND NOT EXISTS (SELECT 1 FROM cats x WHERE x.category_id = 0)
),
paths AS (
  SELECT category_id, name, parent_id, CAST(name AS VARCHAR) AS full_path, [category_id] AS path, 0 AS depth
  FROM roots
  UNION ALL
  SELECT c.category_id, c.name, c.parent_id, p.full_path || ' / ' || c.name,
         list_append(p.path, c.category_id), p.depth + 1
  FROM cats c JOIN paths p ON c.parent_id = p.category_id
  WHERE NOT list_contains(p.path, c.category_id)
),
analysis AS (
  SELECT c.category_id, c.name, c.parent_id,
         EXISTS (SELECT 1 FROM cats ch WHERE ch.parent_id = c.category_id) AS is_branch,
         (SELECT count(*) FROM cats ch WHERE ch.parent_id = c.category_id) AS child_count,
         coalesce((SELECT min(depth) FROM paths p WHERE p.category_id = c.category_id), 0) AS parent_count
  FROM cats c
)"""


@query(sql=TREE_SQL + """
SELECT category_id, name, parent_id, full_path, depth FROM paths""")
def q_tree_paths(spark, d):
    """HIER-1/SET-6: full name path of every category (roots: parent
    missing; a self-parented row 0 is the single root)."""
    return TR.paths(category_tree(spark, d)).drop("path")


@query(sql=TREE_SQL + """
SELECT category_id, name, parent_id, is_branch, child_count, parent_count FROM analysis""")
def q_cat_analysis(spark, d):
    """HIER-2/JOIN-4/5/6/AGG-3/WIN-5: branch flag, child count, depth."""
    return TR.category_analysis(category_tree(spark, d)).orderBy(
        F.col("is_branch").desc(), F.col("child_count").desc(), F.col("parent_count").desc(), "name")


@query(sql=TREE_SQL + """
SELECT count(*) FILTER (WHERE is_branch) AS total_branches,
       count(*) FILTER (WHERE NOT is_branch) AS total_leaves,
       count(*) AS total_categories
FROM analysis""")
def q_branch_totals(spark, d):
    """AGG-2: branches, leaves, total."""
    return AG.branch_totals(TR.category_analysis(category_tree(spark, d)))


@query(sql=TREE_SQL + """
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS series_id FROM customer
WHERE c_nationkey + 100 IN (SELECT category_id FROM paths WHERE full_path LIKE '%AMERICA%' GROUP BY category_id)
  AND CAST(2020 + c_custkey % 8 AS VARCHAR) || '-06-30' >= '2025-01-01'""")
def q_path_series(spark, d):
    """HIER-3/JOIN-3/FLT-12: series whose category path mentions a word
    and whose observations end recently."""
    p = TR.paths(category_tree(spark, d))
    cats = p.where(F.col("full_path").like("%AMERICA%")).select("category_id")
    series = read(spark, d, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("series_id"),
        (F.col("c_nationkey") + 100).cast("long").alias("category_id"),
        F.concat((F.lit(2020) + F.col("c_custkey") % 8).cast("string"), F.lit("-06-30")).alias("observation_end"))
    return J.series_under_categories(cats, series).select("series_id")


@query(sql="WITH RECURSIVE " + CATEGORY_TREE + """,
cats AS (
  SELECT category_id, name,
         CASE WHEN parent_id IS NULL OR parent_id = category_id THEN NULL ELSE parent_id END AS parent_id
  FROM categories
),
walk AS (
  SELECT category_id, name, parent_id, 0 AS depth FROM cats WHERE category_id = 2
  UNION ALL
  SELECT c.category_id, c.name, c.parent_id, w.depth + 1 FROM cats c JOIN walk w ON c.parent_id = w.category_id
)
SELECT category_id, min(name) AS name, min(parent_id) AS parent_id, min(depth) AS depth
FROM walk GROUP BY category_id""")
def q_closure(spark, d):
    """HIER-4: a root and all its descendants, breadth first, each once."""
    return TR.closure(category_tree(spark, d), 2)
