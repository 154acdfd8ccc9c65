"""Merkle manifest of a dataset with proofs for every row.  DataFrame functions only.

Each group of rows (``lang``) is a tree of fan-out ``FAN`` over its leaves; the
groups' roots are the leaves of one more tree.  A node carries the interval
[lo, hi) of leaf ranks that it covers:

- the nodes of a level whose intervals lie in one interval of the next level
  are a family: its parent's digest is the hash of theirs;
- a family finds its parent's own family by a containment join, level by level
  from the root, on (tree, the interval's place in its level): no more than
  ``FAN`` families meet one, whatever the size of the tree;
- within a family the siblings of a node are what is left of the family's
  interval without the node's, to its left and to its right.

The steps (left and right digests) of a family's parent up to the root are
handed down, so that a row's proof is its own family's step and those.
Digests move as 32 bytes and are hashed as hexadecimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

from .common import let, query, table
from .ranks import ordered, ranks

FAN = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_STEPS = "array<struct<left:binary,right:binary>>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else UTF-8 length, ``:``, value."""
    return F.sha2(F.concat(*[let(f.cast("string"), lambda v: F.coalesce(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))) for f in fields]), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(members: Column) -> Column:
    return F.aggregate(members, F.lit(b""), lambda all_, c: F.concat(all_, c["digest"]))


def _step(members: Column, lo: Column, hi: Column) -> Column:
    """The siblings' digests of the member that covers [lo, hi)."""
    return F.struct(_joined(F.filter(members, lambda c: c["hi"] <= lo)).alias("left"),
                    _joined(F.filter(members, lambda c: c["lo"] >= hi)).alias("right"))


def fold(steps: Column, digest: Column) -> Column:
    """The root that follows from a leaf's digest and its steps."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(_hex(s["left"]), d, _hex(s["right"])), 256))


def proof(steps: Column) -> Column:
    """SHA-256 of all siblings, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)


def families(leaves: DataFrame, carried: list[str], fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees over ``leaves (tree, n, rank, digest, *carried)``,
    ``n`` leaves to a tree: per level one row (tree, n, at, lo, hi, members,
    digest) for each family, ``members`` in order as (lo, hi, digest,
    *carried), ``digest`` the parent's; and the roots (tree, digest).  A tree
    of one leaf has no family; levels end with the tallest tree."""
    nodes = leaves.select("tree", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *carried)
    roots = nodes.where("n = 1").select("tree", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [], 1
    while width < most:
        member = F.struct("lo", "hi", "digest", *(carried if width == 1 else []))
        wide = width * fan
        family = (nodes.where(F.col("n") > width)
                  .groupBy("tree", "n", F.expr(f"lo div {wide}").alias("at"))
                  .agg(F.sort_array(F.collect_list(member)).alias("members"))
                  .select("tree", "n", "at", F.element_at("members", 1)["lo"].alias("lo"),
                          F.element_at("members", -1)["hi"].alias("hi"), "members",
                          F.unhex(F.sha2(_hex(_joined(F.col("members"))), 256)).alias("digest")))
        levels.append(cut_lineage(family))
        nodes = levels[-1].select("tree", "n", "lo", "hi", "digest")
        roots = roots.unionByName(nodes.where(F.col("n") <= wide).select("tree", "digest"))
        width = wide
    return levels, roots


def with_steps(levels: list[DataFrame], above: DataFrame, fan: int = FAN) -> DataFrame | None:
    """The families of the lowest level with ``steps`` of their parent up to
    the root: ``above (tree, steps, *handed)`` are those of each tree's own
    root, and what else each of its families gets.  None where no tree has a
    family."""
    handed = [c for c in above.columns if c not in ("tree", "steps")]
    rows, width = None, fan ** len(levels)
    for family in reversed(levels):
        at_root = family.where(F.col("n") <= width).join(above, "tree")
        if rows is None:
            rows = at_root
        else:
            node = rows.select(F.col("tree").alias("__tree"), "steps", "members", *handed, F.explode("members").alias("c"))
            node = node.select(
                "__tree", *handed, F.col("c.lo").alias("__lo"), F.col("c.hi").alias("__hi"),
                F.concat(F.array(_step(F.col("members"), F.col("c.lo"), F.col("c.hi"))), "steps").alias("steps"))
            inside = ((F.col("tree") == F.col("__tree")) & (F.col("at") == F.expr(f"__lo div {width}"))
                      & (F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi")))
            below = family.where(F.col("n") > width).join(node, inside)
            out = [*family.columns, "steps", *handed]
            rows = below.select(*out).unionByName(at_root.select(*out))
        width //= fan
    return rows


def manifest(df: DataFrame, group: str = "lang", order: str = "doc_id", fields: list[str] | None = None,
             tampered: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """One row per row of ``df``: (order, leaf, subroot, root, steps,
    tampered_leaf), digests in hexadecimal.  ``steps``:
    array<struct<left,right>>, the siblings' digests of each level up to the
    root, 32 bytes each; ``tampered_leaf``: the leaf of the
    row with the fields of ``tampered`` in place of its own.

    Leaves stand by ``order`` (null first), then leaf digest, so repeated rows
    are leaves of their own and equal; groups by bytes, null first.  Null
    fields are told from empty ones; texts of any length are hashed whole; an
    empty table has no rows; columns beside the fields are ignored, whatever
    their names.
    """
    names = fields or FIELDS
    own = {c: F.col(c) for c in names}
    # written first: the sort reads its rows twice, the texts are read once
    leaves = cut_lineage(df.select(F.col(group).alias("grp"), F.col(order).alias("ord"),
                                   F.unhex(leaf_digest([own[c] for c in names])).alias("digest"),
                                   F.unhex(leaf_digest([(tampered or {}).get(c, own[c]) for c in names])).alias("forged")))
    by_order = [F.col(c).asc_nulls_first() for c in ("grp", "ord", "digest")]
    ranked = ranks(ordered(leaves, by_order), ["grp"])
    sizes = ranked.groupBy("grp").agg(F.count("*").alias("n"))
    trees = cut_lineage(ranks(ordered(sizes, by_order[:1]), [], rank="tree"))
    rows = ranked.join(trees.withColumnRenamed("grp", "__grp"), F.col("grp").eqNullSafe(F.col("__grp")))
    levels, subroots = families(rows.select("tree", "n", "rank", "digest", "ord", "forged"), ["ord", "forged"], fan)

    # the tree of the groups: one tree, a leaf for each subroot
    n_trees = trees.count()
    tops = cut_lineage(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"),
                                       F.col("tree").alias("rank"), "digest"))
    upper, root = families(tops, [], fan)
    none = F.array().cast(_STEPS)
    top_steps = with_steps(upper, root.select("tree", none.alias("steps")), fan)
    if top_steps is None:
        above = tops.select(F.col("rank").alias("tree"), none.alias("steps"))
    else:
        above = top_steps.select("steps", "members", F.explode("members").alias("c")).select(
            F.col("c.lo").alias("tree"),
            F.concat(F.array(_step(F.col("members"), F.col("c.lo"), F.col("c.hi"))), "steps").alias("steps"))
    whole = root.first()      # one digest, none of an empty table
    above = cut_lineage(above.join(tops.select(F.col("rank").alias("tree"), F.col("digest").alias("subroot")), "tree")
                        .withColumn("root", F.lit(bytes(whole["digest"]) if whole else None).cast("binary")))

    def shown(leaf: str, steps: Column) -> list[Column]:
        return [F.col(f"{leaf}ord").alias(order), _hex(F.col(f"{leaf}digest")).alias("leaf"),
                _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), steps.alias("steps"),
                _hex(F.col(f"{leaf}forged")).alias("tampered_leaf")]
    alone = rows.where("n = 1").join(above, "tree").select(*shown("", F.col("steps")))
    low = with_steps(levels, above, fan)
    if low is None:
        return alone
    each = low.select("steps", "members", "subroot", "root", F.explode("members").alias("c"))
    own_step = F.array(_step(F.col("members"), F.col("c.lo"), F.col("c.hi")))
    return each.select(*shown("c.", F.concat(own_step, "steps"))).unionByName(alone)


def _tree_sql(name: str, tree: str, levels: int) -> str:
    """CTEs of the levels over ``{name}0 ({tree}, idx, digest)``: a tree that
    has come down to one node keeps it."""
    out = []
    for k in range(levels):
        out.append(f"""
{name}s{k} AS (   -- the digests left and right of each node of level {k} in its family
  SELECT *, coalesce(string_agg(digest, '') OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(digest, '') OVER (f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt,
    count(*) OVER (PARTITION BY {tree}) AS cnt
  FROM {name}{k} WINDOW f AS (PARTITION BY {tree}, idx // {FAN} ORDER BY idx)),
{name}{k + 1} AS (
  SELECT {tree}, idx // {FAN} AS idx,
    CASE WHEN any_value(cnt) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {name}s{k} GROUP BY {tree}, idx // {FAN})""")
    return ",".join(out)


def _path_sql(name: str, tree: str, levels: int) -> tuple[str, str]:
    """Joins of a leaf ``x.{tree}, x.{name}_idx`` with its node of each level,
    and the (left, right) steps of those levels that have a parent."""
    joins = "\n".join(f"JOIN {name}s{k} {name}p{k} ON {name}p{k}.{tree} IS NOT DISTINCT FROM x.{tree} "
                      f"AND {name}p{k}.idx = x.{name}_idx // {FAN ** k}" for k in range(levels))
    steps = [f"CASE WHEN {name}p{k}.cnt > 1 THEN [{{'l': {name}p{k}.lft, 'r': {name}p{k}.rgt}}] ELSE [] END"
             for k in range(levels)]
    return joins, " || ".join(steps)


def _sql(leaf_levels: int = 9, top_levels: int = 3) -> str:
    def h(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars"]
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in fields]
        return f"sha256({' || '.join(parts)} || coalesce(strlen({text}) || ':' || {text}, '-'))"
    crc = ("xor(list_reduce(list_concat([4294967295]::UBIGINT[], list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), "
           "lambda c: ord(c)::UBIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], "
           "lambda v, u: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf_joins, leaf_steps = _path_sql("n", "lang", leaf_levels)
    top_joins, top_steps = _path_sql("t", "one", top_levels)
    return f"""
WITH d AS (SELECT *, {h('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {h(lower)} ELSE {h('text')} END AS forged FROM documents),
n0 AS MATERIALIZED (SELECT doc_id, lang, leaf AS digest, forged,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
{_tree_sql('n', 'lang', leaf_levels)},
t0 AS (SELECT 1 AS one, lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx FROM n{leaf_levels}),
{_tree_sql('t', 'one', top_levels)},
x AS (SELECT n0.*, n0.idx AS n_idx, 1 AS one, t0.idx AS t_idx, t0.digest AS subroot, t{top_levels}.digest AS root
  FROM n0 JOIN t0 ON t0.lang IS NOT DISTINCT FROM n0.lang, t{top_levels}),
p AS (SELECT x.doc_id, x.digest AS leaf, x.subroot, x.root, x.forged, {leaf_steps} || {top_steps} AS steps
  FROM x {leaf_joins} {top_joins})
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.l || s.r), '')) AS proof_sha256,
  list_reduce([forged] || list_transform(steps, lambda s: s.l || '.' || s.r),
    lambda v, s: sha256(split_part(s, '.', 1) || v || split_part(s, '.', 2))) AS folded_root,
  folded_root = root AS verified
FROM p
"""


@query(_sql())
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    forged = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.when(forged, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    out = manifest(docs, tampered={"text": lowered}).withColumn("folded_root", fold(F.col("steps"), F.col("tampered_leaf")))
    return out.select("doc_id", "leaf", "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
