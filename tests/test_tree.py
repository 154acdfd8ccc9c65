"""Hierarchy edge cases: self-parented root, cycles, closure."""

from marketlake.operators import tree as TR

SCHEMA = "category_id long, name string, parent_id long"


def test_self_root_and_paths(spark):
    cats = spark.createDataFrame([(0, "Root", 0), (1, "A", 0), (2, "B", 1), (3, "C", 1)], SCHEMA)
    got = {r.category_id: (r.full_path, r.depth) for r in TR.paths(cats).collect()}
    assert got == {0: ("Root", 0), 1: ("Root / A", 1), 2: ("Root / A / B", 2), 3: ("Root / A / C", 2)}
    an = {r.category_id: (r.is_branch, r.child_count, r.parent_count) for r in TR.category_analysis(cats).collect()}
    assert an[1] == (True, 2, 1) and an[3] == (False, 0, 2)


def test_roots_without_row_zero(spark):
    cats = spark.createDataFrame([(1, "A", 0), (2, "B", 1), (5, "E", None)], SCHEMA)
    got = {r.category_id: r.depth for r in TR.paths(cats).collect()}
    assert got == {1: 0, 2: 1, 5: 0}


def test_cycle_terminates(spark):
    cats = spark.createDataFrame([(1, "A", None), (2, "B", 1), (3, "C", 2), (2, "B2", 3)], SCHEMA)
    out = TR.paths(cats).collect()
    assert len(out) < 10


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    write = TR.cut_lineage
    monkeypatch.setattr(TR, "cut_lineage", lambda df: rounds.append(1) or write(df))
    n = 10_000
    chain = spark.range(1, n + 1).selectExpr("id category_id", "concat('n', id) name", "nullif(id - 1, 0) parent_id")
    an = TR.category_analysis(chain)
    assert an.where("parent_count = category_id - 1").count() == n and len(rounds) < 20
    rounds.clear()
    down = TR.closure(chain, 4000)
    assert down.where("depth = category_id - 4000").count() == n - 3999 == down.count() and len(rounds) < 20
    rounds.clear()
    short = TR.paths(chain.where("category_id <= 700"))
    assert short.where("depth = category_id - 1 and size(path) = category_id").count() == 700 and len(rounds) < 13


def test_cycles_dangling_rows_and_many_parents(spark):
    rows = [(1, "A", None), (2, "B", 1), (3, "C", 2), (3, "C", 1), (4, "D", 3),      # 3 under 2 and under 1
            (10, "X", 12), (11, "Y", 10), (12, "Z", 11), (13, "W", 12),               # a cycle and a row below it
            (20, "Q", 99), (21, None, 1)]                                             # no such parent; no name
    cats = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.category_id, r.depth, r.full_path or "") for r in TR.paths(cats).collect())
    assert got == [(1, 0, "A"), (2, 1, "A / B"), (3, 1, "A / C"), (3, 2, "A / B / C"), (4, 2, "A / C / D"),
                   (4, 3, "A / B / C / D"), (21, 1, "")]
    depth = {r.category_id: r.parent_count for r in TR.category_analysis(cats).collect()}
    assert depth == {1: 0, 2: 1, 3: 1, 4: 2, 10: 0, 11: 0, 12: 0, 13: 0, 20: 0, 21: 1}
    assert {r.category_id: r.depth for r in TR.closure(cats, 10).collect()} == {10: 0, 11: 1, 12: 2, 13: 3}
    assert {r.category_id: r.depth for r in TR.closure(cats, 1).collect()} == {1: 0, 2: 1, 3: 1, 4: 2, 21: 1}
    assert TR.paths(cats.limit(0)).count() == 0 and TR.closure(cats, 5).count() == 0


def test_closure(spark):
    cats = spark.createDataFrame([(1, "A", None), (2, None, 1), (3, "C", 2), (4, "D", None)], SCHEMA)
    got = {r.category_id: (r.name, r.depth) for r in TR.closure(cats, 1).collect()}
    assert got == {1: ("A", 0), 2: ("Category 2", 1), 3: ("C", 2)}


def test_path_view_aliases(spark):
    cats = spark.createDataFrame([(1, "Interest Rates", None), (2, "Short", 1)], SCHEMA)
    TR.register_views(TR.paths(cats), ["category_paths", "source_category_paths"])
    q = "SELECT category_id FROM {} WHERE full_path LIKE '%Interest Rates%' GROUP BY category_id"
    assert spark.sql(q.format("category_paths")).count() == 2
    assert spark.sql(q.format("source_category_paths")).count() == 2


def test_stored_parent_round_trip(spark):
    cats = spark.createDataFrame([(0, "Root", None), (1, "A", None), (2, "B", 1)], SCHEMA)
    stored = TR.stored_parent(cats)
    assert sorted((r.category_id, r.parent_id) for r in stored.collect()) == [(0, 0), (1, 0), (2, 1)]
    got = {r.category_id: r.depth for r in TR.paths(stored).collect()}
    assert got == {0: 0, 1: 1, 2: 2}
