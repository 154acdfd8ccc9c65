"""Filter audit, manifest and exact deduplication against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import harness
import pytest
from llm_cases import LONG, ODD
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import block_names, filter_audit, manifest, ranks, registry
from marketlake.session import ship_package

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def in_langs(make_docs, rows):
    """Odd documents in several languages, one of them null."""
    langs = F.array(F.lit("en"), F.lit("de"), F.lit(None).cast("string"), F.lit("é"))
    return make_docs(rows).withColumn("lang", F.get(langs, F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)).cast("int")))


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_manifest", "op13_exact_dedup"])
def test_query_matches_sql(spark, name):
    df = registry.all_queries()[name](spark, SF)
    ok, msg = harness.compare(df, registry.all_oracles()[name], harness.duck(SF))
    assert ok, msg


# --------------------------------------------------------------------- ranks

def test_ranks_and_look_up(spark):
    rows = [(i % 3 if i % 7 else None, i * 37 % 101) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(5)
    got = ranks.ranks(ranks.ordered(df, [F.col("g").asc_nulls_first(), F.col("v")]), ["g"]).collect()
    for g in (None, 0, 1, 2):
        mine = sorted((r["rank"], r["v"]) for r in got if r["g"] == g)
        assert [k for k, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for h, v in rows if h == g)
    # one key with nearly all rows, a null key, and rows without a match
    many = spark.createDataFrame([(1, i) for i in range(3000)] + [(None, -1), (5, -2)], "k int, v int")
    found = spark.createDataFrame([(1, 3000, "a"), (None, 1, "b")], "k int, n long, x string")
    left = {r["v"]: r["x"] for r in ranks.look_up(many, found, ["k"], "n", 3002, how="left").collect()}
    assert len(left) == 3002 and left[0] == "a" and left[-1] == "b" and left[-2] is None
    assert ranks.look_up(many, found, ["k"], "n", 3002).count() == 3001


# -------------------------------------------------------------- exact dedup

def brute_groups(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for norm, members in groups.items():
        keep = rows[min(members)[3]][0]
        out += [(rows[m[3]][0], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def dedup_cases():
    rng = random.Random(4)
    base = "".join(rng.choice("abcd \n") for _ in range(700))
    texts = [base, base[:350], base[350:], base + "a", base.replace(" ", "  "), base.replace("\n", ""), base[::-1],
             "a" * 64, "a" * 65, "a" * 128, "a" * 127, "é😀" * 40, "é😀" * 40 + " ", "\x00\x1f", "\xa0", ""]
    return [*ODD, *((100 + i, t) for i, t in enumerate(texts)), (100, base), (50, base), (51, "a" * 64)]


def test_blocks_name_texts_exactly(spark, make_docs):
    rows = dedup_cases()
    # a block size that gives every text several rounds, odd and even numbers of names
    got = block_names.exact_groups(make_docs(rows).repartition(3), size=8).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == brute_groups(rows)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted({r["text_sha256"] for r in got})       # exactly one row of each group
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_colliding_block_keys_are_found(spark, make_docs):
    rows = dedup_cases()

    def weak(block, salt):          # the first salts give different blocks one key
        k1, k2 = block_names.block_key(block, salt)
        return [F.pmod(k1, F.lit(3)), F.lit(0).cast("long")] if salt < 2 else [k1, k2]
    got = block_names.exact_groups(make_docs(rows), size=16, key=weak).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == brute_groups(rows)
    with pytest.raises(ValueError, match="share a key"):
        block_names.exact_groups(make_docs(rows), key=lambda b, s: [F.lit(0).cast("long"), F.lit(1).cast("long")])


def test_dedup_of_no_rows_and_native_plan(spark, make_docs):
    out = block_names.exact_groups(make_docs([]))
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    plan = block_names.exact_groups(make_docs(ODD))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------ manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests, fan):
    """Root and, per leaf, the steps (left, right) to it."""
    steps, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // fan * fan
            steps[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + fan])))
        nodes = [sha("".join(nodes[i:i + fan])) for i in range(0, len(nodes), fan)]
        at = [k // fan for k in at]
    return nodes[0], steps


def brute_manifest(rows, fan):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for g in langs:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r) for r in rows if r[2] == g)
        trees[g] = ([k[2] for k, _ in mine], [r for _, r in mine])
    subroots = {g: brute_tree(d, fan)[0] for g, (d, _) in trees.items()}
    root, top = brute_tree([subroots[g] for g in langs], fan)
    out = []
    for g, upper in zip(langs, top):
        digests, mine = trees[g]
        for r, d, own in zip(mine, digests, brute_tree(digests, fan)[1]):
            crc = zlib.crc32(b"" if r[0] is None else str(r[0]).encode())
            text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1]) if r[1] and crc % 3 == 0 else r[1]
            folded = leaf(r, text)
            for a, b in own + upper:
                folded = sha(a + folded + b)
            out.append((r[0], d, subroots[g], root, sha("".join(a + b for a, b in own + upper)), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("extra", [0, 1, 75, 600])
def test_manifest_matches_brute_force(spark, make_docs, tmp, extra):
    rows = [*ODD, *((1000 + i, f"Text {i} Of Many" if i % 5 else "Same") for i in range(extra))]
    docs = in_langs(make_docs, rows)
    docs.repartition(4).write.parquet(f"{tmp}/documents.parquet")
    got = sorted((tuple(r) for r in manifest.op12_manifest(spark, tmp).collect()), key=str)
    full = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]
    assert got == brute_manifest(full, manifest.FAN)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_many_groups_none_and_one(spark, make_docs):
    rows = [(i, f"t{i}") for i in range(200)]
    docs = make_docs(rows).withColumn("lang", F.concat(F.lit("l"), F.pmod(F.col("doc_id"), F.lit(70)).cast("string")))
    out = manifest.manifest(docs, fan=3)
    checked = out.select("doc_id", (manifest.fold(F.col("steps"), F.col("leaf")) == F.col("root")).alias("ok"), "root",
                         "subroot").collect()
    assert len(checked) == 200 and all(r["ok"] for r in checked)
    assert len({r["root"] for r in checked}) == 1 and len({r["subroot"] for r in checked}) == 70
    assert manifest.manifest(make_docs([])).count() == 0
    one = manifest.manifest(make_docs([(1, "x")])).collect()
    assert len(one) == 1 and one[0]["root"] == one[0]["leaf"] and one[0]["steps"] == []


# -------------------------------------------------------------- filter audit

def test_gray_walk_matches_brute_force():
    rng = random.Random(11)
    masks = sorted(rng.sample(range(32), 20))
    counts = [(rng.randrange(9), rng.randrange(3), rng.randrange(3)) for _ in masks]
    left = filter_audit.survivors_of_subsets(masks, counts, 5)
    for subset in range(32):
        assert left[subset].tolist() == [sum(c[j] for m, c in zip(masks, counts) if not m & subset) for j in range(3)]


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}   # a null id is no label
    toxic = {i for i, _, t in labels if t == 1} - {None}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    failing = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        failing.append((lang or "", i, {f for f in fails if fails[f]}))
    out, shapley = [], {}
    for part in {p for p, _, _ in failing}:
        mine = [(i, f) for p, i, f in failing if p == part]
        for order in itertools.permutations("ABCDE"):
            alive = mine
            for k, f in enumerate(order):
                lost = [x for x in alive if f in x[1]]
                alive = [x for x in alive if f not in x[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(lost)
                out.append((part, "".join(order), k + 1, f, len(alive), len(lost), sum(f in x[1] for x in mine) - len(lost),
                            sum(x[1] == {f} for x in mine), sum(x[0] in good for x in lost), sum(x[0] in toxic for x in lost)))
    return sorted((*r, shapley[r[0], r[3]]) for r in out)


def test_audit_matches_brute_force(spark, make_docs):
    rng = random.Random(3)
    many = [(200 + i, rng.choice(["$ x", "AB c", "w " * 120, " ".join(f"w{j}" for j in range(130)), "Q" * 30, LONG, None]))
            for i in range(60)]
    docs = in_langs(make_docs, [*ODD, *many, (200, many[0][1])])
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _ in many] + [(None, 1, 1), (200, 1, 0), (200, 1, 0)]
    flags = spark.createDataFrame(labels, LABELS)
    got = filter_audit.audit(docs, flags)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, labels)
    assert filter_audit.audit(make_docs([]), flags).count() == 0
    none = filter_audit.audit(docs, spark.createDataFrame([], T._parse_datatype_string(LABELS)))
    assert none.count() == got.count() and none.agg(F.sum("good_lost")).first()[0] == 0
