"""Operators with Python tasks against brute force, round trips and held-out labels."""

import collections
import math
import random
import re
import textwrap
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_cases import LONG, ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlake.llm import (components, decontaminate, language_model, licenses, packing, quality, simhash, tokens,
                            toxicity)
from marketlake.session import ship_package

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low)


# --------------------------------------------------------- SimHash near-dedup

def brute_simhash(text, n=4):
    w = words(text)
    s = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, most=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.nonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= most)[0] + i + 1:
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_simhash_matches_brute_force(documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    want_fp = [brute_simhash(r["text"]) for r in rows]
    want = brute_components(want_fp)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    assert len(got) == len(rows)
    for r, fp, c in zip(rows, want_fp, want):
        assert got[r["doc_id"]]["fp"] % 2 ** 64 == fp
        assert got[r["doc_id"]]["component_id"] == rows[c]["doc_id"]


@pytest.mark.parametrize("leaf", [4, 64])
@pytest.mark.parametrize("turned", [False, True])
def test_trie_walk_descends_and_loses_nothing(spark, leaf, turned):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)] + [rng.getrandbits(8) << 56 for _ in range(20)] + [0, 2 ** 64 - 1]
    fps = set(base)
    for b in base:
        for _ in range(8):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << bit
            fps.add(x)
    signed = [(x - 2 ** 64 if x >= 2 ** 63 else x,) for x in fps]
    nodes = spark.createDataFrame(signed, "fp long")
    found = simhash.trie_links(nodes, len(fps), turned, leaf=leaf).collect()
    order = sorted(fps)
    half = lambda a, b: ((a ^ b) & (2 ** 32 - 1) if turned else (a ^ b) >> 32).bit_count() <= 2
    comp = components_of([(a, b) for i, a in enumerate(order) for b in order[i + 1:]
                          if (a ^ b).bit_count() <= 4 and half(a, b)])
    assert components_of([(r["u"] % 2 ** 64, r["v"] % 2 ** 64) for r in found]) == comp


def components_of(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_connected_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(5, i) for i in range(1000, 1200)] + [(7, 7), (300, 100), (None, 3)]
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == components_of([e for e in edges if None not in e and e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_of_each_group(make_docs):
    rows = [*ODD, (50, "one two three four five six seven"), (3, "one two three four five six seven"), (60, "")]
    kept = simhash.keep_one(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    groups = collections.defaultdict(list)
    fps = [brute_simhash(t) for _, t, *_ in rows]
    for k, c in enumerate(brute_components(fps)):
        groups[c].append((rows[k][0] is None, rows[k][0] or 0))
    assert got == sorted(min(g) for g in groups.values())
    assert simhash.keep_one(make_docs([])).count() == 0


def test_near_duplicates_odd_rows(make_docs):
    got = simhash.near_duplicates(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r["component_id"] for r in got if r["fp"] == 0} == {1}


# ------------------------------------------------------------------- packing

def check_pieces(pieces, docs, size=2048):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc = collections.defaultdict(list)
    by_seq = collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    fill = {}
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= size
        fill[s] = at
    return fill


def test_packing_round_trip_and_mixture(documents):
    out = packing.pack(documents, tokens.WordTokenizer.from_package("word_bpe_49k.json")).collect()
    fill = check_pieces(out, [(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sorted(fill) == list(range(len(fill)))
    assert [s for s, n in fill.items() if n < 2048] in ([], [max(fill)])
    totals = collections.Counter()
    for p in out:
        totals[p["source"]] += p["length"]
    every = sum(totals.values())
    seen = collections.defaultdict(collections.Counter)
    for p in out:
        seen[p["sequence_id"]][p["source"]] += p["length"]
    for s, mix in seen.items():
        if fill[s] == 2048:
            assert max(abs(mix[x] - 2048 * totals[x] / every) for x in totals) <= 2


def test_packing_targets_and_dry_queues(make_docs):
    rows = [(k, "a b c d e f g " * (k % 9), "abc"[k % 3] if k % 7 else None) for k in range(400)]
    out = packing.pack(make_docs(rows), tokens.WordTokenizer.from_package("word_bpe_49k.json"), size=64,
                       targets={"a": 0.7, "b": 0.2, "c": 0.1}).collect()
    fill = check_pieces(out, [r[:2] for r in rows], 64)
    first = collections.Counter()
    for p in out:
        if p["sequence_id"] < 10:
            first[p["source"]] += p["length"]
    assert first["a"] > 2.5 * first["b"] > 4 * first["c"]
    assert sum(n == 64 for n in fill.values()) >= len(fill) - 1


def test_packing_odd_rows(make_docs):
    rows = [r for r in ODD if r[0] != 4] + [(11, "x", None)]
    out = packing.pack(make_docs(rows), tokens.WordTokenizer.from_package("word_bpe_49k.json")).collect()
    check_pieces(out, [r[:2] for r in rows])
    twice = packing.pack(make_docs(ODD[3:5]), tokens.WordTokenizer.from_package("word_bpe_49k.json")).collect()
    assert sum(p["length"] for p in twice) == 2 * twice[0]["doc_tokens"]
    assert packing.pack(make_docs([]), tokens.WordTokenizer.from_package("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("totals", [[5, 5, 5], [1000, 1, 3], [10 ** 6, 10 ** 5 + 7, 13], [2 ** 50, 2 ** 49 + 1], [0, 64]])
def test_schedule_gives_everything_once(totals):
    own = {k: Fraction(t or 1) for k, t in enumerate(totals)}
    groups = packing.queue_groups(dict(enumerate(totals)), own, 64)
    grouped = [sum(totals[k] for k in g) for g in groups]
    for totals, phases in ((totals, packing.plan(totals, [Fraction(1, len(totals))] * len(totals), 64)),
                           (grouped, packing.plan(grouped, [sum(own[k] for k in g) / sum(own.values()) for g in groups], 64))):
        last = phases[-1]
        ends = [b + int(g) for b, g in zip(last.begin, last.given(np.array([last.windows]))[0])]
        assert ends == totals
        for p in phases:
            w = np.unique(np.linspace(0, p.windows, min(p.windows + 1, 300)).astype(np.int64))
            given = p.given(w)
            assert (np.diff(given, axis=0) >= 0).all()
            if p is not last:
                assert (given.sum(axis=1) == 64 * w).all()


def test_tokenizer_memo_is_exact():
    tok = tokens.WordTokenizer.from_package("word_bpe_49k.json")()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for t in ["<|ENDOFTEXT|> a <|endoftext|>b", "don't it's, 's. x., $$$, İ ΑΣ Σ. é, Å.", " a\tb\x0bc  d\n\n,. .", "",
              "a" * 3000 + ".", "9,8.7", "Ǆ ß ẞ, ﬀ.", "é, É."]:
        assert np.frombuffer(tok.encode(t.encode()), "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids


# ---------------------------------------------------------------- LM scoring

def test_language_model_against_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    toks = {r["doc_id"]: [*words(r["text"]), ""] for r in rows}
    fold = {d: zlib.crc32(str(d).encode()) % 5 for d in toks}
    uni, pair = collections.Counter(), collections.Counter()
    for d, t in toks.items():
        if fold[d] != 1:
            uni.update(t)
            pair.update(zip(["", *t], t))
    n, v = sum(uni.values()), len(uni)
    got = {r["row_id"]: r for r in language_model.score_documents(documents).collect()}
    assert len(got) == len(rows)
    better = [0.0, 0.0]
    for d, t in toks.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            fold[d] == 1, len(t), sum(uni[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((uni[w] + .5) / (n + .5 * (v + 1))) for w in t))
        if fold[d] == 1:
            better[0] += r["base_score"]
            better[1] += r["score"]
    assert better[1] > better[0]


def test_model_scores_from_its_own_weights(spark, make_docs, monkeypatch):
    rows = [(k, " ".join(random.Random(k).choices("a b c d e f g h".split(), k=k % 13))) for k in range(300)]
    kept = {}
    learn = language_model.learn_weights
    monkeypatch.setattr(language_model, "learn_weights", lambda *a: kept.setdefault("w", learn(*a)))
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 200)
    got = {r["row_id"]: r["score"] for r in language_model.score_documents(make_docs(rows)).collect()}
    uni, pair = collections.Counter(), collections.Counter()
    toks = {d: [*words(t), ""] for d, t in rows}
    for d, t in toks.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            uni.update(t)
            pair.update(zip(["", *t], t))
    n, v = sum(uni.values()), len(uni)
    assert np.allclose(kept["w"].sum(axis=1), 1)
    for d, t in toks.items():
        want = 0.0
        for c, w in zip(["", *t], t):
            l2, l1, l0 = kept["w"][0 if not uni[c] else int(math.log2(uni[c])) + 1]
            want += math.log10(l2 * (pair[c, w] / uni[c] if uni[c] else 0) + l1 * uni[w] / n + l0 / (v + 1))
        assert got[d] == pytest.approx(want)


def test_em_raises_held_out_likelihood():
    cells = [{"cell": (b * language_model.RATIO_BINS + i) * language_model.RATIO_BINS + j, "n": n, "s2": n * f2, "s1": n * f1}
             for b, i, j, n, f2, f1 in ((3, 30, 20, 90.0, .5, .01), (3, 0, 20, 10.0, 0, .01), (9, 0, 20, 50.0, 0, .02))]
    w = language_model.learn_weights(cells, 1000)
    assert w[3, 0] > 0.8 and w[9, 0] < 0.3 and np.allclose(w.sum(axis=1), 1)


def test_language_model_odd_rows(make_docs):
    got = language_model.score_documents(make_docs(ODD)).collect()
    assert sorted((r["row_id"] is None, r["row_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ODD)
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert language_model.score_documents(make_docs([])).count() == 0


# ----------------------------------------------------------- decontamination

def levenshtein_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_bit_parallel_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(4) for _ in range(rng.randint(0, 30))]
        assert decontaminate.best_edits(a, b)[0] == levenshtein_in(a, b)


def test_leaks_are_found_and_clean_documents_left(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: decontaminate.words_of(r["text"]) for r in bench.collect()}
    docs = {r["doc_id"]: decontaminate.words_of(r["text"] or "") for r in documents.collect()}
    want = {(d, i) for d, w in docs.items() for i, x in items.items()
            if b" " + b" ".join(x) + b" " in b" " + b" ".join(w) + b" "}
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(documents, bench).collect()}
    assert want and want <= set(got)
    for (d, i), e in got.items():
        assert levenshtein_in(items[i], docs[d]) <= decontaminate.max_edits(len(items[i])) and e >= 0
    clean = decontaminate.decontaminate(documents, bench)
    assert clean.columns == documents.columns
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == set(docs) - {d for d, _ in got}


def test_edited_leaks_reach_the_target_recall(spark, make_docs):
    rng = random.Random(7)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    fill = [f"filler{rng.randrange(400)}" for _ in range(5000)]
    rows = []
    for k, t in enumerate(items):
        w = t.split()
        for _ in range(decontaminate.max_edits(len(decontaminate.words_of(t)))):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            if kind == 0:
                w[at] = "changed"
            elif kind == 1:
                w.insert(at, "more")
            elif len(w) > 1:
                del w[at]
        a = rng.randrange(4000)
        rows.append((k, " ".join(fill[a:a + 50] + w + fill[a + 50:a + rng.choice([50, 200])])))
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 3000):
        got = {(r["doc_id"], r["item_id"]) for r in
               decontaminate.leaks(make_docs(rows), bench, block_words=block_words).collect()}
        assert sum((k, k) in got for k in range(len(items))) >= 0.95 * len(items)


def test_recall_holds_at_every_length_of_a_mixed_benchmark():
    rng = random.Random(5)
    lens = [5, 6, 9] * 60 + [59] * 30 + [128] * 30
    items = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for k, n in enumerate(lens)]
    ix = decontaminate.build(items)
    found, trials = collections.Counter(), 3
    for _ in range(trials):
        texts = []
        for _, t in items:
            w = t.split()
            for _ in range(decontaminate.max_edits(len(w))):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                if kind == 0:
                    w[at] = "changed"
                elif kind == 1:
                    w.insert(at, "more")
                elif len(w) > 1:
                    del w[at]
            f = [f"filler{rng.randrange(400)}" for _ in range(40)]
            texts.append(" ".join(f[:20] + w + f[20:]))
        found.update(lens[a] for a, i, *_ in decontaminate.search(texts, ix) if a == i)
    for n in set(lens):
        assert found[n] >= 0.95 * trials * lens.count(n)


def test_decontaminate_odd_rows(spark, make_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "token"), (None, "negative id"), (5, LONG), (5, LONG)],
                                  "item_id long, text string")
    got = decontaminate.leaks(make_docs(ODD), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(9, 3), (-5, None), (7, 5)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(make_docs(ODD), none).count() == 0
    assert decontaminate.decontaminate(make_docs(ODD), none).count() == len(ODD)
    assert decontaminate.decontaminate(make_docs([]), bench).count() == 0


# ----------------------------------------------------- toxicity and quality

def test_toxicity_on_held_out_rows(documents, labels):
    model = toxicity.fit(documents, labels)
    got = toxicity.score(documents.select("doc_id", "text"), model).join(labels, "doc_id") \
        .select("doc_id", "toxic", "toxicity").collect()
    right = [(r["toxicity"] >= 0.5) == (r["toxic"] == 1) for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(right) / len(right) > 0.85
    assert all(0 <= r["toxicity"] <= 1 for r in got)


def test_toxicity_never_reads_held_out_labels(spark, documents, labels):
    other = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0,
                                              1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(documents, labels, epochs=3), toxicity.fit(documents, other, epochs=3)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_toxicity_whole_text_and_odd_rows(spark, make_docs, documents, labels):
    model = toxicity.fit(documents, labels, epochs=3)
    got = toxicity.score(make_docs(ODD), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["toxicity"] <= 1 for r in got)
    assert len({r["toxicity"] for r in got if not r["text"]}) == 1
    segment = toxicity.buckets.__globals__["SEGMENT"]
    text = "ab c" * 1000
    whole = model.score(text)
    toxicity.buckets.__globals__["SEGMENT"] = 37
    try:
        assert model.score(text) == pytest.approx(whole)
    finally:
        toxicity.buckets.__globals__["SEGMENT"] = segment
    none = toxicity.fit(make_docs([]), labels)
    assert 0 < none.score("x") < 1
    assert toxicity.score(make_docs([]), model).count() == 0


def test_quality_on_held_out_rows(documents, labels):
    model = quality.fit(documents, labels)
    got = quality.score(documents.select("doc_id", "text", "lang", "source"), model) \
        .join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good, bad = ([r["quality"] >= 0.5 for r in held if r["label"] == k] for k in (1, 0))
    assert sum(good) / len(good) > 0.95
    assert sum(bad) / len(bad) < 0.5


def test_co_training_gains_from_the_pool():
    """Two views that each hold the class; with four labels a side the pool decides."""
    rng = np.random.default_rng(0)
    n = 600
    y = rng.integers(0, 2, n)
    views = [quality._Rows([np.array([2 * k + c if rng.random() < .9 else 2 * k + 1 - c for k in range(6)], np.int32) for c in y],
                           [np.ones(6, np.float32)] * n, 4, 1e-3) for _ in range(2)]
    label, fold = np.full(n, -1), np.arange(n) % 5
    label[:30] = y[:30]
    done, _ = quality.co_train(views, label, fold, per_round=60)
    z = sum(v.calibrated(views[k].margin(v, np.arange(n))) for k, v in enumerate(done))
    assert ((z > 0) == (y == 1)).mean() > 0.9


def test_quality_odd_rows(make_docs, documents, labels):
    model = quality.fit(documents, labels)
    got = quality.score(make_docs(ODD), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["quality"] <= 1 for r in got)
    assert quality.score(make_docs([]), model).count() == 0
    assert 0 < quality.fit(make_docs([]), labels).score("x", None, None)[2] < 1


# ------------------------------------------------------------------ licences

def test_license_lines_and_wording(make_docs):
    rows = [(1, "prose\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "RELEASED!! UNDER!! THE!! MIT!! LICENSE."),
            (3, "This work is licensed under the GNU General Public License, version 2."),
            (4, "This work is licensed under the GNU General Public License, version 3"),
            (5, "we talked about the license plate of a car and its copyright holder"), (6, "Licensed under CC BY-NC 4.0."),
            (7, "x " * 5000 + "This program is free software: you can share it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
             "your option) any later version." + " y" * 5000)]
    got = {r["doc_id"]: r for r in licenses.scan(make_docs(rows)).collect()}
    assert {d: r["license"] for d, r in got.items()} == {
        1: "Apache-2.0", 2: "MIT", 3: "GPL-2.0", 4: "GPL-3.0", 6: "CC-BY-NC-4.0", 7: "GPL-3.0-or-later"}
    assert got[7]["differences"] == "-redistribute +share" and got[7]["differing_words"] == 1
    assert rows[0][1][got[1]["start"]:got[1]["end"]] == "Licensed under the Apache License, Version 2.0."


def test_license_scan_on_documents(documents):
    cue = re.compile(r"^(Licensed under (the Apache License, Version 2\.0|CC BY-NC 4\.0)|Released under the MIT License"
                     r"|This work is licensed under the GNU General Public License, version 3)\.$", re.M)
    want = {(r["doc_id"], m.start()) for r in documents.collect() for m in cue.finditer(r["text"] or "")}
    got = {(r["doc_id"], r["start"]) for r in licenses.scan(documents).collect()}
    assert want and want <= got


def test_license_odd_rows(make_docs):
    assert licenses.scan(make_docs(ODD)).count() == 0
    assert licenses.scan(make_docs([])).count() == 0


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(n))


def test_license_among_ordinary_words(make_docs):
    notices = [("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
               ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0")]
    rows = [(k, f"{prose(30, k)} {t} {prose(30, k + 10)}") for k, (t, _) in enumerate(notices)]
    rows.append((3, " ".join(f"{t} {prose(5, 20)}" for t, _ in notices)))
    got = {(r["doc_id"], r["license"]): rows[r["doc_id"]][1][r["start"]:r["end"]] for r in licenses.scan(make_docs(rows)).collect()}
    assert got == {(d, name): t for k, (t, name) in enumerate(notices) for d in (k, 3)}


def test_license_wrapped_over_lines(make_docs):
    long = {name: text for name, text in licenses.TEMPLATES if len(text) > 120 and "Apache" not in text}
    assert {"MIT", "GPL-3.0-or-later"} <= set(long)
    rows = []
    for k, text in enumerate(long.values()):
        for width, mark in ((80, "\n"), (40, "\r\n"), (60, "\n# "), (1, "\n")):
            rows.append((len(rows), f"{prose(40, k)}\n\n" + mark.join(textwrap.wrap(text, width, break_long_words=False)) + f"\n\n{prose(40, k + 50)}"))
    got = [(r["doc_id"], r["license"], r["differing_words"]) for r in licenses.scan(make_docs(rows)).collect()]
    assert sorted(got) == [(d, list(long)[d // 4], 0) for d in range(len(rows))]


SIBLINGS = [
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "CC-BY-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 3 or any later version.", "GPL-3.0-or-later"),
    ("This work is licensed under the GNU General Public License, version 3.0.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 4.", None),
    ("This work is licensed under the GNU Frugal General Public License, version 3.7.", None),
    ("Licensed under the Apache License, Version 2.0.1", None), ("Licensed under the Academic License, Version 2.0.", None),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Licensed under the Eclipse Public License v2.0", "EPL-2.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
]


def test_license_siblings(make_docs):
    bsd = dict(licenses.TEMPLATES)
    numbered = bsd["BSD-3-Clause"].replace(": Redis", ": 1. Redis").replace(". Redis", ". 2. Redis").replace(
        "Neither the name of the copyright holder", "3. Neither the name of Example Research Inc.")
    rows = [*SIBLINGS, (numbered, "BSD-3-Clause"), (bsd["BSD-2-Clause"], "BSD-2-Clause"), (bsd["MIT-0"], "MIT-0")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(make_docs([(k, t) for k, (t, _) in enumerate(rows)])).collect()}
    assert got == {k: name for k, (_, name) in enumerate(rows) if name}


def test_rank_comes_from_conditional_compression(monkeypatch):
    """Of templates that confirm overlapping spans the one that saves most
    wins; without the compressor the results are wrong."""
    notices = {name: text for name, text in licenses.TEMPLATES if len(text.split()) > 90 and name.startswith("BSD")}
    assert len(notices) == 3
    words = "some ordinary words before a notice " * 8
    blocks_ = {name: f"{words}{text} {words}" for name, text in notices.items()}
    assert all([h[2] for h in licenses.explain(b)] == [name] for name, b in blocks_.items())
    for name, block in blocks_.items():
        order = licenses.by_size_saved(licenses._plain(block).split(), licenses.TEMPLATES)
        assert licenses.TEMPLATES[order[0]] == (name, notices[name])
    monkeypatch.setattr(licenses, "compressed_size", lambda data, wording: 100)
    assert not any([h[2] for h in licenses.explain(b)] == [name] for name, b in blocks_.items())


def test_a_notice_far_into_a_long_block_is_ranked():
    name, text = next(t for t in licenses.TEMPLATES if t[0] == "MIT" and len(t[1].split()) > 150)
    long = "the license word returns here and there " * 3000 + text
    order = licenses.by_size_saved(licenses._plain(long).split(), licenses.TEMPLATES)
    assert licenses.TEMPLATES[order[0]] == (name, text)


def test_every_license_template_is_reported_by_its_name(make_docs):
    rows = list(enumerate(t for _, t in licenses.TEMPLATES))
    got = sorted((r["doc_id"], r["license"], r["differing_words"]) for r in licenses.scan(make_docs(rows)).collect())
    assert got == [(k, name, 0) for k, (name, _) in enumerate(licenses.TEMPLATES)]


# ----------------------------------------------- bounded samples, clashing names

def test_long_labelled_rows_still_teach(spark, make_docs, monkeypatch):
    """All toxic rows are over the length limit: the shortest of them are taken."""
    monkeypatch.setattr(toxicity, "TRAIN_MAX_CHARS", 200)
    rows = [(i, ("you vile idiot scum " if i % 2 else "a calm and pleasant day ") * (30 + i if i % 2 else 3)) for i in range(1, 121)]
    flags = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    sample, sizes = toxicity.training_rows(make_docs(rows), flags)
    got = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    assert got[1] == toxicity.LONG_ROWS and got[0] == sizes[0] and sizes[1] > got[1]
    model = toxicity.fit(make_docs(rows), flags)
    assert model.score("you vile idiot scum") > 0.5 > model.score("a calm and pleasant day")


def test_scores_beside_columns_of_their_names(spark, make_docs):
    rows = [(i, ("vile idiot " if i % 2 else "calm day ") * 5) for i in range(1, 60)]
    flags = spark.createDataFrame([(i, i % 2, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = make_docs(rows).withColumn("Toxicity", F.lit("mine")).withColumn("quality", F.lit("mine"))
    out = toxicity.score(docs, toxicity.fit(docs, flags))
    assert out.columns[-1] == "toxicity_" and out.where("Toxicity = 'mine' and toxicity_ between 0 and 1").count() == len(rows)
    both = quality.score(docs, quality.fit(docs, flags))
    assert both.columns[-3:] == ["text_view", "meta_view", "quality_"]
    assert both.where("quality = 'mine' and quality_ between 0 and 1").count() == len(rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, flags)).count() == 0


def test_words_sent_to_the_model_keep_their_ids():
    file = public_tokenizers.path("word_bpe_49k.json")
    plain, ours = Tokenizer.from_file(file), tokens.WordTokenizer(file)
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("abcz019.,'s-éüßÉÑñ́ \n$_İſ漢") for _ in range(rng.randrange(1, 20)))
        assert np.frombuffer(ours.encode(text.encode()), "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_placing_many_queues_takes_bounded_memory():
    totals = [50_000 + 37 * q for q in range(1500)]
    lay = packing.Layout(packing.plan(totals, [Fraction(t, sum(totals)) for t in totals], 2048))
    start, length = np.arange(0, 50_000, 500), np.full(100, 500)
    tracemalloc.start()
    placed = [x for x in lay.place(7, start, length)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(int(n.sum()) for _, _, n, _, _ in placed) == 50_000 and peak < 200 << 20


def deficit_round_robin(totals, size):
    """Step by step: every window gives each queue its share, rests carried."""
    whole, left, carry, windows = sum(totals), list(totals), [Fraction(0)] * len(totals), []
    while all(n * whole >= size * t for n, t in zip(left, totals)):       # every queue can give a whole quantum
        due = [c + Fraction(size * t, whole) for c, t in zip(carry, totals)]
        give = [int(d) for d in due]
        rest = [d - g for d, g in zip(due, give)]
        for q in sorted(range(len(totals)), key=lambda q: (-rest[q], q))[:size - sum(give)]:
            give[q] += 1
        carry = [d - g for d, g in zip(due, give)]
        left = [n - g for n, g in zip(left, give)]
        windows.append(give)
    return windows


def test_schedule_is_a_deficit_round_robin():
    for totals in ([700, 200, 101], [5000, 4999, 1, 1234], [64, 64]):
        size = 64
        shares = [Fraction(t, sum(totals)) for t in totals]
        phases = packing.plan(totals, shares, size)
        windows = deficit_round_robin(totals, size)
        first = phases[0]
        for w in range(1, min(first.windows, len(windows)) + 1):
            want = [sum(g[q] for g in windows[:w]) for q in range(len(totals))]
            got = first.given(np.array([w]))[0].tolist()
            # sums of w windows agree to the token that a carried rest may give earlier or later
            assert sum(got) == w * size and all(abs(a - b) <= 1 for a, b in zip(got, want)), (totals, w)
            assert all(abs(a - w * size * s) < 1 for a, s in zip(got, shares))


def test_repeated_ids_keep_the_same_row_every_time(spark, make_docs):
    rows = [(1, "alpha beta gamma delta epsilon")] * 6 + [(2, "quite other words stand in here")]
    docs = make_docs(rows).withColumn("score", F.concat(F.lit("v"), F.monotonically_increasing_id()))
    kept = {tuple(sorted((r["doc_id"], r["score"]) for r in simhash.keep_one(docs.repartition(n, "score")).collect())) for n in (1, 4)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2
