from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.test_words import plain
from tidemark.llm import jaccard, workload


def brute_force(rows, rule):
    """(size, smallest id reachable) per row by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        w = plain(text or "")
        sets.append({tuple(w[j : j + rule.words]) for j in range(max(1, len(w) - rule.words + 1))} if w else set())
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        near = {j for e in s for j in holders.get(e, ())}
        for j in near:
            common = len(s & sets[j])
            if rule.per * common >= rule.share * (len(s) + len(sets[j]) - common):
                part[root(i)] = root(j)
        for e in s:
            holders.setdefault(e, []).append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((repr(doc), len(sets[i]), repr(least.get(root(i)))) for i, (doc, _) in enumerate(rows))


def result(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 1)
    return words


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 60
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        if rng.random() < 0.3:
            base = passage + base[:20]
        for _ in range(rng.choice([1, 1, 2, 6])):
            rows.append(" ".join(edited(rng, base, rng.randint(0, 4))))
    rows += [None, "", " \n", "one", "ONE", "one two", "x " * 500, "x " * 700] + rows[:5]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "leaf"), [(1, 2_000), (2, 3)])
def test_equals_all_pairs(spark, monkeypatch, seed, leaf):
    monkeypatch.setattr(jaccard, "LEAF_DOCUMENTS", leaf)
    rows = corpus(seed)
    rule = jaccard.Rule(4, 85, 100) if seed == 1 else jaccard.Rule()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string").repartition(3)
    assert result(jaccard.near_duplicates(df, rule)) == brute_force(rows, rule)


def test_chain_without_a_centre(spark):
    """Each text is linked to the next one only."""
    words = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 5 : i * 5 + 80])) for i in range(24)]
    rule = jaccard.Rule(4, 85, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.near_duplicates(df, rule)) == brute_force(rows, rule)


def test_no_rows_no_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (2, "z y x w v u")]
    df = spark.createDataFrame(rows, schema)
    assert result(jaccard.near_duplicates(df)) == brute_force(rows, jaccard.Rule())
    kept = jaccard.keep_one(df)
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["2", "7", "None", "None"]


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(workload.op5_jaccard(spark, folder)) == brute_force(rows, jaccard.Rule(4, 85, 100))


def test_signatures_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    rule = jaccard.Rule(4, 85, 100)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 900).astype(np.uint64)
        n = rng.integers(1, 400)
        sets = [np.unique(pool[:n]), np.unique(pool[rng.integers(0, 1 + n // 8) : n + rng.integers(0, 1 + n // 8)]), np.unique(pool[500:900])]
        kept = jaccard.may_be_linked(np.array([len(s) for s in sets]), [jaccard.signature(s) for s in sets], rule)
        for i in range(3):
            for j in range(3):
                common = len(np.intersect1d(sets[i], sets[j]))
                if i != j and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    assert kept[i] and kept[j]
    far = [np.unique(rng.integers(0, 2**63, 1450).astype(np.uint64)) for _ in range(4)]
    assert not jaccard.may_be_linked(np.array([len(s) for s in far]), [jaccard.signature(s) for s in far], rule).any()


def clusters(seed):
    """Near copies of three texts, all with one line in common, some too far from most others to be linked with them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(3):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([90, 100]))]
        rows += [" ".join(["one", "common", "line", "of", "words", "here", *edited(rng, base, rng.randint(0, 7))]) for _ in range(70)]
    return list(enumerate(rows))


@pytest.mark.parametrize("divided", [0, 20_000_000_000])
def test_large_clusters_take_two_rounds(spark, monkeypatch, divided):
    """Regions of near copies are not divided again and again: what is one component already is not compared any more."""
    monkeypatch.setattr(jaccard, "LEAF_DOCUMENTS", 20)
    monkeypatch.setattr(jaccard, "PRUNED", 10)
    monkeypatch.setattr(jaccard, "DIVIDED", divided, raising=False)
    rounds, measure = [], jaccard.distances

    def counted(*a):
        rounds.append(1)
        assert len(rounds) <= 2
        return measure(*a)

    monkeypatch.setattr(jaccard, "distances", counted)
    rows, rule = clusters(3), jaccard.Rule()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.near_duplicates(df, rule)) == brute_force(rows, rule)
    assert len(rounds) == (1 if divided else 2)


def test_bitmap_has_every_id_in_few_rows(spark):
    found = jaccard.bitmap(spark.range(0, 60_000).withColumnRenamed("id", "doc_id")).collect()
    bits = {64 * (r.block * jaccard.WORDS + i) + j for r in found for i, w in enumerate(r.words) for j in range(64) if w >> j & 1}
    ids = spark.range(0, 60_000).selectExpr(f"pmod(xxhash64(id), {jaccard.BITS}) as bit").collect()
    assert bits == {r.bit for r in ids}
    assert len(found) <= jaccard.BITS // 1024
