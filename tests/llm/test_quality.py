from __future__ import annotations

import itertools

import numpy as np

from tidemark.llm import linear, quality, workload

FOLDER = "/root/testdata/sf0.01"


def test_shapes():
    shapes = quality.Shapes()
    assert [shapes[w][0] for w in ("Haus,", "###", "a1b22!!", "ÉTÉ", "")] == ["Xx,", "#", "x9x9!", "X", ""]


def test_posteriors_recover_planted_accuracies():
    """Counts of an exact model of three labellers that abstain at random: EM must find the posterior."""
    right, prior = [0.9, 0.8, 0.7], 0.6
    patterns, truth = {}, {}
    for bits in itertools.product((0, 1, 2), repeat=3):
        p = {}
        for y in (0, 1):
            p[y] = prior if y else 1 - prior
            for j, v in enumerate(bits):
                p[y] *= 0.2 if v == 2 else 0.8 * (right[j] if v == y else 1 - right[j])
        name = "".join(map(str, bits))
        patterns[name] = round(1e7 * (p[0] + p[1]))
        truth[name] = p[1] / (p[0] + p[1])
    found = quality.posteriors(patterns, rounds=5000)
    assert max(abs(found[n] - truth[n]) for n in truth) < 0.01


def test_posteriors_of_nothing_and_one_pattern():
    assert quality.posteriors({}) == {}
    assert quality.posteriors({"111": 5})["111"] > 0.5


def test_linear_fit_finds_the_optimum():
    rng = np.random.default_rng(1)
    places = [sorted(rng.choice(6, 3, replace=False).tolist()) for _ in range(300)]
    targets = np.array([1.0 if 0 in p and 1 not in p else 0.0 for p in places])
    weights = linear.fit(places, [[1.0] * 3] * 300, targets, 6, rounds=2000)
    dense = np.zeros((300, 7))
    for i, p in enumerate(places):
        dense[i, p] = 1
    dense[:, 6] = 1
    slope = dense.T @ (1 / (1 + np.exp(-dense @ weights)) - targets)
    slope[:6] += weights[:6]
    assert np.abs(slope).max() < 0.05
    assert linear.fit([], [], np.zeros(0), 3).tolist() == [0, 0, 0, 0]


def test_odd_rows(spark):
    good = "The house is at the end of the road, and it was a long way to go. We like it there."
    rows = [(i, good + f" It is number {i}.", "x") for i in range(40)] + [(i + 100, "### $$$ %%% " * 40, None) for i in range(20)]
    rows += [(200, None, None), (201, "", None), *[(202, "x " * 50_000, None)] * 12, (None, good, "y"), (3, good, None), (3, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = quality.classify(df).collect()
    assert len(found) == len(rows)
    kept = {r.doc_id for r in found if r.kept}
    assert {*range(40), None} <= kept and not kept & {*range(100, 120), 200, 201, 202}
    left = quality.keep_good(df)
    assert left.columns == df.columns and sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(r.doc_id) for r in found if r.kept)
    assert quality.classify(df.limit(0)).count() == 0


def test_agrees_with_labels_it_never_saw(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = workload.op7_quality(spark, FOLDER).collect()
    assert len(rows) == 1000
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.05 * len(bad)


def test_long_words_are_looked_at_to_their_end():
    words = ["x1" * 15 + "/", "abc" * 20 + "."]
    facts = quality.Facts(" ".join(words), quality.Shapes())
    assert (facts.marked, facts.ends) == (0.5, 0.5)
    assert quality.features(quality.Facts("x1" * 15 + "/", quality.Shapes())) != quality.features(quality.Facts("x1" * 15, quality.Shapes()))
