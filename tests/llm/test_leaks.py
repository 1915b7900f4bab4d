from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import leaks, workload


def semi_global(item, text):
    """Least edits of the item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        text[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y", "é"])
    return "".join(text)


@pytest.mark.parametrize("seed", range(4))
def test_equals_alignment_with_every_item(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(["the", "thener", "of", "ing", "erth", "ana", "été"]) + rng.choice("abcd") for _ in range(n))
    items = [(i, leaks.normal(prose(rng.randint(3, 40)))) for i in range(12)]
    index = leaks.Items(items)
    for _ in range(40):
        text = leaks.normal(prose(rng.randint(0, 20)) + " " + edited(rng, rng.choice(items)[1], rng.randint(0, 14)) + " " + prose(rng.randint(0, 9)))
        got = {i: cost for i, _, cost in leaks.found_in(text, index)}
        want = {i: semi_global(t, text) for i, t in items if len(t) >= leaks.Q}
        assert got == {i: c for i, c in want.items() if c <= leaks.budget(len(dict(items)[i]))}


def test_long_texts_are_searched_whole(monkeypatch):
    item = "a passage of the benchmark that is long enough to matter here"
    text = "z" * 3000 + item + "q" * 5000 + item[:30]
    for piece in (leaks.PIECE, 100, 2000):
        monkeypatch.setattr(leaks, "PIECE", piece)
        assert leaks.found_in(text, leaks.Items([(7, item)])) == [(7, 3000 + len(item), 0)]


def test_qgrams_depend_on_their_characters_only():
    code = leaks.codes("the cat and the cat and")
    grams = leaks.qgrams(code)
    assert len(grams) == len(code) - leaks.Q + 1 and grams[0] != grams[1]
    assert np.array_equal(leaks.qgrams(code[5:]), grams[5:])


def test_odd_rows(spark):
    item = "The quick brown fox jumps over the lazy dog, and then it sleeps."
    docs = [(1, None), (2, ""), (3, "x " + item.upper().replace(" ", "  \n") + " y"), (4, "clean"), (4, "clean"), (None, item)]
    df = spark.createDataFrame([(a, b, 5) for a, b in docs], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, "short"), (4, "")], "item_id long, text string")
    found = {r.doc_id: (r.n_items, r.contaminated) for r in leaks.find(df, bench).collect()}
    assert found == {1: (0, False), 2: (0, False), 3: (1, True), 4: (0, False), None: (1, True)}
    assert sorted(repr(r.doc_id) for r in leaks.clean(df, bench).collect()) == ["1", "2", "4", "4"]
    assert leaks.clean(df, bench).columns == df.columns
    assert leaks.find(df.limit(0), bench).count() == 0
    assert not leaks.find(df, bench.limit(0)).where("contaminated").count()


def test_blocks_find_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    whole = sorted((r.doc_id, r.n_items) for r in workload.op8_leaks(spark, folder).collect())
    monkeypatch.setattr(leaks, "BLOCK", 3000)
    assert sorted((r.doc_id, r.n_items) for r in workload.op8_leaks(spark, folder).collect()) == whole


def test_finds_all_passages_in_the_table(spark):
    folder = "/root/testdata/sf0.01"
    items = [leaks.normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = {r.doc_id: leaks.normal(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {d for d, t in docs.items() if any(i in t for i in items)}
    found = {r.doc_id for r in workload.op8_leaks(spark, folder).collect() if r.contaminated}
    assert held and held <= found and len(found - held) <= 0.01 * len(docs)
