from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from tidemark.llm import language, workload

FOLDER = "/root/testdata/sf0.01"


def plain_grams(text):
    """N-grams of padded words by slicing strings."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    joined = " " + " ".join(words) + " " if words else ""
    found = Counter(c for c in joined if c != " ")
    found.update(joined[i : i + 2] for i in range(len(joined) - 1))
    found.update(joined[i : i + 3] for i in range(len(joined) - 2) if joined[i + 1] != " ")
    return found


def number(gram):
    value = 0
    for c in gram:
        value = value * language.WIDTH + ord(c)
    return value


def test_counts_equal_slicing():
    for text in ("", "!!", "a", "The cat.  It's été 漢字!", "ab " * 60_000 + "Größe"):
        codes = language.padded_words(text)
        want = sorted((number(g), n) for g, n in plain_grams(text).items())
        got = list(zip(*(a.tolist() for a in language.counted(codes)), strict=True)) if codes.size else []
        assert got == want


def test_distance_equals_the_definition():
    learned = {n: language.ranked(language.padded_words(t), 20).tolist() for n, t in (("a", "abra cadabra"), ("b", "hocus pocus"))}
    near = language.Nearest(learned)
    for text in ("abra pocus", "zzz", "cadabra!", "hocus"):
        own = language.ranked(language.padded_words(text), language.DOCUMENT).tolist()
        by = {}
        for name, profile in learned.items():
            by[name] = sum(min(abs(profile.index(g) - i), near.charge) if g in profile else near.charge for i, g in enumerate(own))
        name, _, distance = near(text)
        assert name == min(by, key=lambda n: (by[n], n))
        assert np.isclose(distance, min(by.values()) / near.charge / len(own))


def test_profiles_equal_counting_all_texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(80).collect()
    learned = language.profiles(spark.createDataFrame(rows).select("lang", "text").repartition(5), 50)
    for lang, profile in learned.items():
        total = Counter()
        for r in rows:
            if r.lang == lang:
                total.update(plain_grams(r.text))
        assert profile == [number(g) for g, _ in sorted(total.items(), key=lambda x: (-x[1], number(x[0])))[:50]]


def test_odd_rows(spark):
    odd = [(1, None, "x"), (2, "", None), (3, "12 !?", None), (4, "abra", None), (4, "abra", None), (None, "cad" * 50_000, None)]
    df = spark.createDataFrame(odd, "doc_id long, text string, TEXT2 string")
    learned = {"a": language.ranked(language.padded_words("abra cadabra"), 30).tolist()}
    rows = {(r.doc_id, r.lang_pred) for r in language.identify(df, learned).collect()}
    assert rows == {(1, "und"), (2, "und"), (3, "und"), (4, "a"), (None, "a")}
    assert {r.lang_pred for r in language.identify(df, {}).collect()} == {"und"}
    assert language.identify(df.limit(0), learned).count() == 0
    assert language.profiles(spark.createDataFrame([(None, "a"), ("b", None)], "lang string, text string")) == {}


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = workload.op1_language(spark, FOLDER).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if r.held_out}
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
