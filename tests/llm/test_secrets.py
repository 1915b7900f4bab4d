from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import secrets, spans, workload

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = [k for _, _, k, _ in found]
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(joined.encode()).hexdigest(), joined


def odd_texts():
    rng = random.Random(2)
    parts = ["token", "TOKEN", "secret", "api_key", "apikey", "passwd", " ", "=", ":", "'", '"', "abc", "AKIA", "Q" * 9, "f0" * 7, "é", "🙂", "\n", ".", "x=y"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [None, "", "secret: token : abcdefgh", "f" * 20_000, "token=" * 300, "ſecret=abcdefgh", *made]


def test_base_spans_equal_the_patterns(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, hash int").repartition(4)
    rows = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        want = base(text)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == want[:4], text
        assert set(filter(None, want[4].split(","))) <= set(filter(None, r.spans.split(",")))


def test_places_are_code_points(spark):
    df = spark.createDataFrame([("🙂é a1 b22",)], "t string")
    rows = df.select(spans.matches(F.col("t"), "[a-z][0-9]+").alias("m")).collect()[0].m
    assert [(m.start, m.end, m.value) for m in rows] == [(3, 5, "a1"), (6, 9, "b22")]


def test_ownership_separates_examples_from_live_values(spark):
    live, copied = "aB3dE5gH7jK9mN1pQ2rS", "zY8xW6vU4tS2rQ0pO9nM"
    rows = [(1, f"see {live} here", "a"), (1, f"see {live} here", "a"), (2, f"use {copied}", "a")]
    rows += [(i, f"use {copied}", f"o{i}") for i in range(3, 6)] + [(9, f"mine {live[::-1]}", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: (r.spans, r.n_live, r.n_copied) for r in secrets.scan(df).collect()}
    assert found[1] == ("opaque:4:24", 1, 0)
    assert found[2] == found[3] == ("", 0, 1)
    assert found[9] == ("opaque:5:25", 1, 0)
    assert secrets.scan(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in workload.op3_secrets(spark, folder).collect()}
    assert rows == {d.doc_id: base(d.text)[:4] for d in docs}
