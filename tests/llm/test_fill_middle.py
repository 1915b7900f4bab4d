from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle, workload
from tidemark.llm.fill_middle import Blocks, Rule


def brute_force(doc_id, text, rule=Rule()):
    """(n, form, prefix_chars, middle_chars, output) by the definition, over code points."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"{rule.seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rule.rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < rule.suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "é\nü\n漢字\n🙂🙃", "x <P> y\nz", "<S>\n", "a\n<M>", "<P\n>\n<S\n", "a\rb\r\nc d\n",
    "no line end " * 9000, "é\n" * 30_000, "\n" * 9000, "long 🙂 line " * 1200 + "\n" + "z" * 4096 + "\n" + "q" * 4095 + "\nend",
]


@pytest.mark.parametrize("rule", [Rule(), Rule("other", 60, 10)])
def test_equals_brute_force_on_odd_texts(spark, rule):
    rows = [(100 * k + i, t, "x", 1) for i, t in enumerate(ODD) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, OUTPUT string, n int").repartition(3)
    found = fill_middle.transform(df, rule)
    got = {r.doc_id: r for r in found.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_force(doc_id, text, rule)
        assert r.again == (text or "")
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a\nb\nc"), (5, "a\nb\n"), (5, "a\nb\n")], "doc_id long, text string")
    got = [(r.doc_id, r.n, r.output) for r in fill_middle.transform(df).collect()]
    want = brute_force("null", "a\nb\nc")
    assert (None, want[0], want[4]) in got and len(got) == 3 and len(set(got)) == 2
    assert fill_middle.digest(fill_middle.transform(df.limit(0))).count() == 0


def test_every_cut_of_blocks_of_any_size():
    rng = random.Random(3)
    for _ in range(120):
        text = "".join(rng.choice("aé🙂\n\n ") for _ in range(rng.randint(0, 90)))
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        for block in (1, 2, 7, 64, 4096):
            blocks = Blocks(text.encode(), block)
            assert blocks.lines == len(lines)
            for k in range(len(lines) + 1):
                head = "".join(lines[:k])
                assert blocks.cut(k) == (len(head.encode()), len(head))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = workload.op11_fill_middle(spark, folder).collect()
    assert len(rows) == len(given)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        *facts, output = brute_force(r.doc_id, given[r.doc_id])
        assert list(r) == [r.doc_id, *facts, sha(output), sha(given[r.doc_id])]
