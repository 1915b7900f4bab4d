from __future__ import annotations

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_byte_bpe import ORACLE
from tests.llm.test_jaccard import brute_force as linked_by_all_pairs
from tests.llm.test_line_chunks import brute_force as without_pieces
from tidemark.llm import jaccard, leaks, line_chunks, quality
from tidemark.llm.common import store

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of every stage, each on what the one before wrote."""
    found, made = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, found, FOLDER), name)
        made.append((name, found.collect(), after.collect(), after.columns))
        found = after
    return {name: rest for name, *rest in made}


def test_columns_stay_until_the_last_stage(stages):
    assert list(stages) == ["quality", "line_chunks", "jaccard", "leaks", "byte_bpe"]
    for name in list(stages)[:-1]:
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert len(stages[name][1]) <= len(stages[name][0])


def test_quality(spark, stages):
    before, after, _ = stages["quality"]
    kept = {r.doc_id for r in quality.classify(spark.createDataFrame(before)).collect() if r.kept}
    assert {r.doc_id for r in after} == kept and 0 < len(kept) < len(before)


def test_line_chunks(spark, stages):
    before, after, _ = stages["line_chunks"]
    rows = [(r.doc_id, r.text) for r in before]
    want = {d: t for d, t, n in without_pieces(rows, line_chunks.Chunking(copy_share=0.8), every=False) if not n or t}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_jaccard(stages):
    before, after, _ = stages["jaccard"]
    want = linked_by_all_pairs([(r.doc_id, r.text) for r in before], jaccard.Rule())
    assert sorted(repr(r.doc_id) for r in after) == sorted(doc for doc, _, component in want if doc == component)


def test_leaks(spark, stages):
    before, after, _ = stages["leaks"]
    items = [leaks.normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {r.doc_id for r in before if any(i in leaks.normal(r.text) for i in items)} <= gone


def test_tokens(stages):
    before, after, _ = stages["byte_bpe"]
    want = {r.doc_id: hashlib.sha256(np.array(ORACLE.encode_ordinary(r.text), "<u4").tobytes()).hexdigest() for r in before}
    assert {r.doc_id: r.ids_sha256 for r in after} == want


def test_run_is_the_stages_in_turn(spark, stages):
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(stages["byte_bpe"][1])


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, DOC_ID long, gone_id long, gone_chunks int, gone_ranges int, kept_id long, hash string"


@pytest.mark.parametrize("name", list(dict(corpus_pipeline.STAGES)))
def test_odd_tables(spark, name):
    """Nulls in all columns, clashing names, an id in a third of all rows, no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    text = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 400 and lang = 'en'").orderBy("doc_id").limit(8).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, len(r.text), "T", 1, 2, 3, 4, 5, "h") for r in text]
    rows += [(7_000, f"{rows[0][1]}\nand one more line {i}", "en", "s", None, None, None, None, None, None, None, None) for i in range(9)]
    rows += [(None,) * 12, (8_000, None, *(None,) * 10), (8_001, "", *(None,) * 10), rows[1], rows[1]]
    df = spark.createDataFrame(rows, CLASHING).repartition(3)
    found = stage(spark, df, FOLDER)
    assert found.count() <= len(rows)
    if name != "byte_bpe":
        assert found.columns == df.columns
        ids = {r[0] for r in found.collect()}
        assert ids <= {r[0] for r in rows} and len(ids) > 4
    empty = stage(spark, df.limit(0), FOLDER)
    assert empty.count() == 0 and empty.columns == found.columns
