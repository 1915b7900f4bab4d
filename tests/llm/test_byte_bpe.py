from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe, workload

PATH = public_tokenizers.path(workload.TOKENIZER)
CONTENT = open(PATH, "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, CONTENT.splitlines())}
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCABULARY = byte_bpe.Vocabulary(RANKS)
ODD = [
    None, "", " ", "\n\n\n  \t x", "don't we'll I'M", "Größe été ñandú", "a" * 3000, "🙂🙃 漢字 かな", "1234567890" * 30,
    "<|endoftext|>", " " * 400 + "x", "\u0000\u0007", "é" * 500, "!?!?!?" * 50, "the the the",
]


def test_equals_the_library_on_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD * 2)], "doc_id long, text string, IDS string")
    rows = byte_bpe.encode_decode(df, CONTENT, public_tokenizers.PATTERN).collect()
    assert len(rows) == 2 * len(ODD)
    for row in rows:
        text = (ODD * 2)[row.doc_id] or ""
        assert np.frombuffer(row.ids, "<u4").tolist() == ORACLE.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_equals_the_library_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = workload.op10_byte_bpe(spark, folder).collect()
    assert len(rows) == len(given)
    for row in rows:
        ids = ORACLE.encode_ordinary(given[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(given[row.doc_id].encode()).hexdigest()


def test_appends_and_edits_equal_encoding_afresh():
    rng = random.Random(5)
    for _ in range(60):
        piece = bytes(rng.choice(b"abetionghs") for _ in range(rng.randint(0, 40)))
        table = byte_bpe.Prefixes(VOCABULARY, piece)
        for _ in range(4):
            more = bytes(rng.choice(b"thering") for _ in range(rng.randint(0, 9)))
            begin = rng.randint(0, len(table.piece))
            end = rng.randint(begin, len(table.piece))
            table.replace(begin, end, more)
            table.append(more)
            assert table.last == byte_bpe.Prefixes(VOCABULARY, table.piece).last
            assert table.ids() == (ORACLE.encode_ordinary(table.piece.decode()))


def test_every_token_is_reachable():
    assert all(VOCABULARY.reachable(t) for t in range(0, 50_256, 7))


def test_no_rows_and_a_missing_column(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digest(byte_bpe.encode_decode(none, CONTENT, public_tokenizers.PATTERN)).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode_decode(none.drop("text"), CONTENT, public_tokenizers.PATTERN)
