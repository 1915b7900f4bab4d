from __future__ import annotations

import random

import numpy as np

from tidemark.llm import words

ALPHABET = ["the", "The", "THE", "a", "é", "É", "漢字", "x" * 50, "ab", "ba", " "]


def random_texts(seed, n=60):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(ALPHABET) + rng.choice([" ", "\n", "\t\v ", ""]) for _ in range(rng.randint(0, 30))) for _ in range(n)
    ]


def plain(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def test_words_are_the_same_exactly_where_hashes_are(monkeypatch):
    for block in (words.BLOCK, 64):
        monkeypatch.setattr(words, "BLOCK", block)
        texts = random_texts(block)
        hashes, at = words.hash_words(texts)
        known = {}
        for i, text in enumerate(texts):
            mine = hashes[at[i] : at[i + 1]].tolist()
            assert len(mine) == len(plain(text))
            for h, w in zip(mine, plain(text), strict=True):
                assert known.setdefault(h, w) == w
        assert len(set(known.values())) == len(known)


def test_shingle_sets_have_the_sizes_of_plain_sets():
    texts = random_texts(9)
    hashes, at = words.hash_words(texts)
    made, sets = [], []
    for i, text in enumerate(texts):
        w = plain(text)
        sets.append({tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set())
        made.append(words.shingles(hashes[at[i] : at[i + 1]], 4))
    for a, x in zip(made, sets, strict=True):
        assert len(a) == len(x)
        for b, y in zip(made, sets, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_nothing():
    assert words.hash_words([])[0].size == 0
    assert words.hash_words(["", " "])[1].tolist() == [0, 0, 0]
