from __future__ import annotations

import random
import textwrap
import time

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import line_chunks, workload
from tidemark.llm.line_chunks import Chunking

CHUNKS_ONLY = Chunking(runs=False)
MASK = 2**64 - 1


def size(lines):
    return len("\n".join(lines).encode())


def chunk_bounds(lines, how):
    """(begin, end) of the chunks, by the definition."""
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    long = [len(line.encode()) >= how.long for line in lines]
    begins = []
    for i, h in enumerate(hashes):
        rolling = ((h << 1 & MASK) | h >> 63) ^ (hashes[i + 1] if i + 1 < len(hashes) else 0)
        signed = rolling - (rolling >> 63 << 64)
        if i == 0 or long[i] or long[i - 1] or signed % how.divisor == 0:
            begins.append(i)
    return list(zip(begins, [*begins[1:], len(lines)], strict=True))


def run_bounds(lines, how, every):
    """All runs of two or more lines and ``long`` bytes; or, for long tables, the shortest from each line down and up."""
    found = set()
    for a in range(len(lines)):
        for b in range(a + 2, len(lines) + 1):
            if size(lines[a:b]) >= how.long:
                found.add((a, b))
                if not every:
                    break
        if not every:
            for c in range(a - 1, -1, -1):
                if size(lines[c : a + 1]) >= how.long:
                    found.add((c, a + 1))
                    break
    return found


def brute_force(rows, how=Chunking(), every=True):
    """(doc_id, text, n_removed) by comparing the texts of all chunks and runs."""
    docs = [(d, t.split("\n")) for d, t in rows if d is not None and t is not None]
    owner, parts = {}, {}
    for d, lines in docs:
        chunks = [(a, b) for a, b in chunk_bounds(lines, how) if b - a > 1 or len(lines[a].encode()) >= how.long]
        runs = run_bounds(lines, how, every) if how.runs else set()
        parts[d, "\n".join(lines)] = chunks, runs
        for kind, bounds in enumerate((chunks, runs)):
            for a, b in bounds:
                key = kind, tuple(lines[a:b])
                owner[key] = min(d, owner.get(key, d))
    exempt = copies(docs, parts, owner, how.copy_share) if how.copy_share is not None else set()
    result = []
    for d, t in rows:
        if d is None or t is None or d in exempt:
            result.append((d, t, 0))
            continue
        lines = t.split("\n")
        chunks, runs = parts[d, t]
        gone = [(a, b) for a, b in chunks if owner[0, tuple(lines[a:b])] < d]
        in_chunks = {i for a, b in gone for i in range(a, b)}
        cut = in_chunks | {i for a, b in runs if owner[1, tuple(lines[a:b])] < d for i in range(a, b)}
        result.append((d, "\n".join(x for i, x in enumerate(lines) if i not in cut), len(gone) + len(cut - in_chunks)))
    return sorted(result, key=repr)


def copies(docs, parts, owner, share):
    """Ids whose shared chunks with the owner of most of them are ``share`` of both texts."""
    held, last = {}, {}
    for d, lines in docs:
        for a, b in parts[d, "\n".join(lines)][0]:
            last[tuple(lines[a:b])] = max(d, last.get(tuple(lines[a:b]), d))
    for d, lines in docs:
        mine = held.setdefault(d, {})
        for a, b in parts[d, "\n".join(lines)][0]:
            key = tuple(lines[a:b])
            if owner[0, key] != last[key]:
                mine[key] = mine.get(key, 0) + size(key) + 1
    whole = {d: size(lines) + 1 for d, lines in docs}
    found = set()
    for d, mine in held.items():
        others = {}
        for key, n in mine.items():
            if owner[0, key] != d:
                others[owner[0, key]] = others.get(owner[0, key], 0) + n
        if others:
            original = min(others, key=lambda o: (-others[o], o))
            both = [key for key in mine if key in held[original]]
            if sum(mine[k] for k in both) >= share * whole[d] and sum(held[original][k] for k in both) >= share * whole[original]:
                found.add(d)
    return found


def removed(spark, rows, how=Chunking()):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text, r.n_removed) for r in line_chunks.remove_repeated(df, how).collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passages = [[line(rng.choice([3, 8, 30])) for _ in range(rng.randint(1, 6))] for _ in range(6)]
    rows = []
    for i in range(80):
        lines = [line(rng.randint(1, 40)) for _ in range(rng.randint(3, 12))]
        if rng.random() < 0.5:
            at = rng.randrange(len(lines))
            lines[at:at] = rng.choice(passages)
        rows.append((i, "\n".join(lines)))
    rows += [(90, rows[3][1]), (91, rows[3][1] + "\nmore"), (92, None), (93, ""), (94, "\n\n"), (None, rows[5][1]), (95, "ä\n" * 200), (96, "ä\n" * 210)]
    return rows


@pytest.mark.parametrize("how", [CHUNKS_ONLY, Chunking(), Chunking(copy_share=0.8), Chunking(5, 60, True, 0.5)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, how):
    rows = corpus(seed)
    got = removed(spark, rows, how)
    assert got == brute_force(rows, how)
    assert any(n for *_, n in got)


def test_boundaries_equal_the_definition_and_resist_shifts(spark):
    rng = random.Random(4)
    lines = [f"line {rng.random()}" * rng.choice([1, 1, 9]) for _ in range(60)]
    texts = ["\n".join(lines), "\n".join(["new", "lines", *lines]), "", "\n", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: [(c.at, c.at + c.lines) for c in r.c] for r in df.select("i", line_chunks.chunks(line_chunks.facts(F.col("t")), Chunking()).alias("c")).collect()}
    assert [found[i] for i in range(len(texts))] == [chunk_bounds(t.split("\n"), Chunking()) for t in texts]
    assert len({(a + 2, b + 2) for a, b in found[0]} - set(found[1])) <= 2


def test_repeated_rows_and_no_rows(spark):
    text = "a b c\n" + " ".join(f"x{i}" for i in range(60))
    own = "\n" + " ".join(f"y{i}" for i in range(70))
    rows = [(1, text), (2, text + own), (2, text + own), (2, "another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.text) for r in line_chunks.remove_repeated(df, CHUNKS_ONLY).collect())
    assert [g[:2] for g in got] == [(1, 0), (2, 0), (2, 1), (2, 1)] and got[1][2] == "another text"
    assert line_chunks.remove_repeated(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in workload.op4_line_chunks(spark, folder).collect()), key=repr)
    assert got == brute_force(rows, every=False)


def test_only_copies_of_one_document_are_left_to_a_later_stage(spark):
    rng = random.Random(7)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    sources = [[line(30) for _ in range(4)] for _ in range(3)]
    long = [line(200)]
    rows = [(i, "\n".join(s)) for i, s in enumerate(sources)] + [(3, "\n".join([*(line(40) for _ in range(8)), *long]))]
    rows += [(10, "\n".join(sources[0][:2] + sources[1][1:3] + sources[2][2:])), (11, "\n".join([line(30), *long]))]
    rows += [(12, "\n".join(sources[1])), (13, "\n".join([line(10), *sources[2]]))]
    got = {d: (t, n) for d, t, n in removed(spark, rows, Chunking(copy_share=0.8))}
    assert got[10] == ("", 6) and got[11][1] == 1 and got[12] == (rows[6][1], 0) and got[13] == (rows[7][1], 0)
    without = {d: (t, n) for d, t, n in removed(spark, rows)}
    assert without[12] == ("", 4) and without[13] == (rows[7][1].split("\n")[0], 4)


def wrapped(seed):
    """Texts in short lines with a passage of 50 words at widths of 20 to 140 columns."""
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))
    lines = lambda: [rng.choice([words(rng.randint(1, 9)), words(30)]) for _ in range(rng.randint(6, 9))]
    passages = {width: textwrap.wrap(words(50), width) for width in (20, 40, 72, 80, 140)}
    passages[0] = [words(4), words(30), words(5), words(40), words(12)]
    passages[1] = [words(25), "", words(2)]
    rows = []
    for doc in range(0, 35):
        a = lines()
        a[3:3] = passages[list(passages)[doc % len(passages)]]
        rows.append((doc, "\n".join(a)))
    return rows, passages


def test_wrapped_passages_go(spark):
    rows, passages = wrapped(5)
    got = removed(spark, rows)
    assert got == brute_force(rows)
    found = {d: t for d, t, _ in got}
    for i, (width, passage) in enumerate(passages.items()):
        for doc in range(i + 7, 35, 7):
            assert not set(found[doc].split("\n")) & set(filter(None, passage)), width


def test_long_texts_need_no_more_than_in_proportion(spark):
    """Two texts of 20,000 short lines, half of them shared; the heap of the tests is one of 1 GB."""
    rng = random.Random(8)
    lines = lambda n: [" ".join(f"w{rng.randrange(10**4)}" for _ in range(rng.randint(1, 9))) for _ in range(n)]
    shared, first, second = lines(10_000), lines(10_000), lines(10_000)
    rows = [(1, "\n".join(first + shared)), (2, "\n".join(second[:5000] + shared + second[5000:]))]
    begin = time.time()
    got = {d: t.split("\n") for d, t, _ in removed(spark, rows)}
    assert got[1] == first + shared and got[2] == second
    assert time.time() - begin < 120
