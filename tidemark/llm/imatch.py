"""I-Match fingerprints.

The lexicon holds the words of middling document frequency: those that are in at least ``LOW`` and at most
``HIGH`` of all documents. A document keeps the distinct terms of its text that are in the lexicon, in sorted
order, and hashes those that fall into each of several random subsets of the lexicon. Small edits change few
subsets; documents that share none of the hashes are unlike.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_BYTES, pick, slices, store, texts
from tidemark.llm.words import hash_words, mixed

LOW, HIGH = 0.0005, 0.1
SUBSETS = 48
# Of so many terms one is in a subset, on average.
RARITY = 200


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of all terms of the band; at most the mean number of distinct terms of a text, divided by ``low``. Frequencies count every text of (text) once for each of its terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words, at = hash_words(texts(batch))
                row = np.repeat(np.arange(batch.num_rows), np.diff(at))
                order = np.lexsort((row, words))
                words, row = words[order], row[order]
                new = np.ones(words.size, bool)
                new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
                terms, n = np.unique(words[new], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "n"]
                )

    total = docs.count()
    sums = docs.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = sums.where((F.col("n") >= 2) & (F.col("n") >= low * total) & (F.col("n") <= max(2.0, high * total)))
    rows = band.select("term").collect()
    return np.sort(np.array([r.term for r in rows], np.int64).view(np.uint64))


class Fingerprinter:
    """Fingerprints by a lexicon, in one Python worker."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        seeds = mixed(np.arange(1, SUBSETS + 1, dtype=np.uint64))
        # Row k tells which terms the k-th subset holds.
        self.held = [mixed(terms ^ seed) % np.uint64(RARITY) == 0 for seed in seeds]

    def known(self, words: np.ndarray) -> np.ndarray:
        """Places of the distinct terms of a text, in sorted order."""
        if not self.terms.size or not words.size:
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, words), self.terms.size - 1)
        return np.unique(at[self.terms[at] == words])

    def __call__(self, words: np.ndarray) -> str:
        """Hashes of the subsets, joined by ``-``; ``0`` for a subset without a term of the text. A text without
        any of them is hashed by all its distinct words."""
        places = self.known(words)
        parts = []
        for held in self.held:
            chosen = places[held[places]]
            parts.append(hashlib.blake2b(self.terms[chosen].tobytes(), digest_size=4).hexdigest() if chosen.size else "0")
        if all(p == "0" for p in parts):
            parts = [hashlib.blake2b(np.unique(words).tobytes(), digest_size=4).hexdigest()] * SUBSETS
        return "-".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that one of both has terms of; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    pairs = [(x, y) for x, y in zip(a.split("-"), b.split("-"), strict=True) if (x, y) != ("0", "0")]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def fingerprints(df: DataFrame, terms: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint``. A null text counts as empty; equal texts have equal fingerprints."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                words, at = hash_words(texts(batch))
                made = [maker(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    found = pick(df, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint"), "text")
    return found.mapInArrow(run, "doc_id bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first code points of the following text, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = (
    "kind string, doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, text string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


class Chain:
    """Rows of documents, each compared with the one after it."""

    def __init__(self, terms: np.ndarray):
        self.make = Fingerprinter(terms)

    def rows(self, docs: list[tuple[int | None, str]]) -> list[tuple]:
        """A row for each document but the last."""
        mixed_texts = [edited(a[1], b[1]) for a, b in zip(docs, docs[1:], strict=False)]
        words, at = hash_words([t for _, t in docs] + mixed_texts)
        made = [self.make(words[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        own, changed = made[: len(docs)], made[len(docs) :]
        return [
            (
                "row",
                doc,
                len(text),
                hashlib.sha256(mixed_texts[i].encode("utf-8", "replace")).hexdigest(),
                own[i],
                changed[i],
                likeness(own[i], changed[i]),
                likeness(own[i], own[i + 1]),
                None,
            )
            for i, (doc, text) in enumerate(docs[:-1])
        ]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)


def robustness(df: DataFrame, terms: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, and its likeness to its edited
    text (``near_edited``) and to the next document (``near_next``), by descending id; the first follows the last.

    A null text counts as empty. Rows without an id come last; rows of equal id follow each other by a hash of their text. A
    single document follows itself; an empty table gives an empty table; other columns are ignored.

    Texts are moved once, compressed, into ranges of ids. A range compares its neighbours as it reads them, and passes on only its first
    and last document; those are paired by their ids, two for each range.
    """
    body = F.coalesce("text", F.lit(""))
    docs = pick(df, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint"), F.xxhash64(body).alias("tie"), body.alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(terms)
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                packed = [zlib.compress(t.encode("utf-8"), 1) for t in texts(batch)]
                columns = [batch.column("doc_id"), batch.column("tie"), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "packed"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, last = Chain(shared.value), None
        for whole in batches:
            for batch in slices(whole, "packed", BATCH_BYTES // 4):
                bodies = [zlib.decompress(p).decode("utf-8") for p in batch.column("packed").to_pylist()]
                docs_ = list(zip(batch.column("doc_id").to_pylist(), bodies, strict=True))
                if last is None:
                    yield batch_of([("head", docs_[0][0], *[None] * 6, docs_[0][1])])
                docs_ = ([last] if last else []) + docs_
                yield batch_of(chain.rows(docs_))
                last = docs_[-1]
        if last:
            yield batch_of([("tail", last[0], *[None] * 6, last[1])])

    docs = docs.mapInArrow(pack, "doc_id bigint, tie bigint, packed binary")
    ranged = docs.repartitionByRange(F.desc_nulls_last("doc_id")).sortWithinPartitions(*order)
    found = ranged.mapInArrow(walk, SCHEMA).withColumn("range", F.spark_partition_id())
    found = store(found, "chain")
    ends = found.where("kind <> 'row'").select("kind", "range", F.monotonically_increasing_id().alias("key"), "text", "doc_id")
    ends = store(ends, "ends")
    # One head and one tail for each range: ranges are in order, so a tail is followed by the next range's head.
    heads = ends.where("kind = 'head'").select("range", F.col("key").alias("head"))
    turn = Window.orderBy("range")
    heads = heads.withColumn("next", F.coalesce(F.lead("head").over(turn), F.first("head").over(turn)))
    tails = ends.where("kind = 'tail'").select("range", "doc_id", "text")
    pairs = tails.join(heads.select("range", F.col("next").alias("key")), "range").join(
        ends.select("key", F.col("text").alias("following")), "key"
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(shared.value)
        for batch in batches:
            for doc, text_, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                yield batch_of(chain.rows([(doc, text_), (None, following)]))

    closed = pairs.select("doc_id", "text", "following").mapInArrow(close, SCHEMA)
    names = [n for n in NAMES if n not in ("kind", "text")]
    return found.where("kind = 'row'").select(*names).unionByName(closed.select(*names))
