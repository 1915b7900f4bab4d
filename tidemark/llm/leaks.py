"""Benchmark texts inside documents, found by the q-gram lemma and verified by banded alignment.

An item of ``m`` characters that stands in a document with at most ``e`` edits shares at least
``m - q + 1 - q * e`` of its character q-grams with it, and all of them on diagonals (document position minus
item position) at most ``e`` apart. Shared q-grams are counted in overlapping bands of diagonals; only bands
that reach the bound are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_position, pick, slices, texts
from tidemark.llm.words import mixed

Q = 12
# Edits for a hundred characters of an item.
EDIT_SHARE = 6
# Characters of items that are looked for in one pass over the documents.
BLOCK = 4_000_000
FILTER_BITS = 22
PIECE = 1024 * 1024


def normal(text: str) -> str:
    """Lower case, one space for every run of white space."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def qgrams(code: np.ndarray) -> np.ndarray:
    """A hash of each run of ``Q`` = 8 + 4 characters; doubling takes a few additions for each position."""
    if code.size < Q:
        return np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    two = code[:-1].astype(np.uint64) * base + code[1:]
    two *= base
    four = two[:-2] * np.uint64(pow(0x9E3779B97F4A7C15, 2, 2**64)) + two[2:]
    eight = four[:-4] * np.uint64(pow(0x9E3779B97F4A7C15, 4, 2**64)) + four[4:]
    n = code.size - Q + 1
    return eight[:n] * np.uint64(pow(0x9E3779B97F4A7C15, 8, 2**64)) + four[8 : 8 + n]


def budget(m: int) -> int:
    """Edits allowed for an item of ``m`` characters, such that one shared q-gram at least is sure."""
    return max(0, min(m * EDIT_SHARE // 100, (m - Q) // Q))


def alignment(item: np.ndarray, window: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """(least edits, end) of the item against any stretch of the window that stays between two diagonals."""
    width = high - low + 1
    far = len(item) + len(window) + 1
    at = np.arange(width)
    # Cell k of row i stands for window position i + low + k.
    row = np.where((low + at >= 0) & (low + at <= len(window)), 0, far)
    for i in range(1, len(item) + 1):
        place = i + low + at
        inside = (place >= 0) & (place <= len(window))
        here = window[np.clip(place - 1, 0, max(0, len(window) - 1))] if len(window) else np.zeros(width, np.uint32)
        step = np.where(place >= 1, row + (here != item[i - 1]), far)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        step = np.where(inside, step, far)
        row = np.minimum(np.minimum.accumulate(step - at) + at, far)
        row = np.where(inside, row, far)
    best = int(np.argmin(row))
    return int(row[best]), len(item) + low + best


class Items:
    """A block of items with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.codes = [codes(t) for _, t in items]
        self.edits = np.array([budget(len(c)) for c in self.codes], np.int64)
        self.bounds = np.array([len(c) - Q + 1 for c in self.codes], np.int64) - Q * self.edits
        grams = [qgrams(c) for c in self.codes]
        keys = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else order
        self.mask = np.zeros(1 << FILTER_BITS, bool)
        self.mask[self.slot(self.keys)] = True
        self.width = int(self.edits.max(initial=0)) + 1

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document position, item, item position) of every shared q-gram."""
        grams = qgrams(code)
        places = np.flatnonzero(self.mask[self.slot(grams)])
        grams = grams[places]
        first, last = np.searchsorted(self.keys, grams, "left"), np.searchsorted(self.keys, grams, "right")
        n = last - first
        begins = np.cumsum(n) - n
        at = np.repeat(first - begins, n) + np.arange(n.sum())
        return np.repeat(places, n), self.item[at], self.place[at]

    def search(self, code: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, end, edits) of every item that stands in the text within its budget; the best place of each."""
        if not self.keys.size:
            return []
        places, item, own = self.hits(code)
        if not places.size:
            return []
        diagonal = places - own + int(self.place.max()) + 1
        band = diagonal // self.width
        # Bands overlap by half: a hit counts for its own band and for the one before.
        span = int(band.max()) + 2
        keys, counts = np.unique(np.concatenate((item * span + band, item * span + band - 1)), return_counts=True)
        found: dict[int, tuple[int, int]] = {}
        enough = counts >= self.bounds[keys // span]
        for key in keys[enough].tolist():
            i, b = divmod(key, span)
            edits = int(self.edits[i])
            low = b * self.width - int(self.place.max()) - 1 - edits
            high = low + 2 * self.width + 2 * edits
            start = max(0, low)
            window = code[start : max(start, high + len(self.codes[i]))]
            cost, end = alignment(self.codes[i], window, low - start, high - start)
            if cost <= edits:
                found[i] = min(found.get(i, (cost, start + end)), (cost, start + end))
        return [(self.ids[i], end, cost) for i, (cost, end) in sorted(found.items())]


def pieces(text: str, overlap: int) -> Iterator[tuple[int, str]]:
    """(offset, part) of a long text; neighbours share ``overlap`` characters, so no place is lost."""
    step = max(PIECE, 2 * overlap)
    for begin in range(0, max(1, len(text)), step):
        yield begin, text[begin : begin + step + overlap]
        if begin + step + overlap >= len(text):
            return


def found_in(text: str, items: Items) -> list[tuple[int, int, int]]:
    """(item id, end, edits) in a text of any length; positions are those of the normalised text."""
    whole = normal(text)
    overlap = max((len(c) for c in items.codes), default=0) + 2 * items.width
    best: dict[int, tuple[int, int]] = {}
    for offset, part in pieces(whole, overlap):
        for item, end, cost in items.search(codes(part)):
            best[item] = min(best.get(item, (cost, offset + end)), (cost, offset + end))
    return [(item, end, cost) for item, (cost, end) in sorted(best.items())]


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of ``BLOCK`` characters, which are the stated queries of one pass each.

    Items without text or id, or shorter than ``Q`` characters, identify nothing and are left out.
    """
    block, size = [], 0
    rows = pick(benchmark, item_id=item_id, text=text).where("item_id is not null and text is not null").distinct()
    for row in rows.toLocalIterator():
        plain = normal(row.text)
        if len(plain) < Q:
            continue
        if block and size + len(plain) > BLOCK:
            yield block
            block, size = [], 0
        block.append((row.item_id, plain))
        size += len(plain)
    if block:
        yield block


def _mapped(df: DataFrame, block: list[tuple[int, str]], text: str, schema: str | object, make) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(sorted(block))
    ready: list[Items] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            ready.append(Items(shared.value))
        for whole in batches:
            for batch in slices(whole, text):
                yield make(batch, [found_in(t, ready[0]) for t in texts(batch, text)])

    return df.mapInArrow(run, schema)


def find(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_items``, ``items`` (item:end:edits, comma-joined by item), ``contaminated``.

    Texts are compared in lower case with single spaces. A null or empty text holds nothing; repeated rows come
    out repeated; an empty table on either side gives no find; other columns are ignored. Map only, one pass for
    each block of items.
    """
    found = pick(df, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint"), "text", F.lit("").alias("items"))
    schema = "doc_id bigint, text string, items string"

    def make(batch: pa.RecordBatch, rows: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
        new = [",".join(":".join(map(str, r)) for r in row) for row in rows]
        both = [",".join(filter(None, (old, more))) for old, more in zip(batch.column("items").to_pylist(), new, strict=True)]
        columns = [batch.column("doc_id"), batch.column("text"), pa.array(both, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "items"])

    for block in blocks(benchmark):
        found = _mapped(found, block, "text", schema, make)
    n = F.when(F.col("items") == "", 0).otherwise(F.size(F.split("items", ","))).cast("bigint")
    return found.select("doc_id", n.alias("n_items"), "items", (F.col("items") != "").alias("contaminated"))


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all columns, whose text holds no item.

    A null or empty text holds none and stays; repeated rows are treated alike; an empty table gives an empty table, and
    without items all rows stay. Columns are found by position, so others may be called as they like.
    """

    def make(batch: pa.RecordBatch, rows: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
        return batch.filter(pa.array([not row for row in rows], pa.bool_()))

    plain, at = by_position(df)
    for block in blocks(benchmark):
        plain = _mapped(plain, block, at[text], plain.schema, make)
    return plain.toDF(*df.columns)
