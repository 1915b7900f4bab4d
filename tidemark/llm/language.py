"""Language identification by rank-order profiles.

A language's profile is its most frequent character n-grams (one to three characters of padded words) in
order of frequency. A document's own n-grams are ranked the same way; the out-of-place distance adds up how
far each of them stands from its place in the profile, with a fixed charge for one that is not there. The
nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, pick, slices, texts

PROFILE = 400
DOCUMENT = 300
UNKNOWN = "und"
SPACE = 32
# Ranking one language's n-grams starts in so many parts, so that no task gets them all.
PARTS = 16
# A dense count table is used up to this many cells (three characters of an alphabet of 158).
DENSE = 4_000_000


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def padded_words(text: str) -> np.ndarray:
    """Code points of the lower-cased words, one space before, between and after them; empty if no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    found = np.where(letter, codes, SPACE)[keep].astype(np.int64)
    if not found.size:
        return found
    ends = [SPACE] if found[-1] != SPACE else []
    return np.concatenate(([SPACE], found, np.array(ends, np.int64)))


# N-grams are numbers whose digits are code points.
WIDTH = 1 << 21


def grams(codes: np.ndarray) -> np.ndarray:
    """N-grams of one to three characters; three need a letter in the middle."""
    two = codes[:-1] * WIDTH + codes[1:]
    three = (two[:-1] * WIDTH + codes[2:])[codes[1:-1] != SPACE]
    return np.concatenate((codes[codes != SPACE], two, three))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in ascending order, and how often each occurs."""
    alphabet = np.flatnonzero(np.bincount(codes))
    # Dense numbers keep the order of code points, and a leading zero is left free for shorter n-grams.
    size = len(alphabet) + 1
    if codes.size < 100_000 or size**3 > DENSE:
        return np.unique(grams(codes), return_counts=True)
    place = np.zeros(int(alphabet[-1]) + 1, np.int64)
    place[alphabet] = np.arange(1, size)
    dense, gap = place[codes], place[SPACE]
    two = dense[:-1] * size + dense[1:]
    three = (two[:-1] * size + dense[2:])[dense[1:-1] != gap]
    counts = np.bincount(dense[dense != gap], minlength=size**3)
    counts += np.bincount(two, minlength=size**3)
    counts += np.bincount(three, minlength=size**3)
    at = np.flatnonzero(counts)
    back = np.concatenate(([0], alphabet))
    keys = (back[at // size**2] * WIDTH + back[at // size % size]) * WIDTH + back[at % size]
    order = np.argsort(keys)
    return keys[order], counts[at][order]


def ranked(codes: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; equal counts in ascending order."""
    keys, counts = counted(codes)
    return keys[np.argsort(-counts, kind="stable")[:most]]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def profiles(df: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The ranked n-grams of each ``lang`` of (lang, text): ``size`` numbers a language reach the driver.

    Tasks count whole texts; the counts are summed per language and n-gram, and ranked in ``PARTS`` parts
    first. Rows without text or language teach nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                by: dict[str, list[str]] = {}
                for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, members in by.items():
                    codes = padded_words("\n".join(members))
                    if codes.size:
                        keys, counts = counted(codes)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys)), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
                            names=["lang", "gram", "n"],
                        )

    known = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sums = known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("gram")]
    part = F.pmod(F.xxhash64("gram"), F.lit(PARTS))
    first = sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    last = first.where(F.col("rank") <= size).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    )
    found: dict[str, list[tuple[int, int]]] = {}
    for row in last.where(F.col("rank") <= size).collect():
        found.setdefault(row.lang, []).append((row.rank, row.gram))
    return {lang: [gram for _, gram in sorted(rows)] for lang, rows in sorted(found.items())}


class Nearest:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, learned: dict[str, list[int]]):
        self.names = list(learned)
        self.keys = np.unique(np.array([g for grams_ in learned.values() for g in grams_], np.int64))
        self.charge = max([1, *map(len, learned.values())])
        # One more column stands for n-grams that no profile has.
        self.places = np.full((len(self.names), len(self.keys) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            self.places[i, np.searchsorted(self.keys, np.array(learned[name], np.int64))] = np.arange(len(learned[name]))

    def __call__(self, text: str, most: int = DOCUMENT) -> tuple[str, float, float | None]:
        """(language, score, distance from 0 to 1)."""
        codes = padded_words(text)
        if not codes.size or not self.names:
            return UNKNOWN, 0.0, None
        own = ranked(codes, most)
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = -1
        at = np.where(self.keys[at] == own, at, len(self.keys))
        places = self.places[:, at]
        apart = np.where(places < 0, self.charge, np.minimum(np.abs(places - np.arange(len(own))), self.charge))
        distances = apart.sum(axis=1) / (self.charge * len(own))
        order = np.argsort(distances, kind="stable")
        best = float(distances[order[0]])
        second = float(distances[order[1]]) if len(order) > 1 else 1.0
        return self.names[order[0]], (second - best) / second if second > 0 else 0.0, best


def identify(df: DataFrame, learned: dict[str, list[int]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``lang_pred``, ``score`` (how much nearer the best profile is than the second,
    0 to 1) and ``distance`` (0 to 1).

    A null text or one without a letter gives ``und``, score 0 and no distance, as does an empty set of
    profiles. Equal distances go to the first name. Rows are independent: repeated rows come out repeated,
    an empty table gives an empty table, other columns are ignored. Map only.
    """
    shared = df.sparkSession.sparkContext.broadcast(learned)
    made: list[Nearest] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Nearest(shared.value))
        rows = [made[0](t) for t in texts(batch)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.float64()),
            ],
            names=["doc_id", "lang_pred", "score", "distance"],
        )

    found = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return map_batches(found, work, "doc_id bigint, lang_pred string, score double, distance double")
