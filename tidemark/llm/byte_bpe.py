"""Byte-level BPE by prefix dynamic programming.

Every prefix of a piece has exactly one encoding, so it is enough to store the prefix's last token: the
encoding is read back by following last tokens from the end. A token ends a prefix if the prefix before it
is encoded, and if merging the bytes of the last token there and of this one gives just these two tokens
(an encoding is the right one exactly when all its neighbouring pairs are). The table makes two things
exact and cheap: appending bytes only adds entries, and an edit keeps every entry before it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept, map_batches, pick, texts

# Pieces whose ids one worker remembers, some 100 MB.
REMEMBERED = 400_000
ENDING = 4
OWNER = "byte_bpe"
SCHEMA = "doc_id bigint, ids binary, decoded binary"


class Vocabulary:
    """Token bytes by rank, and which pairs of tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # The longest token with each ending of ENDING bytes; where none has it, tokens there are shorter than that.
        self.longest: dict[bytes, int] = {}
        for token in ranks:
            if len(token) >= ENDING:
                ending = token[-ENDING:]
                self.longest[ending] = max(self.longest.get(ending, 0), len(token))
        self.whole: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        """From lines of ``base64(token) rank``."""
        lines = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines})

    def merged(self, piece: bytes) -> list[int]:
        """Plain BPE: merge the neighbouring pair of lowest rank until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        """Merging the token's own bytes gives the token."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.merged(self.tokens[token]) == [token]
        return known

    def neighbours(self, left: int, right: int) -> bool:
        """Merging the bytes of both tokens gives these two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[left, right] = known
        return known


class Prefixes:
    """The last token of every prefix of one piece; grows by ``append``, changes by ``replace``."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; entries of earlier prefixes stay as they are."""
        v, last = self.vocabulary, self.last
        piece = self.piece = self.piece + more
        get, longest, pairs = v.ranks.get, v.longest.get, v.pairs.get
        for end in range(len(last) + 1, len(piece) + 1):
            begin = end - longest(piece[end - ENDING : end], ENDING - 1) if end >= ENDING else 0
            if begin <= 0:
                token = get(piece[:end])
                if token is not None and v.reachable(token):
                    last.append(token)
                    continue
                begin = 1
            while begin < end:
                token = get(piece[begin:end])
                if token is not None:
                    # Neighbours are reachable each on its own.
                    fits = pairs((last[begin - 1], token))
                    if fits is None:
                        fits = v.neighbours(last[begin - 1], token)
                    if fits:
                        last.append(token)
                        break
                begin += 1
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def replace(self, begin: int, end: int, by: bytes) -> None:
        """Put ``by`` in place of ``piece[begin:end]``; only prefixes longer than ``begin`` are encoded again."""
        rest = self.piece[end:]
        self.piece = self.piece[:begin]
        del self.last[begin:]
        self.append(by + rest)

    def ids(self) -> list[int]:
        """The tokens of the piece; a piece that is itself a token is that token."""
        token = self.vocabulary.ranks.get(self.piece)
        if token is not None:
            return [token]
        found, at = [], len(self.piece)
        while at:
            token = self.last[at - 1]
            found.append(token)
            at -= len(self.vocabulary.tokens[token])
        return found[::-1]


class Remembered(dict):
    """Ids of pieces as little-endian 32-bit bytes, computed on first sight.

    When half of the room is filled, the pieces become the older half and the older half before them goes; a piece met
    again comes back from it, so frequent ones stay.
    """

    def __init__(self, vocabulary: Vocabulary, room: int = REMEMBERED):
        super().__init__()
        self.vocabulary = vocabulary
        self.half = max(1, room // 2)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode("utf-8")
            token = self.vocabulary.ranks.get(raw)
            ids = [token] if token is not None else Prefixes(self.vocabulary, raw).ids()
            packed = np.array(ids, "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


def pieces(text: str, pattern: str) -> Iterator[str]:
    """Matches of the pattern, left to right."""
    return (m[0] for m in regex.finditer(pattern, text))


def encode_text(text: str, pattern: regex.Pattern, remembered: Remembered) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    return b"".join(map(remembered.__getitem__, pattern.findall(text)))


def decode_ids(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    """Bytes of packed ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file: read by the driver if it is a local path, by Spark if it names a store."""
    if ":" not in path:
        with open(path, "rb") as file:
            return file.read()
    rows = spark.read.format("binaryFile").load(path).select("content").take(1)
    return bytes(rows[0].content)


def _worker(content: bytes) -> tuple[Vocabulary, Remembered]:
    """The parsed vocabulary and what this Python worker remembers of its pieces, kept between tasks."""

    def parsed() -> tuple[Vocabulary, Remembered]:
        vocabulary = Vocabulary.parse(content)
        return vocabulary, Remembered(vocabulary)

    return kept(OWNER, content, parsed)


def encode_decode(df: DataFrame, content: bytes, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``ids`` (packed little-endian unsigned 32-bit), ``decoded`` (bytes of the ids).

    ``content`` is the vocabulary file (a fixed, small size, broadcast once). Each match of ``pattern`` is
    encoded separately, without special tokens. A null text counts as empty and gives empty ids; rows are
    independent, so repeated rows come out repeated; an empty table gives an empty table; other columns are
    ignored. One pass, no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(content)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary, remembered = _worker(shared.value)
        compiled = regex.compile(pattern)
        ids = [encode_text(t, compiled, remembered) for t in texts(batch)]
        decoded = [decode_ids(i, vocabulary.tokens) for i in ids]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
            names=["doc_id", "ids", "decoded"],
        )

    found = pick(df, doc_id=doc_id, text=text)
    return map_batches(found.withColumn("doc_id", F.col("doc_id").cast("bigint")), work, SCHEMA, owner=OWNER)


def n_tokens(ids: Column) -> Column:
    """Number of packed ids."""
    return F.floor(F.octet_length(ids) / 4).cast("bigint")


def digest(found: DataFrame) -> DataFrame:
    """Lengths and hashes of the ids and the decoded bytes."""
    return found.select(
        "doc_id",
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
