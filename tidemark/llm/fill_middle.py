"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, and put together in another order.

A text's UTF-8 bytes are divided into blocks of a fixed size. Two Fenwick trees over the blocks count the lines that
end, and the code points that begin, in each. A cut behind the k-th line descends the trees by binary lifting to the
block in which that line ends, collecting the code points on the way; only that block is then looked at.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, pick

BLOCK = 4096
# The marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class Rule(NamedTuple):
    """The seed of the cuts, the texts of a hundred that are transformed, and those of a hundred in suffix-first form."""

    seed: str = "7"
    rate: int = 100
    suffix_first: int = 50


class Blocks:
    """Where the lines of a text end, in bytes and code points."""

    def __init__(self, raw: bytes, block: int = BLOCK):
        self.block = block
        self.bytes = np.frombuffer(raw, np.uint8)
        starts = np.arange(0, len(raw), block)
        if not len(raw):
            self.lines, self.units, self.points = 0, [0], [0]
            return
        ends = np.add.reduceat((self.bytes == 10).astype(np.int64), starts)
        ends[-1] += raw[-1] != 10
        self.lines = int(ends.sum())
        self.units = self._tree(ends)
        self.points = self._tree(np.add.reduceat(self._begins(self.bytes), starts))

    @staticmethod
    def _begins(part: np.ndarray) -> np.ndarray:
        """1 for every byte that begins a code point."""
        return ((part & 0xC0) != 0x80).astype(np.int64)

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        """Entry i holds the sum of the last ``i & -i`` of the first i counts."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        i = np.arange(sums.size)
        return (sums - sums[i - (i & -i)]).tolist()

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the k-th line; nothing lies before the end of line 0."""
        if k <= 0:
            return 0, 0
        at, before, last = 0, 0, len(self.units) - 1
        step = 1 << last.bit_length()
        while step:
            if at + step <= last and self.units[at + step] < k:
                at += step
                k -= self.units[at]
                before += self.points[at]
            step >>= 1
        begin = at * self.block
        here = self.bytes[begin : begin + self.block]
        ends = np.flatnonzero(here == 10)
        size = int(ends[k - 1]) + 1 if k <= ends.size else here.size
        return begin + size, before + int(self._begins(here[:size]).sum())


def numbers(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers of 32 bits that the seed and the id fix."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def arranged(raw: bytes, doc_id: int | None, rule: Rule) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, code points of prefix and middle, output) of one text."""
    blocks = Blocks(raw)
    n = blocks.lines
    h1, h2, h3, h4 = numbers(doc_id, rule.seed)
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    if not raw or p in raw or s in raw or m in raw or h3 % 100 >= rule.rate:
        return n, "plain", None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, before), (b, until) = blocks.cut(first), blocks.cut(second)
    head, middle, tail = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < rule.suffix_first:
        return n, "spm", before, until - before, b"".join((s, tail, p, head, m, middle))
    return n, "psm", before, until - before, b"".join((p, head, s, tail, m, middle))


def transform(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n`` (lines), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (code points;
    null if plain) and ``output``.

    A null text counts as empty; an empty text, and one that holds a mark already, is plain. A null id is cut as the
    id ``null``. Rows are independent: repeated rows come out repeated, an empty table gives an empty table, other
    columns are ignored. A text of any length is one row of work, its blocks of ``BLOCK`` bytes. One pass, no shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        raws = batch.column("text").cast(pa.binary()).to_pylist()
        made = [arranged(raw or b"", i, rule) for raw, i in zip(raws, ids, strict=True)]
        n, form, prefix, middle, output = map(list, zip(*made, strict=True)) if made else [[]] * 5
        arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64())]
        arrays += [pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    found = pick(df, doc_id=doc_id, text=text)
    return map_batches(found.withColumn("doc_id", F.col("doc_id").cast("bigint")), work, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    # The part in front of the first mark is empty.
    psm, spm = (F.concat(*[F.get(parts, i) for i in order]) for order in ((1, 3, 2), (2, 3, 1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digest(found: DataFrame) -> DataFrame:
    """Counts, and hashes of the output and of the text rebuilt from it."""
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


# The digest of the table of documents, for the default rule.
SQL = """
with lines as (
  select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as parts, sha256('7:' || doc_id) as h from documents
), counted as (
  select *, case when text = '' then 0 when ends_with(text, chr(10)) then len(parts) - 1 else len(parts) end as n,
    ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 25, 8))::bigint as h4
  from lines
), cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from counted
), sized as (
  select *, length(array_to_string(parts[1:a], chr(10))) + case when a > 0 and a < len(parts) then 1 else 0 end as p,
    length(array_to_string(parts[1:b], chr(10))) + case when b > 0 and b < len(parts) then 1 else 0 end as q
  from cuts
), named as (
  select *, substr(text, 1, p) as prefix, substr(text, p + 1, q - p) as middle, substr(text, q + 1) as suffix from sized
)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then p::bigint end as prefix_chars,
  case when form <> 'plain' then (q - p)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from named
"""
