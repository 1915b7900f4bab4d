"""Removal of repeated passages by content-defined chunks of lines.

Lines are hashed; a cyclic-polynomial hash rolls over each line and the one after it, and a chunk begins where
that hash is divisible by ``divisor``. A line of ``long`` bytes or more, a paragraph rather than a line, is a
chunk of its own. Boundaries depend on the lines next to them only, so an insertion moves no other boundary.
Chunks that several documents hold are compared byte by byte with the chunk of the document with the smallest
id and removed everywhere else. Passages that the boundaries cut differently are found by runs of lines: from every
line, the shortest run of ``long`` bytes down and up the text. Each run that lies within a passage is the same in
all documents that hold it, and together they cover it. Only DataFrame functions are used.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.common import by_position, pick, store

CHUNK, RUN = 0, 1


class Chunking(NamedTuple):
    """How lines form chunks, whether runs of lines are looked for besides, and which documents are left to a later
    stage as copies of another one as a whole (see ``copies``): with ``None`` none are."""

    divisor: int = 3
    long: int = 150
    runs: bool = True
    copy_share: float | None = None


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def facts(text: Column) -> Column:
    """The bytes of each line with its line feed, and its hash."""
    return spans.bound(
        lines(text),
        lambda x: F.struct(F.transform(x, lambda y: F.octet_length(y) + 1).alias("sizes"), F.transform(x, lambda y: F.xxhash64(y)).alias("hashes")),
    )


def chunks(fact: Column, how: Chunking) -> Column:
    """(at, lines) of every chunk of a text, from its ``facts``; they follow each other without a gap."""
    sizes, hashes = fact["sizes"], fact["hashes"]

    def begins(h: Column, i: Column) -> Column:
        turned = F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))
        rolling = turned.bitwiseXOR(F.coalesce(F.get(hashes, i + 1), F.lit(0).cast("bigint")))
        beside = (F.get(sizes, i) > how.long) | (F.get(sizes, i - 1) > how.long)
        return (i == 0) | beside | (F.pmod(rolling, F.lit(how.divisor)) == 0)

    starts = F.filter(F.transform(hashes, lambda h, i: F.when(begins(h, i), i)), lambda i: i.isNotNull())
    return spans.bound(
        starts,
        lambda s: F.transform(s, lambda a, j: F.struct(a.alias("at"), (F.coalesce(F.get(s, j + 1), F.size(hashes)) - a).alias("lines"))),
    )


def runs(fact: Column, how: Chunking) -> Column:
    """(at, lines) of the runs of two or more lines: for every line, the shortest run of ``long`` bytes that begins
    there, and the one that ends there."""
    # A line takes one byte and its own at least, so no more lines are needed; most often eight are enough.
    few, most = 8, how.long + 1
    sizes = fact["sizes"]

    def gathered(part: Column) -> Column:
        start = F.struct(F.lit(-1).alias("total"), F.lit(0).alias("lines"))
        step = lambda acc, n: F.when(acc["total"] >= how.long, acc).otherwise(
            F.struct((acc["total"] + n).alias("total"), (acc["lines"] + 1).alias("lines"))
        )
        return F.aggregate(part, start, step)

    def reached(part, i: Column, down: bool) -> Column:
        def named(got: Column) -> Column:
            at = i if down else i - got["lines"] + 1
            return F.struct(at.alias("at"), got["lines"].alias("lines"), (got["total"] >= how.long).alias("enough"))

        return spans.bound(gathered(part(few)), lambda a: named(F.when(a["total"] >= how.long, a).otherwise(gathered(part(most)))))

    def both(_: Column, i: Column) -> Column:
        below = lambda k: spans.part(sizes, i, F.least(i + k, F.size(sizes)) - 1)
        above = lambda k: spans.part(sizes, i, F.greatest(i - k + 1, F.lit(0)))
        return F.array(reached(below, i, True), reached(above, i, False))

    every = F.filter(F.flatten(F.transform(sizes, both)), lambda r: r["enough"] & (r["lines"] > 1))
    # Structs would be compared each with each; whole numbers are distinct by hash.
    packed = F.array_distinct(F.transform(every, lambda r: F.shiftleft(r["at"].cast("bigint"), 32) + r["lines"]))
    return F.transform(
        packed, lambda r: F.struct(F.shiftright(r, 32).cast("int").alias("at"), r.bitwiseAND(2**32 - 1).cast("int").alias("lines"))
    )


def hash_of(hashes: Column, kind: Column, at: Column, n: Column) -> Column:
    """The hash of a piece, from the hashes of all lines; pieces of different kinds have nothing to do with each other."""
    return F.xxhash64(kind, spans.part(hashes, at, at + n - 1))


def pieces(text: Column, how: Chunking) -> Column:
    """(kind, at, lines, hash, size) of what may be repeated: chunks of two or more lines or one long line, and runs."""

    def found(fact: Column) -> Column:
        def piece(kind: int, p: Column) -> Column:
            k, at, n = F.lit(kind), p["at"], p["lines"]
            size = F.aggregate(spans.part(fact["sizes"], at, at + n - 1), F.lit(0), lambda a, b: a + b)
            return F.struct(k.alias("kind"), at.alias("at"), n.alias("lines"), hash_of(fact["hashes"], k, at, n).alias("hash"), size.alias("size"))

        able = F.filter(chunks(fact, how), lambda p: (p["lines"] > 1) | (F.get(fact["sizes"], p["at"]) > how.long))
        made = F.transform(able, lambda p: piece(CHUNK, p))
        return F.concat(made, F.transform(runs(fact, how), lambda p: piece(RUN, p))) if how.runs else made

    return spans.bound(facts(text), found)


def repeated(docs: DataFrame, how: Chunking) -> DataFrame:
    """(doc_id, kind, at, lines, hash, owner) of the pieces that several documents hold.

    ``owner`` is the smallest id; its own piece is listed as well. A copy as a whole (see ``copies``) is not
    listed, unless it is the owner.
    """
    every = docs.where("doc_id is not null and text is not null").select(
        "doc_id", (F.octet_length("text") + 1).alias("all"), F.explode(pieces(F.col("text"), how)).alias("part")
    )
    able = store(every.select("doc_id", "all", "part.*"), "chunks")
    shared = able.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner <> last")
    # Written first: a join of two plain exchanges lets Spark split the rows of a hot chunk.
    found = store(able.join(store(shared.select("hash", "owner"), "owners"), "hash"), "shared")
    if how.copy_share is not None:
        copy = copies(found.where(F.col("kind") == CHUNK), how.copy_share).select("doc_id", F.lit(True).alias("copy"))
        found = found.join(copy, "doc_id", "left").where("copy is null or doc_id = owner")
    return found.select("doc_id", "kind", "at", "lines", "hash", "owner")


def copies(found: DataFrame, share: float) -> DataFrame:
    """(doc_id) of the documents that are copies of one other document as a whole, from shared chunks.

    The other document is the owner of most of its repeated bytes; the chunks that both hold must be ``share`` of the
    bytes of each. A text put together from several documents, or a short text with a long passage of another
    one, is no copy.
    """
    others = found.where("doc_id <> owner").distinct().groupBy("doc_id", "owner").agg(F.sum("size").alias("bytes"))
    one = others.groupBy("doc_id").agg(F.min_by("owner", F.struct(-F.col("bytes"), "owner")).alias("original"))
    held = found.distinct().groupBy("doc_id", "hash").agg(F.sum("size").alias("bytes"), F.min("all").alias("all"))
    held = store(held, "held")
    # Written first, like the shared chunks: an original of many copies is a hot key.
    mine = store(held.join(store(one, "originals-of"), "doc_id"), "held-copies")
    theirs = held.select(F.col("doc_id").alias("original"), "hash", F.col("bytes").alias("other_bytes"), F.col("all").alias("other_all"))
    shares = mine.join(theirs, ["original", "hash"]).groupBy("doc_id").agg(
        (F.sum("bytes") / F.min("all")).alias("share"), (F.sum("other_bytes") / F.min("other_all")).alias("other_share")
    )
    return shares.where((F.col("share") >= share) & (F.col("other_share") >= share)).select("doc_id")


def verified(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """(gone_id, gone_body, gone, chunks, chunk_lines): for each id and hash of its text, the numbers of the lines in pieces whose bytes equal the owner's, and how
    many chunks, and lines in chunks, are among these pieces.

    The pieces are cut out within the row, so that only they, not the whole text, are repeated for each of them.
    """
    by_doc = listed.groupBy("doc_id").agg(F.collect_set(F.struct("kind", "at", "lines", "hash", "owner")).alias("listed"))
    held = docs.join(by_doc, "doc_id")

    def cut(x: Column) -> Column:
        # Rows that share an id may hold different texts.
        here = F.filter(
            F.col("listed"),
            lambda p: (p["at"] + p["lines"] <= F.size(x["lines"])) & (hash_of(x["hashes"], p["kind"], p["at"], p["lines"]) == p["hash"]),
        )
        return F.transform(here, lambda p: F.struct(p.alias("p"), F.array_join(spans.part(x["lines"], p["at"], p["at"] + p["lines"] - 1), "\n").alias("piece")))

    both = spans.bound(lines(F.col("text")), lambda x: F.struct(x.alias("lines"), F.transform(x, lambda y: F.xxhash64(y)).alias("hashes")))
    each = held.select("doc_id", F.xxhash64("text").alias("body"), F.explode(spans.bound(both, cut)).alias("one"))
    parts = store(each.select("doc_id", "body", "one.p.*", "one.piece"), "chunk-texts")
    first = parts.where("doc_id = owner").groupBy("hash").agg(F.min("piece").alias("original"))
    equal = parts.where("doc_id <> owner").join(store(first, "originals"), "hash").where("piece = original")
    place = F.struct("at", "lines")
    found = equal.groupBy("doc_id", "body").agg(
        F.collect_set(F.when(F.col("kind") == CHUNK, place)).alias("chunks"), F.collect_set(F.when(F.col("kind") == RUN, place)).alias("runs")
    )
    numbers = F.flatten(F.transform(F.concat("chunks", "runs"), lambda p: F.sequence(p["at"], p["at"] + p["lines"] - 1)))
    return found.select(
        F.col("doc_id").alias("gone_id"),
        F.col("body").alias("gone_body"),
        F.array_distinct(numbers).alias("gone"),
        F.size("chunks").alias("chunks"),
        F.aggregate("chunks", F.lit(0), lambda a, p: a + p["lines"]).alias("chunk_lines"),
    )


def remove_repeated(df: DataFrame, how: Chunking = Chunking(), doc_id: str = "doc_id", text: str = "text", removed: str = "n_removed") -> DataFrame:
    """All rows and columns, ``text`` without chunks and runs that a document with a smaller id holds too, and ``removed``,
    the number of chunks taken out, and of the lines that runs take out besides.

    A null text stays null, an empty one empty; rows without an id, and, if ``copy_share`` says so, copies of whole
    documents, stay as they are; rows that repeat an id are one document, so nothing is removed from one for the other,
    and equal rows are treated alike; an empty table gives an empty table. A text all of whose lines are removed becomes empty. Time and memory follow the length of the
    longest text. A column called as ``removed`` is replaced; columns are found by position, so that others may be
    called as they like.
    """
    docs = pick(df, doc_id=doc_id, text=text)
    plain, at = by_position(df)
    gone = verified(docs, repeated(docs, how))
    same = (F.col(at[doc_id]) == F.col("gone_id")) & (F.xxhash64(F.col(at[text])) == F.col("gone_body"))
    joined = plain.join(gone, same, "left")

    def left(x: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n")

    body = F.col(at[text])
    new = F.when(F.col("gone").isNull() | body.isNull(), body).otherwise(spans.bound(lines(body), left))
    count = F.when(F.col("gone").isNull(), 0).otherwise(F.col("chunks") + F.size("gone") - F.col("chunk_lines"))
    kept = [(f"c{i}", c) for i, c in enumerate(df.columns) if c != removed]
    columns = [new if c == at[text] else F.col(c) for c, _ in kept]
    return joined.select(*columns, count.cast("bigint")).toDF(*[name for _, name in kept], removed)
