"""Jaccard join of word-shingle sets as a metric-space join.

One minus the Jaccard similarity is a metric, so a pair of linked sets (at most ``r`` apart) lies at nearly the
same distance from any third set. Pivots are documents; the region of a pivot holds every document that could
be linked to another one of the region, and its distance to the pivot is computed exactly.

* Candidate regions come from the prefix of a set under one global order of shingles (shingles of rare words
  first): two linked sets are of similar size and share a shingle of both prefixes. Every shingle that several
  documents of a size class share names as its pivot the member with most shared shingles; a document belongs
  to the regions of its shingles' pivots. A linked pair is together in the region of its common shingle.
* In a region, members within ``r`` of the pivot are linked to it and to each other's component. Only members
  beyond ``r`` are open, and they can be linked only to members whose distance to the pivot differs by at most
  ``r`` (triangle inequality); those boundary members stay with them.
* Links found so far are contracted to components. Members of the pivot's component are done with each other, and a
  region of one component is done as a whole; only members of other components are open.
* What is open forms a smaller region without its pivot: a small one is joined pivot after pivot in one task, a large
  one in blocks, every block of open members with every block of the region. One whose blocks would cost too much is
  divided again by Spark, once, with shingles ordered by how many of *its* members have them; what shares a shingle
  with its own component only is left out.

All copies of one set are one node. Sets stay with their documents until a region needs them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_position, map_batches, pick, slices, store, texts
from tidemark.llm.words import hash_words, mixed, shingles, windows

# Words whose frequency is known when shingles are ordered; the order only decides how much work is done.
FREQUENT = 65_536
FREQUENT_IN_BATCH = 8
# A region of at most so many documents and shingles is joined in one task.
LEAF_DOCUMENTS = 2_000
LEAF_SHINGLES = 1_000_000
# A large region whose open members have so many shingles of others to be compared with is divided before it is joined.
DIVIDED = 20_000_000_000
# Regions of up to so many members are thinned by signatures before sets are moved.
PRUNED = 3_000
MIN_BITS = 512
SLACK = 1e-9
# Bits of the filter that keeps texts of other documents where they are, and the key of rows without an id.
BITS = 1 << 25
WORDS = 16
NO_ID = -(2**63)


class Rule(NamedTuple):
    """Shingles of ``words`` words; linked when ``per * intersection >= share * union``."""

    words: int = 5
    share: int = 80
    per: int = 100

    @property
    def radius(self) -> float:
        return 1.0 - self.share / self.per

    def prefix(self, n: int) -> int:
        """How many shingles of a set of ``n`` must hold one of any linked set's."""
        return n + (-n * self.share) // self.per + 1


def frequent_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, weight 1, 2, ... by powers of two of the frequency) of the most frequent words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found, n = np.unique(hash_words(texts(batch))[0], return_counts=True)
                often = n >= FREQUENT_IN_BATCH
                columns = [pa.array(found[often].view(np.int64)), pa.array(n[often].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    sums = docs.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # Stored, because a collected limit sends that many rows of every task to the driver.
    rows = store(sums.orderBy(F.desc("n"), "word").limit(FREQUENT), "frequent").toArrow()
    words, n = rows.column("word").to_numpy().view(np.uint64), rows.column("n").to_pylist()
    least = min(n, default=1).bit_length()
    order = np.argsort(words)
    return words[order], np.array([v.bit_length() - least + 1 for v in n], np.uint64)[order]


def weights(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, weight = frequent
    if not known.size:
        return np.zeros(words.size, np.uint64)
    at = np.minimum(np.searchsorted(known, words), known.size - 1)
    return np.where(known[at] == words, weight[at], np.uint64(0))


def set_hash(members: np.ndarray) -> int:
    """A signed 64-bit hash of a set of shingles."""
    mark = int(np.bitwise_xor.reduce(mixed(members))) ^ (members.size * 0x2545F4914F6CDD1D)
    mark &= 2**64 - 1
    return mark - 2**64 if mark >= 2**63 else mark


def prefix_keys(words: np.ndarray, weight: np.ndarray, rule: Rule) -> tuple[int, int, np.ndarray, bytes]:
    """(set size, hash of the set, keys of the prefix, signature) of one text's words.

    A key is the summed weight of the shingle's words, then its hash: ascending keys are the global order.
    """
    if not words.size:
        return 0, 0, np.zeros(0, np.int64), b""
    n = min(rule.words, words.size)
    heavy = np.convolve(weight.astype(np.int64), np.ones(n, np.int64), "valid")
    hashes = windows(words, n)
    whole = np.unique(hashes)
    keys = np.unique((np.minimum(heavy, 255).astype(np.uint64) << np.uint64(55)) | (hashes >> np.uint64(9)))
    return whole.size, set_hash(whole), keys[: rule.prefix(whole.size)].view(np.int64), signature(whole)


def signature(members: np.ndarray) -> bytes:
    """Parity of the number of members that fall on each bit. Two signatures differ in no more bits than the sets
    differ in members. Twice as many bits as members, a power of two, so folding halves gives a shorter one."""
    bits = max(MIN_BITS, 1 << (2 * members.size - 1).bit_length())
    odd = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(mark: np.ndarray, words: int) -> np.ndarray:
    """A signature (64-bit words) as one of fewer bits."""
    while mark.size > words:
        mark = mark[: mark.size // 2] ^ mark[mark.size // 2 :]
    return mark


def may_be_linked(sizes: np.ndarray, marks: list[bytes], rule: Rule) -> np.ndarray:
    """Which members of a region could be linked to another one, by their sizes and signatures."""
    order = np.argsort(sizes, kind="stable")
    n, views = sizes[order], [np.frombuffer(marks[i], "<u8") for i in order]
    lengths = np.array([v.size for v in views])
    found = np.zeros(len(n), bool)
    length, first, stacked = 0, 0, np.zeros((0, 0), np.uint64)
    for i in range(len(n)):
        high = int(np.searchsorted(n, n[i] * rule.per // rule.share, "right"))
        if high <= i + 1:
            continue
        if lengths[i] != length:
            # Sizes within a factor of two have signatures of this length or the double one.
            length, first = int(lengths[i]), i
            last = int(np.searchsorted(n, 2 * n[lengths == length].max(), "right"))
            stacked = np.stack([folded(v, length) for v in views[first:last]])
        apart = np.bitwise_count(stacked[i + 1 - first : high - first] ^ views[i]).sum(axis=1, dtype=np.int64)
        near = apart * (rule.per + rule.share) <= (rule.per - rule.share) * (n[i + 1 : high] + n[i])
        found[i] |= near.any()
        found[i + 1 : high] |= near
    back = np.zeros(len(n), bool)
    back[order] = found
    return back


def promising(found: DataFrame, described_: DataFrame, rule: Rule) -> DataFrame:
    """(region, pivot, node, n) of regions without the members whose signature rules out every link there.

    Signatures, a thirtieth of the sets, are moved for this instead of the sets.
    """
    marks = described_.where("n > 0").groupBy("node").agg(F.min("signature").alias("signature"))
    joined = found.join(marks, "node").select("region", "pivot", "node", "n", "signature")
    ready = joined.repartition("region").sortWithinPartitions("region")

    def chosen(table: pa.Table) -> pa.RecordBatch:
        region = table.column("region").to_numpy()
        sizes = table.column("n").to_numpy()
        marks_ = table.column("signature").to_pylist()
        starts = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1])))
        keep = np.zeros(len(region), bool)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(region)], strict=True):
            keep[a:b] = may_be_linked(sizes[a:b], marks_[a:b], rule)
        names = ["region", "pivot", "node", "n"]
        rows = table.select(names).filter(pa.array(keep)).combine_chunks()
        return pa.RecordBatch.from_arrays([rows.column(i).combine_chunks() for i in range(4)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            region = held.column("region").to_numpy()
            # The last region may go on in the next batch.
            last = int(np.flatnonzero(region == region[-1])[0]) if len(region) else 0
            if last:
                yield chosen(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield chosen(held)

    return ready.mapInArrow(run, "region bigint, pivot bigint, node bigint, n bigint")


def described(docs: DataFrame, rule: Rule, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per document: ``doc_id``, ``n``, ``node`` (hash of its set), ``keys`` of its prefix, ``signature``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, at = hash_words(texts(batch))
        weight = weights(words, shared.value)
        rows = [
            prefix_keys(words[a:b], weight[a:b], rule) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                pa.array([r[3] for r in rows], pa.binary()),
            ],
            names=["doc_id", "n", "node", "keys", "signature"],
        )

    return map_batches(docs, work, "doc_id bigint, n bigint, node bigint, keys array<bigint>, signature binary")


def bitmap(ids: DataFrame) -> DataFrame:
    """(block, words): a bit for the hash of every ``doc_id``, 64 in a word, ``WORDS`` words in a row, so that the driver
    and the executors hold few rows; ``BITS / 64 / WORDS`` of them at most, however many ids."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    rows = ids.select(bit.alias("bit")).select(
        F.expr(f"bit div {64 * WORDS}").alias("block"),
        F.expr(f"shiftright(bit, 6) % {WORDS}").alias("word"),
        F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits"),
    )
    words = [F.bit_or(F.when(F.col("word") == i, F.col("bits"))).alias(f"w{i}") for i in range(WORDS)]
    sums = rows.groupBy("block").agg(*words)
    return sums.select("block", F.array(*[F.coalesce(f"w{i}", F.lit(0)) for i in range(WORDS)]).alias("words"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, carried: str, rule: Rule) -> DataFrame:
    """(node, members, ``carried`` column) for ``wanted`` (doc_id, node, carried): the sets of these documents only.

    A bitmap of fixed size, broadcast, drops most other documents before texts are moved; the join decides.
    """
    kind = dict(wanted.dtypes)[carried]
    wanted = wanted.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "node", carried)
    bits = F.broadcast(store(bitmap(wanted.select(F.col("key").alias("doc_id"))), "bitmap"))
    keyed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "text").withColumn(
        "bit", F.pmod(F.xxhash64("key"), F.lit(BITS))
    )
    maybe = keyed.withColumn("block", F.expr(f"bit div {64 * WORDS}")).join(bits, "block")
    word = f"get(words, cast(shiftright(bit, 6) % {WORDS} as int))"
    maybe = maybe.where(F.expr(f"{word} & shiftleft(1L, cast(bit & 63 as int)) <> 0")).select("key", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, at = hash_words(texts(batch))
        sets = [shingles(words[a:b], rule.words) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        members = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        named = pa.array([set_hash(s) for s in sets], pa.int64())
        found = pa.RecordBatch.from_arrays([named, members, batch.column(carried)], names=["node", "members", carried])
        # An id whose rows differ in text has several nodes; each row gives its own.
        return found.filter(pa.compute.equal(named, batch.column("node")))

    joined = maybe.join(wanted, "key").select("text", "node", carried)
    return map_batches(joined, work, f"node bigint, members array<bigint>, {carried} {kind}")


def regions(keys: DataFrame, rule: Rule, label: str = "node") -> DataFrame:
    """(region, pivot, node, n) from (region, key, node, n, label): a region for every pivot that a shared key names.

    Keys of one label only, the same component or the same node, are dropped by an aggregate with map-side combining;
    the pivot of a key is the node with most shared keys. Linked sizes differ by a factor of at most ``per / share``, one size class: a node
    stands in its own class and the next, and keys name pivots class by class. No group is ever listed.
    """
    by, two = ["region", "key"], [F.min(label).alias("low"), F.max(label).alias("high")]
    shared = keys.groupBy(*by).agg(*two).where("low <> high")
    # Aggregates are written before they are joined: a join of two plain exchanges lets Spark split hot keys.
    members = keys.join(store(shared.select(*by), "shared"), by).select(*by, *dict.fromkeys(["node", "n", label])).distinct()
    width = math.log(rule.per / rule.share) + 1e-6
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    members = store(members.select("*", F.explode(F.array(own, own + 1)).alias("class")), "members")
    central = members.groupBy("region", "node").agg(F.count("*").alias("links"))
    ranked = members.join(central, ["region", "node"])
    named = (
        ranked.groupBy(*by, "class")
        .agg(F.max(F.struct("links", "node")).alias("best"), *two)
        .where("low <> high")
        .select(*by, "class", F.col("best.node").alias("pivot"))
    )
    found = members.join(store(named, "named"), [*by, "class"]).select("region", "pivot", "node", "n").distinct()
    return found.select(F.xxhash64("region", "pivot").alias("region"), "pivot", "node", "n")


def sized(found: DataFrame) -> DataFrame:
    """(region, count, large) of regions of several members; one task should not join a large one."""
    sizes = found.groupBy("region").agg(F.count("*").alias("count"), F.sum("n").alias("total")).where("count > 1")
    return sizes.select("region", "count", ((F.col("count") > LEAF_DOCUMENTS) | (F.col("total") > LEAF_SHINGLES)).alias("large"))


def distances(found: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(region, pivot, node, n, distance, linked) of every member that is not the pivot itself."""
    own = found.where("node <> pivot").drop("n").join(sets, "node")
    pivots = sets.select(F.col("node").alias("pivot"), F.col("members").alias("centre"))
    both = own.join(pivots, "pivot")
    common = F.size(F.array_intersect("members", "centre")).cast("bigint")
    counted = both.select("region", "pivot", "node", F.size("members").alias("n"), F.size("centre").alias("m"), common.alias("common"))
    union = F.col("n") + F.col("m") - F.col("common")
    return counted.select(
        "region",
        "pivot",
        "node",
        "n",
        (1 - F.col("common") / union).alias("distance"),
        (F.lit(rule.per) * F.col("common") >= F.lit(rule.share) * union).alias("linked"),
    )


def still_open(measured: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """(region, node, n, label, open, count, total, opens, weight) of the members that may be linked to an open one.

    ``label`` is the component by the links so far; open is what is not in the pivot's. The last four tell of the region
    how many members and shingles it has, and how many of its open members.
    """
    own = measured.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    home = labels.select(F.col("node").alias("pivot"), F.col("label").alias("home"))
    named = own.join(home, "pivot", "left").withColumn("open", F.col("label") != F.coalesce("home", "pivot"))
    named = store(named.select("region", "node", "n", "distance", "label", "open"), "labelled")
    opened = named.where("open").groupBy("region").agg(F.min("distance").alias("nearest"), F.max("distance").alias("farthest"))
    reach = F.lit(rule.radius + SLACK)
    within = F.col("distance").between(F.col("nearest") - reach, F.col("farthest") + reach)
    near = named.join(store(opened, "opened"), "region").where(F.col("open") | within)
    near = store(near.select("region", "node", "n", "label", "open"), "open")
    sizes = near.groupBy("region").agg(
        F.count("*").alias("count"),
        F.sum("n").alias("total"),
        F.count_if("open").alias("opens"),
        F.sum(F.when(F.col("open"), F.col("n"))).alias("weight"),
    )
    return near.join(store(sizes.where("count > 1"), "sizes"), "region")


def leaf(nodes: np.ndarray, members: list[np.ndarray], part: np.ndarray, done: np.ndarray, first: int, rule: Rule) -> list[tuple[int, int]]:
    """Links that connect what is linked in one small region and not in one ``part`` yet; pairs of members that are
    ``done`` are left out.

    The first pivot orders the members by their distance to it; every later pivot is compared with the members
    of its window only.
    """
    sizes = np.array([len(m) for m in members])
    codes = np.unique(np.concatenate(members), return_inverse=True)[1]
    at = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.zeros(int(codes.max()) + 1, np.int64)

    def shared_with(i: int, low: int, high: int) -> np.ndarray:
        inside[codes[at[i] : at[i + 1]]] = 1
        common = np.add.reduceat(inside[codes[at[low] : at[high]]], at[low:high] - at[low])
        inside[codes[at[i] : at[i + 1]]] = 0
        return common

    common = shared_with(first, 0, len(nodes))
    distance = 1 - common / (sizes + sizes[first] - common)
    order = np.argsort(distance, kind="stable")
    codes = np.concatenate([codes[at[i] : at[i + 1]] for i in order])
    nodes, sizes, done, distance = nodes[order], sizes[order], done[order], distance[order]
    at = np.concatenate(([0], np.cumsum(sizes)))
    part = np.unique(part, return_inverse=True)[1][order]
    links = []
    for i in range(len(nodes)):
        if done[i]:
            continue
        low = int(np.searchsorted(distance, distance[i] - rule.radius - SLACK))
        high = int(np.searchsorted(distance, distance[i] + rule.radius + SLACK, "right"))
        near = part[low:high]
        if (near == part[i]).all():
            continue
        common = shared_with(i, low, high)
        linked = rule.per * common >= rule.share * (sizes[low:high] + sizes[i] - common)
        for other in np.unique(near[linked & (near != part[i])]):
            j = low + int(np.flatnonzero(linked & (near == other))[0])
            links.append((int(nodes[i]), int(nodes[j])))
            part[part == other] = part[i]
            near = part[low:high]
    return links


def leaf_links(small: DataFrame, rule: Rule) -> DataFrame:
    """Links (node, other) of small regions, from (region, pivot, node, label, members); a region in one task."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        nodes, label = group["node"].to_numpy(), group["label"].to_numpy()
        first = int(np.argmax(nodes == group["pivot"].iloc[0]))
        # Members of the largest component need not be compared with each other.
        names, n = np.unique(label, return_counts=True)
        links = leaf(nodes, group["members"].to_list(), label, label == names[n.argmax()], first, rule)
        return pd.DataFrame(links, columns=["node", "other"], dtype="int64")

    return small.groupBy("region").applyInPandas(join, "node bigint, other bigint")


def block_links(large: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links (node, other) of large regions, from rows of ``still_open``: every block of a region's open members meets
    every block of its members in a task of its own, of at most about as much as a small region holds."""

    def blocks(count: str, total: str):
        return F.greatest(F.ceil(2 * F.col(count) / F.lit(LEAF_DOCUMENTS)), F.ceil(2 * F.col(total) / F.lit(LEAF_SHINGLES)))

    cut = large.withColumn("blocks", blocks("count", "total")).withColumn("turns", blocks("opens", "weight"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("turn", F.pmod(F.xxhash64("node", F.lit(1)), "turns"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1))
    around = cut.withColumn("turn", every).withColumn("done", F.lit(True))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    pivots = cut.where("open").withColumn("block", every).withColumn("done", F.lit(False))
    names = ["region", "turn", "block", "node", "label", "done"]
    placed = around.select(*names).unionByName(pivots.select(*names)).join(sets, "node")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        done = group["done"].to_numpy()
        links = []
        if not done.all():
            links = leaf(group["node"].to_numpy(), group["members"].to_list(), group["label"].to_numpy(), done, 0, rule)
        return pd.DataFrame(links, columns=["node", "other"], dtype="int64")

    return placed.groupBy("region", "turn", "block").applyInPandas(join, "node bigint, other bigint")


def local_keys(near: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(region, key, node, n, label) of the prefixes of regions, shingles of few members of the region first."""
    names = ["region", "node", "n", "label"]
    every = near.select(*names).join(sets, "node").select(*names, F.explode("members").alias("key"))
    often = every.groupBy("region", "key").agg(F.count("*").alias("often"))
    ordered = every.join(store(often, "often"), ["region", "key"]).groupBy(*names).agg(
        F.sort_array(F.collect_list(F.struct("often", "key"))).alias("all")
    )
    length = (F.col("n") - F.ceil(F.col("n") * F.lit(rule.share) / F.lit(rule.per)) + 1).cast("int")
    return ordered.select(*names, F.explode(F.slice("all", F.lit(1), length)).alias("one")).select(
        "region", "one.key", "node", "n", "label"
    )


def links(described_: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links (node, other) whose components are those of all linked pairs of sets."""
    first = described_.where("n > 0").select(
        F.lit(0).cast("bigint").alias("region"), F.explode("keys").alias("key"), "node", "n"
    )
    found = store(regions(first, rule), "regions")
    found = found.join(store(sized(found), "sizes"), "region")
    thin = promising(found.where(F.col("count") <= PRUNED), described_, rule)
    found = store(thin.unionByName(found.where(F.col("count") > PRUNED).select(*thin.columns)), "promising")
    found = found.join(store(sized(found), "sizes"), "region")
    # A pivot measures distances in its region also where its own signature has ruled it out.
    nodes = store(found.select("node").unionByName(found.select(F.col("pivot").alias("node"))).distinct(), "nodes")
    ids = described_.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    # Small regions are joined as they are; each document's text is read once for all its regions.
    homes = found.where("not large").groupBy("node").agg(F.collect_list(F.struct("region", "pivot")).alias("homes"))
    placed = shingle_sets(docs, ids.join(homes, "node"), "homes", rule)
    placed = placed.select("node", "members", F.explode("homes").alias("home")).select(
        "home.region", "home.pivot", "node", F.col("node").alias("label"), "members"
    )
    parts = [store(leaf_links(placed, rule), "leaf")]
    found = found.where("large")
    if not found.isEmpty():
        named = found.select("node").unionByName(found.select(F.col("pivot").alias("node"))).distinct()
        wanted = ids.join(named, "node").withColumn("any", F.lit(True))
        sets = store(shingle_sets(docs, wanted, "any", rule).select("node", "members"), "sets").dropDuplicates(["node"])
    small = (F.col("count") <= LEAF_DOCUMENTS) & (F.col("total") <= LEAF_SHINGLES)
    for turn in range(2):
        if found.isEmpty():
            break
        measured = store(distances(found, sets, rule), "distances")
        parts.append(measured.where("linked").select("node", F.col("pivot").alias("other")))
        near = store(still_open(measured, components(reduce(DataFrame.unionByName, parts)), rule), "near")
        heavy = ~small & (F.col("opens").cast("double") * F.col("total") > DIVIDED) if turn == 0 else F.lit(False)
        few = near.where(small).join(sets, "node").withColumn("pivot", F.col("node"))
        parts.append(store(leaf_links(few.select("region", "pivot", "node", "label", "members"), rule), "leaf"))
        parts.append(store(block_links(near.where(~small & ~heavy), sets, rule), "blocks"))
        if turn == 0:
            near = near.where(heavy)
            found = near if near.isEmpty() else store(regions(local_keys(near, sets, rule), rule, "label"), "regions")
    return reduce(DataFrame.unionByName, parts)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for every node of an edge (node, other).

    Each round takes the smallest label around a node and then the label of that label, so chains of labels
    halve; rounds are written to the shared folder.
    """
    both = store(edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = store(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        nearer = store(nearer, "labels")
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = store(
            nearer.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels"
        )
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def near_duplicates(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` (smallest ``doc_id`` that links reach).

    A null or empty text, or one of white space only, has an empty set and is linked with nothing; a text of
    fewer words than a shingle is one shingle. Equal sets are always linked; repeated rows come out repeated. A
    row without a ``doc_id`` takes part, and its component is the smallest id there is, if any. An empty table
    gives an empty table; other columns are ignored. Hashes have 64 bits.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    every = store(described(docs, rule, frequent_words(docs)), "described")
    labels = components(links(every, docs, rule))
    classes = every.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    named = classes.join(store(smallest, "smallest"), "label").select("node", "component_id")
    full = every.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = every.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(alone)


def keep_one(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the document with the smallest id of each component; all columns stay.

    Rows with an empty set, a null or empty text, stay. Of rows that repeat an id one stays, rows without an id stay. An
    empty table gives an empty table; columns are found by position, so others may be called as they like.
    """
    found = near_duplicates(df, rule, doc_id, text)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    plain, at = by_position(df)
    key = at[doc_id]
    one = plain.join(kept, F.col(key) == F.col("kept_id"), "left_semi").dropDuplicates([key])
    return plain.where(F.col(key).isNull()).unionByName(one).toDF(*df.columns)
