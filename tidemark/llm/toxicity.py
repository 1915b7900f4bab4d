"""Toxic terms, also misspelled, judged in their context.

A lexicon of words and word beginnings is learned from labelled documents. It becomes a trie, and the trie
is intersected with a Levenshtein automaton: a state is the set of (trie node, edits so far) that a word's
characters can reach, and states are made when first needed. A word is read once, most words reach the
empty state after a few characters. The words around a match tell quotation from abuse. A linear scorer
weighs the matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linear
from tidemark.llm.common import map_batches, pick, slices, texts

WORD = re.compile(r"[^\W\d_]+")
# Marks and words that report or quote speech, and words of address.
QUOTES = "\"'“”„«»‘’`"
REPORTING = frozenset("said says wrote called quote quoted word words term reported cites cited".split())
ADDRESS = frozenset("you your yours you're tu te vous votre tus usted du dich dein ihr sie".split())
WINDOW = 4

PREFIXES = (4, 5, 6, 7, 8)
# Bounds of what is learned from: labelled rows taken, in the order of a hash of their id, of either label.
TOXIC_ROWS = 8_192
CLEAN_ROWS = 32_768
# Different words that stand before a term, and the share of the most frequent one: a term of copied passages
# stands in the same few contexts again and again.
CONTEXTS = 8
SAME_CONTEXT = 0.2
EVIDENCE = 25.0
FEATURES = 1 << 14
THRESHOLD = 0.3
BEGINNING = "*"
# Terms whose counts one task holds before it passes them on.
HELD = 200_000


def allowed_edits(term: str) -> int:
    """Edits in which a word may differ from a term; a word beginning must be exact."""
    return 0 if term.endswith(BEGINNING) or len(term) < 5 else 1 if len(term) < 10 else 2


class Automaton:
    """A Levenshtein automaton over the whole lexicon, made deterministic state by state."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.begins: list[str | None] = [None]
        self.most: list[int] = [0]
        for term in terms:
            bare, node, edits = term.removesuffix(BEGINNING), 0, allowed_edits(term)
            self.most[0] = max(self.most[0], edits)
            for c in bare:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.begins.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            if term.endswith(BEGINNING):
                self.begins[node] = term
            else:
                self.ends[node] = term
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.seen: list[tuple[str, int] | None] = []
        self.empty = self.number(frozenset())
        self.start = self.number(self.closed({(0, 0)}))

    def closed(self, state: set[tuple[int, int]]) -> frozenset:
        """Also the nodes reached by leaving out characters of a term; the fewest edits of each node."""
        least: dict[int, int] = {}
        todo = list(state)
        while todo:
            node, edits = todo.pop()
            if edits > self.most[node] or least.get(node, 99) <= edits:
                continue
            least[node] = edits
            todo += [(child, edits + 1) for child in self.children[node].values()]
        return frozenset(least.items())

    def number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            ends = [(e, self.ends[n]) for n, e in state if self.ends[n] and e <= allowed_edits(self.ends[n])]
            begun = [(len(self.begins[n]), self.begins[n]) for n, e in state if self.begins[n] and e == 0]
            self.accepts.append((min(ends)[1], min(ends)[0]) if ends else None)
            self.seen.append((max(begun)[1], 0) if begun else None)
        return self.numbers[state]

    def step(self, at: int, c: str) -> int:
        """The state after one more character."""
        after: set[tuple[int, int]] = set()
        for node, edits in self.states[at]:
            if c in self.children[node]:
                after.add((self.children[node][c], edits))
            if edits < self.most[node]:
                after.add((node, edits + 1))
                after.update((child, edits + 1) for child in self.children[node].values())
        found = self.moves[at][c] = self.number(self.closed(after))
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits): the nearest whole term, else the longest word beginning, else nothing."""
        at, empty, moves, seen, begun = self.start, self.empty, self.moves, self.seen, None
        for c in word:
            following = moves[at].get(c)
            at = self.step(at, c) if following is None else following
            if at == empty:
                return begun
            begun = seen[at] or begun
        return self.accepts[at] or begun


class Matcher(dict):
    """Matches of words, kept for words seen before."""

    def __init__(self, terms: list[str]):
        super().__init__()
        self.automaton = Automaton(terms)

    def __missing__(self, word: str) -> tuple[str, int] | None:
        if len(self) > 300_000:
            self.clear()
        if len(self.automaton.states) > 20_000:
            self.automaton = Automaton([t for t in (*self.automaton.ends, *self.automaton.begins) if t])
        found = self[word] = self.automaton.match(word)
        return found


def context(text: str, words: list[re.Match], i: int) -> str:
    """How a match stands: quoted, reported, addressed to somebody, or plain."""
    here = words[i]
    if text[here.start() - 1 : here.start()] in QUOTES and here.start() and text[here.end() : here.end() + 1] in QUOTES:
        return "quoted"
    near = {w[0] for w in words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]}
    if near & REPORTING:
        return "reported"
    return "addressed" if near & ADDRESS else "plain"


def matches(text: str, matcher: Matcher) -> list[tuple[int, int, str, int, str]]:
    """(start, end, term, edits, context) of every match; code points of the lower-cased text."""
    lowered = text.lower()
    if not any(matcher[w] for w in set(WORD.findall(lowered))):
        return []
    words = list(WORD.finditer(lowered))
    return [
        (w.start(), w.end(), *matcher[w[0]], context(lowered, words, i)) for i, w in enumerate(words) if matcher[w[0]]
    ]


def features(found: list[tuple[int, int, str, int, str]]) -> tuple[list[int], list[float]]:
    """Hashed features of the matches: each term with its edits and context, and how many there are."""
    counts: dict[str, int] = {}
    for _, _, term, edits, where in found:
        kind = "begin" if term.endswith(BEGINNING) else "word"
        for name in (f"{term}/{edits}", f"{kind}/{edits}/{where}", f"any/{where}"):
            counts[name] = counts.get(name, 0) + 1
    if found:
        different = len({m[2] for m in found})
        counts[f"different/{min(different, 5)}"] = 1
        counts[f"matches/{min(len(found), 8)}"] = 1
    merged: dict[int, float] = {}
    for name, n in counts.items():
        at = linear.hashed(name, FEATURES)
        merged[at] = merged.get(at, 0.0) + math.log1p(n)
    return list(merged), list(merged.values())


def sample(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """At most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled ids with their weight, so that the weights have the
    proportion of the labels. A document with several labels counts as toxic if one says so."""
    known = pick(labels, doc_id=doc_id, label=label).where("doc_id is not null and label is not null")
    once = known.groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    total = {r.label: r.n for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = []
    for value, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        part = once.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        weight = max(1.0, total.get(value, 0) / most)
        parts.append(part.withColumn("weight", F.lit(weight)))
    return parts[0].unionByName(parts[1])


def terms_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(word[:n] + BEGINNING for n in PREFIXES if len(word) > n)]


def freely_used(toxic: DataFrame, candidates: list[str]) -> set[str]:
    """The candidates that stand behind many different words, none of which prevails."""
    wanted = frozenset(candidates)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                seen: list[tuple[str, str]] = []
                for text in texts(batch):
                    words = WORD.findall(text.lower())
                    seen += {(t, before) for before, word in zip(["", *words], words, strict=False) for t in terms_of(word) if t in wanted}
                columns = [pa.array([t for t, _ in seen], pa.string()), pa.array([b for _, b in seen], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "before"])

    counted = toxic.mapInArrow(pairs, "term string, before string").groupBy("term", "before").agg(F.count("*").alias("n"))
    judged = counted.groupBy("term").agg(F.count("*").alias("different"), F.sum("n").alias("all"), F.max("n").alias("most"))
    free = (F.col("different") >= CONTEXTS) & (F.col("most") <= SAME_CONTEXT * F.col("all"))
    return {r.term for r in judged.where(free).collect()}


def lexicon(examples: DataFrame) -> list[str]:
    """Words, and beginnings of longer words, that toxic documents hold far more often, by the log-likelihood ratio.

    ``examples`` (text, label) is bounded by ``sample``; terms are counted once a document, in Spark, and all with enough
    evidence reach the driver: such a term stands in several of the toxic documents, so their words bound the
    number. Of these stay the ones that stand in different contexts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held)), *(pa.array([n[i] for n in held.values()], pa.int64()) for i in (0, 1))]
            return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for text, label in zip(texts(batch), batch.column("label").to_pylist(), strict=True):
                    words = set(WORD.findall(text.lower()))
                    terms = {t for w in words for t in terms_of(w)}
                    for term in terms:
                        held.setdefault(term, [0, 0])[label] += 1
                    if len(held) > HELD:
                        yield out()
                        held = {}
        yield out()

    size = {r.label: r.n for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = float(size.get(0, 0)), float(size.get(1, 0))
    if not clean or not toxic:
        return []
    sums = examples.mapInArrow(count, "term string, clean bigint, toxic bigint").groupBy("term").agg(
        F.sum("clean").alias("a"), F.sum("toxic").alias("b")
    )
    whole = F.col("a") + F.col("b")

    def gain(n: str, rate: float):
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (whole * rate))).otherwise(0.0)

    rated = sums.where((F.col("b") >= 5) & (F.col("b") / toxic > 4 * F.col("a") / clean)).withColumn(
        "evidence", 2 * (gain("a", clean / (clean + toxic)) + gain("b", toxic / (clean + toxic)))
    )
    best = rated.where(F.col("evidence") >= EVIDENCE).select("term", "evidence", "a", "b")
    strongest = sorted(best.collect(), key=lambda r: (-r.evidence, r.term))
    found = {r.term: (r.evidence, r.a, r.b) for r in strongest}
    free = freely_used(examples.where("label = 1"), list(found))
    found = {t: f for t, f in found.items() if t in free}
    # The shortest beginning that clean documents hardly use stands for all that begin with it, unless one word
    # makes up most of it: that word is kept instead, as only whole words may be misspelled.
    kept: list[str] = []
    for n in PREFIXES:
        for term, (evidence, a, b) in found.items():
            bare = term.removesuffix(BEGINNING)
            if not term.endswith(BEGINNING) or len(bare) != n or any(bare.startswith(k[:-1]) for k in kept):
                continue
            leading = max((e for w, (e, *_) in found.items() if not w.endswith(BEGINNING) and w.startswith(bare)), default=0.0)
            if leading < 0.7 * evidence and a / clean <= 0.1 * b / toxic:
                kept.append(term)
    kept += [w for w in found if not w.endswith(BEGINNING) and not any(w.startswith(k[:-1]) for k in kept)]
    return sorted(kept)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """(lexicon, weights) from documents (doc_id, text) and labels (doc_id, toxic).

    The labelled rows used are bounded by ``TOXIC_ROWS`` and ``CLEAN_ROWS``, so their ids are broadcast.
    """
    chosen = F.broadcast(sample(labels))
    examples = docs.join(chosen, "doc_id").select("text", "label", "weight")
    terms = lexicon(examples)
    matcher: list[Matcher] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not matcher:
            matcher.append(Matcher(terms))
        rows = [features(matches(t, matcher[0])) for t in texts(batch)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                batch.column("weight"),
                pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                pa.array([r[1] for r in rows], pa.list_(pa.float64())),
            ],
            names=["label", "weight", "places", "amounts"],
        )

    seen = map_batches(examples, work, "label int, weight double, places array<bigint>, amounts array<double>")
    # Equal feature rows are added up before they reach the driver: most documents have none at all.
    rows = seen.groupBy("label", "places", "amounts").agg(F.sum("weight").alias("weight")).collect()
    rows.sort(key=lambda r: (r.label, r.places, r.amounts))
    weights = linear.fit(
        [r.places for r in rows],
        [r.amounts for r in rows],
        np.array([float(r.label) for r in rows]),
        FEATURES,
        np.array([r.weight for r in rows]),
    )
    return terms, weights


def score(
    df: DataFrame, terms: list[str], weights: np.ndarray, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD`` on), ``n_matches``,
    ``spans`` (start:end:term:edits:context, comma-joined; code points of the lower-cased text).

    A null or empty text has no match and scores as a document without one. Rows are independent; an empty
    table gives an empty table; other columns are ignored. Map only.
    """
    shared = df.sparkSession.sparkContext.broadcast((terms, weights))
    matcher: list[Matcher] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not matcher:
            matcher.append(Matcher(shared.value[0]))
        spans = [matches(t, matcher[0]) for t in texts(batch)]
        scores = [linear.score(shared.value[1], *features(s)) for s in spans]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(scores, pa.float64()),
                pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array([",".join(":".join(map(str, m)) for m in s) for s in spans], pa.string()),
            ],
            names=["doc_id", "score", "predicted", "n_matches", "spans"],
        )

    found = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return map_batches(found, work, "doc_id bigint, score double, predicted int, n_matches bigint, spans string")
