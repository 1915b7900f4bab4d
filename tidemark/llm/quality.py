"""A quality classifier without hand-made labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation estimates, for a
good and for a bad document, how often each labeller gives each vote, and from that the posterior of every
vote pattern; it sees the patterns of all documents and how often each occurs. A linear scorer over hashed
features then learns the posteriors from a bounded sample, and scores (and rejects) all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linear
from tidemark.llm.common import by_position, map_batches, pick, store, texts

GOOD, BAD, NONE = 1, 0, 2
# Documents the scorer learns from, taken in the order of a hash of their id.
SAMPLE = 12_000
FEATURES = 1 << 12
THRESHOLD = 0.5
# Words whose shapes one task remembers before it starts afresh, some 50 MB.
REMEMBERED = 200_000

# Frequent words of the languages.
FUNCTION_WORDS = frozenset(
    """the of and to in a is that it for on was be as with by this are at from or an
    de la le et les des un une en que dans pour qui sur pas est au du par avec
    der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch
    el los las y del se por con para una su al lo como más no""".split()
)
RUN = re.compile(r"(.)\1+", re.DOTALL)
LETTERS = {c: "X" if chr(c).isupper() else "x" for c in range(0x250) if chr(c).isupper() or chr(c).islower()}
CLASSES = LETTERS | {c: "9" for c in range(ord("0"), ord("9") + 1)}


def shape(word: str) -> str:
    """Runs of capitals, small letters, digits and equal marks as one character each."""
    return RUN.sub(r"\1", word.translate(CLASSES))


class Shapes(dict):
    """Shapes of words seen before, and whether they are function words."""

    def __missing__(self, word: str) -> tuple[str, bool]:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = (shape(word), word.strip(".,;:!?").lower() in FUNCTION_WORDS)
        return found


class Facts:
    """What the labellers and the features look at."""

    def __init__(self, text: str, shapes: Shapes):
        words = text.split()
        n = self.n = len(words)
        counts = Counter(words)
        self.shapes: dict[str, int] = {}
        function = 0
        for word, times in counts.items():
            form, frequent = shapes[word]
            self.shapes[form] = self.shapes.get(form, 0) + times
            if frequent:
                function += times
        share = lambda total: total / n if n else 0.0
        self.stutter = share(sum(map(eq, words, words[1:])))
        self.distinct = len(counts) / min(n, 200) if n else 0.0
        self.top = share(max(counts.values(), default=0))
        self.function = share(function)
        marks = {s: sum(c in "!#$%&*|<>{}[]=~^\\/_+@" for c in s) for s in self.shapes}
        self.marked = share(sum(t for s, t in self.shapes.items() if marks[s]))
        self.bare = share(sum(t for s, t in self.shapes.items() if not any(c in "Xx9" or c.isalnum() for c in s)))
        self.capital = share(sum(t for s, t in self.shapes.items() if s.startswith("X") and "x" not in s))
        self.ends = share(sum(t for s, t in self.shapes.items() if s[-1:] in ".?" and len(s) > 1))
        self.length = len(text) / n if n else 0.0


def between(low: float, high: float, value: float) -> int:
    """Bad from ``high`` on, good up to ``low``, no vote between."""
    return BAD if value >= high else GOOD if value <= low else NONE


# Name and vote of every labeller. Texts of few words get votes only from those that make sense for them.
LABELLERS: dict[str, Callable[[Facts], int]] = {
    "empty": lambda f: BAD if f.n < 3 else NONE,
    "marks": lambda f: between(0.04, 0.15, f.marked),
    "bare": lambda f: between(0.02, 0.12, f.bare),
    "capitals": lambda f: between(0.12, 0.35, f.capital) if f.n >= 5 else NONE,
    "stutter": lambda f: between(0.03, 0.1, f.stutter) if f.n >= 5 else NONE,
    "repeats": lambda f: between(0.12, 0.25, f.top) if f.n >= 20 else NONE,
    "variety": lambda f: (BAD if f.distinct < 0.2 else GOOD if f.distinct > 0.4 else NONE) if f.n >= 20 else NONE,
    "function": lambda f: (BAD if f.function < 0.04 else GOOD if f.function > 0.12 else NONE) if f.n >= 20 else NONE,
    "sentences": lambda f: (BAD if f.ends < 0.01 else GOOD if 0.03 < f.ends < 0.5 else NONE) if f.n >= 30 else NONE,
    "length": lambda f: (BAD if f.length > 25 else GOOD if 3 < f.length < 12 else NONE) if f.n >= 5 else NONE,
}


def votes(facts: Facts) -> str:
    """One digit a labeller."""
    return "".join(str(vote(facts)) for vote in LABELLERS.values())


def posteriors(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Probability of good for every vote pattern, by expectation-maximisation.

    A labeller that gives no vote says nothing about the document. Starts from the share of good among the votes
    given. At most 3 to the power of the number of labellers
    patterns exist, whatever the number of documents.
    """
    names = sorted(patterns)
    if not names:
        return {}
    n = np.array([patterns[p] for p in names], float)
    table = np.array([[int(c) for c in p] for p in names])
    good, bad = (table == GOOD).sum(axis=1), (table == BAD).sum(axis=1)
    belief = (good + 0.5) / (good + bad + 1.0)
    belief = np.clip(belief, 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([n * (1 - belief), n * belief])
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        log = np.log(prior)[:, None] + np.zeros((2, len(names)))
        for j in range(table.shape[1]):
            rate = np.stack([np.bincount(table[:, j], w, 3)[:2] for w in weight]) + 1.0
            rate /= rate.sum(axis=1, keepdims=True)
            log += np.pad(np.log(rate), ((0, 0), (0, 1)))[:, table[:, j]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - belief).max() < 1e-9:
            break
        belief = new
    # The class that agrees with the good votes is the good one.
    if (n * belief) @ (good - bad) / (n @ belief) < (n * (1 - belief)) @ (good - bad) / max(n @ (1 - belief), 1e-300):
        belief = 1 - belief
    return dict(zip(names, belief.tolist(), strict=True))


def features(facts: Facts) -> tuple[list[int], list[float]]:
    """Hashed shares of word shapes and steps of the facts."""
    merged: dict[int, float] = {}

    def add(name: str, value: float) -> None:
        at = linear.hashed(name, FEATURES)
        merged[at] = merged.get(at, 0.0) + value

    for s, times in facts.shapes.items():
        add(f"shape/{s}", (times / facts.n) ** 0.5)
    for name in ("stutter", "distinct", "top", "function", "marked", "bare", "capital", "ends"):
        add(f"{name}/{min(int(getattr(facts, name) * 20), 20)}", 0.5)
    add(f"n/{min(facts.n, 1000).bit_length()}", 0.5)
    add(f"length/{min(int(facts.length), 40)}", 0.5)
    return list(merged), list(merged.values())


def vote_table(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``votes``."""
    shapes: list[Shapes] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not shapes:
            shapes.append(Shapes())
        found = [votes(Facts(t, shapes[0])) for t in texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "votes"])

    return map_batches(docs, work, "doc_id bigint, votes string")


def learn(docs: DataFrame, voted: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """(posterior of every pattern, weights of the scorer).

    Patterns are counted over all documents. The scorer learns from ``SAMPLE`` documents, whose ids are
    broadcast and whose features reach the driver; both are bounded by that number. An id in many rows is one
    document, with the text of the smallest hash, that weighs as much as its rows.
    """
    patterns = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    belief = posteriors(patterns)
    ids = voted.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    shapes: list[Shapes] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not shapes:
            shapes.append(Shapes())
        facts = [Facts(t, shapes[0]) for t in texts(batch)]
        rows = [features(f) for f in facts]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("n"),
                pa.array([votes(f) for f in facts], pa.string()),
                pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                pa.array([r[1] for r in rows], pa.list_(pa.float32())),
            ],
            names=["n", "votes", "places", "amounts"],
        )

    rows_of = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id")
    chosen = rows_of.agg(F.count("*").alias("n"), F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    made = map_batches(chosen.select("n", "text"), work, "n bigint, votes string, places array<int>, amounts array<float>")
    rows = made.collect()
    rows.sort(key=lambda r: (r.votes, r.places, r.amounts))
    # Votes of rows that share an id may differ from those of its text here; patterns of no row say nothing.
    targets, weights = np.array([belief.get(r.votes, 0.5) for r in rows]), np.array([float(r.n) for r in rows])
    return belief, linear.fit([r.places for r in rows], [r.amounts for r in rows], targets, FEATURES, weights)


class Scorer:
    """Scores of texts, in one Python worker; a text without words scores 0."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.shapes = weights, Shapes()

    def score(self, facts: Facts) -> float:
        return linear.score(self.weights, *features(facts)) if facts.n else 0.0

    def __call__(self, text: str) -> float:
        return self.score(Facts(text, self.shapes))


def classify(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``votes`` (a digit a labeller: 1 good, 0 bad, 2 none), ``posterior``, ``score``
    (0 to 1, higher is better), ``kept`` (score of ``THRESHOLD`` or more).

    A null text counts as empty, is voted bad and scores 0. Repeated rows come out repeated; an empty table gives an empty table;
    other columns are ignored.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    belief, weights = learn(docs, store(vote_table(docs), "votes"))
    shared = df.sparkSession.sparkContext.broadcast((belief, weights))
    made: list[Scorer] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Scorer(shared.value[1]))
        facts = [Facts(t, made[0].shapes) for t in texts(batch)]
        patterns = [votes(f) for f in facts]
        scores = [made[0].score(f) for f in facts]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(patterns, pa.string()),
                pa.array([shared.value[0].get(p) for p in patterns], pa.float64()),
                pa.array(scores, pa.float64()),
                pa.array([s >= THRESHOLD for s in scores], pa.bool_()),
            ],
            names=["doc_id", "votes", "posterior", "score", "kept"],
        )

    return map_batches(docs, work, "doc_id bigint, votes string, posterior double, score double, kept boolean")


def keep_good(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all columns, that ``classify`` keeps.

    Null and empty texts go; repeated rows are treated alike; an empty table gives an empty table; columns are found by
    position, so others may be called as they like.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    _, weights = learn(docs, store(vote_table(docs), "votes"))
    shared = df.sparkSession.sparkContext.broadcast(weights)
    made: list[Scorer] = []
    plain, at = by_position(df)
    body = at[text]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Scorer(shared.value))
        return batch.filter(pa.array([made[0](t) >= THRESHOLD for t in texts(batch, body)], pa.bool_()))

    return map_batches(plain, work, plain.schema, body).toDF(*df.columns)
