"""Main text of web pages by a tree-structured graphical model.

A page's block elements and runs of text are the nodes of a tree, each with a hidden label: main text or not. A node's
own features give its potential, a table gives the potential between a parent's label and a child's. Messages go up
the tree and down again (sum-product, exact on a tree); runs of text whose marginal reaches a half are the main text.
Both potentials are learned from labelled pages: those with one ``article`` or ``main`` element say themselves where
their text is. Each is learned from as it stands, and in two arrangements of its parts that have no such element.
"""

from __future__ import annotations

import html
import random
import zlib
from collections import Counter
from collections.abc import Iterator
from math import exp, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import html_tree, linear
from tidemark.llm.common import map_batches, pick, texts
from tidemark.llm.html_tree import Node

# Different pages that are learned from; their features are counted in Spark, not collected.
SAMPLE = 2_000
# Weight of all examples together against the ridge of 1, and what is added to every count of a pair of labels.
WEIGHT, PRIOR = 20_000.0, 0.5
KINDS = ["text", *html_tree.GROUPS]
HINTS = ["", "content", "other"]
LENGTHS, SHARES, STOPS = 14, 5, 5
WIDTHS = (len(KINDS), len(KINDS), len(HINTS), len(HINTS), LENGTHS, SHARES, STOPS, len(KINDS) * SHARES)
PLACES = np.concatenate([[0], np.cumsum(WIDTHS)[:-1]]).tolist()
SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, marginals array<double>"


class Model(NamedTuple):
    """Weights of the features, and for each kind and hint of a child: P(child's label | parent's) over P(child's label)."""

    weights: np.ndarray
    pairs: dict[str, tuple[float, float, float, float]]


# ---- features


def features(nodes: list[Node]) -> list[tuple[int, ...]]:
    """Kind and hint of each node and its parent, and from the text below it: length, share of links, ends of sentences."""
    n = len(nodes)
    size, linked, stops = [0] * n, [0] * n, [0] * n
    for i, node in enumerate(nodes):
        if node.text is not None:
            t = node.text
            size[i], linked[i] = len(t), node.linked
            stops[i] = t.count(". ") + t.count("! ") + t.count("? ") + (t[-1] in ".!?")
    for i in range(n - 1, 0, -1):
        parent = nodes[i].parent
        size[parent] += size[i]
        linked[parent] += linked[i]
        stops[parent] += stops[i]
    found = []
    for i, node in enumerate(nodes):
        above = nodes[max(node.parent, 0)]
        kind = KINDS.index(node.kind)
        share = min(int(4 * linked[i] / size[i] + 0.5), SHARES - 1) if size[i] else 0
        length = min(size[i].bit_length(), LENGTHS - 1)
        found.append(
            (kind, KINDS.index(above.kind), HINTS.index(node.hint), HINTS.index(above.hint), length, share, min(stops[i].bit_length(), STOPS - 1), kind * SHARES + share)
        )
    return found


def group(node: Node) -> str:
    return f"{node.kind}/{node.hint}"


# ---- labelled pages


def labels(nodes: list[Node]) -> list[int] | None:
    """1 for the nodes of the main text, 0 for others, None for a page that does not say where it is.

    ``data-main`` counts if there is one; else the page's only ``article``, or else only ``main``, without the
    menus, asides, forms, footers and parts named as such in it.
    """
    given = any(n.given is not None for n in nodes)
    roots: set[int] = set()
    if not given:
        for kind in ("article", "main"):
            found = [i for i, n in enumerate(nodes) if n.kind == kind]
            if len(found) == 1:
                roots = set(found)
                break
        else:
            return None
    made = [0] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        if given:
            made[i] = int(n.given == "1") if n.given is not None else made[n.parent]
        else:
            out = n.kind in ("menu", "aside", "form", "footer") or n.hint == "other"
            made[i] = int(i in roots or (made[n.parent] == 1 and not out))
    return made


def arranged(blocks: list[str], notes: list[str], menu: list[str], rng: random.Random) -> str:
    """A page of these parts without any element for its main text; ``data-main`` says where it is."""
    line = lambda: html.escape(rng.choice(notes))
    name = lambda *words: f' {rng.choice(("class", "id"))}="{rng.choice(words)}"' if rng.random() < 0.7 else ""
    links = lambda: "".join(f'<li><a href="#">{html.escape(rng.choice(menu))}</a></li>' for _ in range(rng.randint(2, 8)))
    some = lambda part, share=0.5: part() if rng.random() < share else ""
    tag = lambda *tags: rng.choice(tags)

    def part(outer: str, words: tuple[str, ...], inner: str, label: int = 0) -> str:
        return f'<{outer}{name(*words)} data-main="{label}">{inner}</{outer}>'

    def short(*words: str, outer: str = "div", most: int = 2) -> str:
        return part(outer, words, "".join(f"<p>{line()}</p>" for _ in range(rng.randint(1, most))))

    def block(text: str) -> str:
        kind = tag("p", "p", "p", "p", "div", "h2", "li", "blockquote")
        return f"<ul><li>{text}</li></ul>" if kind == "li" else f"<{kind}>{text}</{kind}>"

    def inside() -> str:
        return rng.choice((
            lambda: short("ad", "promo", outer="aside"), lambda: part("form", ("newsletter",), f"<label>{line()}</label><input>"),
            lambda: short("share", "related"), lambda: part("nav", ("breadcrumb",), f"<ul>{links()}</ul>"),
            lambda: short("notice", "cookie-notice"),
        ))()

    body = [block(html.escape(b)) for b in blocks[1:]]
    body.insert(rng.randint(0, len(body)), some(inside))
    inner = f"<h1>{html.escape(blocks[0])}</h1>" + "".join(body)
    wrap = tag("div", "div", "section", "main", "article")
    text = part(wrap, ("content", "post-body", "entry", "story", "box"), inner, 1)
    comment = lambda: part("div", ("comment", "reply"), f"<p>{line()} {line()}</p><p>{line()}</p>")
    discussion = lambda: part(tag("div", "section"), ("comments", "replies", "respond"), "".join(comment() for _ in range(rng.randint(1, 5))))
    side = lambda: part(tag("aside", "div"), ("sidebar", "widget"), f"<h3>{line()}</h3><ul>{links()}</ul><p>{line()}</p>")
    return "".join((
        "<html><body>",
        some(lambda: part(tag("header", "div"), ("header", "masthead"), f"<p>{line()}</p>")),
        some(lambda: part(tag("nav", "div"), ("menu", "navbar"), f"<ul>{links()}</ul>"), 0.9),
        some(lambda: short("cookie", "notice", "banner")),
        some(lambda: short("ad", "ads", "sponsored")),
        some(side),
        text,
        some(discussion),
        some(lambda: part("form", ("search", "login", "subscribe"), f"<p>{line()}</p><label>{line()}</label>")),
        some(side),
        some(lambda: part(tag("footer", "div"), ("footer", "copyright"), f"<p>&copy; {line()}</p>"), 0.9),
        "</body></html>",
    ))


def lessons(page: str) -> Iterator[tuple[list[Node], list[int]]]:
    """A labelled page as it stands and rearranged twice; nothing for a page without labels."""
    nodes = html_tree.read(page)
    made = labels(nodes)
    if made is None:
        return
    yield nodes, made
    blocks = [n.text for n, label in zip(nodes, made, strict=True) if label and n.text]
    other = [n for n, label in zip(nodes, made, strict=True) if not label and n.text]
    notes, menu = [n.text for n in other if not n.linked], [n.text for n in other if n.linked]
    if blocks:
        rng = random.Random(zlib.crc32(page.encode("utf-8", "replace")))
        for _ in range(2):
            again = html_tree.read(arranged(blocks, notes or ["Notice."], menu or ["Home"], rng))
            yield again, labels(again)


def plain_pages() -> list[str]:
    """A few arrangements of stand-in words, so that a table without labelled pages has a model too."""
    rng = random.Random(11)
    sentence = lambda: " ".join("word" * rng.randint(1, 2) for _ in range(rng.randint(4, 18))).capitalize() + "."
    made = []
    for _ in range(60):
        blocks = ["Some heading", *(" ".join(sentence() for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 9)))]
        made.append(arranged(blocks, [sentence() for _ in range(4)], ["Home", "About us", "News"], rng))
    return made


# ---- learning


def counted(pages: Iterator[str]) -> Counter:
    """How often each combination of features has each label, and each pair of labels stands at each kind of child."""
    found: Counter = Counter()
    for page in pages:
        for nodes, made in lessons(page):
            for node, row, label in zip(nodes, features(nodes), made, strict=True):
                found["node", ",".join(map(str, row)), 0, label] += 1
                if node.parent >= 0:
                    found["pair", group(node), made[node.parent], label] += 1
    return found


def fitted(found: Counter) -> Model:
    """Weights by logistic regression on the combinations, tables from the counts of pairs."""
    rows: dict[str, list[float]] = {}
    pairs: dict[str, np.ndarray] = {}
    for (what, name, above, label), times in sorted(found.items()):
        if what == "node":
            rows.setdefault(name, [0.0, 0.0])[label] += times
        else:
            pairs.setdefault(name, np.full((2, 2), PRIOR))[above, label] += times
    times = np.array([sum(r) for r in rows.values()])
    target = np.array([r[1] / sum(r) for r in rows.values()])
    places = [[p + int(x) for p, x in zip(PLACES, name.split(","), strict=True)] for name in rows]
    weights = linear.fit(places, [[1.0] * len(p) for p in places], target, sum(WIDTHS), times * (WEIGHT / times.sum()))
    tables = {}
    for name, table in pairs.items():
        ratio = table / table.sum(axis=1, keepdims=True) / (table.sum(axis=0) / table.sum())
        tables[name] = tuple(ratio.ravel().tolist())
    return Model(weights, tables)


def learn(df: DataFrame, sample: int = SAMPLE, html: str = "html") -> Model:
    """The model of the labelled pages among ``sample`` different pages, those with the smallest hashes.

    Null and empty pages teach nothing; a page in many rows is one page. Only counts of the combinations of features,
    bounded by their number, reach the driver.
    """
    pages = pick(df, html=html).where("html <> ''").withColumn("h", F.xxhash64("html"))
    chosen = pages.select("h").distinct().orderBy("h").limit(sample)
    taught = pages.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("html")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = counted(iter(texts(batch, "html")))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(found.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["what", "name", "above", "label", "times"])

    made = map_batches(taught, work, "what string, name string, above int, label int, times bigint", "html")
    total = Counter({tuple(r)[:4]: r["times"] for r in made.groupBy("what", "name", "above", "label").agg(F.sum("times").alias("times")).collect()})
    return fitted(total + counted(iter(plain_pages())))


# ---- inference


def odds(x: float) -> float:
    return 1.0 / (1.0 + exp(-x)) if x > -700 else 0.0


def marginals(nodes: list[Node], model: Model, known: dict[tuple[int, ...], float] | None = None) -> list[float]:
    """Probability of main text for every node: messages from the leaves up, then from the page down.

    A message is the log of what it says for label 1 over what it says for 0; sums of messages replace products, so
    nothing underflows in a page of any size. Children stand behind their parents, so two loops visit all.
    """
    known = {} if known is None else known
    own = []
    for row in features(nodes):
        value = known.get(row)
        if value is None:
            value = known[row] = float(model.weights[-1] + sum(model.weights[p + x] for p, x in zip(PLACES, row, strict=True)))
        own.append(value)
    tables = [model.pairs.get(group(n)) or model.pairs.get(f"{n.kind}/") or (1.0, 1.0, 1.0, 1.0) for n in nodes]
    belief, message = own[:], [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        p = odds(belief[i])
        t00, t01, t10, t11 = tables[i]
        message[i] = log(t10 * (1 - p) + t11 * p) - log(t00 * (1 - p) + t01 * p)
        belief[nodes[i].parent] += message[i]
    for i in range(1, len(nodes)):
        p = odds(belief[nodes[i].parent] - message[i])
        t00, t01, t10, t11 = tables[i]
        belief[i] += log(t01 * (1 - p) + t11 * p) - log(t00 * (1 - p) + t10 * p)
    return [odds(b) for b in belief]


def extract(df: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` (blocks of main text joined by line feeds), ``n_chars``, ``n_blocks`` and the
    ``marginals`` of all runs of text.

    A null or empty page, and one without text, has an empty text. Rows are independent: repeated rows come out
    repeated, an empty table gives an empty table, other columns are ignored. Pages are read whole, in time and
    memory in proportion to their length. One pass, no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held, known = shared.value, {}
        found, sure = [], []
        for page in texts(batch, "html"):
            nodes = html_tree.read(page)
            runs = [(n.text, m) for n, m in zip(nodes, marginals(nodes, held, known), strict=True) if n.text is not None]
            found.append([t for t, m in runs if m >= 0.5])
            sure.append([m for _, m in runs])
        made = ["\n".join(blocks) for blocks in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(made, pa.string()),
                pa.array([len(t) for t in made], pa.int64()),
                pa.array([len(b) for b in found], pa.int64()),
                pa.array(sure, pa.list_(pa.float64())),
            ],
            names=["page_id", "url", "text", "n_chars", "n_blocks", "marginals"],
        )

    pages = pick(df, page_id=page_id, url=url, html=html).withColumn("page_id", F.col("page_id").cast("bigint"))
    return map_batches(pages, work, SCHEMA, "html")


# The main text of pages whose text stands in one article of headings and paragraphs.
SQL = r"""
with articles as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as article from pages
), blocks as (
  select page_id, url, list_transform(regexp_split_to_array(article, '</?(?:p|h1)>'), lambda b:
    trim(regexp_replace(
      regexp_replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
      '\s+', ' ', 'g'))) as found
  from articles
), joined as (
  select page_id, url, array_to_string(list_filter(found, lambda b: b <> ''), chr(10)) as text from blocks
)
select page_id, url, text, length(text)::bigint as n_chars from joined
"""
