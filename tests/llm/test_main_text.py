from __future__ import annotations

import html
import itertools
import random
import re

import pytest

from tidemark.llm import html_tree, main_text, workload
from tidemark.llm.html_tree import Node

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    return main_text.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id % 5 <> 1"))


def texts_of(spark, model, pages):
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], PAGES)
    return {r.page_id: r.text for r in main_text.extract(df, model).collect()}


def article(page):
    """The text of a page's article of headings and paragraphs, by regular expressions."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(filter(None, blocks))


def test_query_and_pages_not_learned_from(spark, model):
    folder = "/root/testdata/sf0.01"
    given = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r for r in workload.op13_main_text(spark, folder).collect()}
    assert {i: r.text for i, r in got.items()} == {i: article(p) for i, p in given.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())
    unseen = {i: p for i, p in given.items() if i % 5 == 1}
    assert texts_of(spark, model, unseen.values()) == dict(enumerate(map(article, unseen.values())))


def test_held_out_pages_without_an_article(spark, model):
    """The same unseen pages rearranged, without any element that marks the text: blocks found and blocks wrong."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id % 5 = 1").collect()]
    rng, right, found, wanted = random.Random(9), 0, 0, 0
    made, truth = [], []
    for page in pages:
        nodes = html_tree.read(page)
        held = main_text.labels(nodes)
        text = [n.text for n, y in zip(nodes, held, strict=True) if y and n.text]
        notes = [n.text for n, y in zip(nodes, held, strict=True) if not y and n.text and not n.linked]
        again = main_text.arranged(text, notes, ["Home", "News"], rng)
        nodes = html_tree.read(again)
        made.append(re.sub(r' data-main="."', "", again))
        truth.append([n.text for n, y in zip(nodes, main_text.labels(nodes), strict=True) if y and n.text])
    got = texts_of(spark, model, made)
    for i, blocks in enumerate(truth):
        mine = got[i].split("\n") if got[i] else []
        right += len(set(mine) & set(blocks))
        found += len(set(mine))
        wanted += len(set(blocks))
    assert right / wanted > 0.97 and right / found > 0.97


def test_marginals_equal_the_sum_over_all_labellings(model):
    rng = random.Random(2)
    kinds = list(html_tree.GROUPS)
    for _ in range(25):
        nodes = [Node(-1, "page", "", None, 0, None)]
        for i in range(1, rng.randint(2, 9)):
            text = rng.choice([None, "Some words. And more of them.", "x"])
            parent = rng.choice([j for j in range(i) if nodes[j].text is None])
            nodes.append(Node(parent, "text" if text else rng.choice(kinds), rng.choice(["", "other", "content"]), text, 0, None))
        rows = main_text.features(nodes)
        own = [model.weights[-1] + sum(model.weights[p + x] for p, x in zip(main_text.PLACES, r, strict=True)) for r in rows]
        total, ones = 0.0, [0.0] * len(nodes)
        for y in itertools.product((0, 1), repeat=len(nodes)):
            weight = 1.0
            for i, node in enumerate(nodes):
                p = main_text.odds(own[i])
                weight *= p if y[i] else 1 - p
                if i:
                    table = model.pairs.get(main_text.group(node)) or model.pairs.get(f"{node.kind}/") or (1.0,) * 4
                    weight *= table[2 * y[node.parent] + y[i]]
            total += weight
            for i, one in enumerate(y):
                ones[i] += weight * one
        for a, b in zip(main_text.marginals(nodes, model), ones, strict=True):
            assert abs(a - b / total) < 1e-9


def runs(page):
    return [n.text for n in html_tree.read(page) if n.text is not None]


def test_reading():
    assert runs("<p>a<b>b</b> <i>c\n\t d</i>&nbsp;&amp;&eacute;&#x41;&lt;</p>e") == ["ab c d &éA<", "e"]
    assert runs("<p>one<p>two<ul><li>x<li>y<ul><li>z</ul></ul><table><tr><td>1<td>2<tr><td>3</table>") == ["one", "two", "x", "y", "z", "1", "2", "3"]
    assert runs("<script>var a='<p>no</p>';</script>yes<!-- no --><style>no</style><!doctype html><TITLE>no</TITLE> 1 < 2 <3") == ["yes 1 < 2 <3"]
    assert runs("a<script>never ended <p>b</p>") == ["a"]
    assert runs("a<!-- never ended <p>b</p>") == ["a"]
    assert runs('<p title="a > b">c</p><a href=\'x>y\'>d</a><p title="open>e</p>') == ["c", "d", "e"]
    assert runs("a<br>b</nothing></p>c</div>d") == ["a b", "cd"]
    assert runs("") == [] and runs("<") == ["<"] and runs("<p") == ["<p"] and runs("&am") == ["&am"] and runs(" \n ") == []
    tree = html_tree.read('<div class="sideBar"><p id=x>t</div><div role="main">u')
    assert [(n.kind, n.hint) for n in tree] == [("page", ""), ("division", "other"), ("paragraph", ""), ("text", ""), ("division", "content"), ("text", "")]


def test_long_and_deep_pages_in_linear_time():
    assert len(html_tree.read("<div>" * 50_000 + "x" + "</div>" * 50_000)) == 50_002
    assert len(html_tree.read("<p>y" * 50_000)) == 100_001
    assert len(html_tree.read("<a href='" * 20_000)) == 2


def test_odd_rows(spark, model):
    page = "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Title here</h1><p>One sentence. Another one.</p></article></body></html>"
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", page, "x"), (2, "u", page, "x"), (3, "u", "<nav></nav>", "x")]
    df = spark.createDataFrame(rows, PAGES + ", HTML string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in main_text.extract(df, model).collect()), key=repr)
    text = "Title here\nOne sentence. Another one."
    assert got == sorted([(1, "u", "", 0), (None, None, "", 0), (3, "u", "", 0)] + [(2, "u", text, len(text))] * 2, key=repr)
    assert main_text.extract(df.limit(0), model).count() == 0


def test_learning_without_labelled_pages(spark):
    df = spark.createDataFrame([(1, "u", None), (2, "u", "<div>no label</div>")], PAGES)
    assert main_text.learn(df).pairs == main_text.learn(df.limit(0)).pairs
