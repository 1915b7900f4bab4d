"""Samples of the rule report over tables where rules have limits: the same records, and few rows moved to find them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q

ROWS = 20_000


def shuffled(df):
    """Rows that the exchanges of a finished query wrote."""
    rows, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "Exchange":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return rows


@pytest.fixture(scope="module")
def data():
    """Places with NULLs and ties in no order, hot keys, a key of two rows, values that a few rows hold."""
    draw = random.Random(3)
    places = [None if i % 4000 == 7 else i // 2 for i in range(ROWS)]
    draw.shuffle(places)
    hot = [i % 5000 for i in range(ROWS)]
    rare = [str(i // 2 if i in (500, 501) else -i) for i in range(ROWS)]
    known = [None if i % 50 == 0 else i % 40 for i in range(ROWS)]
    return [(f"R{i:05d}", places[i], hot[i], rare[i], known[i], float(i % 6000 - 3)) for i in range(ROWS)]


def expected(data, broken):
    first = sorted((place is not None, place or 0, record) for (record, place, *_), bad in zip(data, broken) if bad)
    return sum(broken), ", ".join(r for *_, r in first[:10]) + (" …" if len(first) > 10 else "")


@pytest.mark.parametrize("broadcast, most", [("10MB", 1.5), ("10KB", 2), ("-1", 3)])
def test_samples_move_few_rows(spark, data, broadcast, most):
    """All keys that break a rule are broadcast, or only those of rules without limit, or none."""
    df = spark.createDataFrame(data, "record string, place int, hot int, rare string, known int, v double").repartition(6)
    reference = spark.createDataFrame([(i,) for i in range(35)], "known int")
    every = q.RowRule("every row", "Major", F.col("v") > -100)
    few = q.RowRule("few rows", "Major", q.not_positive("v"))
    rules = [every, few, q.UniqueRule("hot", "Major", ("hot",)), q.UniqueRule("rare", "Major", ("rare",))]
    rules.append(q.ReferenceRule("known", "Major", "known", reference, "known"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        report = q.run_rules(df, rules, "record", ["place"])
        found = {r["rule"]: (r["violations"], r["sample_ids"]) for r in report.collect()}
        moved = shuffled(report)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found["every row"] == expected(data, [True] * ROWS)
    assert found["few rows"] == expected(data, [v <= 0 for *_, v in data])
    assert found["hot"] == expected(data, [True] * ROWS)
    assert found["rare"] == expected(data, [i in (500, 501) for i in range(ROWS)])
    assert found["known"] == expected(data, [k is None or k >= 35 for *_, k, _ in data])
    assert moved < most * ROWS, moved  # the table itself is moved once here, by repartition()


def test_rows_numbered_while_reading_have_no_limit(spark, tmp_path):
    """Their places may differ between scans, so one scan has to find all samples."""
    df = spark.range(0, 5000, 1, 4).select("id", F.monotonically_increasing_id().alias("place"))
    report = q.run_rules(df, [q.RowRule("every row", "Major", F.col("id") >= 0)], "id", ["place"])
    assert report.first()["sample_ids"] == ", ".join(map(str, range(10))) + " …"
