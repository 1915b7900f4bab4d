"""Steps that go by the order of the file, against pandas."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import POSITION
from tidemark.operators import cleaning, quality
from tidemark.plans import store
from tidemark.sources import read_delimited, read_table


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Three CSV files of repeated keys, each of several splits of 4 KB."""
    folder = tmp_path_factory.mktemp("files")
    rng = random.Random(4)
    for name in ("a.csv", "b.csv", "c.csv"):
        lines = [f"k{rng.randrange(60)},{rng.randrange(5)},{name}-{i}-{'x' * rng.randrange(30)}" for i in range(900)]
        (folder / name).write_text("\n".join(["key,part,note", *lines]) + "\n")
    return folder


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def as_pandas(files):
    return pd.concat([pd.read_csv(files / n) for n in ("a.csv", "b.csv", "c.csv")], ignore_index=True)


@pytest.mark.parametrize("source", ["", "a.csv"])
def test_keep_first_equals_pandas(spark, files, small_splits, source):
    df = read_delimited(spark, str(files / source) if source else str(files), {"part": "int"}, position=True)
    assert df.rdd.getNumPartitions() > 3
    want = as_pandas(files) if not source else pd.read_csv(files / source)
    first = want.drop_duplicates(subset=["key", "part"], keep="first")
    got = cleaning.keep_first(df, ["key", "part"], [F.col(POSITION)]).drop(POSITION)
    assert sorted(map(tuple, got.collect())) == sorted(first.itertuples(index=False, name=None))
    in_order = [tuple(r) for r in df.orderBy(POSITION).drop(POSITION).collect()]
    assert in_order == list(want.itertuples(index=False, name=None))


def test_equal_rows_keep_the_first(spark, files, small_splits):
    df = read_delimited(spark, str(files), {"part": "int"}, position=True).drop("note")
    got = [tuple(r) for r in cleaning.drop_duplicates(df).orderBy(POSITION).drop(POSITION).collect()]
    assert got == list(as_pandas(files)[["key", "part"]].drop_duplicates().itertuples(index=False, name=None))


def test_samples_are_the_first_in_the_file(spark, files, small_splits):
    df = read_delimited(spark, str(files), {"part": "int"}, position=True)
    rules = [quality.RowRule("part", "Minor", F.col("part") == 2), quality.CompletenessRule("full", "Minor")]
    found = {r["rule"]: r for r in quality.run_rules(df, rules, "note").collect()}
    table = as_pandas(files)
    assert found["part"]["sample_ids"] == ", ".join(table[table.part == 2].note[:10]) + " …"
    assert found["full"]["checked"] == 3


def test_orders_listed_twice(spark, tmp_path):
    head = "Order ID,Product ID,Order Date,Ship Date,Sales,Quantity,Profit,Discount,Category,Sub-Category,Region,Product Name"
    line = "o{},p,{}/5/2016,9/9/2016,{},1,1,0,Furniture,Chairs,East,n"
    lines = [line.format(1, 5, 90), line.format(1, 3, 70), line.format(2, 4, -1), line.format(2, 4, 20), line.format(2, 3, 10)]
    (tmp_path / "orders.csv").write_text("\n".join([head, *lines]) + "\n")
    types = {"Sales": "double", "Quantity": "int", "Profit": "double", "Discount": "double"}
    found = store.clean(read_delimited(spark, str(tmp_path / "orders.csv"), types, position=True))
    assert POSITION not in found.columns
    assert sorted((r["Order ID"], r["Sales"]) for r in found.collect()) == [("o1", 90.0), ("o2", 20.0)]


def test_parquet_rows_are_numbered(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id % 7 as k").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    found = read_table(spark, str(tmp_path), "t", position=True)
    assert found.filter(f"{POSITION}.row = id").count() == 5000
    assert sorted(r["id"] for r in cleaning.keep_first(found.repartition(5), ["k"], [F.col(POSITION)]).collect()) == list(range(7))
