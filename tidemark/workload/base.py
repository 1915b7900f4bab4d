"""What a registered query is, and SQL snippets shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import sources

Run = Callable[[SparkSession, str], DataFrame]


# Column types of the driver's tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return sources.read_table(spark, folder, name, SCHEMAS[name])


class Query(NamedTuple):
    run: Run
    sql: str | None = None


def cents(c: Column) -> Column:
    """Round to two decimals by the same binary arithmetic in every engine."""
    return F.floor(c * 100 + F.lit(0.5)) / F.lit(100.0)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating-point column for comparison."""
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def sql_cents(expression: str) -> str:
    return f"(floor(({expression}) * 100 + 0.5) / 100.0)"


def sql_money(expression: str) -> str:
    """Exact sum of a two-decimal column, as double."""
    return f"coalesce(sum(cast({expression} as decimal(18,2))), 0)::double"
