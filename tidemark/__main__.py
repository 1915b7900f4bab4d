"""Run a job from files: python -m tidemark JOB --input FILE --output FOLDER.

Every result table becomes a CSV folder of its name below the output folder, text reports become text
folders. Start it with spark-submit on a cluster.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators.cleaning import rename
from tidemark.plans import activity, dashboard, financials, fraud, ledger, store, supply, taxi
from tidemark.sources import read_delimited, schemas, write_delimited, write_lines
from tidemark.sources.checkpoints import discard
from tidemark.sources.checkpoints import store as store_table

LATIN_1 = "ISO-8859-1"

# Job name: column types, encoding, results of the table read.
JOBS: dict[str, tuple[dict[str, str], str, Callable[[DataFrame], dict[str, DataFrame]]]] = {
    "activity": (schemas.PAYMENT_ACTIVITY, "UTF-8", activity.results),
    "fraud": (schemas.CARD_TRANSACTIONS, "UTF-8", fraud.results),
    "supply": (schemas.SUPPLY_ORDERS, LATIN_1, supply.results),
    "dashboard": (schemas.KPI_METRICS, "UTF-8", dashboard.results),
    "financials": (schemas.FINANCIALS, LATIN_1, financials.results),
    "store": (schemas.STORE_ORDERS, LATIN_1, store.results),
    "inventory": (schemas.SALES_INVENTORY, "UTF-8", store.inventory_results),
    "taxi": (schemas.TRIPS, "UTF-8", taxi.results),
}


def write_results(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        if table.columns == ["line_no", "line"]:
            write_lines(table, path)
        else:
            write_delimited(table, path)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from its listing; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def run(
    spark: SparkSession, job: str, source: str, folder: str, vendors: str | None = None, names: Mapping[str, str] | None = None
) -> None:
    """One job; ``names`` maps columns of a ledger file to those of the standard schema."""
    if job == "ledger":
        if not vendors:
            raise SystemExit("the ledger job needs --vendors, a CSV with a vendor_id column")
        types = schemas.FINANCIAL_RECORDS
        back = {standard: own for own, standard in (names or {}).items()}
        records = read_delimited(spark, source, {back.get(c, c): kind for c, kind in types.items()}, position=True)
        # Read several times, and each time in the order of the file: written once.
        records = store_table(rename(records, names or {}), "records")
        tables = ledger.results(records, read_delimited(spark, vendors))
    else:
        types, encoding, results = JOBS[job]
        table = read_delimited(spark, source, types, encoding, position=job == "store")
        # Of orders listed twice the one that comes first in the file stays.
        tables = results(store_table(table, "orders") if job == "store" else table)
    write_results(tables, folder)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "ledger"])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--vendors")
    parser.add_argument("--columns", help="ledger: JSON object from the file's column names to the standard ones")
    parser.add_argument("--shared", help="folder all executors share, for intermediate tables (spark.checkpoint.dir)")
    parser.add_argument("--master", help="only outside spark-submit, e.g. local[8]")
    a = parser.parse_args(arguments)
    conf = {"spark.checkpoint.dir": a.shared} if a.shared else None
    spark = session.build(f"tidemark-{a.job}", a.master, conf)
    for key, value in session.sized(input_bytes(spark, a.input), spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    try:
        run(spark, a.job, a.input, a.output, a.vendors, json.loads(a.columns) if a.columns else None)
    finally:
        discard(spark)


if __name__ == "__main__":
    main()
