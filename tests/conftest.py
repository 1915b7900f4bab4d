from __future__ import annotations

import tempfile

import pytest

from tidemark import session


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-warehouse-"),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted by the text of their values or by the given columns."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)
