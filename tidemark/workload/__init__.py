"""The registered queries: the operators on the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from tidemark.workload import cleaning, fraud, ledger, live, sales, supply, trips
from tidemark.workload.base import Query


def all_queries() -> dict[str, Query]:
    """Every registered query by name."""
    found: dict[str, Query] = {}
    for module in (sales, fraud, supply, ledger, cleaning, trips, live):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
