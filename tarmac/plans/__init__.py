"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from tarmac.plans import cleaning, eda, flows, learning, network, series, splitting
from tarmac.plans.common import Query

_MODULES = (eda, cleaning, series, network, splitting, learning, flows)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}
