"""All queries of this package."""

from __future__ import annotations

from seamark.llm import queries as _queries  # noqa: F401
from seamark.llm.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
