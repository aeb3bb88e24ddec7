"""The registered queries, with the SQL that they are held against."""

from __future__ import annotations

from tramloom.queries import feeds, history, networks, plans, streams, travel
from tramloom.queries.sql import Query

_MODULES = (travel, feeds, history, networks, plans, streams)


def queries() -> dict[str, Query]:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
