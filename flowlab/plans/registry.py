"""All registered queries of the library's own operators, and their SQL."""

from __future__ import annotations

from flowlab.plans import alerts, fitted, flows, graphs, learned, scoring, storage
from flowlab.plans.base import Query

BOOKS = (flows.book, alerts.book, graphs.book, learned.book, storage.book, scoring.book, fitted.book)


def queries() -> dict[str, Query]:
    return {k: v for b in BOOKS for k, v in b.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for b in BOOKS for k, v in b.sql.items()}
