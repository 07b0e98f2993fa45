"""All registered queries."""

from __future__ import annotations


def all_queries():
    from millrace.catalog import eda, merging, models, preparation, quality, storage, store, streams  # noqa: F401
    from millrace.catalog.registry import QUERIES

    return dict(QUERIES)


def all_sql():
    all_queries()
    from millrace.catalog.registry import SQL

    return dict(SQL)
