"""All registered queries."""

from .base import ORACLES, QUERIES


def _load() -> None:
    from . import match_queries, pipeline_queries, series_queries, table_queries, text_queries  # noqa: F401


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
