"""All registered queries, gathered from the query modules."""

from __future__ import annotations

from . import queries_clean, queries_extract, queries_models, queries_score  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
