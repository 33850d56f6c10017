"""Registered queries."""

from __future__ import annotations

from weftwork.plans import network, terms, text, vectors
from weftwork.plans.registry import Registry

QUERIES = Registry()
for _part in (text, terms, network, vectors):
    QUERIES.update(_part.QUERIES)
