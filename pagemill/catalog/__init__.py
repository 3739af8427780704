"""Registered queries and their SQL checks."""

from pagemill.catalog import documents, events, jobs, markup, records, scoring, streams  # noqa: F401
from pagemill.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
