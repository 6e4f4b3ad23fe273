"""Registered queries over the driver's test tables."""
from . import codecs, edges, filters, profile, reads, relational, storage, writes  # noqa: F401,E501
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
