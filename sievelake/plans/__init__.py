"""Registered queries of the curation library."""

from . import corpus, passages, selection  # noqa: F401
from .registry import ORACLES as ALL_ORACLES
from .registry import QUERIES as ALL_QUERIES

__all__ = ["ALL_ORACLES", "ALL_QUERIES"]
