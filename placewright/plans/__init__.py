"""Registered queries and their SQL twins."""

from . import areas, atlas, documents, eras, feeds, imports, indexes, lineage, more, names, pairs, requests, upkeep
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "areas", "atlas", "documents", "eras", "feeds", "imports", "indexes", "lineage", "more", "names", "pairs", "requests", "upkeep"]
