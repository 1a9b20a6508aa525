"""All queries of the core with their SQL where SQL can express them."""

from __future__ import annotations

from tagloom.plans import files, omics, parsing, tags

_MODULES = (parsing, tags, omics, files)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
