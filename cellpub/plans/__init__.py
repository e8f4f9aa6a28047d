"""Registered queries (``QUERIES``) and their SQL (``ORACLES``)."""

from cellpub.plans import chain, cube, facts, quality, registers, scalars, series

_PARTS = (facts, chain, scalars, registers, cube, series, quality)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
