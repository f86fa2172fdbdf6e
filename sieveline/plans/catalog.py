"""All queries of the core and their SQL."""

from __future__ import annotations

from . import data_checks, research, screening, units

_MODULES = [data_checks, screening, units, research]
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
FLAGSHIP = "nano_ratio"
