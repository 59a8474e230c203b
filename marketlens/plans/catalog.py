"""All queries outside the llm subpackage."""

from __future__ import annotations

from marketlens.plans import general, marketplace, relational, scalar, similar, windows

_REGISTRIES = (relational.R, scalar.R, similar.R, windows.R, marketplace.R)
QUERIES = general.QUERIES | {k: f for r in _REGISTRIES for k, f in r.queries.items()}
SQL = general.SQL | {k: q for r in _REGISTRIES for k, q in r.sql.items()}
OPERATORS = {k: o for r in _REGISTRIES for k, o in r.operators.items()}
