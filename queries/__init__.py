"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from queries import bronze, runlog, silver, upsert

_MODULES = (upsert, silver, bronze, runlog)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
