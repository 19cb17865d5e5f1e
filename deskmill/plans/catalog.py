"""All registered queries and their SQL."""

from __future__ import annotations

from deskmill.plans import closure, governance, loads, marts, tickets

MODULES = [marts, tickets, loads, governance, closure]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
