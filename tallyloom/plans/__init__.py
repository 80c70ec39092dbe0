"""Registered queries and the SQL each is checked against."""

from tallyloom.plans import cubes, measures, models, places_routes, readings, records, texts, trade

_MODULES = (trade, cubes, readings, records, measures, places_routes, texts, models)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
