"""All queries of the library proper, with SQL for those that SQL can express."""

from __future__ import annotations

from quern.plans import answers, incremental, pages, quality, refresh, relational, site, structure, summaries, text, topics

MODULES = (quality, relational, structure, text, pages, site, topics, answers, refresh, summaries, incremental)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
