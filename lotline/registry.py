"""All registered queries and their SQL twins, apart from those of the llm subpackage."""

from __future__ import annotations

from lotline.queries import applications, people, portals, records, streams, values, work

FLAGSHIP = "projects"
MODULES = [applications, records, work, portals, people, values, streams]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
