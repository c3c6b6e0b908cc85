"""All registered queries of the package's own operators, by name."""

from . import archives, catalog, files, matching, review, workflows

_PARTS = (catalog, review, matching, archives, workflows, files)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
