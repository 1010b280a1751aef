"""Named queries over the given tables, each with the flat SQL it must agree with.

Importing the modules registers their queries.
"""

from recordloom.queries import changes, chronology, domains, fields, landing, records, references, shapes, upkeep
from recordloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "chronology", "domains", "fields", "landing", "records", "references", "shapes", "upkeep"]
