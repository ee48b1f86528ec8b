"""All registered queries over the test tables and the SQL that gives the same rows."""

from folio.plans import depth, linkage, relational, scalar, stored  # noqa: F401  they register their queries
from folio.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
