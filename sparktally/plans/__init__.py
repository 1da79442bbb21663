"""Named queries over the test tables, their SQL oracles, and report jobs."""

from sparktally.plans.edges import EDGE_QUERIES, EDGE_SQL
from sparktally.plans.files import FILE_QUERIES, FILE_SQL
from sparktally.plans.oracle import ORACLE_SQL as _PLAIN_SQL
from sparktally.plans.queries import QUERIES as _PLAIN_QUERIES

QUERIES = {**_PLAIN_QUERIES, **EDGE_QUERIES, **FILE_QUERIES}
ORACLE_SQL = {**_PLAIN_SQL, **EDGE_SQL, **FILE_SQL}

__all__ = ["ORACLE_SQL", "QUERIES"]
