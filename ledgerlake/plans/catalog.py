"""All registered queries: importing the modules fills the registry."""

from ledgerlake.plans import cohorts, eligibility, gates, intake, lineage, matching, places, publication, ranking, review, serving, texts  # noqa: F401
from ledgerlake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
