"""All registered queries and the SQL that checks them."""

from quotepanel.plans.entries import analytics, checks, ingest, jobs  # noqa: F401
from quotepanel.plans.registry import ORACLES, QUERIES  # noqa: F401
