from rollcall.plans.registry import ORACLES, QUERIES
from rollcall.plans import joins, lookups, scalars, scans, streams, upserts  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
