"""All driver queries, imported for their registration side effect."""

from __future__ import annotations

from scorewell.plans import q_model, q_ops, q_relational, q_rows, q_serving, q_state  # noqa: F401 - registration
from scorewell.plans.registry import ORACLES, QUERIES

FLAGSHIP = "flagship_calibration"


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
