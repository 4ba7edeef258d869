"""All registered queries."""

from riskweave.plans import (  # noqa: F401
    engineering,
    evaluation,
    experiments,
    explore,
    ingest,
    modelling,
    monitoring,
    splits,
    streams,
)
from riskweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
