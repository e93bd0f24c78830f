"""All registered queries outside the training-data subpackage, with their DuckDB equivalents."""

from . import catalog, citations, curves, grids, inference, instruments, jobs, ledger, records, routing, sequence, sources, stats, streams, telemetry, text  # noqa: F401
from .base import ORACLE, QUERIES  # noqa: F401

FLAGSHIP = "pr_curve"
