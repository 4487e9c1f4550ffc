"""Registered queries, by section of the operator inventory."""

from rungwise.checks import arrays, columns, growth, metrics, models, runs, sources, splits  # noqa: F401
from rungwise.checks.registry import ORACLE_SQL, QUERIES  # noqa: F401
