"""Registered queries over the given tables and their SQL."""

from bandstand.checks.registry import ORACLE, QUERIES, check  # noqa: F401
from bandstand.checks import (  # noqa: F401,E402
    source_checks,
    mart_checks,
    cleaning_checks,
    linkage_checks,
    model_checks,
    chart_checks,
)
