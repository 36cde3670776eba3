"""All registered queries and their SQL twins."""

from __future__ import annotations

from wagelens.checks import cleaning, filling, inputs, modelling, reports, skills, stats  # noqa: F401
from wagelens.checks.base import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
