"""All registered queries (importing a section registers it)."""

from __future__ import annotations

from . import cleaning, jobs, reports, selection  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
