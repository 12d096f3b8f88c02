"""Every operator on the shared test tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from jobstrata.checks import intake, postings, reports, stages, star, texts
from jobstrata.checks.base import REGISTRY

__all__ = ["REGISTRY", "intake", "postings", "reports", "stages", "star", "texts"]
