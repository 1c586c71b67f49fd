"""All queries over the reference's operators, and the SQL each must equal."""

from __future__ import annotations

from pagemill.plans import evaluation, labeling, pages

_PARTS = (labeling, evaluation, pages)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
SQL = {k: v for part in _PARTS for k, v in part.SQL.items()}
