"""The registered queries: thin compositions of the operators over the input tables."""

from __future__ import annotations

from . import activity, basics, curation, review, selection, storage  # noqa: F401  (the others register their queries with curation)


def queries() -> dict:
    return dict(curation.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(curation.SQL)
