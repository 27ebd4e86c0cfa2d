"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from . import browse_queries, change_queries, estate_queries, lint_queries  # noqa: F401
from .registry import DOCS, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "DOCS"]


if __name__ == "__main__":
    for key in sorted(QUERIES):
        first = DOCS[key].splitlines()[0] if DOCS[key] else ""
        print(f"{key:30s} {'oracle' if key in ORACLE else 'rows-only':9s} {first}")
