"""Registered queries, each with the SQL that must give the same rows where SQL can say it."""

from tidemark.plans.catalog import (  # noqa: F401  (registration by import)
    daily,
    evaluation,
    ingest,
    models,
    pipeline_steps,
    statistics,
    streams,
    text,
)
from tidemark.plans.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
