"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import (
    collocations, decontaminate, exact_dedup, jaccard, language_model, licenses, packed_ids, packing, quality, resampling, secrets,
    topk_search, url_lists,
)

MODULES = (secrets, language_model, url_lists, packed_ids, jaccard, decontaminate, licenses, quality, exact_dedup, packing, topk_search, collocations, resampling)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
