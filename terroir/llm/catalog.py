"""Registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from . import (
    best_fit_packing,
    caps,
    centroids,
    chunk_dedup,
    decontamination,
    exact_dedup,
    importance,
    language_id,
    line_dedup,
    ngram_join,
    pii,
    quote_links,
    url_filters,
)

MODULES = (best_fit_packing, url_filters, pii, chunk_dedup, quote_links, decontamination, line_dedup, exact_dedup, ngram_join, language_id, importance, centroids, caps)


def queries() -> dict:
    import corpus_pipeline

    return {name: f for m in MODULES for name, f in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
