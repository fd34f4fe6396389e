"""Registry of this package's queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from importlib import import_module

MODULES = ("token_counts", "sharding", "quality_rules", "url_filter", "quality_classifier",
           "packing", "toxicity", "lm_scoring", "near_dedup",
           "decontamination", "vector_codes", "spelling_variants", "language_id")


def queries() -> dict:
    import corpus_pipeline

    out = {}
    for name in MODULES:
        out |= import_module(f"rowsift.llm.{name}").QUERIES
    return out | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    out = {}
    for name in MODULES:
        out |= getattr(import_module(f"rowsift.llm.{name}"), "ORACLES", {})
    import corpus_pipeline

    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
