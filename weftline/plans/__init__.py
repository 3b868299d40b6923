"""Registered queries, grouped by family."""

from importlib import import_module

FAMILIES = ["graph_queries", "source_queries", "normalize_queries", "column_queries", "table_queries", "quality_queries",
            "governance_queries", "federation_queries", "model_queries", "text_queries", "stream_queries"]


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"weftline.plans.{family}")
