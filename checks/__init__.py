"""Queries over the given tables, each with an equivalent SQL text where SQL can say it."""

MODULES = ["features", "scores", "ingest", "profile", "metrics", "planned", "models"]


def all_queries():
    """(queries, oracle texts), in order of registration."""
    from importlib import import_module

    from checks.registry import ORACLES, QUERIES

    for name in MODULES:
        import_module(f"checks.{name}")
    return dict(QUERIES), dict(ORACLES)
