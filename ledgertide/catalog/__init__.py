"""Registered queries over the driver's test tables, each with its SQL twin."""

from importlib import import_module

_MODULES = ("explore_queries", "ledger_queries", "price_queries", "operator_queries", "stream_queries", "feed_queries",
            "job_queries")


def load_queries():
    """``(queries, oracle SQL)`` by name."""
    from . import registry

    for module in _MODULES:
        import_module(f"{__name__}.{module}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
