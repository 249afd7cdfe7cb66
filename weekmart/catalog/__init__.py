"""Registered queries: each runs an operator over the given tables, with its SQL counterpart."""

from weekmart.catalog.base import REGISTRY

__all__ = ["REGISTRY", "load"]


def load():
    """Import all query modules and return the registry."""
    from weekmart.catalog import (  # noqa: F401
        analytic, cleaning, dates, history, mappings, marts, metrics, models, quality, sellin, sinks, sources, streams,
    )
    return REGISTRY
