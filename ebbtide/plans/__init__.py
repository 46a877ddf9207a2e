"""Named queries over the stored tables, by family."""

from __future__ import annotations

import sys

from ebbtide import travels

travels(sys.modules[__name__])

import importlib

_MODULES = (
    "scans", "explore", "features", "joins", "scalars", "metrics", "monitoring",
    "lookups", "texts", "agents", "models", "synthetic", "streams",
)


def load():
    """Import every plan module once; returns (queries, oracles)."""
    from ebbtide.plans import oracle, registry

    for module in _MODULES:
        importlib.import_module(f"ebbtide.plans.{module}")
    return registry.QUERIES, {name: oracle.with_views(sql) for name, sql in registry.ORACLES.items()}
