"""Composite jobs and the queries the driver runs over its tables."""

import importlib

_MODULES = ("reports", "identity", "applog", "ml", "io")


def load_all():
    """Import every plan module (each registers its queries) and return
    ``(QUERIES, ORACLES)``."""
    from daybook.plans import registry

    for m in _MODULES:
        importlib.import_module(f"daybook.plans.{m}")
    return registry.QUERIES, registry.ORACLES
