"""Registered queries: each binds operators to the given tables and pairs them with plain SQL."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for found in iter_modules(__path__):
        if found.name.startswith("q_"):
            import_module(f"{__name__}.{found.name}")
