"""Registered queries over the driver's tables, each with the SQL it is checked against."""

import importlib
import pkgutil


def load_queries() -> None:
    """Import every query module of this package, which registers its queries."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module}")
