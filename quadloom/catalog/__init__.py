"""Named queries over the driver tables, one module per operator family."""

from __future__ import annotations

import importlib
import pkgutil


def load():
    """Import every family and return (queries, checking SQL), sorted by name."""
    from quadloom.catalog import common

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return dict(sorted(common.QUERIES.items())), dict(sorted(common.ORACLE.items()))
