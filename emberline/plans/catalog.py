"""Every registered query outside of ``llm``, by name, with its SQL: a query f has its SQL in the constant F, if SQL can express it."""

from __future__ import annotations

import inspect

from emberline.plans import catalogues, chips, rasters, sites

_MODULES = (sites, rasters, catalogues, chips)
QUERIES = {
    name: f
    for m in _MODULES
    for name, f in vars(m).items()
    if inspect.isfunction(f) and f.__module__ == m.__name__ and not name.startswith("_")
}
ORACLE = {name: vars(m)[name.upper()] for m in _MODULES for name in QUERIES if name.upper() in vars(m)}
