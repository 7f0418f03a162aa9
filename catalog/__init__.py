"""Registered queries: each runs a library operator on the given tables, most with a SQL twin."""

from catalog.views import Registry

REGISTRY = Registry()

from catalog import audit, blocked, features, files, growth, merging, panels, pit, sources, validation  # noqa: E402,F401
