"""Registered queries, one module per operator family."""

import importlib

MODULES = (
    "scans", "writes", "projection", "joins", "aggregates", "windows", "ordering",
    "scalars", "streams", "userfuncs", "lifecycle", "flows", "jobs",
)


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"tidemill.plans.{module}")
