"""Registered queries by subject."""

from importlib import import_module
from importlib.util import find_spec

SUBJECTS = ("ingest", "quality", "maintain", "resolve", "spatial", "network", "flow", "issues", "normals", "reservoir",
            "climate", "snow", "status", "streaming")


def load():
    """Import every subject module that exists and return the registry."""
    from tidemark.plans import registry

    for subject in SUBJECTS:
        if find_spec(f"tidemark.plans.{subject}_queries"):
            import_module(f"tidemark.plans.{subject}_queries")
    return registry
