"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from pairloom.plans import captions, files, flows, general, objects, registry, samples  # noqa: F401  (listing happens on import)

QUERIES = dict(registry.QUERIES) | dict(general.QUERIES)
ORACLES: dict[str, str] = dict(registry.ORACLES) | general.ORACLES
