"""All registered queries and oracles, merged from the per-family catalogs."""

from __future__ import annotations

from yieldcast.plans import catalog_baselines, catalog_evaluation, catalog_explore, catalog_features, catalog_models

QUERIES: dict = {}
ORACLES: dict = {}
for _mod in (catalog_features, catalog_baselines, catalog_explore, catalog_evaluation, catalog_models):
    QUERIES.update(_mod.QUERIES)
    ORACLES.update(_mod.ORACLES)
