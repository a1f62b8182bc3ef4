"""All registered queries and oracles."""

from __future__ import annotations

# The transform queries define oracle pieces the others use, hence the order.
from relata.catalog import transform_queries  # isort: skip
from relata.catalog import quality_queries, serving_queries
from relata.session import configure

MODULES = (transform_queries, quality_queries, serving_queries)


def all_queries() -> dict:
    merged = {}
    for module in MODULES:
        for key, build in module.QUERIES.items():
            merged[key] = lambda spark, sf_dir, build=build: build(configure(spark), sf_dir)
    return merged


def all_oracles() -> dict[str, str]:
    merged = {}
    for module in MODULES:
        merged.update(module.ORACLES)
    return merged
