"""All registered queries."""

from importlib import import_module

from ferrolith.catalog.registry import QUERIES, SQL

for _part in ("delays", "catalogue", "study", "evaluation", "words", "landing", "models", "streams", "clusters"):
    import_module(f"ferrolith.catalog.{_part}")

__all__ = ["QUERIES", "SQL"]
