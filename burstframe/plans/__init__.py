"""Named queries over the operators."""

from importlib import import_module

from burstframe.plans.registry import ORACLES, QUERIES

for _group in ("lightcurve", "temporal", "geometry", "spectral", "classification", "fit", "interval", "circular", "catalog", "population", "source", "stage"):
    import_module(f"burstframe.plans.{_group}_queries")

__all__ = ["ORACLES", "QUERIES"]
