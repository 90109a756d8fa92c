"""Layer jobs: bronze ingest, silver cleaning, gold marts."""

from tillroll.plans.layers import RetailLayers

__all__ = ["RetailLayers"]
