"""Retail customer analytics as Spark jobs over a star schema."""

from merchlens.params import Params
from merchlens.sources.star import Star, StoredStar
from merchlens.sources.retail import RetailStar

__all__ = ["Params", "Star", "StoredStar", "RetailStar"]
