"""Named queries over the given tables; importing this package registers all of them."""

from affinary.catalog import additive, basics, jobs, joins, models, scores, training, versions  # noqa: F401
from affinary.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
