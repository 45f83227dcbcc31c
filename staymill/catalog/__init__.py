"""All registered queries with their checking texts."""

from staymill.catalog import encoding, evaluation, exploration, modelling, points, texts  # noqa: F401
from staymill.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
