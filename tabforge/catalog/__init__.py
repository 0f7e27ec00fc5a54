"""All named queries; importing the package fills the registry."""

from . import checked, cleaning, fitting, modelling, profiling, runs  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
