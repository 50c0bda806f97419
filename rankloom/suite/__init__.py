"""Registered queries over the provided tables, each beside its check SQL."""

from . import analysis, lexical_dense, ranking, sources, text  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
