"""All queries: importing the modules registers them."""

from __future__ import annotations

from tarnhouse.catalogue import (  # noqa: F401
    files,
    functions,
    joining,
    loading,
    measures,
    shaping,
    star,
)
from tarnhouse.catalogue.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
