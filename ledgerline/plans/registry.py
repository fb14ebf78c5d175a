"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None
    ids: str = ""          # SURVEY §2 ids covered


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: Callable[[], str] | None = None, ids: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn
    return deco
