"""Registration of queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldcatch.workload.adapter import SQL_VIEWS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """Put the adapter views a statement names in front of it."""
    used = [v for v in SQL_VIEWS if re.search(rf"\b{v}\b", sql)]
    views = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


def query(name: str, sql: str):
    """Register a function of the adapter tables under `name`, with the SQL it must agree with."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        ORACLES[name] = with_views(sql)
        return fn

    return register
