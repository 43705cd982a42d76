"""Query registry. A query is a function of ``Feeds``; both sides round the named columns alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.catalog.feeds import Feeds
from millrace.catalog.feeds_sql import steady, with_feeds
from millrace.functions import guards


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Feeds], DataFrame]
    sql: str | None
    digits: dict[str, int]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Feeds(spark, sf_dir))
        return df.withColumns({c: guards.steady(F.col(c), n) for c, n in self.digits.items()}) if self.digits else df


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, r4: str = "", r2: str = ""):
    """Register a query. ``r4`` and ``r2`` list columns rounded to 4 and 2 places on both sides,
    because engines add doubles in different orders."""
    digits = {c: 4 for c in r4.split()} | {c: 2 for c in r2.split()}

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        text = None
        if sql is not None:
            body = sql
            if digits:
                fixes = ", ".join(f"{steady(c, n)} AS {c}" for c, n in digits.items())
                body = f"SELECT * REPLACE ({fixes}) FROM ({sql}) AS q"
            text = with_feeds(body)
        REGISTRY[name] = Query(name, fn, text, digits)
        return fn

    return wrap
