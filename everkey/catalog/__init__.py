"""Named queries over the test tables, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


def full_catalog() -> Catalog:
    from . import inputs, lookups, marts, plans, validity

    whole = Catalog()
    for part in (lookups, inputs, plans, marts, validity):
        for name, query in part.catalog.queries.items():
            whole.add(name, part.catalog.sql.get(name))(query)
    return whole
