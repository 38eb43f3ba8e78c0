"""Query registry plumbing: a query = Spark callable + independent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabulon.functions.exprs import round_doubles, sql_str
from tabulon.session import ship_package
from tabulon.sources.fixtures import oracle_views

ROUND = 6


@dataclass(frozen=True)
class Query:
    name: str
    ids: str                                   # SURVEY §2 operator ids
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None                  # DuckDB SQL body (after the fixture CTEs)
    doubles: Sequence[str] = field(default_factory=tuple)  # columns rounded on the oracle side
    ctes: str = ""                             # extra CTEs appended to the fixture CTEs
    survey: bool = True                        # prefix the fixture views

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return round_doubles(self.build(spark, sf_dir), ROUND)

    def sql(self) -> str | None:
        if self.oracle is None:
            return None
        body = self.oracle
        if self.doubles:
            repl = ", ".join(f"round({c}, {ROUND}) as {c}" for c in self.doubles)
            body = f"select * replace ({repl}) from ({body}) as q"
        if not self.survey:
            return (f"with {self.ctes} " if self.ctes else "") + body
        prefix = oracle_views()
        if self.ctes:
            prefix += ", " + self.ctes
        return prefix + " " + body


def values_sql(rows: Sequence[Sequence], names: Sequence[str]) -> str:
    """Inline VALUES table text for small parameter tables (oracle side)."""
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return repr(v)
        return sql_str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cols = ', '.join(f'"{n}"' for n in names)
    return f"(select * from (values {body}) as v({cols}))"
