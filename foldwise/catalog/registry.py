"""Registry of named queries: a Spark builder plus (optionally) its DuckDB oracle.

Columns named in ``doubles`` (aggregates whose last bits depend on summation order) are rounded to
6 decimals on both sides; row-level formulas are computed identically by both engines and left
untouched (rounding them would only create half-way disagreements between the engines' ``round``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from foldwise.functions.columns import round_doubles

DIGITS = 6


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]
    ops: tuple[str, ...]
    digits: int = DIGITS

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.build(spark, sf_dir), self.digits, only=self.doubles)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql
        rep = ", ".join(f'round("{c}", {self.digits}) as "{c}"' for c in self.doubles)
        return f"select * replace ({rep}) from (\n{self.sql}\n) as oracle_result"


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, doubles=(), ops=(), digits: int = DIGITS):
    """Decorator: ``@register("x4_auc_by_fold", sql=..., doubles=["auc"], ops=["X4"])``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(doubles), tuple(ops), digits)
        return fn

    return deco
