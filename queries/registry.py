"""Registration of a query with the operators it covers and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from playledger.session import ensure_checkpoint_dir, use_utc


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


@dataclass(frozen=True)
class Given:
    """The given tables: `read(name)` scans one."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers a function `(read) -> DataFrame`; `read` gives the tables."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            ensure_checkpoint_dir(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.checkpoints")
            return function(Given(spark, sf_dir))

        name = function.__name__
        REGISTRY[name] = Query(name, tuple(covers.split()), run, sql)
        return function

    return register
