"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = "2024-02-20"


def query(sql: str | None = None):
    """Registers a function(read) as a query; read(name) is a table. Integers are given as longs."""

    def wrap(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            return out.select(*[F.col(f.name).cast("long") if f.dataType.simpleString() in ("int", "smallint", "tinyint") else F.col(f.name) for f in out.schema.fields])

        QUERIES[function.__name__] = run
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return wrap


def as_of():
    return F.lit(AS_OF).cast("date")
