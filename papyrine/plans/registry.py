"""The named queries: one Spark function each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; results use 64-bit integers and doubles only, as the SQL does."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_numbers(function(spark, sf_dir))

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain_numbers(df: DataFrame) -> DataFrame:
    narrow = {T.IntegerType: "bigint", T.ShortType: "bigint", T.ByteType: "bigint", T.FloatType: "double"}
    return df.select(
        *[
            F.col(f.name).cast(narrow[type(f.dataType)]).alias(f.name) if type(f.dataType) in narrow else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
