"""Reading raw and processed data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from slipstream import schemas


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The schema is given: inferring it would read everything twice. Columns are matched by
    # position, and the header check makes a file with other columns fail instead of shift.
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    )


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.FLIGHTS_RAW)


def read_capacity(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.CAPACITY_RAW)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.WEATHER_RAW)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
