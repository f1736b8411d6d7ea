"""Scans: declared schemas, column pruning and filters reach the files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_set(spark: SparkSession, folder: str, schemas: Mapping[str, StructType | str]) -> dict[str, DataFrame]:
    """Several CSV files as one set of frames."""
    return {name: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", s) for name, s in schemas.items()}


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """One row per text file: (source, text), whole."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("text"))
