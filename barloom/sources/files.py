"""CSV price files in, clustered Parquet tables in and out."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.operators.mutate import first_per_key
from barloom.operators.validate import typed_prices
from barloom.schemas import BAR_KEY, BARS

CSV_OPTIONS = {"header": "true", "dateFormat": "yyyy-MM-dd", "pathGlobFilter": "*.csv"}


def _or_empty(spark: SparkSession, load, schema: T.StructType) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = BARS) -> DataFrame:
    """All *.csv files of a directory or object-store prefix; cells that do not parse are NULL.

    A missing directory is an empty frame with the same schema.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return _or_empty(spark, lambda: reader.csv(path), schema)


def scan_csv_inferred(
    spark: SparkSession, path: str, sampling_ratio: float = 1.0
) -> DataFrame:
    """The same files with types inferred from a sample, then cast to the price types."""
    reader = spark.read.options(**CSV_OPTIONS, inferSchema="true", samplingRatio=str(sampling_ratio))
    raw = _or_empty(spark, lambda: reader.csv(path), BARS)
    if not raw.columns:  # files without any line
        return spark.createDataFrame([], BARS)
    return typed_prices(raw)


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Chunks that may order their columns differently."""
    return reduce(DataFrame.unionByName, parts)


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("header", "true").csv(path)


def clustered(rows: DataFrame, keys: list[str] = BAR_KEY) -> DataFrame:
    """Rows laid out by key ranges, so row-group statistics prune key and date filters.

    Ranges are cut on the whole key: a hot ticker spans several files, split by date.
    """
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_table(
    rows: DataFrame, path: str, keys: list[str] = BAR_KEY, partition_by: list[str] | None = None
) -> None:
    writer = clustered(rows, keys).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema)


def unique_bars(rows: DataFrame, order: list[str]) -> DataFrame:
    """One bar per ticker and date, the first in the given order."""
    return first_per_key(rows, BAR_KEY, order)
