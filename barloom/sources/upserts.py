"""Keyed upsert into a stored table, rewriting only the months it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.mutate import insert_ignore, upsert
from barloom.operators.validate import require_constraints
from barloom.schemas import PRICE_TABLE, TableSpec
from barloom.session import scratch_path
from barloom.sources import folders
from barloom.sources.files import clustered, read_table

MONTH = "month"
MARKER = T.StructType([T.StructField("state", T.StringType())])
STAGED, STORED = "staged", "stored"
POLICIES = {"upsert": upsert, "insert_ignore": insert_ignore}


def _stored_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.schema.fields, T.StructField(MONTH, T.StringType())])


def _read(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    return read_table(spark, path, _stored_schema(spec))


def read_stored(spark: SparkSession, path: str, spec: TableSpec = PRICE_TABLE) -> DataFrame:
    return _read(spark, path, spec).drop(MONTH)


def _merged_months(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    spec: TableSpec,
    order: list[str],
    policy: str,
    staged_batch: str,
) -> DataFrame | None:
    batch = incoming.select(*spec.schema.fieldNames()).withColumn(
        MONTH, F.date_format(spec.dated_by, "yyyy-MM")
    )
    # the batch feeds two jobs, so it is written once instead of being computed twice
    batch.write.mode("overwrite").parquet(staged_batch)
    batch = _read(spark, staged_batch, spec)

    # calendar months of the batch: bounded by the calendar, not by the data
    months = [r[MONTH] for r in batch.select(MONTH).distinct().collect()]
    if not months:
        return None
    stored = _read(spark, path, spec).where(F.col(MONTH).isin(months))
    return POLICIES[policy](stored, batch, list(spec.key), order)


def _mark(spark: SparkSession, marker: str, state: str) -> None:
    spark.createDataFrame([(state,)], MARKER).coalesce(1).write.mode("append").parquet(marker)


def store(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    order: list[str],
    spec: TableSpec = PRICE_TABLE,
    policy: str = "upsert",
    staging: str | None = None,
    constraints: dict[str, str] | None = None,
) -> None:
    """Merge a batch into the table at `path`, partitioned by the month of its date.

    The merged months are first staged in full, then replace the stored ones. A
    caller that repeats failed batches names `staging` by the batch's identity: a
    batch that was staged in full is not merged with half-replaced months again, and
    one that was stored is not stored again, whatever has been written since. The
    name has to be the batch's own for good: another batch under it would be taken
    for this one. One writer per table at a time.

    The staged rows go as soon as the batch is marked stored; of a named staging the mark
    stays, until the caller knows that the batch cannot come again (`forget`).

    A batch with a row that breaks one of the table's `constraints` is refused as a whole.
    """
    incoming = require_constraints(incoming, constraints or {})
    named = staging is not None
    staging = staging or scratch_path(spark, "months")
    marker, staged_batch = f"{staging}-state", f"{staging}-batch"
    states = {row["state"] for row in read_table(spark, marker, MARKER).collect()}
    if STORED in states:
        return
    if STAGED not in states:
        merged = _merged_months(spark, path, incoming, spec, order, policy, staged_batch)
        if merged is None:
            folders.remove(spark, staged_batch)
            return
        merged.write.mode("overwrite").parquet(staging)
        _mark(spark, marker, STAGED)
    (
        clustered(_read(spark, staging, spec), [MONTH, *spec.key])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )
    _mark(spark, marker, STORED)
    for path_of_batch in [staging, staged_batch, *([] if named else [marker])]:
        folders.remove(spark, path_of_batch)


def forget(spark: SparkSession, staging: str) -> None:
    """Removes all that `store` has left under a name, of a batch that cannot come again."""
    for ending in ("", "-batch", "-state"):
        folders.remove(spark, f"{staging}{ending}")
