"""Incremental file ingest: new CSV files -> validated, keyed upserts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.validate import PRICE_CONSTRAINTS, stamp, validate
from barloom.schemas import BARS
from barloom.sources import folders
from barloom.sources.files import CSV_OPTIONS
from barloom.sources.upserts import forget, store


def read_new_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BARS).options(**CSV_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def forget_committed(spark: SparkSession, checkpoint: str, staged: str, current: int) -> None:
    """Removes what is staged of the batches before the current one that the checkpoint has
    committed; they cannot come again."""
    committed = [int(n) for n in folders.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    batches = {int(name.split("-")[0]) for name in folders.names(spark, staged)}
    for batch in batches:
        if batch < current and batch <= max(committed, default=-1):
            forget(spark, f"{staged}/{batch}")


def ingest_new_files(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    source: str = "auto_loader",
    profile: str = "full",
    max_files: int | None = None,
) -> int:
    """Ingest the files not seen by this checkpoint yet, then stop; returns the batches run.

    Each micro-batch is an upsert by (ticker, date). It is staged inside the checkpoint
    under the query's own id, which a recreated checkpoint does not share, so a batch
    that is repeated after a failure changes nothing and no other batch is taken for it.
    What is staged of a batch goes once it is stored, its mark once the checkpoint has committed
    it, so the disk beside the table does not grow with the number of batches.
    """
    checkpoint = checkpoint.rstrip("/")
    stored_batches: list[int] = []

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        rows = validate(batch, profile)
        stamped = stamp(rows, source, F.lit(datetime.now(timezone.utc)))
        staged = f"{checkpoint}/staged/{query_id}"
        store(
            batch.sparkSession,
            table,
            stamped,
            order=["open", "high", "low", "close", "volume"],
            staging=f"{staged}/{batch_id}",
            constraints=PRICE_CONSTRAINTS,
        )
        forget_committed(batch.sparkSession, checkpoint, staged, batch_id)
        stored_batches.append(batch_id)

    query = (
        read_new_files(spark, path, max_files)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(stored_batches)
