"""What the operators share: tables, shared scratch tables, package shipping, buckets of ids."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path

ARROW_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

_shipped: weakref.WeakSet = weakref.WeakSet()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches by bytes and sends this package to the Python workers, once."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="barloom-ship-")) / "barloom-package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))  # the driver's file server hands it to executors
        _shipped.add(context)
    return spark


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Writes a frame into the shared folder and reads it back: a short lineage that
    survives lost executors, and one computation however often it is used."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def crc_bucket(key: str | Column, buckets: int) -> Column:
    """crc32 of the id as decimal text, modulo `buckets`; NULL for a NULL id."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % buckets


def map_batches(
    frame: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """Applies a function from column lists to column lists to every Arrow batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            out = function(columns)
            arrays = [pa.array(out[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return frame.mapInArrow(run, schema)


def small_groups(texts: list[str], chars: int = 2_000_000) -> Iterator[list[str]]:
    """The texts in order, in lists of about `chars` characters, so that working memory is bounded."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group
