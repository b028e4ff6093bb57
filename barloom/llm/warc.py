"""Pages to WARC archives by way of ARC, and back: conversion in Spark tasks.

Archives are files in the shared folder. A task names its files after its attempt
and returns the names; only names of attempts that Spark has accepted are read, so
what a lost executor leaves behind does no harm.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import archives
from barloom.llm.base import prepared, stored
from barloom.session import scratch_path

LEAST_SHARED = 1000
FILE_BYTES = 64 << 20
WRITTEN = "path string, records long, bytes long"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, target_uri string, captured string"
)


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def with_originals(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, html and refers_to: the largest page_id with the same payload of at
    least `least` bytes, NULL for that page itself and for smaller payloads.

    Only digests are aggregated, partially before their shuffle; a hot payload's
    pages meet its one original in a join whose large side may be split.
    """
    digests = pages.select("page_id", "url", "html", F.sha1(_payload()).alias("digest"))
    shared = (
        pages.where(F.octet_length(_payload()) >= least)
        .groupBy(F.sha1(_payload()).alias("digest"))
        .agg(F.max("page_id").alias("original"), F.count("*").alias("pages"))
        .where("pages > 1")
        .drop("pages")
    )
    refers = F.when(F.col("page_id").isNull() | (F.col("original") != F.col("page_id")), F.col("original"))
    return digests.join(shared, "digest", "left").select(
        "page_id", "url", "html", refers.alias("refers_to")
    )


def convert_pages(pages: DataFrame, folder: str, least: int = LEAST_SHARED) -> DataFrame:
    """Writes every page as an ARC record, converts the ARC to WARC files below `folder`;
    returns path, number of records and bytes of each file.

    Batches alternate between ARC version 1 and 2. A file is closed after the record
    that brings it to 64 MB.
    """
    prepared(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        system, root = _file_system(folder)
        sink, path, records, size, files = None, "", 0, 0, []
        for number, batch in enumerate(batches):
            rows = batch.to_pylist()
            version, name = 1 + number % 2, f"{task}-{number:04d}.arc"
            arc = io.BytesIO()
            arc.write(archives.arc_version_block(version, name))
            for row in rows:
                payload = (row["html"] or "").encode()
                arc.write(
                    archives.arc_record(version, name, arc.tell(), row["page_id"], row["url"], payload)
                )
            arc.seek(0)
            refers = iter([None, *(row["refers_to"] for row in rows)])  # the version block refers to none
            for record in archives.read_arc(arc):
                if sink is None:
                    name = f"{task}-{len(files):04d}.warc.gz"
                    system.create_dir(root, recursive=True)
                    sink, path = system.open_output_stream(f"{root}/{name}"), f"{folder}/{name}"
                written = archives.warc_bytes(archives.convert(record, next(refers)))
                sink.write(written)
                records += 1
                size += len(written)
                if size >= FILE_BYTES:
                    sink.close()
                    files.append((path, records, size))
                    sink, records, size = None, 0, 0
        if sink is not None:
            sink.close()
            files.append((path, records, size))
        if files:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*files, strict=True)], names=["path", "records", "bytes"]
            )

    return with_originals(pages, least).mapInArrow(write, WRITTEN)


def read_archives(files: DataFrame) -> DataFrame:
    """Response and revisit records of the WARC files in column path; files of 64 MB and a
    record at most are read by a task each.

    A revisit's digest is its header's and its length that of its HTTP head, both of
    the payload it shares; a response's are those of the payload read.
    """
    prepared(files.sparkSession)
    names = [part.split(" ")[0] for part in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, location = _file_system(path)
                rows = []
                with system.open_input_stream(location) as stream:
                    for record in archives.read_warc(stream):
                        headers = record.headers
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        revisit = headers["WARC-Type"] == "revisit"
                        rows.append(
                            (
                                archives.page_of(headers["WARC-Record-ID"]),
                                int(record.http["Content-Length"]) if revisit else len(record.payload),
                                archives.digest_hex(headers["WARC-Payload-Digest"]),
                                headers["WARC-Type"],
                                archives.page_of(headers["WARC-Refers-To"]) if revisit else None,
                                headers["WARC-Record-ID"],
                                headers.get("WARC-Target-URI"),
                                headers["WARC-Date"],
                            )
                        )
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]
                columns = list(zip(*rows, strict=True)) or [()] * len(types)
                arrays = [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    # a task for each file; without their number adaptive execution puts the short rows together
    return files.select("path").repartition(max(1, files.count())).mapInArrow(read, RECORDS)


def archived_pages(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Writes all pages to WARC archives in the shared folder and reads them back.

    One record per input row. A NULL html is an empty payload; a NULL url has no
    target URI, any other url is kept, whatever its scheme; a NULL page_id has an identifier of its own content and is a revisit
    if a page with an id shares its payload. Repeated rows of the original are all
    responses. An empty table writes no file and gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = folder.replace("file:", "", 1)
    written = stored(convert_pages(pages.select("page_id", "url", "html"), folder, least), "warc-files")
    return read_archives(written)
