"""Small durable records next to a table: one file per record, put in place whole.

A record has a name, and putting it again replaces it, so whoever repeats a step
after a failure leaves one record.  Files lie in groups, to keep folders short.
Folder names begin with an underscore, which readers of the table skip.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pairforge.sources.readers import file_system, read_or_empty

#: Rows saved and failed by session, run and (for a stream) batch.
LEDGER = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("saved", T.LongType()),
        T.StructField("failed", T.LongType()),
    ]
)

#: Folders that the records of one kind are spread over.
GROUPS = 64


def ledger_of(folder: str) -> str:
    return f"{folder}/_ledger"


def _place(folder: str, name: str) -> str:
    return f"{folder}/group-{zlib.crc32(name.encode()) % GROUPS:02d}/{name}.json"


def put_record(spark: SparkSession, folder: str, name: str, rows: list[dict]) -> None:
    """Write the rows of a record, as JSON lines, in place of what it was before."""
    target, files = file_system(spark, _place(folder, name))
    # hidden until it is complete
    part, _ = file_system(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    out = files.create(part)
    try:
        out.write(bytearray("".join(json.dumps(row) + "\n" for row in rows).encode()))
    finally:
        out.close()
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"could not put {target} in place")


def drop_record(spark: SparkSession, folder: str, name: str) -> None:
    target, files = file_system(spark, _place(folder, name))
    files.delete(target, False)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all records of a ledger; one that is not there has none."""
    return read_or_empty(spark, folder, LEDGER, "json", recursiveFileLookup="true")


def own_id(spark: SparkSession, folder: str) -> str:
    """An id that belongs to a folder: made and kept there when first asked for."""
    target, files = file_system(spark, f"{folder}/owner-id")
    if not files.exists(target):
        part, _ = file_system(spark, f"{folder}/.owner-id-{uuid.uuid4().hex}")
        out = files.create(part)
        out.write(bytearray(uuid.uuid4().hex.encode()))
        out.close()
        files.rename(part, target)  # fails where another one was faster
        files.delete(part, False)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
