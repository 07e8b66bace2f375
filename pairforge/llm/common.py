"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to one numpy step; working arrays take some eight times as much.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors see.

    It lies below ``spark.checkpoint.dir``; only where that is unset (tests) a
    temporary folder takes its place.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pairforge-llm-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, *partition_by: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps start
    from the files and not from the work before them."""
    spark = frame.sparkSession
    path, schema = shared_folder(spark), frame.schema
    frame.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], size: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose column ``size`` adds up to about
    ``limit`` bytes; a larger row stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(size)), 0).to_pylist()
        start, total = 0, 0
        for row, n in enumerate(lengths):
            if total and total + n > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def with_texts(batch: pa.RecordBatch, column: str, texts: list[bytes | None]) -> pa.RecordBatch:
    """The batch with other UTF-8 texts in a column."""
    at = batch.schema.get_field_index(column)
    kind = batch.schema.field(at).type
    return batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.binary()).cast(kind))


#: Flags of the filter below.
FILTER_BITS = 20


def hash_flags(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """2^bits flags of the leading bits of a column of long hashes (the only one)."""
    name = hashes.columns[0]
    flags = np.zeros(1 << bits, bool)
    found = hashes.select(F.shiftrightunsigned(name, 64 - bits).cast("int").alias("flag")).distinct().toArrow()
    flags[found.column("flag").to_numpy()] = True
    return flags


def by_flag(frame: DataFrame, column: str, flags: np.ndarray, flagged: bool) -> DataFrame:
    """The rows whose long hash may be among those of the flags, or the rows whose
    hash surely is not; it spares a join most of its other rows.  Only the hashes
    go to Python.  With hashes far more than flags all flags are set; the join then
    meets all rows, and results are the same."""
    shared = frame.sparkSession.sparkContext.broadcast(np.packbits(flags))
    shift = np.uint64(64 - (len(flags).bit_length() - 1))

    @F.arrow_udf("boolean")
    def has_flag(hashes: pa.Array) -> pa.Array:
        flag = (hashes.to_numpy(zero_copy_only=False).view(np.uint64) >> shift).astype(np.int64)
        return pa.array(shared.value[flag >> 3] >> (7 - (flag & 7)).astype(np.uint8) & 1 != 0)

    return frame.where(has_flag(F.col(column)) == F.lit(flagged))


def hand_back() -> None:
    """Give what this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, whose worker hands back at the task's end what the
    task has freed.  Spark keeps idle workers beside those of later steps, and memory
    that none of them uses would still count for the executor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        hand_back()

    return task


_SHIPPED: set[str] = set()

#: Bytes of rows that go to Python at once.  Spark counts rows alone unless told
#: otherwise, and 10,000 texts have no bound in bytes, neither in the JVM's Arrow
#: buffers nor in the worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Cut the batches of this session by bytes too; a smaller bound of its own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def _bytes(size: str) -> int:
    """A size as Spark spells it: a number, perhaps with b, k, m, g or t (kb, mb, ...)."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([bkmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and bound what goes
    to Python at once."""
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="pairforge-"), "pairforge.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
        _SHIPPED.add(context.applicationId)
