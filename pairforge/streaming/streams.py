"""Incremental jobs: new files in, validated rows appended, restart where left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairforge import schemas
from pairforge.operators.pages import PageRules, recipe_records
from pairforge.operators.pairs import flatten_pairs, is_valid_pair, stamp
from pairforge.sources.ledger import ledger_of, own_id, put_record, read_ledger

def _run(writer, checkpoint: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def save_batch(
    batch: DataFrame, batch_id: int, out_dir: str, run: str, session_id: str, timestamp: Column
) -> None:
    """The valid pairs of one batch, stamped, and the batch's row in the ledger.

    Rows and ledger row are named by run and batch and replace what an earlier,
    unfinished attempt left, so a repeated batch counts once.  Both counts are
    observed on the write itself.
    """
    ok, seen = is_valid_pair(), Observation(f"batch-{batch_id}")
    counted = batch.observe(seen, F.count_if(ok).alias("saved"), F.count_if(~ok).alias("failed"))
    name = f"{run}-{batch_id:09d}"
    rows = stamp(counted.filter(ok), session_id, timestamp)
    rows.write.mode("overwrite").partitionBy("session_id").json(f"{out_dir}/run={name}")
    row = {"session_id": session_id, "run": name, "batch_id": batch_id, **seen.get}
    put_record(batch.sparkSession, ledger_of(out_dir), name, [row])


def stream_pairs(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    session_id: str,
    timestamp: Column | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Save the valid pairs of files not seen before, stamped, as JSON lines.

    A checkpoint folder is a run: a restart goes on in it, and another folder
    starts another run beside it.  ``stream_outcome`` tells saved and failed
    counts of every batch of every run.
    """
    run = own_id(spark, f"{checkpoint}-run")
    when = F.current_timestamp() if timestamp is None else timestamp

    def save(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, batch_id, out_dir, run, session_id, when)

    pairs = spark.readStream.schema(schemas.DPO_PAIR).option("maxFilesPerTrigger", max_files).json(in_dir)
    return _run(pairs.writeStream.foreachBatch(save), checkpoint)


def stream_outcome(spark: SparkSession, out_dir: str) -> DataFrame:
    """(session_id, run, batch_id, saved, failed) of every batch saved below a folder,
    whichever run or session of Spark wrote it."""
    return read_ledger(spark, ledger_of(out_dir)).filter(F.col("batch_id").isNotNull())


def stream_flatten(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files: int = 1000,
    source: str = "metadata",
) -> StreamingQuery:
    """JSON pairs in, flat Parquet rows out, a bounded number of files at a time."""
    schema = schemas.DPO_PAIR if source == "metadata" else schemas.PAIR_RECORD
    pairs = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(in_dir)
    rows = flatten_pairs(pairs, source)
    return _run(rows.writeStream.format("parquet").outputMode("append").option("path", out_dir), checkpoint)


def unseen_pages(pages: DataFrame) -> DataFrame:
    """Readable pages of a stream whose address did not come before.

    The addresses seen are keyed state of the stream, kept with its checkpoint, so
    nothing that was saved is read again.  Of pages with one address the first to
    arrive stays; pages without an address all stay.
    """
    own = F.when(F.col("url").isNull(), F.col("page_id"))
    return pages.filter(F.col("html").isNotNull()).withColumn("_own", own).dropDuplicates(["url", "_own"]).drop("_own")


def stream_pages(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    rules: PageRules = PageRules(),
    max_files: int = 1000,
) -> StreamingQuery:
    """Recipe records of pages whose address was not scraped yet.

    Each batch owns the folder ``batch=<run>-<id>`` and overwrites it, so a batch
    that is run again after a failure leaves the same addresses.
    """
    output, run = f"{out_dir}/records", own_id(spark, f"{checkpoint}-run")

    def save(batch: DataFrame, batch_id: int) -> None:
        recipe_records(batch, rules).write.mode("overwrite").parquet(f"{output}/batch={run}-{batch_id:09d}")

    pages = spark.readStream.schema(schemas.PAGE).option("maxFilesPerTrigger", max_files).parquet(in_dir)
    return _run(unseen_pages(pages).writeStream.foreachBatch(save), checkpoint)
