"""Sinks: Parquet, appended sessions, published dataset, CSV, splits, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.operators.pairs import keep_columns, stamp, valid_pairs
from pairforge.schemas import PAIR_COLUMNS
from pairforge.sources.ledger import drop_record, ledger_of, put_record


def write_parquet(rows: DataFrame, path: str, max_records: int | None = None) -> None:
    """One sink for every conversion variant; ``max_records`` bounds file size."""
    writer = rows.write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def save_sessions(pairs: DataFrame, folder: str, timestamp: str, run: str) -> None:
    """Save the valid pairs of every ``session_id``, stamped, in one write.

    The rows belong to ``run``: its folder ``run=...`` is replaced whole, so a run
    that is repeated after a failure leaves each row once, and no session that it no
    longer has; other runs stay.  The run's ledger record (rows saved a session) is
    taken away before the write and put back after it, and ``read_pairs`` takes only
    runs with a record, so half a run is never read.
    """
    spark = pairs.sparkSession
    drop_record(spark, ledger_of(folder), run)
    stamped = stamp(valid_pairs(pairs), F.col("session_id"), F.to_timestamp(F.lit(timestamp)))
    home = f"{folder}/run={run}"
    stamped.write.mode("overwrite").partitionBy("session_id").json(home)
    saved = spark.read.schema("session_id string").json(home).groupBy("session_id").agg(F.count(F.lit(1)).alias("saved"))
    rows = [{"session_id": r["session_id"], "run": run, "batch_id": None, "saved": r["saved"], "failed": None} for r in saved.collect()]
    put_record(spark, ledger_of(folder), run, rows)


def append_pairs(pairs: DataFrame, folder: str, session_id: str, timestamp: str, run: str | None = None) -> None:
    """``save_sessions`` for one session; without a name of its own the run is the
    session, so that a repeated append leaves the rows once."""
    save_sessions(pairs.withColumn("session_id", F.lit(session_id)), folder, timestamp, run or session_id)


def publish_pairs(pairs: DataFrame, path: str, validate: bool = True) -> int:
    """Write the final dataset without session columns; returns the row count.

    The count is observed on the write itself, so the input is read once.
    """
    rows = keep_columns(valid_pairs(pairs) if validate else pairs, PAIR_COLUMNS)
    seen = Observation("published")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    return seen.get["rows"]


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with header; nested columns become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [
        F.to_json(F.col(f"`{field.name}`")).alias(field.name)
        if isinstance(field.dataType, nested)
        else F.col(f"`{field.name}`")
        for field in rows.schema.fields
    ]
    (
        rows.select(*flat)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_splits(
    rows: DataFrame, filtered: DataFrame, analysed: str, path: str, split: str = "split"
) -> None:
    """All splits, with the analysed one replaced by its filtered rows."""
    others = rows.filter(~F.col(split).eqNullSafe(analysed))
    others.unionByName(filtered).write.mode("overwrite").partitionBy(split).parquet(path)


def profile(rows: DataFrame, order: str, n: int = 5) -> DataFrame:
    """Row count and column list next to the first ``n`` rows as JSON text."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    head = rows.orderBy(order).limit(n)
    return head.select(
        F.col(order).alias("row_key"),
        total.alias("n_rows"),
        F.lit(", ".join(rows.columns)).alias("columns"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in rows.columns])).alias("row_json"),
    )
