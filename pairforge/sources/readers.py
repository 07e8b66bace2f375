"""Readers with explicit schemas: JSON arrays, JSON lines, Parquet, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import constants as K
from pairforge import schemas
from pairforge.functions.replies import json_elements, salvaged_text
from pairforge.functions.text import strip

CORRUPT = "_corrupt_record"


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of records.

    One such file is read by one task; ``read_large_arrays`` splits it.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _unquoted(text: Column, inside: bool) -> Column:
    """The text without strings, where it begins outside or ``inside`` of one."""
    rest = F.regexp_replace(text, K.RX_STRING_REST, "") if inside else text
    return F.regexp_replace(rest, K.RX_STRING, "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _array_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Files cut at each ``}``: what a piece does to quotes and depth, if it begins
    outside of a string (0) and if inside (1)."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    quotes = F.regexp_count(F.regexp_replace("text", r"(?s)\\.", ""), F.lit('"'))
    moves = {
        f"move_{inside}": (
            _count(_unquoted(F.col("text"), bool(inside)), "[{")
            - _count(_unquoted(F.col("text"), bool(inside)), "]}")
            # the bracket that ends the piece, if it is not in a string
            - (quotes + inside + 1) % 2
        ).cast("long")
        for inside in (0, 1)
    }
    return raw.withColumns({"quotes": quotes.cast("long"), **moves})


def read_large_arrays(spark: SparkSession, path: str, schema: T.StructType, work: str) -> DataFrame:
    """Records of files that each hold one JSON array, every file split over tasks.

    A file is cut at each ``}``, and pieces of one record are put together again.
    Whether a piece begins inside a string, and how deep, follows from the pieces
    before it: sums inside each split of a file, then sums over the splits (one row
    each).  Both cases, in and out of a string, are summed, and the first sums tell
    which one holds.  Arrays hold objects and are complete; other elements and what
    follows the last record are passed over.  ``work`` is a folder for the pieces.
    """
    split = Window.partitionBy("file", "block").orderBy("at")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    pieces = _array_pieces(spark, path).withColumn("odd", odd)
    # sums for a split that begins outside (0) and inside (1) of a string
    sums = {
        f"depth_{start}": F.sum(F.when((F.col("odd") + start) % 2 == 0, F.col("move_0")).otherwise(F.col("move_1"))).over(upto)
        for start in (0, 1)
    }
    pieces.withColumns(sums).drop("move_0", "move_1").write.mode("overwrite").parquet(f"{work}/pieces")
    pieces = spark.read.parquet(f"{work}/pieces")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), *[F.max_by(f"depth_{s}", "at").alias(f"depth_{s}") for s in (0, 1)]
    )
    begun = splits.withColumn("start", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    moved = F.when(F.col("start") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    begun = begun.select("file", "block", "start", F.coalesce(F.sum(moved).over(earlier), F.lit(0)).alias("base"))
    depth = F.col("base") + F.when(F.col("start") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    closes = (F.col("odd") + F.col("start") + F.col("quotes")) % 2 == 0
    known = pieces.join(begun, ["file", "block"]).select("file", "block", "at", "text", (closes & (depth == 1)).cast("long").alias("ends"))
    # a record's number in its file: the ends before it
    inside = F.coalesce(F.sum("ends").over(before), F.lit(0))
    total = known.groupBy("file", "block").agg(F.sum("ends").alias("ends"))
    first = total.select("file", "block", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("first"))
    numbered = known.withColumn("inside", inside).join(first, ["file", "block"])
    part = F.sort_array(F.collect_list(F.struct("block", "at", "text")))
    records = numbered.groupBy("file", (F.col("first") + F.col("inside")).alias("record")).agg(part["text"].alias("parts"))
    body = F.regexp_replace(F.concat(F.array_join("parts", "}"), F.lit("}")), r"^[\s,\[]*", "")
    parsed = records.select(F.when(F.startswith(body, F.lit("{")), F.from_json(body, schema)).alias("row"))
    return parsed.filter(F.col("row").isNotNull()).select("row.*")


def file_system(spark: SparkSession, path: str):
    """The path and its file system, as Spark's JVM sees them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = file_system(spark, path)
    return files.exists(target)


def read_pairs(
    spark: SparkSession,
    folder: str,
    session_id: str | None = None,
    schema: T.StructType = schemas.SESSION_PAIR,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Saved pairs (JSON lines, one folder per session); blank lines are skipped.

    Good rows around a bad line are kept, and the bad text is exposed in
    ``_corrupt_record``; ``mode="FAILFAST"`` stops on it instead.  Where the folder
    has a ledger, only the runs it names are read.
    """
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(schema).option("mode", mode).json(folder)
    if "run" in rows.columns and path_exists(spark, f"{folder}/_ledger"):
        finished = spark.read.schema("run string").option("recursiveFileLookup", True).json(f"{folder}/_ledger")
        # the folder names are text, whatever Spark takes them for
        rows = rows.withColumn("run", F.col("run").cast("string")).join(finished.distinct(), "run", "left_semi")
    pairs = rows.select(*schema.fieldNames())
    if session_id is not None:
        pairs = pairs.filter(F.col("session_id") == session_id)
    return pairs


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json", **options: str
) -> DataFrame:
    """An absent path reads as an empty table."""
    if path_exists(spark, path):
        return spark.read.schema(schema).format(file_format).options(**options).load(path)
    return spark.createDataFrame([], schema)


def salvage_arrays(texts: DataFrame, text: str, element: T.StructType) -> DataFrame:
    """Explode array texts; of one that was cut off, the complete elements.

    Adds ``salvaged``; a text that stays unreadable gives no rows.
    """
    body = F.col(text)
    keep = [name for name in texts.columns if name != text]
    repaired = texts.select(
        *keep,
        salvaged_text(body).alias("_body"),
        (salvaged_text(body) != strip(body)).alias("salvaged"),
    )
    return (
        repaired.select(*keep, "salvaged", F.posexplode_outer(json_elements(F.col("_body"))))
        .filter(F.col("pos").isNotNull())
        .select(*keep, "salvaged", F.col("pos").cast("long").alias("position"), F.from_json("col", element).alias("_row"))
        .select(*keep, "salvaged", "position", "_row.*")
    )


def pick_split(rows: DataFrame, split: str = "split", prefer: str = "train") -> DataFrame:
    """Rows of the preferred split, or of the first one by name without it.

    The choice is a one-value subquery over the partition column, so only the
    chosen split's files are read.
    """
    name = F.col(split)
    chosen = rows.agg(
        F.coalesce(F.max(F.when(name == prefer, name)), F.min(name)).alias("chosen")
    ).scalar()
    return rows.filter(name == chosen)


def list_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions with saved pairs, latest first: those the ledger names, and raw
    ``session_<id>.jsonl`` files.  No pair is read."""
    target, files = file_system(spark, f"{folder}/session_*.jsonl")
    names = [(status.getPath().getName(),) for status in files.globStatus(target) or []]
    raw = spark.createDataFrame(names, "file string").select(session_of_file(F.col("file")).alias("session_id"))
    saved = spark.createDataFrame([], "session_id string, saved long")
    if path_exists(spark, f"{folder}/_ledger"):
        saved = spark.read.schema(saved.schema).option("recursiveFileLookup", True).json(f"{folder}/_ledger")
    named = saved.filter(F.col("saved") > 0).select("session_id").unionByName(raw)
    return named.distinct().orderBy(F.col("session_id").desc())


def read_session_files(spark: SparkSession, folder: str, schema: T.StructType = schemas.DPO_PAIR) -> DataFrame:
    """Pairs of raw ``session_<id>.jsonl`` files, with the session of each file."""
    rows = spark.read.schema(schema).json(f"{folder}/session_*.jsonl")
    return rows.select("*", session_of_file(F.col("_metadata.file_name")).alias("session_id"))


def session_of_file(path: Column) -> Column:
    """Session id out of a raw file name, for folders that are not partitioned."""
    return F.regexp_extract(path, r"session_(.+)\.jsonl", 1)
