"""Seeded splits, sequence packing and token clipping.

Row order is defined by ``md5(key:seed)``, so it does not depend on partition
layout.  Rows are grouped by the first four hex digits of that hash: at most
65,536 evenly filled buckets, which is the size bound of every small table
below.  Keys are unique per row.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import token_count

BUCKET_DIGITS = 4


def order_hash(key: str | Column, seed: int = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def _bucket(hashed: Column) -> Column:
    return F.substring(hashed, 1, BUCKET_DIGITS)


def _cut_hash(hashes: DataFrame, test_size: float) -> Column:
    """The ceil(n * test_size)-th smallest hash, as a one-value subquery.

    A histogram over buckets finds the bucket the cut falls in; only that
    bucket's hashes are put in order.
    """
    share = Decimal(str(test_size))
    histogram = hashes.groupBy(_bucket(F.col("h")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    wanted = F.ceil(F.sum("n") * F.lit(share)).cast("long")
    start = F.struct(
        F.lit(0).cast("long").alias("seen"),
        F.lit(None).cast("string").alias("bucket"),
        F.lit(None).cast("long").alias("rank"),
    )
    spot = (
        histogram.agg(
            wanted.alias("wanted"),
            F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("bars"),
        )
        .select(
            F.aggregate(
                "bars",
                start,
                lambda at, bar: F.struct(
                    (at["seen"] + bar["n"]).alias("seen"),
                    F.when(
                        at["bucket"].isNull() & (at["seen"] + bar["n"] >= F.col("wanted")), bar["bucket"]
                    ).otherwise(at["bucket"]).alias("bucket"),
                    F.when(
                        at["bucket"].isNull() & (at["seen"] + bar["n"] >= F.col("wanted")),
                        F.col("wanted") - at["seen"],
                    ).otherwise(at["rank"]).alias("rank"),
                ),
            ).alias("spot")
        )
        .scalar()
    )
    in_order = (
        Window.partitionBy(_bucket(F.col("h")))
        .orderBy("h")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # counted per hash first, so copies of one key are a single row here
    near = (
        hashes.filter(_bucket(F.col("h")) == spot["bucket"])
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reached", F.sum("n").over(in_order))
    )
    return near.filter(F.col("reached") >= spot["rank"]).agg(F.min("h").alias("cut")).scalar()


def train_test_split(
    rows: DataFrame, key: str, test_size: float, seed: int = 42, exact: bool = True
) -> DataFrame:
    """Add ``split`` (``train`` / ``test``) without moving any row.

    ``exact`` puts ceil(n * test_size) rows into test; otherwise each row falls
    into test with that probability, from its hash alone.  Rows that share a key
    always land on the same side.
    """
    if not 0 <= test_size <= 1:
        raise ValueError("test_size is a share from 0 to 1")
    if test_size in (0, 1):
        return rows.withColumn("split", F.lit("test" if test_size else "train"))
    hashed = order_hash(key, seed)
    if exact:
        cut = _cut_hash(rows.select(hashed.alias("h")), test_size)
        in_test = hashed <= cut
    else:
        threshold = math.floor(Decimal(str(test_size)) * 16**8)
        in_test = F.substring(hashed, 1, 8) < F.lit(f"{threshold:08x}")
    return rows.withColumn("split", F.when(in_test, F.lit("test")).otherwise("train"))


def _bucket_offsets(sizes: DataFrame) -> DataFrame:
    """Tokens before each bucket, from the per-bucket totals.

    Running sums are taken inside each group of 256 buckets; the (at most 256)
    group totals travel as one array.
    """
    totals = sizes.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn(
        "group", F.substring("bucket", 1, 2)
    )
    groups = totals.groupBy("group").agg(F.sum("n").alias("n"))
    bars = groups.agg(F.collect_list(F.struct("group", "n")).alias("bars")).scalar()
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "bucket", "group", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inner"), bars.alias("bars")
    )
    outer = F.aggregate(
        F.filter("bars", lambda bar: bar["group"] < F.col("group")),
        F.lit(0).cast("long"),
        lambda total, bar: total + bar["n"],
    )
    return before.select("bucket", (F.col("inner") + outer).alias("offset"))


def pack_sequences(
    rows: DataFrame,
    key: str,
    text: str = "text",
    max_len: int = 4096,
    seed: int = 42,
    n_tokens: str | None = None,
) -> DataFrame:
    """Lay all texts end to end in hash order and cut every ``max_len`` tokens.

    Returns one row per piece: block, position in the block, source key, first
    token and number of tokens taken from the source, and the piece itself.  A
    text that crosses a block border gives a piece on each side.  The layout is
    that of one global sequence, though no task sees more than one bucket.
    ``n_tokens`` names a column with known lengths, so they are not recounted.
    """
    counted = rows.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        order_hash(key, seed).alias("h"),
        (F.col(n_tokens) if n_tokens else token_count(F.col(text))).alias("n"),
    )
    counted = counted.withColumn("bucket", _bucket(F.col("h")))
    offsets = _bucket_offsets(counted.select("bucket", "n"))
    inside = Window.partitionBy("bucket").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)
    size = F.lit(max_len)
    placed = (
        # at most 65,536 rows, one per bucket
        counted.join(F.broadcast(offsets), "bucket")
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("end", F.col("start") + F.col("n"))
        .withColumn("pieces", F.regexp_extract_all("text", F.lit(K.RX_TOKEN_SPACED), F.lit(0)))
    )
    first = F.floor(F.col("start") / size).cast("long")
    last = F.floor((F.col("end") - 1) / size).cast("long")
    blocks = F.when(F.col("n") > 0, F.sequence(first, last))
    cut = placed.select("key", "start", "end", "pieces", F.explode(blocks).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * size)
    finish = F.least(F.col("end"), (F.col("block") + 1) * size)
    taken = (finish - begin).cast("int")
    offset = (begin - F.col("start")).cast("int")
    return cut.select(
        "block",
        (begin - F.col("block") * size).alias("block_offset"),
        "key",
        offset.cast("long").alias("token_from"),
        taken.cast("long").alias("n_tokens"),
        F.array_join(F.slice("pieces", offset + 1, taken), "").alias("piece"),
    )


def packed_blocks(pieces: DataFrame) -> DataFrame:
    """Training blocks: the pieces of a block in order (at most ``max_len`` each)."""
    entry = F.array_sort(F.collect_list(F.struct("block_offset", "piece")))
    return pieces.groupBy("block").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_pieces"),
        F.array_join(entry["piece"], " ").alias("text"),
    )


def _clip(text: Column, limit: Column, keep: str) -> Column:
    """First or last ``limit`` tokens of a text, with the spacing between them."""
    pieces = F.regexp_extract_all(text, F.lit(K.RX_TOKEN_SPACED), F.lit(0))
    size = F.size(pieces)
    start = F.greatest(size - limit, F.lit(0)) + 1 if keep == "end" else F.lit(1)
    kept = F.array_join(F.slice(pieces, start, limit), "")
    return F.when(size > limit, kept).otherwise(text)


def clip_pairs(
    rows: DataFrame, max_prompt: int = 350, max_total: int = 2500, keep_prompt: str = "end"
) -> DataFrame:
    """Bound the prompt, then prompt plus reply, in tokens.

    Adds ``prompt_clipped`` and ``reply_clipped``.  Replies keep their start.
    """
    prompt_size = token_count(F.col("prompt")).cast("int")
    room = F.lit(max_total) - F.least(prompt_size, F.lit(max_prompt))
    longer = (token_count(F.col("chosen")) > room) | (token_count(F.col("rejected")) > room)
    rest = [name for name in rows.columns if name not in ("prompt", "chosen", "rejected")]
    return rows.select(
        *rest,
        _clip(F.col("prompt"), F.lit(max_prompt), keep_prompt).alias("prompt"),
        _clip(F.col("chosen"), room, "start").alias("chosen"),
        _clip(F.col("rejected"), room, "start").alias("rejected"),
        (prompt_size > max_prompt).alias("prompt_clipped"),
        longer.alias("reply_clipped"),
    )
