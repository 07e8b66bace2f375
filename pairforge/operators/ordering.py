"""Order numbers of a whole table, without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that a table is ordered in, if the caller names no other number.
RANGES = 64


def with_order_numbers(rows: DataFrame, order: Sequence[str | Column], name: str, ranges: int = RANGES) -> DataFrame:
    """Number the rows from 0 in their order, without gaps.

    Rows are dealt by ranges of the order and numbered inside each range; a range's
    first number is the count of the rows before it, from one row per range.  The
    number of ranges is fixed, so the count and the numbering see the same ones.
    Rows of equal order are numbered in any order; with more than one row in
    ``ranges`` of one order value, that range is larger than the others.
    """
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the id holds the range in its upper bits and the place in the range below
    place = F.monotonically_increasing_id()
    parts = dealt.withColumn("_place", place).withColumns(
        {"_range": F.shiftright("_place", 33), "_inside": F.col("_place").bitwiseAND((1 << 33) - 1)}
    )
    counts = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range
    sizes = counts.agg(F.sort_array(F.collect_list(F.struct("_range", "_n"))).alias("sizes"))
    start = F.aggregate(
        F.filter("sizes", lambda size: size["_range"] < F.col("at._range")),
        F.lit(0).cast("long"),
        lambda total, size: total + size["_n"],
    )
    starts = sizes.select("sizes", F.explode("sizes").alias("at")).select("at._range", start.alias("_start"))
    numbered = parts.join(F.broadcast(starts), "_range")
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_start") + F.col("_inside")).cast("long").alias(name))
