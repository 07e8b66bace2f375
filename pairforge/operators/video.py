"""Like counts and transcripts joined to recipes by video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.urls import like_count, video_id



def _join_key(rows: DataFrame, key: Column) -> Column:
    """Video id, or a value that matches nothing and differs from row to row.

    Rows without a video would otherwise all hash to one partition.
    """
    spread = F.concat(F.lit("!"), F.xxhash64(*rows.columns).cast("string"))
    return F.coalesce(key, spread)


def _has_url(url: Column) -> Column:
    return F.coalesce(url != "", F.lit(False))


def attach_votes(
    recipes: DataFrame, video_pages: DataFrame, url: str = "youtube_url"
) -> DataFrame:
    """Set ``votos`` from the page of the recipe's video.

    No url leaves ``votos`` as it is; a page that is missing or unreadable
    gives 0.  Only (video, count) pairs are shuffled, never page text.
    """
    counts = (
        video_pages.select("video_id", like_count(F.col("html")).alias("likes"))
        .filter(F.col("video_id").isNotNull())
        .groupBy(F.col("video_id").alias("_video"))
        .agg(F.max("likes").alias("_likes"))
    )
    before = F.col("votos") if "votos" in recipes.columns else F.lit(None).cast("long")
    keyed = recipes.withColumn("_video", _join_key(recipes, video_id(F.col(url))))
    votes = F.when(_has_url(F.col(url)), F.coalesce("_likes", F.lit(0))).otherwise(before)
    return keyed.join(counts, "_video", "left").withColumn("votos", votes).drop("_video", "_likes")


def transcripts(segments: DataFrame, block_size: int | None = None) -> DataFrame:
    """Segments (video_id, seq, text) joined by a space, in order.

    A video is one row.  With ``block_size`` it continues in further blocks, which
    joined by a space, in order, give the whole transcript.
    """
    block = F.floor(F.col("seq") / F.lit(block_size)).cast("long") if block_size else F.lit(0).cast("long")
    block = block.alias("transcript_block")
    ordered = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return (
        segments.filter(F.col("video_id").isNotNull())
        .groupBy("video_id", block)
        .agg(F.array_join(ordered["text"], " ").alias("transcript"))
    )


def attach_transcripts(
    recipes: DataFrame,
    segments: DataFrame,
    url: str = "youtube_url",
    block_size: int | None = None,
) -> DataFrame:
    """Set ``youtube_transcript``, or the fixed text that says why there is none."""
    texts = transcripts(segments, block_size).withColumnRenamed("video_id", "_video")
    vid = video_id(F.col(url))
    keyed = recipes.drop("youtube_transcript").withColumn("_id", vid)
    keyed = keyed.withColumn("_video", _join_key(recipes, F.col("_id")))
    text = (
        F.when(~_has_url(F.col(url)), F.lit(K.NO_VIDEO_URL))
        .when(F.col("_id").isNull(), F.lit(K.BAD_VIDEO_URL))
        .when(F.col("transcript").isNull(), F.concat(F.lit(f"{K.TRANSCRIPT_ERROR}: "), "_id", F.lit(".")))
        .otherwise(F.col("transcript"))
    )
    return (
        keyed.join(texts, "_video", "left")
        .withColumns(
            {
                "youtube_transcript": text,
                "transcript_block": F.coalesce("transcript_block", F.lit(0).cast("long")),
            }
        )
        .drop("_video", "_id", "transcript")
    )
