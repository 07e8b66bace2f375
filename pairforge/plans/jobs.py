"""End-to-end jobs, each a chain of operators ending in one lazy table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.constants import MAX_TOKENS
from pairforge.functions.text import token_count
from pairforge.operators import lengths, pages, pairs, questions, recipes, split, summary, video
from pairforge.sources.writers import write_csv, write_splits


def _long_form(row: DataFrame, prefix: Column | None = None, ids: tuple[str, ...] = ()) -> DataFrame:
    """(metric, value) rows out of columns."""
    values = row.select(
        *ids, *[F.col(name).cast("double").alias(name) for name in row.columns if name not in ids]
    )
    names = [name for name in values.columns if name not in ids]
    melted = values.unpivot(list(ids), names, "metric", "value")
    metric = F.col("metric") if prefix is None else F.concat(prefix, F.lit("_"), "metric")
    return melted.select(metric.alias("metric"), "value")


def length_metrics(measured: DataFrame, max_length: int = MAX_TOKENS) -> DataFrame:
    """Length report, over-limit statistics and retention as (metric, value)."""
    return (
        _long_form(lengths.length_report(measured, max_length))
        .unionByName(_long_form(lengths.long_side_stats(measured, max_length), F.col("side"), ("side",)))
        .unionByName(_long_form(lengths.retention(measured, max_length)))
    )


def length_curation(
    rows: DataFrame,
    measured: DataFrame,
    key: str,
    out_dir: str,
    with_texts: Callable[[DataFrame], DataFrame],
    max_length: int = MAX_TOKENS,
    analysed: str = "train",
    split_column: str = "split",
    n_samples: int = 5,
) -> DataFrame:
    """Curate one split of ``rows`` by length; returns (metric, value).

    ``measured`` has key, split, lengths and blank marks of every row; it is
    written once (``lengths``), and all that follows reads it back.  The other
    splits and the kept rows of the analysed one go to ``splits``, the kept rows to
    ``csv``, and the first over-limit rows, for which alone ``with_texts`` builds
    texts, to ``samples``.  Metrics are those of ``length_metrics``, the rows
    written (``split_<name>``) and the lengths in ``samples``.
    """
    spark = rows.sparkSession
    measured.write.mode("overwrite").parquet(f"{out_dir}/lengths")
    measured = spark.read.schema(measured.schema).parquet(f"{out_dir}/lengths")
    mine = measured.filter(F.col(split_column) == analysed)
    kept = rows.filter(F.col(split_column) == analysed).join(
        lengths.length_filter(mine, max_length).select(key), key, "left_semi"
    )
    write_splits(rows, kept, analysed, f"{out_dir}/splits", split_column)
    written = spark.read.schema(rows.schema).parquet(f"{out_dir}/splits")
    write_csv(written.filter(F.col(split_column) == analysed), f"{out_dir}/csv")
    first = with_texts(lengths.first_long(mine, key, max_length, n_samples))
    sample = lengths.sample_long(first, key, max_length, n_samples)
    sample.write.mode("overwrite").json(f"{out_dir}/samples")
    samples = spark.read.schema(sample.schema).json(f"{out_dir}/samples")
    counts = written.groupBy(split_column).agg(F.count(F.lit(1)).cast("double").alias("value"))
    shown = samples.select("index", "chosen_length", "rejected_length")
    return (
        length_metrics(mine, max_length)
        .unionByName(counts.select(F.concat(F.lit("split_"), split_column).alias("metric"), "value"))
        .unionByName(_long_form(shown, F.concat(F.lit("sample_"), F.col("index").cast("string")), ("index",)))
    )


def build_pairs(
    recipe_table: DataFrame,
    bank: DataFrame,
    responses: DataFrame,
    session_id: str,
    timestamp: Column,
) -> DataFrame:
    """Questions joined to recipes and replies, as validated, stamped pairs."""
    asked = recipes.recipe_questions(recipe_table, bank)
    # a question whose prompt cannot be written never gets a pair
    usable = asked.filter(
        F.col("recipe_name").isNotNull()
        & F.col("ingredientes").isNotNull()
        & F.col("pasos").isNotNull()
        & F.col("tiempo").isNotNull()
        & F.col("dificultad").isNotNull()
        & F.col("racion").isNotNull()
    ).drop("ingredientes", "pasos", "tiempo", "dificultad", "racion", "valor_nutricional")
    answered = recipes.attach_responses(usable, responses)
    assembled = pairs.with_messages(pairs.with_metadata(answered))
    valid = pairs.valid_pairs(assembled.select(*pairs.PAIR_COLUMNS))
    return pairs.stamp(valid, session_id, timestamp)


def question_bank(recipe_table: DataFrame, replies: DataFrame, lenient: bool = False) -> DataFrame:
    """Bank rows from model replies (id, reply), with recipe id and name."""
    parsed = questions.parse_questions(replies.select("id", "reply"), "reply", lenient)
    named = parsed.join(recipe_table.select("id", "nombre"), "id")
    return questions.to_question_bank(named)


def pages_to_recipes(
    page_table: DataFrame, existing: DataFrame, rules: pages.PageRules = pages.PageRules()
) -> DataFrame:
    """Existing recipes followed by the records of pages not scraped before."""
    done = recipes.distinct_urls(existing)
    fresh = page_table.join(done, "url", "left_anti")
    return recipes.merge_recipes(existing, pages.recipe_records(fresh, rules).drop("page_id"))


def crawl_to_recipes(
    index_pages: DataFrame,
    fetched: DataFrame,
    existing: DataFrame,
    site: str,
    rules: pages.PageRules = pages.PageRules(),
    start: int = 0,
    max_links: int | None = None,
) -> DataFrame:
    """Existing recipes followed by those that the index pages lead to.

    Links of the index pages are kept by address, each once and in the order of
    their first place, cut to ``start`` and ``max_links`` and rid of the addresses
    of ``existing``; only addresses move for that.  Of ``fetched`` (page_id, url,
    html) the pages with such an address become records; a page that appears
    several times under one address counts once, with its smallest page_id.
    """
    links = pages.extract_links(index_pages, site, rules.content, distinct=True)
    if start or max_links:
        links = pages.link_slice(links, start, max_links)
    wanted = pages.pending_links(links, existing).select(F.col("href").alias("url"))
    # one page of an address is chosen by keys alone, before any markup moves
    first = fetched.groupBy("url").agg(F.min("page_id").alias("page_id")).join(wanted, "url", "left_semi")
    fresh = fetched.join(first, ["url", "page_id"], "left_semi").dropDuplicates(["page_id"])
    return recipes.merge_recipes(existing, pages.recipe_records(fresh, rules).drop("page_id"))


def video_enrichment(
    recipe_table: DataFrame,
    video_pages: DataFrame,
    segments: DataFrame,
    stop_words: list[str] | None = None,
    k: int = 5,
) -> DataFrame:
    """Like counts, transcripts and transcript summaries on recipes."""
    voted = video.attach_votes(recipe_table, video_pages)
    told = video.attach_transcripts(voted, segments)
    return summary.extractive_summary(
        told, ["id", "transcript_block"], "youtube_transcript", k, stop_words
    )


def preference_train_set(
    conversations: DataFrame, key: str, test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    rows = pairs.preference_rows(conversations)
    kept = pairs.keep_columns(rows, [key, "prompt", "chosen", "rejected"])
    return split.train_test_split(kept, key, test_size, seed)


def sft_train_set(
    rows: DataFrame, key: str, test_size: float = 0.1, seed: int = 42
) -> DataFrame:
    """Rendered single-turn texts with their split; ``sft_blocks`` packs them."""
    usable = pairs.single_turn(pairs.standardize_turns(pairs.drop_multi_turn(rows)))
    texts = pairs.keep_columns(pairs.sft_rows(usable), [key, "text"])
    return split.train_test_split(texts, key, test_size, seed)


def sft_blocks(
    rows: DataFrame,
    key: str,
    out_dir: str,
    max_len: int = 4096,
    test_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """(split, block, n_tokens, n_pieces, text): each split of the rendered texts,
    packed into blocks of ``max_len`` tokens that hold no text of the other.

    Texts are rendered, split and counted once (``texts``); both splits read that.
    A split without rows has no blocks.
    """
    spark = rows.sparkSession
    texts = sft_train_set(rows, key, test_size, seed).withColumn("n", token_count(F.col("text")))
    texts.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/texts")
    counted = spark.read.schema(texts.schema).parquet(f"{out_dir}/texts")
    packed = None
    for name in ("train", "test"):
        pieces = split.pack_sequences(counted.filter(F.col("split") == name), key, "text", max_len, seed, "n")
        blocks = split.packed_blocks(pieces).select(F.lit(name).alias("split"), "block", "n_tokens", "n_pieces", "text")
        packed = blocks if packed is None else packed.unionByName(blocks)
    return packed
