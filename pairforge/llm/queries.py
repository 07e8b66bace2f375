"""Registered queries of this folder, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import blocks, counts, decontam, jaccard, neighbours, packing, periods, quality, repair, repeats, topk, toxicity, warc
from pairforge.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = blocks.write_token_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return blocks.read_token_blocks(pages, with_ids=False)


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=85)


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=400)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query
def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where("id % 50 = 0"), vectors, k=5)


ORACLE["op10_top_k_search"] = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages")))
    index = warc.capture_index(records)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


ORACLE["op9_warc_index"] = r"""
WITH page AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
         strlen(coalesce(html, '')) AS bytes
  FROM pages
), grouped AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id,
         lower(regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')) AS rest
  FROM page
), cut AS (
  SELECT *, regexp_replace(regexp_replace(regexp_extract(rest, '^([^/?]*)', 1), ':[0-9]*$', ''), '^www[0-9]*\.', '') AS host,
         regexp_extract(rest, '^[^/?]*(.*)$', 1) AS path
  FROM grouped
)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END AS url_key,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM cut
"""


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(documents, model, threshold=0.3)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, table(spark, sf_dir, "labels"))
    return quality.quality_scores(documents, model)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.periodic_runs(periods.planted_runs(documents), exponent=4, shortest=6)
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", F.array_min(ranked)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text in SQL: eight shifts for each byte."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    # a byte meets only the lowest eight bits of the sum so far
    codes = f"list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"


ORACLE["op12_periodic_runs"] = rf"""
WITH given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w, {crc32_sql("doc_id::VARCHAR")} AS h
  FROM documents
), shaped AS (
  SELECT doc_id, w, h // 10 AS g, len(w)::BIGINT AS n, h % 10 = 0 AND len(w) > 0 AS plant FROM given
), placed AS (
  SELECT *, CASE WHEN plant THEN g % n END AS a FROM shaped
), done AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed
), word AS (
  SELECT doc_id, n, i, CASE WHEN plant AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM done, unnest(range(n)) AS t(i)
), pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM word x JOIN word y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), per_doc AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing,
         min((-length, start, period)) AS best
  FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS left_over FROM word w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length)
  GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length, best[3]::BIGINT AS period,
       (-1000 * best[1]) // best[3] AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM documents d LEFT JOIN per_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_summary(repair.damaged(table(spark, sf_dir, "conversations"))).drop("path")


def _repair_sql() -> str:
    """The same repair as a walk over all rows that holds one label a state."""

    def add(label: str, cost: str, letter: str, line: str | None = None) -> str:
        text = f"{label}.t" if line is None else f"{label}.t || CASE WHEN {label}.t = '' THEN '' ELSE chr(10) END || {line}"
        return f"{{'c': {label}.c + {cost}, 'a': {label}.a || '{letter}', 't': {text}}}"

    def least(*labels: str) -> str:
        return f"list_min([{', '.join(labels)}])"

    none = "{'c': 1000000000000::BIGINT, 'a': '', 't': ''}"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN f IN (0, 3) AND i = '{initial}' THEN {add(state, 'more', 'K', 'line')} ELSE {none} END"

    def speak(state: str, role: str) -> str:
        return f"CASE WHEN f IN (0, 3) THEN {add(state, '3 + more', 'R', f"'{role}:' || text")} ELSE {none} END"

    asked = f"({add('s1', '3', 'I', "'user:'")})"
    return rf"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) AS copies(k) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS final
  FROM rows
), row_fault AS (
  SELECT *, role[1] AS i, role || ':' || text AS line, CASE WHEN final = '' THEN 1
           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
           WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
  FROM placed
), fault AS (
  SELECT *, CASE WHEN f = 3 THEN 3 ELSE 0 END AS more FROM row_fault
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), walk AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM ids
  UNION ALL
  SELECT conv_id, pos,
         {add("s0", "4", "D")} AS s0,
         {least(add("s1", "4", "D"), keep("s0", "s"))} AS s1,
         {least(add("s2", "4", "D"), keep("s0", "u"), keep("s1", "u"), keep("s3", "u"), speak("s0", "user"), speak("s1", "user"), speak("s3", "user"))} AS s2,
         {least(add("s3", "4", "D"), keep("s2", "a"), speak("s2", "assistant"))} AS s3
  FROM (
    SELECT o.* EXCLUDE (s3), {least("o.s3", add("o.s2", "3", "I", "'assistant:'"))} AS s3
    FROM (
      SELECT w.conv_id, r.pos, r.f, r.more, r.i, r.line, r.text, w.s0, w.s1, w.s3,
             {least("w.s2", *[add(f"w.s{k}", "3", "I", "'user:'") for k in (0, 1, 3)])} AS s2
      FROM walk w JOIN fault r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1) o)
), ends AS (
  SELECT conv_id, {least("s0", "s3", add("s2", "3", "I", "'assistant:'"))} AS one,
         {add(asked, "3", "I", "'assistant:'")} AS two
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), chosen AS (
  SELECT conv_id, {least("one", "two")} AS l FROM ends
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(f = 1) AS blank,
         count_if(f = 2) AS duplicate, count_if(f = 3) AS truncated,
         count_if(pos > 1 AND earlier || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM fault GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, l.c::BIGINT AS cost, l.a AS audit, sha256(l.t) AS repaired_sha256
FROM chosen c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE["op11_conversation_repair"] = _repair_sql()


@query
def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return neighbours.nearest(vectors.where("id % 50 = 0"), vectors, k=5)
