"""Registered queries: one per operator, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge import schemas
from pairforge.functions import chat, replies, text, urls
from pairforge.operators import abbreviations, batches, lengths, pages, pairs, questions, recipes, split, summary, video
from pairforge.operators.vocabulary import vocabulary_token_counts
from pairforge.plans import derived as D
from pairforge.plans import jobs
from pairforge.plans import oracle as O
from pairforge.session import scratch_path, tune
from pairforge.sources import readers, writers
from pairforge.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
MAX = 150


def query(name: str, sql: str | None = None, extra: str = "") -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql, extra)
        return fn

    return register


def joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def flat(rows: DataFrame, *extra: str) -> DataFrame:
    """Scalar columns of nested pairs, for comparison."""
    return rows.select(
        *extra,
        F.get("messages", F.lit(0))["content"].alias("system_text"),
        F.get("messages", F.lit(1))["content"].alias("question"),
        "chosen",
        "rejected",
        *[F.col(f"metadata.{n}").alias(n) for n in schemas.PAIR_METADATA.fieldNames()],
    )


FLAT_SQL = """sys as system_text, usr as question, chosen, rejected, recipe_id, recipe_name, category, context,
  difficulty_level, 'N/A' as recipe_category, 'Ecuador' as recipe_country"""
STAMP_SQL = "'2025-01-02T03:04:05.000000' as timestamp"


# --- sources ------------------------------------------------------------------


BANK_ROWS_SQL = """select recipe_id, recipe_name, questions, questions_category, question_type
       from d_question where recipe_id is not null"""


def _bank_arrays(spark, sf_dir) -> str:
    """The question bank as files of one JSON array each."""
    path = scratch_path(spark, "bank")
    bank = questions.with_recipe_id(D.d_question(spark, sf_dir))
    row = F.struct("recipe_id", "recipe_name", "questions", "questions_category", "question_type")
    # 1024 recipes and 4096 positions bound each array
    group, block = F.floor(F.col("recipe_id") / 1024), F.floor(F.col("position") / 4096)
    arrays = bank.groupBy(group.alias("recipes"), block.alias("block")).agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("scan_json_array", BANK_ROWS_SQL)
def _(spark, sf_dir):
    return readers.read_records(spark, _bank_arrays(spark, sf_dir), schemas.QUESTION)


@query("scan_large_array", BANK_ROWS_SQL)
def _(spark, sf_dir):
    return readers.read_large_arrays(spark, _bank_arrays(spark, sf_dir), schemas.QUESTION, scratch_path(spark, "cut"))


def _saved_sessions(spark, sf_dir) -> str:
    """Every pair saved under its session, as a run would leave it."""
    folder = scratch_path(spark, "sessions")
    rows = D.d_session_pair(spark, sf_dir).select(*schemas.PAIR_COLUMNS, "session_id")
    writers.save_sessions(rows, folder, D.STAMP, "one")
    return folder


@query(
    "scan_jsonl",
    f"select {FLAT_SQL}, session_id, {STAMP_SQL} from valid_pair where session_id = {O.lit(D.SESSIONS[1])}",
)
def _(spark, sf_dir):
    saved = readers.read_pairs(spark, _saved_sessions(spark, sf_dir), D.SESSIONS[1])
    good = saved.filter(F.col(readers.CORRUPT).isNull())
    return flat(good, "session_id", "timestamp")


@query("scan_optional", "select cast(page_id as bigint) as page_id, url from pages")
def _(spark, sf_dir):
    there = readers.read_or_empty(spark, f"{sf_dir}/pages.parquet", schemas.PAGE, "parquet")
    absent = readers.read_or_empty(spark, f"{sf_dir}/no_such_pages.parquet", schemas.PAGE, "parquet")
    return there.unionByName(absent).select("page_id", "url")


@query(
    "salvage_json_array",
    """select conv_id, turn, cast(p.k as bigint) as position, text as question, conv_id % 3 <> 0 as salvaged
       from conversations, (select unnest([0, 1]) as k) p
       where role = 'user' and (conv_id % 3 <> 2 or p.k = 0)""",
)
def _(spark, sf_dir):
    turns = D.table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    element = F.to_json(F.struct(F.col("text").alias("question")))
    whole = F.concat(F.lit(" ["), element, F.lit(", "), element, F.lit("]\n"))
    kind = F.col("conv_id") % 3
    body = (
        F.when(kind == 0, whole)
        .when(kind == 1, F.regexp_replace(whole, r"\]\s*\z", ""))
        .otherwise(F.regexp_replace(whole, r"\}\]\s*\z", ""))
    )
    return readers.salvage_arrays(
        turns.select("conv_id", "turn", body.alias("body")), "body", schemas.RAW_QUESTION
    ).select("conv_id", "turn", F.col("position"), "question", "salvaged")


@query("scan_parquet", "select doc_id, lang, n_chars from documents")
def _(spark, sf_dir):
    return spark.read.schema("doc_id long, lang string, n_chars long").parquet(f"{sf_dir}/documents.parquet")


@query("pick_split", "select doc_id, lang as split from documents where lang = (select min(lang) from documents)")
def _(spark, sf_dir):
    path = scratch_path(spark, "splits")
    docs = D.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("split"))
    docs.write.partitionBy("split").parquet(path)
    stored = spark.read.schema("doc_id long, split string").parquet(path)
    return readers.pick_split(stored)


@query("list_sessions", "select distinct session_id from valid_pair")
def _(spark, sf_dir):
    return readers.list_sessions(spark, _saved_sessions(spark, sf_dir))


# --- sinks --------------------------------------------------------------------


@query(
    "sink_parquet",
    """select coalesce(chosen, '') as chosen, coalesce(rejected, '') as rejected, recipe_id, recipe_name, category
       from d_pair""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "flat")
    writers.write_parquet(pairs.flatten_pairs(D.d_pair(spark, sf_dir)), path)
    return spark.read.schema(schemas.FLAT_PAIR).parquet(path)


@query(
    "sink_jsonl_append",
    f"""select {FLAT_SQL}, session_id, {STAMP_SQL} from valid_pair
        union all select {FLAT_SQL}, session_id, {STAMP_SQL} from valid_pair where session_id = {O.lit(D.SESSIONS[0])}""",
)
def _(spark, sf_dir):
    folder = _saved_sessions(spark, sf_dir)
    # a second run that is repeated, and one that never finished
    again = D.d_session_pair(spark, sf_dir).filter(F.col("session_id") == D.SESSIONS[0]).select(*schemas.PAIR_COLUMNS)
    for _attempt in range(2):
        writers.append_pairs(again, folder, D.SESSIONS[0], D.STAMP, "two")
    again.limit(1).write.json(f"{folder}/run=three/session_id={D.SESSIONS[0]}")
    return flat(readers.read_pairs(spark, folder), "session_id", "timestamp")


@query("sink_json_dataset", f"select {FLAT_SQL}, (select count(*) from valid_pair) as n_published from valid_pair")
def _(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    saved = readers.read_pairs(spark, _saved_sessions(spark, sf_dir), mode="FAILFAST")
    count = writers.publish_pairs(saved, path)
    published = spark.read.schema(schemas.DPO_PAIR).option("mode", "FAILFAST").json(path)
    return flat(published).withColumn("n_published", F.lit(count).cast("long"))


@query("sink_csv", "select conv_id, chosen_length, rejected_length, chosen_text from measured where chosen_text <> ''")
def _(spark, sf_dir):
    path = scratch_path(spark, "csv")
    measured = lengths.with_lengths(D.d_conv(spark, sf_dir))
    writers.write_csv(measured.select("conv_id", "chosen", "chosen_length", "rejected_length"), path)
    raw = (
        spark.read.schema("conv_id long, chosen string, chosen_length long, rejected_length long")
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    back = chat.conversation_to_text(chat.parse_conversation(F.col("chosen")))
    return raw.select("conv_id", "chosen_length", "rejected_length", back.alias("chosen_text")).filter(
        F.col("chosen_text") != ""
    )


@query(
    "sink_splits",
    f"""select conv_id, case when conv_id % 3 = 0 then 'eval' else 'train' end as split from measured
        where conv_id % 3 = 0 or (chosen_length <= {MAX} and rejected_length <= {MAX} and not blank)""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "splits")
    part = F.when(F.col("conv_id") % 3 == 0, "eval").otherwise("train")
    rows = D.d_conv(spark, sf_dir).withColumn("split", part)
    train = lengths.with_lengths(rows.filter(F.col("split") == "train"))
    kept = lengths.length_filter(train, MAX).drop(*lengths.MEASURED, *lengths.BLANKS)
    writers.write_splits(rows, kept, "train", path)
    return spark.read.parquet(path).select("conv_id", "split")


@query(
    "table_profile",
    """select doc_id as row_key, (select count(*) from documents) as n_rows, 'doc_id, lang, n_chars' as columns,
         '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}' as row_json
       from documents order by doc_id limit 5""",
)
def _(spark, sf_dir):
    return writers.profile(D.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 5)


# --- projections ----------------------------------------------------------------


@query(
    "rename_map",
    """select recipe_id, recipe_name, questions, questions_category, question_type from d_question""",
)
def _(spark, sf_dir):
    bank = D.d_question(spark, sf_dir)
    raw = bank.select(
        F.col("recipe_id").alias("id"),
        F.col("recipe_name").alias("nombre"),
        F.when(F.col("questions") != "", F.col("questions")).alias("question"),
        F.col("questions_category").alias("category"),
        "question_type",
    )
    return questions.to_question_bank(raw)


@query(
    "flatten_pairs",
    """select 'metadata' as source, coalesce(chosen, '') as chosen, coalesce(rejected, '') as rejected,
         recipe_id, recipe_name, category from d_pair
       union all
       select 'record', coalesce(chosen, ''), coalesce(rejected, ''), null, null, null from d_pair""",
)
def _(spark, sf_dir):
    rows = D.d_pair(spark, sf_dir).withColumns(
        {
            "recipe_id": F.lit(None).cast("long"),
            "recipe_name": F.lit(None).cast("string"),
            "category": F.lit(None).cast("string"),
        }
    )
    both = [
        pairs.flatten_pairs(rows, source).select(F.lit(source).alias("source"), "*")
        for source in ("metadata", "record")
    ]
    return both[0].unionByName(both[1])


@query(
    "role_content",
    "select conv_id, sys as system_prompt, coalesce(usr, '') as question, '' as tool_text from d_pair",
)
def _(spark, sf_dir):
    messages = F.col("messages")
    return D.d_pair(spark, sf_dir).select(
        "conv_id",
        chat.role_content(messages, "system").alias("system_prompt"),
        chat.role_content(messages, "user").alias("question"),
        chat.role_content(messages, "tool").alias("tool_text"),
    )


@query("strip_session_cols", f"select {FLAT_SQL} from d_session_pair")
def _(spark, sf_dir):
    return flat(pairs.strip_session_columns(D.d_session_pair(spark, sf_dir)))


@query("keep_columns", "select chosen, rejected from d_pair")
def _(spark, sf_dir):
    return pairs.keep_columns(D.d_pair(spark, sf_dir), ["prompt", "chosen", "rejected"])


def _asked(spark, sf_dir) -> DataFrame:
    joined = recipes.recipe_questions(D.recipe_texts(spark, sf_dir), D.d_question(spark, sf_dir))
    return D.with_recipe_fields(joined, "recipe_id")


@query(
    "pair_metadata",
    f"""select question, recipe_id, recipe_name, category, question_type as context,
         {O.difficulty("category")} as difficulty_level, coalesce(categoria, 'N/A') as recipe_category,
         coalesce(pais, 'Ecuador') as recipe_country from asked""",
)
def _(spark, sf_dir):
    return pairs.with_metadata(_asked(spark, sf_dir)).select("question", "metadata.*")


@query(
    "pair_messages",
    f"""select recipe_id, 'system' as role_1, {O.system_text("category")} as content_1, 'user' as role_2,
         question as content_2 from asked""",
)
def _(spark, sf_dir):
    rows = pairs.with_messages(_asked(spark, sf_dir))
    return rows.select(
        "recipe_id",
        *[
            F.get("messages", F.lit(i))[field].alias(f"{field}_{i + 1}")
            for i in (0, 1)
            for field in ("role", "content")
        ],
    )


@query(
    "pair_to_conversations",
    """select conv_id, cast(3 as bigint) as n_messages, 'assistant' as last_role, chosen as last_chosen,
         rejected as last_rejected, sys as first_content from d_pair""",
)
def _(spark, sf_dir):
    rows = pairs.to_conversations(D.d_pair(spark, sf_dir))
    return rows.select(
        "conv_id",
        F.size("chosen").cast("long").alias("n_messages"),
        chat.last_message(F.col("chosen"))["role"].alias("last_role"),
        chat.last_message(F.col("chosen"))["content"].alias("last_chosen"),
        chat.last_message(F.col("rejected"))["content"].alias("last_rejected"),
        F.get("rejected", F.lit(0))["content"].alias("first_content"),
    )


@query(
    "fold_turns",
    """select conv_id, cast(0 as bigint) as block, count(*) as n_messages, string_agg(role, ',' order by turn) as roles,
         string_agg(text, '|' order by turn) as content from conversations group by conv_id""",
)
def _(spark, sf_dir):
    folded = pairs.fold_turns(D.table(spark, sf_dir, "conversations"))
    return folded.select(
        "conv_id",
        "block",
        F.size("conversation").cast("long").alias("n_messages"),
        F.array_join("conversation.role", ",").alias("roles"),
        F.array_join("conversation.content", "|").alias("content"),
    )


@query(
    "conversation_to_text",
    """select conv_id, string_agg(case when turn % 5 = 3 then 'Tool_Call' when role = 'system' then 'System'
           when role = 'user' then 'User' else 'Assistant' end || ': ' || text, chr(10) order by turn) as text
       from conversations group by conv_id""",
)
def _(spark, sf_dir):
    turns = D.table(spark, sf_dir, "conversations").withColumn(
        "role", F.when(F.col("turn") % 5 == 3, "tool_call").otherwise(F.col("role"))
    )
    folded = pairs.fold_turns(turns)
    return folded.select("conv_id", chat.conversation_to_text(F.col("conversation")).alias("text"))


@query(
    "text_preview",
    """select doc_id, case when length(text) > 200 then substr(text, 1, 200) || '...' else text end as preview
       from documents""",
)
def _(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


def _measured(spark, sf_dir) -> DataFrame:
    """Single exchanges: system text, user turn and reply."""
    return lengths.with_lengths(D.d_conv(spark, sf_dir))


@query(
    "exceeds_by",
    f"""select conv_id, greatest(0, chosen_length - {MAX}) as over_chosen,
         greatest(0, rejected_length - {MAX}) as over_rejected from whole_measured""",
)
def _(spark, sf_dir):
    return D.d_measured(spark, sf_dir).select(
        F.col("key").alias("conv_id"),
        lengths.exceeds_by(F.col("chosen_length"), MAX).alias("over_chosen"),
        lengths.exceeds_by(F.col("rejected_length"), MAX).alias("over_rejected"),
    )


@query(
    "category_map",
    f"""select questions, {O.category("nullif(questions_category, 'Porciones')")} as category from d_question""",
)
def _(spark, sf_dir):
    label = F.nullif(F.col("questions_category"), F.lit("Porciones"))
    return D.d_question(spark, sf_dir).select("questions", questions.map_category(label).alias("category"))


@query(
    "difficulty_map",
    f"""select questions, {O.difficulty(O.category("questions_category"))} as difficulty,
         {O.difficulty("questions_category")} as unmapped from d_question""",
)
def _(spark, sf_dir):
    label = F.col("questions_category")
    return D.d_question(spark, sf_dir).select(
        "questions",
        questions.map_difficulty(questions.map_category(label)).alias("difficulty"),
        questions.map_difficulty(label).alias("unmapped"),
    )


@query(
    "system_message_map",
    f"""select questions, {O.system_text(O.category("questions_category"))} as system_text,
         {O.system_text("questions_category")} as unmapped from d_question""",
)
def _(spark, sf_dir):
    label = F.col("questions_category")
    return D.d_question(spark, sf_dir).select(
        "questions",
        pairs.system_message(questions.map_category(label)).alias("system_text"),
        pairs.system_message(label).alias("unmapped"),
    )


def _prompt_sql() -> str:
    def listed(name: str, by: str) -> str:
        return f"array_to_string({name}, {O.lit(by)})"

    bank_fields = {n: f"coalesce({n}, '')" for n in ("nombre", "dificultad", "tiempo", "racion", "categoria")}
    bank_fields |= {"ingredientes": f"coalesce({listed('ingredientes', ', ')}, '')"}
    bank_fields |= {"pasos": f"coalesce({listed('pasos', ' ')}, '')"}
    reply_fields = {n: n for n in ("question", "tiempo", "dificultad", "racion")}
    reply_fields |= {
        "nombre": "recipe_name",
        "ingredientes": listed("ingredientes", ", "),
        "pasos": listed("pasos", " "),
        "valor_nutricional": "coalesce(valor_nutricional, 'N/A')",
    }
    return f"""
      select 'questions' as kind, id as recipe_id, null as question, {O.lit(K.QUESTION_SYSTEM)} as system_text,
        {O.template(K.QUESTION_USER, bank_fields)} as user_text, cast(4096 as bigint) as max_tokens,
        cast(0.7 as double) as temperature from d_recipe
      union all select 'chosen', recipe_id, question, {O.system_text("category")},
        {O.template(K.CHOSEN_USER, reply_fields)}, 8192, 0.7 from asked
      union all select 'rejected', recipe_id, question, {O.lit(K.REJECTED_SYSTEM)},
        {O.template(K.REJECTED_USER, reply_fields)}, 2048, 0.9 from asked"""


@query("prompt_columns", _prompt_sql())
def _(spark, sf_dir):
    asked = _asked(spark, sf_dir)
    kinds = {
        "questions": questions.question_requests(D.d_recipe(spark, sf_dir)).withColumn(
            "question", F.lit(None).cast("string")
        ),
        "chosen": questions.chosen_requests(asked),
        "rejected": questions.rejected_requests(asked),
    }
    rows = [frame.withColumn("kind", F.lit(kind)) for kind, frame in kinds.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "render_chatml",
    f"""select conv_id, {O.chatml(("system", "sys"), ("user", "usr"))} as text,
         {O.chatml(("system", "sys"), ("user", "usr"))} || '<|im_start|>assistant' || chr(10) as prompt,
         replace({O.chatml(("system", "sys"), ("user", "usr"))}, '<|im_end|>', '</s>') as eos_text
       from d_pair""",
)
def _(spark, sf_dir):
    conversation = F.col("messages")
    return D.d_pair(spark, sf_dir).select(
        "conv_id",
        chat.render_chatml(conversation).alias("text"),
        chat.render_chatml(conversation, add_generation_prompt=True).alias("prompt"),
        chat.render_chatml(conversation, end_token="</s>").alias("eos_text"),
    )


PREFERENCE_SQL = f"""
  select conv_id, case when chosen is not null and rejected is not null
      then {O.chatml(("system", "sys"), ("user", "usr"))} || '<|im_start|>assistant' || chr(10) else '' end as prompt,
    case when chosen is not null and rejected is not null then chosen else '' end as chosen,
    case when chosen is not null and rejected is not null then rejected else '' end as rejected from d_pair"""


@query("preference_rows", PREFERENCE_SQL)
def _(spark, sf_dir):
    return pairs.preference_rows(D.d_conv(spark, sf_dir))


SFT_MESSAGES_SQL = """
  select conv_id, case when conv_id % 5 = 0 then 'system,user,assistant' else 'user,assistant' end as roles,
    case when conv_id % 5 = 0 then sys || '|' else '' end || usr || '|' || coalesce(chosen, '') as content from d_pair"""


@query("standardize_turns", SFT_MESSAGES_SQL)
def _(spark, sf_dir):
    rows = pairs.standardize_turns(D.d_sft(spark, sf_dir))
    return rows.select(
        "conv_id",
        F.array_join("messages.role", ",").alias("roles"),
        F.array_join("messages.content", "|").alias("content"),
    )


@query("stamp_session", f"select conv_id, {O.lit(D.SESSIONS[0])} as session_id, {STAMP_SQL} from d_pair")
def _(spark, sf_dir):
    stamped = pairs.stamp(D.d_pair(spark, sf_dir), D.SESSIONS[0], F.to_timestamp(F.lit(D.STAMP)))
    return stamped.select("conv_id", "session_id", "timestamp")


# --- filters --------------------------------------------------------------------


@query("valid_pairs", f"select {FLAT_SQL} from valid_pair")
def _(spark, sf_dir):
    return flat(pairs.valid_pairs(D.d_pair(spark, sf_dir)))


@query(
    "valid_pair_records",
    """select conv_id, chosen, rejected from d_pair
       where length(chosen) >= 50 and length(rejected) >= 20 and chosen <> rejected and conv_id % 20 <> 0""",
)
def _(spark, sf_dir):
    meta = F.col("metadata")
    entries = F.create_map(
        *[part for n in K.REQUIRED_METADATA for part in (F.lit(n), meta[n].cast("string"))]
    )
    # the key itself is missing in one record out of twenty, the value in one of ten
    some = F.map_filter(entries, lambda name, _: (name != "recipe_id") | (F.col("conv_id") % 20 != 0))
    records = D.d_pair(spark, sf_dir).withColumn("metadata", some)
    return pairs.valid_pairs(records, metadata="map").select("conv_id", "chosen", "rejected")


@query(
    "pair_defects",
    """select conv_id, concat_ws(',', case when chosen is null then 'no_chosen' end,
         case when rejected is null then 'no_rejected' end, case when length(chosen) < 50 then 'short_chosen' end,
         case when length(rejected) < 20 then 'short_rejected' end, case when chosen = rejected then 'same_reply' end,
         case when recipe_id is null then 'incomplete_metadata' end) as defects from d_pair""",
)
def _(spark, sf_dir):
    rows = pairs.pair_defects(D.d_pair(spark, sf_dir))
    return rows.select("conv_id", F.array_join("defects", ",").alias("defects"))


@query(
    "length_filter",
    f"""select conv_id, chosen_length, rejected_length from whole_measured
        where chosen_length <= {MAX} and rejected_length <= {MAX} and not blank""",
)
def _(spark, sf_dir):
    kept = lengths.length_filter(D.d_measured(spark, sf_dir), MAX)
    return kept.select(F.col("key").alias("conv_id"), "chosen_length", "rejected_length")


LONG_SQL = f"(chosen_length > {MAX} or rejected_length > {MAX}) and not blank"


@query(
    "long_examples",
    f"""select conv_id as index, chosen_length, rejected_length, chosen_text, rejected_text,
         greatest(0, chosen_length - {MAX}) as exceeds_by_chosen,
         greatest(0, rejected_length - {MAX}) as exceeds_by_rejected
       from whole_measured where {LONG_SQL}""",
)
def _(spark, sf_dir):
    over = D.d_measured(spark, sf_dir).filter(lengths.too_long(MAX))
    return lengths.long_examples(D.with_texts(over, spark, sf_dir), "key", MAX)


@query("blank_pairs", "select conv_id from measured where blank")
def _(spark, sf_dir):
    return lengths.blank_pairs(_measured(spark, sf_dir)).select("conv_id")


@query("drop_multi_turn", "select conv_id from d_pair where conv_id % 3 <> 2")
def _(spark, sf_dir):
    return pairs.drop_multi_turn(D.d_sft(spark, sf_dir)).select("conv_id")


@query("single_turn_only", "select conv_id from d_pair where conv_id % 5 <> 0")
def _(spark, sf_dir):
    return pairs.single_turn(pairs.standardize_turns(D.d_sft(spark, sf_dir))).select("conv_id")


@query("questions_with_recipe", "select recipe_id, questions, position from d_question where recipe_id <> 0")
def _(spark, sf_dir):
    return questions.with_recipe_id(D.d_question(spark, sf_dir)).select("recipe_id", "questions", "position")


@query("nonempty_questions", "select recipe_id, questions, position from d_question where questions <> ''")
def _(spark, sf_dir):
    return questions.nonempty_questions(D.d_question(spark, sf_dir)).select("recipe_id", "questions", "position")


@query(
    "complete_raw_questions",
    f"""select conv_id, turn, text as question,
         case when turn % 4 <> 0 then {O.label("conv_id")} else 'General' end as category,
         case when conv_id % 4 <> 0 then {O.question_type("turn")} else 'conceptual' end as question_type
       from conversations where role = 'user' and turn % 5 <> 4""",
)
def _(spark, sf_dir):
    turns = D.table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    raw = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 5 != 4, F.col("text")).alias("question"),
        F.when(F.col("turn") % 4 != 0, D._bank_label("conv_id")).alias("category"),
        F.when(F.col("conv_id") % 4 != 0, D._question_type("turn")).alias("question_type"),
    )
    return questions.complete_questions(raw)


HREF = O.attr("attrs", "href")
LINKS_SQL = f"""
  select t.page_id, t.pos, {HREF} as href from tok t join content c on t.page_id = c.page_id
  where kind = 'open' and tag = 'a' and pos > c0 and pos < c1"""
KEPT_SQL = f"""
  select * from ({LINKS_SQL}) where href <> '' and contains(href, 'site.test') and not ends_with(href, '#comments')"""


@query("link_predicate", KEPT_SQL)
def _(spark, sf_dir):
    return pages.recipe_links(pages.page_anchors(D.d_page(spark, sf_dir)), "site.test")


TITLE_SQL = f"""
  select p.page_id, coalesce(min_by({O.strip("h.text")}, h.spot) filter (where h.kind = 'h' and h.tag = 'h1'
      and list_contains(regexp_split_to_array({O.attr("h.attrs", "class")}, '\\s+'), 'entry-title')), 'Unknown Title') as title
  from d_page p left join heading h on p.page_id = h.page_id group by p.page_id"""


@query(
    "drop_failed",
    f"select t.page_id, t.title from ({TITLE_SQL}) t join pages p on t.page_id = p.page_id where p.url not like '%#top'",
)
def _(spark, sf_dir):
    read = F.when(~F.endswith("url", F.lit("#top")), F.col("html"))
    fetched = D.d_page(spark, sf_dir).withColumn("html", read)
    return pages.page_title(pages.drop_failed(fetched, "html"))


@query(
    "row_by_index",
    "select conv_id, chosen_text, rejected_text, chosen_length, rejected_length from measured where conv_id = 8 * 1000003",
)
def _(spark, sf_dir):
    return lengths.example_detail(_measured(spark, sf_dir), "conv_id", 8 * 1000003)


# --- joins ----------------------------------------------------------------------


@query(
    "recipe_questions",
    "select recipe_id, recipe_name, question, category, question_type from asked",
)
def _(spark, sf_dir):
    return _asked(spark, sf_dir).select("recipe_id", "recipe_name", "question", "category", "question_type")


@query(
    "recipes_without_questions",
    "select id, nombre from d_recipe where id <> 0 and id not in (select recipe_id from d_question where recipe_id is not null)",
)
def _(spark, sf_dir):
    missing = recipes.recipes_without_questions(D.d_recipe(spark, sf_dir), D.d_question(spark, sf_dir))
    return missing.select("id", "nombre")


@query("pending_links", f"select href, page_id, pos from ({KEPT_SQL}) where href not in (select url from d_done)")
def _(spark, sf_dir):
    links = pages.extract_links(D.d_page(spark, sf_dir), "site.test")
    return pages.pending_links(links, D.d_done(spark, sf_dir))


def _saved(spark, sf_dir) -> DataFrame:
    return D.d_response(spark, sf_dir).filter(F.col("chosen").isNotNull())


@query(
    "pending_pairs",
    """select recipe_id, question, category from asked a where not exists (
         select 1 from d_response s where s.chosen is not null and s.recipe_id = a.recipe_id and s.question = a.question)""",
)
def _(spark, sf_dir):
    pending = recipes.pending_pairs(_asked(spark, sf_dir), _saved(spark, sf_dir))
    return pending.select("recipe_id", "question", "category")


ANSWERED_SQL = f"""
  select a.*, coalesce(s.chosen, {O.lit(K.FALLBACK_CHOSEN)}) as chosen,
    coalesce(s.rejected, {O.lit(K.FALLBACK_REJECTED)}) as rejected,
    s.chosen is null or s.rejected is null as is_fallback
  from asked a left join d_response s on s.recipe_id = a.recipe_id and s.question = a.question"""


@query("attach_responses", f"select recipe_id, question, chosen, rejected, is_fallback from ({ANSWERED_SQL})")
def _(spark, sf_dir):
    answered = recipes.attach_responses(_asked(spark, sf_dir), D.d_response(spark, sf_dir))
    return answered.select("recipe_id", "question", "chosen", "rejected", "is_fallback")


VOTES_SQL = """
  select v.id, v.youtube_url, case when coalesce(v.youtube_url, '') <> '' then coalesce(l.n, 0) else v.votos end as votos
  from video_key v left join (select video_id, max(n) as n from likes where video_id is not null group by 1) l
    on v.vid = l.video_id"""


@query("attach_votes", VOTES_SQL)
def _(spark, sf_dir):
    return video.attach_votes(D.d_video(spark, sf_dir), D.d_video_page(spark, sf_dir))


@query("attach_transcripts", "select id, cast(0 as bigint) as transcript_block, youtube_transcript from told")
def _(spark, sf_dir):
    told = video.attach_transcripts(D.d_video(spark, sf_dir), D.d_segment(spark, sf_dir))
    return told.select("id", "transcript_block", "youtube_transcript")


@query(
    "lookup_tables",
    f"""select questions, {O.category("questions_category")} as category,
         {O.mapped(O.category("questions_category"), K.MESSAGE_TYPE_MAP, K.DEFAULT_MESSAGE_TYPE)} as message_type,
         {O.difficulty(O.category("questions_category"))} as difficulty from d_question""",
)
def _(spark, sf_dir):
    rows = D.d_question(spark, sf_dir)
    rows = questions.lookup_join(rows, "questions_category", K.CATEGORY_MAP, K.DEFAULT_CATEGORY, "category")
    rows = questions.lookup_join(rows, "category", K.MESSAGE_TYPE_MAP, K.DEFAULT_MESSAGE_TYPE, "message_type")
    rows = questions.lookup_join(rows, "category", K.DIFFICULTY_MAP, K.DEFAULT_DIFFICULTY, "difficulty")
    return rows.select("questions", "category", "message_type", "difficulty")


@query(
    "string_conversations",
    f"""select conv_id, {O.tokens("coalesce(chosen, '')")} as chosen_length,
         {O.tokens("coalesce(rejected, '')")} as rejected_length from d_pair""",
)
def _(spark, sf_dir):
    measured = lengths.with_lengths(D.d_pair(spark, sf_dir))
    return measured.select("conv_id", "chosen_length", "rejected_length")


# --- aggregates -----------------------------------------------------------------


@query(
    "questions_by_recipe",
    """select recipe_id, cast(0 as bigint) as block, count(*) as n_questions,
         string_agg(questions || '/' || question_type, '|' order by position) as question_list
       from d_question where recipe_id <> 0 group by recipe_id""",
)
def _(spark, sf_dir):
    grouped = questions.questions_by_recipe(D.d_question(spark, sf_dir))
    entry = F.transform("question_list", lambda q: F.concat(q["questions"], F.lit("/"), q["question_type"]))
    return grouped.select("recipe_id", "block", "n_questions", F.array_join(entry, "|").alias("question_list"))


@query(
    "bank_totals",
    """select count(*) filter (where recipe_id <> 0) as n_questions,
         count(distinct case when recipe_id <> 0 then recipe_id end) as n_recipes,
         count(*) filter (where coalesce(recipe_id, 0) = 0) as n_without_id from d_question""",
)
def _(spark, sf_dir):
    return questions.bank_totals(D.d_question(spark, sf_dir))


@query(
    "question_summary",
    """select 'total' as dimension, '' as label, count(*) as n from d_question
       union all select 'unique_recipes', '', count(distinct recipe_id) + max(case when recipe_id is null then 1 else 0 end)
       from d_question
       union all select 'category', questions_category, count(*) from d_question group by 2
       union all select 'type', question_type, count(*) from d_question group by 2""",
)
def _(spark, sf_dir):
    return questions.question_summary(D.d_question(spark, sf_dir))


SESSION_STATS_SQL = """
  select session_id, 'category' as stat, category as label, count(*) as n from {t} group by 1, 3
  union all select session_id, 'recipe', recipe_name, count(*) from {t} group by 1, 3
  union all select session_id, 'total_pairs', '', count(*) from {t} group by 1
  union all select session_id, 'unique_categories', '', count(distinct category) from {t} group by 1
  union all select session_id, 'unique_recipes', '', count(distinct recipe_name) from {t} group by 1"""


@query("session_stats", SESSION_STATS_SQL.format(t="d_session_pair"))
def _(spark, sf_dir):
    return pairs.session_stats(D.d_session_pair(spark, sf_dir))


@query("estimated_pairs", "select count(*) as estimated_pairs from asked")
def _(spark, sf_dir):
    return recipes.estimated_pairs(D.d_recipe(spark, sf_dir), D.d_question(spark, sf_dir))


OK_SQL = "coalesce(length(chosen) >= 50 and length(rejected) >= 20 and chosen <> rejected and recipe_id is not null, false)"


@query(
    "run_outcome",
    f"""select recipe_id, cast(0 as bigint) as is_total, count(*) filter (where {OK_SQL}) as saved,
         count(*) filter (where not {OK_SQL}) as failed from d_pair group by recipe_id
       union all select null, 1, count(*) filter (where {OK_SQL}), count(*) filter (where not {OK_SQL}) from d_pair""",
)
def _(spark, sf_dir):
    return pairs.run_outcome(D.d_pair(spark, sf_dir))


@query(
    "pair_completeness",
    f"""select count(*) filter (where chosen is null) as null_chosen, count(*) filter (where rejected is null) as null_rejected,
         count(*) filter (where {O.blank("chosen_text")}) as blank_chosen,
         count(*) filter (where {O.blank("rejected_text")}) as blank_rejected
       from (select * from d_conv order by conv_id limit 100)""",
)
def _(spark, sf_dir):
    return lengths.pair_completeness(D.d_conv(spark, sf_dir), "conv_id", 100)


def report_sql(source: str) -> str:
    return f"""
  select count(*) - count(*) filter (where blank) as analyzed, count(*) filter (where blank) as skipped,
    count(*) filter (where {LONG_SQL}) as exceeding,
    {O.round_percent(f"count(*) filter (where {LONG_SQL})", "count(*)")} as exceeding_pct,
    count(*) filter (where not ({LONG_SQL}) and not blank) as within_limit,
    {O.round_percent(f"count(*) filter (where not ({LONG_SQL}))", "count(*)")} as within_pct_reported,
    {O.round_percent(f"count(*) filter (where not ({LONG_SQL}) and not blank)", "count(*)")} as within_pct_exact,
    count(*) filter (where chosen_length > {MAX} and not blank) as chosen_exceeds,
    count(*) filter (where rejected_length > {MAX} and not blank) as rejected_exceeds,
    count(*) filter (where chosen_length > {MAX} and rejected_length > {MAX} and not blank) as both_exceed
  from {source}"""


def sides_sql(source: str) -> str:
    return f"""
  select side, count(*) as n, max(l) as max_length, min(l) as min_length, round(avg(l), 1) as avg_length
  from (select 'chosen' as side, chosen_length as l from {source} where not blank
        union all select 'rejected', rejected_length from {source} where not blank) where l > {MAX} group by side"""


def retention_sql(source: str) -> str:
    return f"""
  select count(*) as original, count(*) filter (where not ({LONG_SQL}) and not blank) as filtered,
    count(*) - count(*) filter (where not ({LONG_SQL}) and not blank) as removed,
    {O.round_percent(f"count(*) filter (where not ({LONG_SQL}) and not blank)", "count(*)")} as retention_pct
  from {source}"""


@query("length_report", report_sql("whole_measured"))
def _(spark, sf_dir):
    return lengths.length_report(D.d_measured(spark, sf_dir), MAX)


@query("long_side_stats", sides_sql("whole_measured"))
def _(spark, sf_dir):
    return lengths.long_side_stats(D.d_measured(spark, sf_dir), MAX)


@query("retention", retention_sql("whole_measured"))
def _(spark, sf_dir):
    return lengths.retention(D.d_measured(spark, sf_dir), MAX)


@query(
    "preference_counts",
    """select count(*) filter (where chosen is not null and rejected is not null) as n_prompt,
         count(*) filter (where chosen <> '' and rejected is not null) as n_chosen,
         count(*) filter (where rejected <> '' and chosen is not null) as n_rejected from d_pair""",
)
def _(spark, sf_dir):
    return pairs.preference_counts(pairs.preference_rows(D.d_conv(spark, sf_dir)))


@query(
    "word_frequency",
    f"""select doc_id, word, count(*) as n from (select doc_id, unnest({O.words("text")}) as word from documents)
        group by doc_id, word""",
)
def _(spark, sf_dir):
    return summary.word_frequency(D.table(spark, sf_dir, "documents"), ["doc_id"], "text", D.STOP_WORDS)


DOC_SUMMARY = O.summarised("documents", "doc_id", "text")


@query("sentence_scores", "select k as doc_id, i as sentence, score from score", DOC_SUMMARY)
def _(spark, sf_dir):
    return summary.sentence_scores(D.table(spark, sf_dir, "documents"), ["doc_id"], "text", D.STOP_WORDS)


@query(
    "generation_progress",
    """select count(*) as total, count(s.question) as finished,
         round(count(s.question) * 100.0 / cast(count(*) as double), 2) as completion_pct
       from (select distinct recipe_id, question from asked) a
       left join (select distinct recipe_id, question from d_response where chosen is not null) s
         on s.recipe_id = a.recipe_id and s.question = a.question""",
)
def _(spark, sf_dir):
    return recipes.generation_progress(_asked(spark, sf_dir), _saved(spark, sf_dir))


@query(
    "conversation_shape",
    """select side, n_messages, first_role, count(*) as n from (
         select 'chosen' as side, cast(case when chosen is null then -1 else 3 end as bigint) as n_messages,
           case when chosen is not null then 'system' end as first_role from d_conv
         union all select 'rejected', case when rejected is null then -1 else 3 end,
           case when rejected is not null then 'system' end from d_conv) group by 1, 2, 3""",
)
def _(spark, sf_dir):
    shape = lengths.conversation_shape(D.d_conv(spark, sf_dir))
    return shape.withColumn("n_messages", F.coalesce("n_messages", F.lit(-1)))


# --- ranking, sorting, sets -----------------------------------------------------


@query("extractive_summary", "select k as doc_id, summary from summary", DOC_SUMMARY)
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents").select("doc_id", "text")
    return summary.extractive_summary(docs, ["doc_id"], "text", 5, D.STOP_WORDS).select("doc_id", "summary")


@query(
    "top_k_sentences",
    "select k as doc_id, i as sentence, score, rank from best where rank <= 3",
    DOC_SUMMARY,
)
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents").select("doc_id", "text")
    return summary.top_sentences(docs, ["doc_id"], "text", 3, D.STOP_WORDS)


@query(
    "row_positions",
    f"""select doc_id, i as position, l[i + 1] as sentence
        from (select doc_id, {O.sentences("text")} as l from documents), unnest(range(len(l))) as t(i)""",
)
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("position", "sentence"))
    return rows.withColumn("position", F.col("position").cast("long"))


@query(
    "sample_long",
    f"""select conv_id as index, chosen_length, rejected_length,
         case when length(chosen_text) > 200 then substr(chosen_text, 1, 200) || '...' else chosen_text end as chosen_preview,
         case when length(rejected_text) > 200 then substr(rejected_text, 1, 200) || '...' else rejected_text end as rejected_preview
       from whole_measured where {LONG_SQL} order by conv_id limit 5""",
)
def _(spark, sf_dir):
    first = lengths.first_long(D.d_measured(spark, sf_dir), "key", MAX)
    return lengths.sample_long(D.with_texts(first, spark, sf_dir), "key", MAX)


@query(
    "link_slice",
    f"""select 'capped' as kind, * from (select page_id, pos, href from (
          select * from ({KEPT_SQL}) order by page_id, pos limit 40) order by page_id, pos offset 10)
        union all select 'rest', * from (select page_id, pos, href from ({KEPT_SQL}) order by page_id, pos offset 15)""",
)
def _(spark, sf_dir):
    links = pages.extract_links(D.d_page(spark, sf_dir), "site.test")
    capped = pages.link_slice(links, start=10, max_links=40).withColumn("kind", F.lit("capped"))
    return capped.unionByName(pages.link_slice(links, start=15).withColumn("kind", F.lit("rest")))


@query(
    "sorted_labels",
    "select questions_category as label, count(*) as n from d_question group by 1 order by 1",
)
def _(spark, sf_dir):
    found = questions.question_summary(D.d_question(spark, sf_dir)).filter(F.col("dimension") == "category")
    return found.select("label", "n").orderBy("label")


@query(
    "merge_recipes",
    f"select url, 'old' as title from d_done union all select p.url, t.title from ({TITLE_SQL}) t join pages p using (page_id)",
)
def _(spark, sf_dir):
    old = D.d_done(spark, sf_dir).withColumn("title", F.lit("old"))
    new = pages.recipe_records(D.d_page(spark, sf_dir)).select("url", "title")
    return recipes.merge_recipes(old, new)


@query(
    "accumulate_questions",
    """select recipe_id, recipe_name, questions, questions_category, question_type from d_question""",
)
def _(spark, sf_dir):
    item = F.struct(
        F.col("questions").alias("question"), F.col("questions_category").alias("category"), "question_type"
    )
    block = F.floor(F.col("position") / 4096).alias("block")
    listed = (
        D.d_question(spark, sf_dir)
        .groupBy(F.col("recipe_id").alias("id"), F.col("recipe_name").alias("nombre"), block)
        .agg(F.collect_list(item).alias("questions"))
    )
    return questions.explode_recipe_questions(listed)


@query("distinct_urls", f"select distinct href from ({KEPT_SQL})")
def _(spark, sf_dir):
    return recipes.distinct_urls(pages.extract_links(D.d_page(spark, sf_dir), "site.test"), "href")


# --- scalars --------------------------------------------------------------------

REPLY_BODY_SQL = f"""
  reply_rows as (select conv_id as id, turn, text as question,
    case when turn % 4 <> 0 then {O.label("conv_id")} else 'General' end as category,
    case when conv_id % 4 <> 0 then {O.question_type("turn")} else 'conceptual' end as question_type
  from conversations where role = 'user')"""


def _reply_elements(spark, sf_dir, lenient: bool) -> DataFrame:
    parsed = questions.parse_questions(D.d_reply(spark, sf_dir), "reply", lenient)
    return parsed.select("id", "turn", "position", "question", "category", "question_type")


@query(
    "strip_code_fence",
    """select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as cleaned from documents""",
)
def _(spark, sf_dir):
    fenced = F.concat(F.lit(" ```json\n"), F.col("text"), F.lit("\n```\n"))
    return D.table(spark, sf_dir, "documents").select("doc_id", replies.strip_code_fence(fenced).alias("cleaned"))


@query(
    "parse_question_array",
    """select id, turn, cast(0 as bigint) as position, question, category, question_type
       from reply_rows where id % 6 not in (4, 5)""",
    REPLY_BODY_SQL,
)
def _(spark, sf_dir):
    return _reply_elements(spark, sf_dir, lenient=False)


@query(
    "repair_trailing_commas",
    """select id, turn, cast(0 as bigint) as position, question, category, question_type
       from reply_rows where id % 6 <> 4""",
    REPLY_BODY_SQL,
)
def _(spark, sf_dir):
    return _reply_elements(spark, sf_dir, lenient=True)


@query("video_id", "select id, vid as video_id from video_key")
def _(spark, sf_dir):
    return D.d_video(spark, sf_dir).select("id", urls.video_id(F.col("youtube_url")).alias("video_id"))


@query(
    "watch_url",
    f"""select id, coalesce('https://www.youtube.com/watch?v=' ||
         nullif(regexp_extract(youtube_url, {O.lit(K.RX_EMBED_ANY)}, 1), ''), youtube_url) as watch_url from d_video""",
)
def _(spark, sf_dir):
    return D.d_video(spark, sf_dir).select("id", urls.watch_url(F.col("youtube_url")).alias("watch_url"))


@query(
    "embed_id",
    """select id, case when contains(youtube_url, 'youtube.com/embed/')
         then split_part(split_part(youtube_url, '/', -1), '?', 1) else '' end as embed_id from d_video""",
)
def _(spark, sf_dir):
    return D.d_video(spark, sf_dir).select("id", urls.embed_id(F.col("youtube_url")).alias("embed_id"))


@query(
    "join_list",
    """select id, array_to_string(ingredientes, ', ') as ingredientes, array_to_string(pasos, ' ') as pasos,
         array_to_string(pasos, chr(10)) as lines from d_recipe""",
)
def _(spark, sf_dir):
    return D.d_recipe(spark, sf_dir).select(
        "id",
        F.array_join("ingredientes", ", ").alias("ingredientes"),
        F.array_join("pasos", " ").alias("pasos"),
        F.array_join("pasos", "\n").alias("lines"),
    )


@query(
    "absolute_url",
    """select page_id, case page_id % 5
           when 0 then regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'img/' || page_id || '.png'
           when 1 then regexp_extract(url, '^(https?://[^/]+)', 1) || '/img/' || page_id || '.png'
           when 2 then regexp_extract(url, '^(https?:)', 1) || '//cdn.test/' || page_id || '.png'
           when 3 then 'https://cdn.test/' || page_id
           else regexp_replace(url, '[?#].*$', '') || '?q=' || page_id end as image_url from pages""",
)
def _(spark, sf_dir):
    key, kind = F.col("page_id").cast("string"), F.col("page_id") % 5
    ref = (
        F.when(kind == 0, F.concat(F.lit("img/"), key, F.lit(".png")))
        .when(kind == 1, F.concat(F.lit("/img/"), key, F.lit(".png")))
        .when(kind == 2, F.concat(F.lit("//cdn.test/"), key, F.lit(".png")))
        .when(kind == 3, F.concat(F.lit("https://cdn.test/"), key))
        .otherwise(F.concat(F.lit("?q="), key))
    )
    return D.table(spark, sf_dir, "pages").select("page_id", urls.absolute_url(F.col("url"), ref).alias("image_url"))


@query("like_count", "select video_id, n as likes from likes")
def _(spark, sf_dir):
    return D.d_video_page(spark, sf_dir).select("video_id", urls.like_count(F.col("html")).alias("likes"))


@query(
    "sentences",
    f"select doc_id, cast(len(l) as bigint) as n, array_to_string(l, '|') as sentences from (select doc_id, {O.sentences('text')} as l from documents)",
)
def _(spark, sf_dir):
    found = D.table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("sentences"))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n"), joined("sentences"))


@query(
    "words",
    f"""select doc_id, cast(len(l) as bigint) as n, array_to_string(l, '|') as words
        from (select doc_id, regexp_extract_all(lower(text), {O.lit(K.RX_WORD)}) as l from documents)""",
)
def _(spark, sf_dir):
    found = D.table(spark, sf_dir, "documents").select("doc_id", text.words(F.col("text")).alias("words"))
    return found.select("doc_id", F.size("words").cast("long").alias("n"), joined("words"))


@query("token_count", f"select doc_id, {O.tokens('text')} as n_tokens from documents")
def _(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("n_tokens"))


# a vocabulary of the beginnings of benchmark words; the SQL walks place by place
VOCABULARY_SQL = f"""
  with recursive piece as (
      select substr(w, 1, n) as piece
      from (select unnest(regexp_extract_all(lower(text), {O.lit(K.RX_WORD)})) as w from benchmark), range(1, 7) as r(n)
      where n <= length(w)),
    vocabulary as (select distinct piece from piece),
    said as (select doc_id, unnest(regexp_extract_all(lower(text), {O.lit(K.RX_WORD)})) as word from documents),
    counted as (select doc_id, word, count(*) as n from said group by all),
    known as (select distinct word from said),
    fits as (select word, p as at, max(l) as l from known, range(1, 7) as r(l), unnest(range(1, length(word) + 1)) as u(p)
      where p + l - 1 <= length(word) and substr(word, p, l) in (select piece from vocabulary) group by word, p),
    walk as (
      select word, cast(1 as bigint) as at, 0 as n from known
      union all select w.word, w.at + coalesce(f.l, 1), w.n + 1 from walk w left join fits f on f.word = w.word and f.at = w.at
      where w.at <= length(w.word)),
    cut as (select word, max(n) as n_tokens from walk group by word)
  select d.doc_id, coalesce(cast(sum(c.n) as bigint), 0) as n_words, coalesce(cast(sum(c.n * t.n_tokens) as bigint), 0) as n_tokens
  from documents d left join counted c on c.doc_id = d.doc_id left join cut t on t.word = c.word group by d.doc_id"""


@query("vocabulary_token_counts", f"select * from ({VOCABULARY_SQL})")
def _(spark, sf_dir):
    said = D.table(spark, sf_dir, "benchmark").select(F.explode(text.words(F.col("text"))).alias("w"))
    begins = F.explode(F.sequence(F.lit(1), F.least(F.lit(6), F.length("w"))))
    vocabulary = said.select("w", begins.alias("n")).select(F.substring("w", F.lit(1), F.col("n")).alias("piece")).distinct()
    return vocabulary_token_counts(D.table(spark, sf_dir, "documents"), ["doc_id"], vocabulary)


# documents whose commas and conjunctions bring abbreviations with them
ABBREVIATED_SQL = r"""abbreviated as (
    select doc_id, replace(replace(text, ', ', ', e.g. '), ' and ', ' and dr. ') as text from documents),
  dotted as (select unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}][\p{L}\p{N}.]*')) as token from abbreviated),
  periods as (select regexp_replace(token, '[.]+$', '') as word, count(*) filter (where token like '%.') as k,
    count(*) filter (where token not like '%.') as plain from dotted group by 1),
  scored as (select word, k, plain,
      2 * (k * ln(0.99::double) + plain * ln(0.01::double) - k * ln(share)
           - case when plain > 0 then plain * ln(1 - share) else 0 end)
      * exp(-chars) * (length(word) - chars + 1) / pow(chars, plain) as score
    from (select *, length(replace(word, '.', '')) as chars, (select sum(k) / sum(k + plain) from periods) as share from periods)
    where k >= 5 and regexp_matches(word, '\p{L}')),
  listed as (select * from scored where score >= 0.3)"""


def _abbreviated(spark, sf_dir) -> DataFrame:
    seeded = F.replace(F.replace("text", F.lit(", "), F.lit(", e.g. ")), F.lit(" and "), F.lit(" and dr. "))
    return D.table(spark, sf_dir, "documents").select("doc_id", seeded.alias("text"))


@query("abbreviations", "select word, k as n_period, plain as n_plain, round(score, 4) as score from listed", ABBREVIATED_SQL)
def _(spark, sf_dir):
    return abbreviations.abbreviations(_abbreviated(spark, sf_dir)).withColumn("score", F.round("score", 4))


# periods inside words are set aside as a noncharacter, then pieces are cut and joined
@query(
    "sentences_with_abbreviations",
    rf"""select doc_id, row_number() over (partition by doc_id order by part) - 1 as sentence, body from (
          select doc_id, part, {O.strip("string_agg(piece, '' order by i)")} as body from (
            select *, count(*) filter (where not coalesce(goes_on, false))
                over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as part
            from (select p.doc_id, p.i, p.piece, l.word is not null as goes_on
              from (select doc_id, i, replace(list[i], chr(64976), '.') as piece from (
                  select doc_id, regexp_extract_all(regexp_replace(regexp_replace(text, '([\p{{L}}\p{{N}}])[.]([\p{{L}}\p{{N}}])',
                    '\1' || chr(64976) || '\2', 'g'), '([\p{{L}}\p{{N}}])[.]([\p{{L}}\p{{N}}])', '\1' || chr(64976) || '\2', 'g'),
                    {O.lit(K.RX_SENTENCE)}) as list from abbreviated), unnest(range(1, len(list) + 1)) as u(i)) p
              left join listed l on l.word || '.' = regexp_extract(lower(p.piece), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}.]*$')))
          group by doc_id, part) where body <> ''""",
    ABBREVIATED_SQL,
)
def _(spark, sf_dir):
    docs = _abbreviated(spark, sf_dir)
    return abbreviations.sentences_with_abbreviations(docs, ["doc_id"], abbreviations.abbreviations(docs))


@query("token_count_side", "select conv_id, chosen_text, rejected_text, chosen_length, rejected_length from measured")
def _(spark, sf_dir):
    return _measured(spark, sf_dir).select("conv_id", *lengths.MEASURED)


@query(
    "ratio_percent",
    "select lang, count(*) as n, round(count(*) * 100.0 / cast((select count(*) from documents) as double), 2) as pct from documents group by lang",
)
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents")
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("pct", text.percent(F.col("n"), total))


# --- pages ----------------------------------------------------------------------


@query(
    "html_tokens",
    "select page_id, pos, kind, tag, attrs, text from tok where case when kind = 'text' then text <> '' else tag <> '' end",
)
def _(spark, sf_dir):
    return pages.html_tokens(D.d_page(spark, sf_dir)).withColumn("pos", F.col("pos").cast("long"))


@query("extract_links", KEPT_SQL)
def _(spark, sf_dir):
    return pages.extract_links(D.d_page(spark, sf_dir), "site.test")


@query("page_title", TITLE_SQL)
def _(spark, sf_dir):
    return pages.page_title(D.d_page(spark, sf_dir))


SRC = O.attr("attrs", "src")
IMAGE_SQL = """
  select page_id, case page_id % 6
      when 0 then regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'img/' || page_id || '.png'
      when 2 then regexp_extract(url, '^(https?://[^/]+)', 1) || '/abs/' || page_id || '.png'
      when 3 then 'https://cdn.test/' || page_id || '.png'
      when 4 then 'feat/' || page_id || '.png'
      when 5 then case when contains(html, '<head>') then 'https://cdn.test/og' || page_id || '.png' else '' end
      else '' end as image_url
  from d_page"""


@query("page_image", IMAGE_SQL)
def _(spark, sf_dir):
    return pages.page_image(D.d_page(spark, sf_dir))


VIDEO_SQL = f"""
  select p.page_id, coalesce(min_by({SRC}, pos) filter (where kind = 'open' and tag = 'iframe'
      and contains({SRC}, 'youtube.com/embed')), '') as youtube_url
  from d_page p left join tok t on p.page_id = t.page_id group by p.page_id"""


@query("page_video", VIDEO_SQL)
def _(spark, sf_dir):
    return pages.page_video(D.d_page(spark, sf_dir))


INGREDIENT_CTES = f"""
  first_header as (select page_id, min(spot) as spot from heading
    where (kind = 'b' or tag in ('h2', 'h3', 'h4')) and contains(lower(text), 'ingrediente') group by page_id),
  next_list as (select h.page_id, min(t.pos) as u0 from first_header h join tok t on t.page_id = h.page_id
    where t.kind = 'open' and t.tag = 'ul' and t.pos > h.spot group by h.page_id),
  list_end as (select n.page_id, u0, coalesce(min(t.pos), 2147483647) as u1 from next_list n
    join marked s on s.page_id = n.page_id and s.pos = n.u0
    left join marked t on t.page_id = n.page_id and t.kind = 'close' and t.tag = 'ul' and t.pos > n.u0
      and t.ul_level < s.ul_level group by n.page_id, u0),
  listed as (select i.page_id, count(*) as n, string_agg(i.text, '|' order by i.spot) as items
    from item i join list_end e on i.page_id = e.page_id and i.spot > u0 and i.spot < u1 group by i.page_id),
  followed as (select page_id, spot, text, lag(lower(text)) over (partition by page_id order by spot) as before
    from paragraph where inside),
  parts as (select page_id, spot, i, {O.strip("l[i + 1]")} as part
    from (select page_id, spot, regexp_split_to_array(text, '[,\\n]') as l from followed
          where contains(before, 'ingrediente') or contains(before, 'necesita')), unnest(range(len(l))) as t(i)),
  from_text as (select page_id, string_agg(part, '|' order by spot, i) as items from parts
    where part <> '' and not starts_with(part, 'http') group by page_id),
  ingredients as (select p.page_id, case when l.n > 0 then l.items else coalesce(f.items, '') end as ingredients
    from d_page p left join listed l on l.page_id = p.page_id left join from_text f on f.page_id = p.page_id)"""


@query("page_ingredients", "select page_id, ingredients from ingredients", INGREDIENT_CTES)
def _(spark, sf_dir):
    return pages.page_ingredients(D.d_page(spark, sf_dir)).select("page_id", joined("ingredients"))


_MARKERS = " or ".join(f"contains(lower(text), {O.lit(m)})" for m in K.INSTRUCTION_MARKERS)
INSTRUCTION_CTES = f"""
  step_header as (select page_id, min_by(struct_pack(spot := spot, level := level, in_p := in_p), spot) as hd from heading
    where inside and (kind = 'b' or tag in ('h2', 'h3', 'h4')) and ({_MARKERS}) group by page_id),
  ordered_list as (select s.page_id, min(t.pos) as o0 from step_header s join tok t on t.page_id = s.page_id
    where t.kind = 'open' and t.tag = 'ol' and t.pos > s.hd.spot group by s.page_id),
  ordered_end as (select o.page_id, o0, coalesce(min(t.pos), 2147483647) as o1 from ordered_list o
    join marked s on s.page_id = o.page_id and s.pos = o.o0
    left join marked t on t.page_id = o.page_id and t.kind = 'close' and t.tag = 'ol' and t.pos > o.o0
      and t.ol_level < s.ol_level group by o.page_id, o0),
  steps as (select e.page_id, coalesce(string_agg(i.text, chr(10) order by i.spot), '') as text from ordered_end e
    left join item i on i.page_id = e.page_id and i.spot > o0 and i.spot < o1 group by e.page_id),
  stop_at as (select s.page_id, coalesce(min(m.pos), 2147483647) as stop from step_header s
    left join marked m on m.page_id = s.page_id and m.pos > s.hd.spot and (
      (m.kind = 'open' and m.tag in ('div', 'section') and m.level - 1 = s.hd.level)
      or (m.kind = 'open' and m.tag in ('h2', 'h3', 'h4') and m.level = s.hd.level)
      or (m.kind = 'close' and m.tag in ({O._CONTAINERS}) and m.level < s.hd.level)) group by s.page_id),
  beside as (select s.page_id, string_agg(p.text, chr(10) order by p.spot) as text from step_header s
    join stop_at x on x.page_id = s.page_id
    join paragraph p on p.page_id = s.page_id and p.spot > s.hd.spot and p.spot < x.stop and p.level = s.hd.level
      and p.text <> '' where not s.hd.in_p group by s.page_id),
  numbered as (select *, row_number() over (partition by page_id order by spot) - 1 as i,
      count(*) over (partition by page_id) as n from paragraph where inside),
  middle as (select page_id, string_agg(text, chr(10) order by i) as text from numbered
    where i >= least(2, n // 3) and i < greatest(least(2, n // 3) + 1, n - 2) group by page_id),
  instructions as (select p.page_id, case when c.page_id is null then ''
      when o.page_id is not null then o.text when s.page_id is not null then coalesce(b.text, '')
      else coalesce(m.text, '') end as instructions
    from d_page p left join content c on c.page_id = p.page_id left join step_header s on s.page_id = p.page_id
    left join steps o on o.page_id = p.page_id left join beside b on b.page_id = p.page_id
    left join middle m on m.page_id = p.page_id)"""


@query("page_instructions", "select page_id, instructions from instructions", INSTRUCTION_CTES)
def _(spark, sf_dir):
    return pages.page_instructions(D.d_page(spark, sf_dir))


TEXT_SQL = f"""
  select p.page_id, coalesce({O.strip("string_agg(m.text, '' order by m.pos)")}, '') as full_content
  from d_page p left join marked m on p.page_id = m.page_id and m.inside and m.kind = 'text' group by p.page_id"""


@query("page_text", TEXT_SQL)
def _(spark, sf_dir):
    return pages.page_text(D.d_page(spark, sf_dir))


RECORD_CTES = f"{INGREDIENT_CTES}, {INSTRUCTION_CTES}"
RECORDS_SQL = f"""
  select p.page_id, t.title, p.url, i.image_url, v.youtube_url, g.ingredients, s.instructions, f.full_content,
    '' as youtube_transcript
  from d_page p join ({TITLE_SQL}) t using (page_id) join ({IMAGE_SQL}) i using (page_id)
  join ({VIDEO_SQL}) v using (page_id) join ingredients g using (page_id) join instructions s using (page_id)
  join ({TEXT_SQL}) f using (page_id)"""


@query("recipe_records", RECORDS_SQL, RECORD_CTES)
def _(spark, sf_dir):
    return pages.recipe_records(D.d_page(spark, sf_dir)).withColumn("ingredients", joined("ingredients"))


# --- splits and shaping ---------------------------------------------------------


@query(
    "train_test_split",
    """select doc_id, case when r <= ceil(n * 0.05) then 'test' else 'train' end as exact,
         case when h[1:8] < '0ccccccc' then 'test' else 'train' end as approximate
       from (select doc_id, md5(doc_id || ':42') as h, row_number() over (order by md5(doc_id || ':42')) as r,
               count(*) over () as n from documents)""",
)
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents").select("doc_id")
    exact = split.train_test_split(docs, "doc_id", 0.05).withColumnRenamed("split", "exact")
    both = split.train_test_split(exact, "doc_id", 0.05, exact=False)
    return both.withColumnRenamed("split", "approximate")


PACK_CTES = f"""
  laid as (select doc_id, n, l, cast(coalesce(sum(n) over (order by h, doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as s
    from (select doc_id, md5(doc_id || ':42') as h, regexp_extract_all(text, {O.lit(K.RX_TOKEN_SPACED)}) as l,
            cast(len(regexp_extract_all(text, {O.lit(K.RX_TOKEN)})) as bigint) as n from documents) where n > 0),
  pieces as (select b as block, greatest(s, b * 512) - b * 512 as block_offset, doc_id as key,
      greatest(s, b * 512) - s as token_from, least(s + n, (b + 1) * 512) - greatest(s, b * 512) as n_tokens, l
    from laid, unnest(range(s // 512, (s + n - 1) // 512 + 1)) as t(b))"""


def _packed(spark, sf_dir) -> DataFrame:
    return split.pack_sequences(D.table(spark, sf_dir, "documents"), "doc_id", "text", 512)


@query(
    "pack_sequences",
    """select block, block_offset, key, token_from, n_tokens,
         array_to_string(l[token_from + 1 : token_from + n_tokens], '') as piece from pieces""",
    PACK_CTES,
)
def _(spark, sf_dir):
    return _packed(spark, sf_dir)


@query(
    "packed_blocks",
    """select block, cast(sum(n_tokens) as bigint) as n_tokens, count(*) as n_pieces,
         string_agg(array_to_string(l[token_from + 1 : token_from + n_tokens], ''), ' ' order by block_offset) as text
       from pieces group by block""",
    PACK_CTES,
)
def _(spark, sf_dir):
    return split.packed_blocks(_packed(spark, sf_dir))


def _clip_sql(expr: str, limit: str, keep: str) -> str:
    pieces = f"regexp_extract_all({expr}, {O.lit(K.RX_TOKEN_SPACED)})"
    span = f"[len({pieces}) - {limit} + 1 :]" if keep == "end" else f"[1 : {limit}]"
    return f"case when len({pieces}) > {limit} then array_to_string(({pieces}){span}, '') else {expr} end"


_ROOM = f"(120 - least({O.tokens('prompt')}, 40))"


@query(
    "clip_pair_tokens",
    f"""select conv_id, {_clip_sql("prompt", "40", "end")} as prompt, {_clip_sql("chosen", _ROOM, "start")} as chosen,
         {_clip_sql("rejected", _ROOM, "start")} as rejected, {O.tokens("prompt")} > 40 as prompt_clipped,
         {O.tokens("chosen")} > {_ROOM} or {O.tokens("rejected")} > {_ROOM} as reply_clipped
       from ({PREFERENCE_SQL})""",
)
def _(spark, sf_dir):
    rows = pairs.preference_rows(D.d_conv(spark, sf_dir))
    return split.clip_pairs(rows, max_prompt=40, max_total=120)


@query("first_n_rows", "select doc_id, lang, n_chars from documents order by doc_id limit 100")
def _(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").orderBy("doc_id").limit(100)


# --- caller code and streaming --------------------------------------------------


@query("batched_map", "select doc_id, length(text) as n_chars from documents where text <> ''")
def _(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents").select("doc_id", "text")

    def measure(batch):
        kept = batch[batch["text"] != ""]
        return kept[["doc_id"]].assign(n_chars=kept["text"].str.len())

    return batches.map_batches(docs, measure, "doc_id long, n_chars long")


def _staged_pairs(spark, sf_dir) -> str:
    path = scratch_path(spark, "incoming")
    D.d_pair(spark, sf_dir).select(*schemas.PAIR_COLUMNS).write.json(path)
    return path


def _streamed(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "saved"), scratch_path(spark, "state")
    incoming = _staged_pairs(spark, sf_dir)
    stamp = F.to_timestamp(F.lit(D.STAMP))
    streams.stream_pairs(spark, incoming, out, checkpoint, D.SESSIONS[0], stamp, max_files=1)
    return out


@query("stream_pairs", f"select {FLAT_SQL}, {O.lit(D.SESSIONS[0])} as session_id, {STAMP_SQL} from valid_pair")
def _(spark, sf_dir):
    return flat(readers.read_pairs(spark, _streamed(spark, sf_dir)), "session_id", "timestamp")


@query(
    "stream_outcome",
    f"""select count(*) filter (where {OK_SQL}) as saved, count(*) filter (where not {OK_SQL}) as failed from d_pair""",
)
def _(spark, sf_dir):
    outcome = streams.stream_outcome(spark, _streamed(spark, sf_dir))
    return outcome.agg(F.sum("saved").alias("saved"), F.sum("failed").alias("failed"))


@query(
    "stream_json_to_parquet",
    """select coalesce(chosen, '') as chosen, coalesce(rejected, '') as rejected, recipe_id, recipe_name, category
       from d_pair""",
)
def _(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "flat"), scratch_path(spark, "state")
    streams.stream_flatten(spark, _staged_pairs(spark, sf_dir), out, checkpoint, max_files=1)
    return spark.read.schema(schemas.FLAT_PAIR).parquet(out)


@query("stream_pages", f"select p.url, t.title from ({TITLE_SQL}) t join pages p using (page_id)")
def _(spark, sf_dir):
    incoming, out = scratch_path(spark, "pages"), scratch_path(spark, "recipes")
    found = D.d_page(spark, sf_dir)
    # every address arrives twice, the second time under another page id
    again = found.withColumn("page_id", F.col("page_id") + 10_000_000)
    found.unionByName(again).write.parquet(incoming)
    streams.stream_pages(spark, incoming, out, scratch_path(spark, "state"), max_files=1)
    return spark.read.parquet(f"{out}/records").select("url", "title")


# --- jobs -----------------------------------------------------------------------


CURATED = "(select * from whole_measured where conv_id % 3 <> 0)"


@query(
    "job_length_curation",
    f"""select metric, cast(value as double) as value from (
          unpivot (select columns(*)::double from r) on * into name metric value value)
        union all select side || '_' || metric, cast(value as double) from (
          unpivot (select side, n::double as n, max_length::double as max_length, min_length::double as min_length,
                     avg_length::double as avg_length from s) on n, max_length, min_length, avg_length
          into name metric value value)
        union all select metric, cast(value as double) from (
          unpivot (select columns(*)::double from k) on * into name metric value value)
        union all select 'split_eval', count(*) from d_pair where conv_id % 3 = 0 having count(*) > 0
        union all select 'split_train', count(*) from {CURATED} where not ({LONG_SQL}) and not blank having count(*) > 0
        union all select 'sample_' || conv_id || '_' || metric, value::double from (
          unpivot (select conv_id, chosen_length, rejected_length from {CURATED} where {LONG_SQL} order by conv_id limit 5)
          on chosen_length, rejected_length into name metric value value)""",
    f"r as ({report_sql(CURATED)}), s as ({sides_sql(CURATED)}), k as ({retention_sql(CURATED)})",
)
def _(spark, sf_dir):
    split = F.when(F.col("key") % 3 == 0, "eval").otherwise("train")
    rows = D.d_conv(spark, sf_dir).withColumnRenamed("conv_id", "key").withColumn("split", split)
    measured = D.d_measured(spark, sf_dir).withColumn("split", split)
    out = scratch_path(spark, "curated")
    return jobs.length_curation(rows, measured, "key", out, lambda some: D.with_texts(some, spark, sf_dir), MAX)


@query(
    "job_build_pairs",
    f"""select {O.system_text("category")} as system_text, question, chosen, rejected, recipe_id, recipe_name, category,
         question_type as context, {O.difficulty("category")} as difficulty_level,
         coalesce(categoria, 'N/A') as recipe_category, coalesce(pais, 'Ecuador') as recipe_country,
         {O.lit(D.SESSIONS[2])} as session_id, {STAMP_SQL}
       from ({ANSWERED_SQL}) where dificultad is not null and length(chosen) >= 50 and length(rejected) >= 20
         and chosen <> rejected""",
)
def _(spark, sf_dir):
    built = jobs.build_pairs(
        D.d_recipe(spark, sf_dir),
        D.d_question(spark, sf_dir),
        D.d_response(spark, sf_dir),
        D.SESSIONS[2],
        F.to_timestamp(F.lit(D.STAMP)),
    )
    return flat(built, "session_id", "timestamp")


BANK_SQL = """
  bank as (select q.id as recipe_id, r.nombre as recipe_name, question as questions, category as questions_category,
    question_type from reply_rows q join d_recipe r on r.id = q.id where q.id % 6 not in (4, 5))"""


@query(
    "job_question_bank",
    """select 'total' as dimension, '' as label, count(*) as n from bank
       union all select 'unique_recipes', '', count(distinct recipe_id) from bank
       union all select 'category', questions_category, count(*) from bank group by 2
       union all select 'type', question_type, count(*) from bank group by 2""",
    f"{REPLY_BODY_SQL}, {BANK_SQL}",
)
def _(spark, sf_dir):
    bank = jobs.question_bank(D.d_recipe(spark, sf_dir), D.d_reply(spark, sf_dir))
    return questions.question_summary(bank)


@query(
    "job_pages_to_recipes",
    f"""select url, 'old' as title, '' as ingredients, '' as instructions from pages where url like 'http://%'
        union all select url, title, ingredients, instructions from ({RECORDS_SQL}) where url not like 'http://%'""",
    RECORD_CTES,
)
def _(spark, sf_dir):
    page_table = D.d_page(spark, sf_dir)
    empty = F.lit("")
    existing = page_table.filter(F.startswith("url", F.lit("http://"))).select(
        F.lit("old").alias("title"),
        "url",
        empty.alias("image_url"),
        empty.alias("youtube_url"),
        F.array().cast("array<string>").alias("ingredients"),
        empty.alias("instructions"),
        empty.alias("full_content"),
        empty.alias("youtube_transcript"),
    )
    merged = jobs.pages_to_recipes(page_table, existing)
    return merged.select("url", "title", joined("ingredients"), "instructions")


ADDRESS_SQL = "'https://site.test/r/' || page_id"


@query(
    "job_crawl_to_recipes",
    f"""select url, 'old' as title, '' as ingredients, '' as instructions from d_done
        union all select {ADDRESS_SQL}, title, ingredients, instructions from ({RECORDS_SQL})
        where {ADDRESS_SQL} in (select href from ({KEPT_SQL})) and {ADDRESS_SQL} not in (select url from d_done)""",
    RECORD_CTES,
)
def _(spark, sf_dir):
    found = D.d_page(spark, sf_dir)
    address = F.concat(F.lit("https://site.test/r/"), F.col("page_id").cast("string"))
    existing = D.d_done(spark, sf_dir).select(
        F.lit("old").alias("title"),
        "url",
        *[F.lit("").alias(name) for name in ("image_url", "youtube_url")],
        F.array().cast("array<string>").alias("ingredients"),
        *[F.lit("").alias(name) for name in ("instructions", "full_content", "youtube_transcript")],
    )
    merged = jobs.crawl_to_recipes(found, found.withColumn("url", address), existing, "site.test")
    return merged.select("url", "title", joined("ingredients"), "instructions")


@query(
    "job_video_enrichment",
    f"""select t.id, v.votos, t.youtube_transcript, s.summary from told t join ({VOTES_SQL}) v on v.id = t.id
        join summary s on s.k = t.id""",
    O.summarised("told", "id", "youtube_transcript"),
)
def _(spark, sf_dir):
    enriched = jobs.video_enrichment(
        D.d_video(spark, sf_dir), D.d_video_page(spark, sf_dir), D.d_segment(spark, sf_dir), D.STOP_WORDS
    )
    return enriched.select("id", "votos", "youtube_transcript", "summary")


@query(
    "job_preference_train_set",
    f"""select conv_id, prompt, chosen, rejected, case when r <= ceil(n * 0.05) then 'test' else 'train' end as split
        from (select *, row_number() over (order by md5(conv_id || ':42')) as r, count(*) over () as n
              from ({PREFERENCE_SQL}))""",
)
def _(spark, sf_dir):
    return jobs.preference_train_set(D.d_conv(spark, sf_dir), "conv_id")


SFT_SQL = f"""
  select conv_id, {O.chatml(("user", "usr"), ("assistant", "coalesce(chosen, '')"))} as text
  from d_pair where conv_id % 3 <> 2 and conv_id % 5 <> 0"""


@query(
    "job_sft_train_set",
    f"""select conv_id, text, case when r <= ceil(n * 0.1) then 'test' else 'train' end as split
        from (select *, row_number() over (order by md5(conv_id || ':42')) as r, count(*) over () as n from ({SFT_SQL}))""",
)
def _(spark, sf_dir):
    return jobs.sft_train_set(D.d_sft(spark, sf_dir), "conv_id")


@query(
    "job_sft_blocks",
    """select split, block, cast(sum(n_tokens) as bigint) as n_tokens, count(*) as n_pieces,
         string_agg(array_to_string(l[token_from + 1 : token_from + n_tokens], ''), ' ' order by s) as text
       from sft_pieces group by split, block""",
    f"""
  sft as (select conv_id, text, h, case when r <= ceil(n * 0.1) then 'test' else 'train' end as split
    from (select *, md5(conv_id || ':42') as h, row_number() over (order by md5(conv_id || ':42')) as r, count(*) over () as n
          from ({SFT_SQL}))),
  sft_laid as (select split, l, n, cast(coalesce(sum(n) over (partition by split order by h, conv_id
      rows between unbounded preceding and 1 preceding), 0) as bigint) as s
    from (select *, regexp_extract_all(text, {O.lit(K.RX_TOKEN_SPACED)}) as l,
            cast(len(regexp_extract_all(text, {O.lit(K.RX_TOKEN)})) as bigint) as n from sft) where n > 0),
  sft_pieces as (select split, b as block, s, l, greatest(s, b * 512) - s as token_from,
      least(s + n, (b + 1) * 512) - greatest(s, b * 512) as n_tokens
    from sft_laid, unnest(range(s // 512, (s + n - 1) // 512 + 1)) as t(b))""",
)
def _(spark, sf_dir):
    return jobs.sft_blocks(D.d_sft(spark, sf_dir), "conv_id", scratch_path(spark, "sft"), 512)


@query(
    "job_flatten_to_parquet",
    """select (select count(*) from d_pair) as n_rows, 'chosen, rejected, recipe_id, recipe_name, category' as columns,
         recipe_id as row_key from d_pair where recipe_id is not null order by recipe_id limit 5""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "flat")
    records = spark.read.schema(schemas.DPO_PAIR).json(_staged_pairs(spark, sf_dir))
    writers.write_parquet(pairs.flatten_pairs(records), path)
    stored = spark.read.schema(schemas.FLAT_PAIR).parquet(path)
    return writers.profile(stored.filter(F.col("recipe_id").isNotNull()), "recipe_id").drop("row_json").withColumn(
        "n_rows", stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
