"""Record types, passed to every reader so that no schema is ever inferred."""

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


MESSAGE = _struct(role=_S, content=_S)
CONVERSATION = T.ArrayType(MESSAGE)

SCRAPED_RECIPE = _struct(
    title=_S,
    url=_S,
    image_url=_S,
    youtube_url=_S,
    ingredients=T.ArrayType(_S),
    instructions=_S,
    full_content=_S,
    youtube_transcript=_S,
)

RECIPE = _struct(
    id=_L,
    nombre=_S,
    ingredientes=T.ArrayType(_S),
    pasos=T.ArrayType(_S),
    tiempo=_S,
    dificultad=_S,
    racion=_S,
    valor_nutricional=_S,
    categoria=_S,
    pais=_S,
    youtube_url=_S,
    votos=_L,
)

RAW_QUESTION = _struct(question=_S, category=_S, question_type=_S)

QUESTION = _struct(
    recipe_id=_L, recipe_name=_S, questions=_S, questions_category=_S, question_type=_S
)

PAIR_METADATA = _struct(
    recipe_id=_L,
    recipe_name=_S,
    category=_S,
    context=_S,
    difficulty_level=_S,
    recipe_category=_S,
    recipe_country=_S,
)

DPO_PAIR = _struct(messages=CONVERSATION, chosen=_S, rejected=_S, metadata=PAIR_METADATA)
PAIR_COLUMNS = DPO_PAIR.fieldNames()

# Metadata as a map keeps the difference between an absent key and a null value.
DPO_PAIR_MAP = _struct(
    messages=CONVERSATION, chosen=_S, rejected=_S, metadata=T.MapType(_S, _S)
)

SESSION_PAIR = T.StructType(
    [*DPO_PAIR.fields, T.StructField("timestamp", _S), T.StructField("session_id", _S)]
)

# The generator nests id, name and category; some exports carry them on top.
PAIR_RECORD = T.StructType(
    [
        *DPO_PAIR.fields,
        T.StructField("recipe_id", _L),
        T.StructField("recipe_name", _S),
        T.StructField("category", _S),
    ]
)

FLAT_PAIR = _struct(chosen=_S, rejected=_S, recipe_id=_L, recipe_name=_S, category=_S)
CONV_PAIR = _struct(chosen=CONVERSATION, rejected=CONVERSATION)
PREF_ROW = _struct(prompt=_S, chosen=_S, rejected=_S)
SFT_ROW = _struct(text=_S)
PAGE = _struct(page_id=_L, url=_S, html=_S)

LONG_EXAMPLE = _struct(
    index=_L,
    chosen_length=_L,
    rejected_length=_L,
    chosen_text=_S,
    rejected_text=_S,
    exceeds_by_chosen=_L,
    exceeds_by_rejected=_L,
)
