"""Patterns, lookup tables, message texts and prompt formats.

Everything here has to equal the published data format for results to match.
"""

# --- patterns (valid in both Java and RE2) ----------------------------------
WHITESPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
# the same characters one by one
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
RX_STRIP = rf"\A{WHITESPACE}+|{WHITESPACE}+\z"
RX_TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
RX_TOKEN_SPACED = r"(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])\s*"
RX_WORD = r"[\p{L}\p{N}]+"
RX_LETTER_RUNS = r"[\p{L}]+|[^\p{L}]+"
RX_SENTENCE = r"[^.!?]+[.!?]*"
# a tag (a quoted value may hold >), or text (a < that starts no tag belongs to it)
RX_HTML_TOKEN_START = r"^<[a-zA-Z/!?]"
RX_HTML = (
    r"""<[a-zA-Z/!?][^'">]*(?:(?:"[^"]*"|'[^']*')[^'">]*)*>|<[a-zA-Z/!?][^>]*>"""
    r"""|[^<]+(?:<[^a-zA-Z/!?<][^<]*)*|<[^a-zA-Z/!?<][^<]*(?:<[^a-zA-Z/!?<][^<]*)*|<"""
)
RX_HTML_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
RX_HTML_TAG = r"^</?([a-zA-Z][a-zA-Z0-9]*)"
RX_REFERENCE = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z][a-zA-Z0-9]*;|[^&]+|&"
RX_ARRAY_SLICE = r"(?s)\[.*\]"
RX_ARRAY_START = r"(?s)\[.*"
RX_EMBED = r"embed/([a-zA-Z0-9_-]+)"
RX_PLAIN_VIDEO = r"(?:v=|youtu\.be/)([a-zA-Z0-9_-]+)"
RX_EMBED_ANY = r"embed/([^?]+)"
RX_LIKES = (
    r'"label":"([\d,]+) likes"',
    r'"likeCount":"(\d+)"',
    r'"likesText":"([\d,]+)"',
    r'"likes":(\d+)',
    r"like this video along with ([\d,]+)",
)
# a string, closed or not, or a comma before a closing bracket; and the same for
# engines that go back over what they matched
RX_TRAILING_COMMA = r'(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+"?)|,\s*([}\]])'
RX_TRAILING_COMMA_SQL = r'(?s)("[^"\\]*(?:\\.[^"\\]*)*"?)|,\s*([}\]])'
RX_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'
RX_STRING_REST = r'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'
RX_JSON_PIECE = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},"]|[^\[\]{},"]++'

WATCH_PREFIX = "https://www.youtube.com/watch?v="
EMBED_MARK = "youtube.com/embed/"
IFRAME_MARK = "youtube.com/embed"

# --- lookup tables ----------------------------------------------------------
CATEGORY_MAP = {
    "General": "basic_recipe",
    "Ingredientes y preparación": "ingredients",
    "Técnicas": "cooking_techniques",
    "Tiempo y planificación": "time_and_planning",
    "Información nutricional": "nutritional_info",
    "Porciones": "scaling_portions",
    "Solución de problemas": "troubleshooting",
    "Contexto cultural": "cultural_context",
    "Opción múltiple": "multiple_choice",
}
DEFAULT_CATEGORY = "basic_recipe"

DIFFICULTY_MAP = {
    "basic_recipe": "beginner",
    "ingredients": "beginner",
    "cooking_techniques": "intermediate",
    "cultural_context": "advanced",
    "troubleshooting": "intermediate",
    "nutritional_info": "intermediate",
    "time_and_planning": "beginner",
    "scaling_portions": "intermediate",
    "multiple_choice": "intermediate",
}
DEFAULT_DIFFICULTY = "intermediate"

MESSAGE_TYPE_MAP = {
    "basic_recipe": "recipe_instructions",
    "ingredients": "ingredient_knowledge",
    "cooking_techniques": "technique_questions",
    "cultural_context": "cultural_context",
    "troubleshooting": "troubleshooting",
    "nutritional_info": "nutritional_expert",
    "time_and_planning": "recipe_instructions",
    "scaling_portions": "recipe_instructions",
    "multiple_choice": "multiple_choice_expert",
}
DEFAULT_MESSAGE_TYPE = "base_expert"

SYSTEM_MESSAGES = {
    "recipe_instructions": "Eres un chef instructor especializado en técnicas culinarias internacionales. Explicas métodos paso a paso con precisión y claridad didáctica, adaptándote a diferentes tradiciones gastronómicas del mundo.",
    "ingredient_knowledge": "Eres un experto en ingredientes de cocina internacional, conoces sus propiedades, usos tradicionales y sustituciones apropiadas en diferentes culturas gastronómicas del mundo.",
    "technique_questions": "Eres un maestro culinario especializado en técnicas de cocción internacionales, con expertise en tiempos, temperaturas y métodos tradicionales de diversas culturas gastronómicas.",
    "cultural_context": "Eres un historiador gastronómico internacional que conoces el origen, evolución y significado cultural de platos tradicionales de diferentes países y regiones del mundo.",
    "troubleshooting": "Eres un chef experto especializado en solucionar errores comunes en la cocina internacional y optimizar resultados culinarios para recetas de diferentes tradiciones gastronómicas.",
    "nutritional_expert": "Eres un nutricionista especializado en cocina internacional, conoces los valores nutricionales y beneficios de ingredientes de diferentes culturas y tradiciones gastronómicas del mundo.",
    "multiple_choice_expert": "Eres un chef educador especializado en gastronomía internacional. Respondes preguntas de opción múltiple con explicaciones detalladas sobre por qué cada opción es correcta o incorrecta, considerando diferentes tradiciones culinarias.",
    "base_expert": "Eres un chef experto especializado en cocina internacional con más de 20 años de experiencia. Tienes conocimiento profundo sobre ingredientes globales, técnicas tradicionales de diferentes culturas y la evolución de la gastronomía mundial.",
}

# --- defaults ---------------------------------------------------------------
DEFAULT_BANK_CATEGORY = "General"
DEFAULT_RAW_TYPE = "conceptual"
DEFAULT_BANK_TYPE = "contextual"
DEFAULT_RECIPE_CATEGORY = "N/A"
DEFAULT_COUNTRY = "Ecuador"
DEFAULT_NUTRITION = "N/A"
UNKNOWN_TITLE = "Unknown Title"
MIN_CHOSEN_CHARS = 50
MIN_REJECTED_CHARS = 20
REQUIRED_METADATA = ("recipe_id", "recipe_name", "category", "context")
MAX_TOKENS = 2048
FALLBACK_CHOSEN = "Lo siento, no puedo proporcionar esa información en este momento."
FALLBACK_REJECTED = "Es un plato tradicional. Sigue las instrucciones básicas de cocina."
NO_VIDEO_URL = "No YouTube URL provided"
BAD_VIDEO_URL = "Invalid YouTube URL format"
TRANSCRIPT_ERROR = "Error retrieving transcript"
TRANSCRIPT_MISSING = "Transcript not available"
INSTRUCTION_MARKERS = (
    "preparación",
    "elaboración",
    "cómo hacer",
    "procedimiento",
    "vamos",
    "paso a paso",
    "instrucciones",
)
INGREDIENT_HEADER = "ingrediente"
INGREDIENT_PARAGRAPH = ("ingrediente", "necesita")

# --- chat markup ------------------------------------------------------------
CHATML_START = "<|im_start|>"
CHATML_END = "<|im_end|>"
CHATML_OPENER = "<|im_start|>assistant\n"

# --- named entities in the pages of the registered queries ------------------------------------
ENTITIES = {
    "&amp;": "&",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": "\u00a0",
    "&copy;": "©",
    "&reg;": "®",
    "&deg;": "°",
    "&middot;": "·",
    "&bull;": "•",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
    "&laquo;": "«",
    "&raquo;": "»",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&iexcl;": "¡",
    "&iquest;": "¿",
    "&frac12;": "½",
    "&frac14;": "¼",
    "&frac34;": "¾",
    "&ordf;": "ª",
    "&ordm;": "º",
    "&aacute;": "á",
    "&eacute;": "é",
    "&iacute;": "í",
    "&oacute;": "ó",
    "&uacute;": "ú",
    "&uuml;": "ü",
    "&ntilde;": "ñ",
    "&Aacute;": "Á",
    "&Eacute;": "É",
    "&Iacute;": "Í",
    "&Oacute;": "Ó",
    "&Uacute;": "Ú",
    "&Ntilde;": "Ñ",
}

# --- request formats --------------------------------------------------------
# Fields are filled by name: the key is the placeholder in the text.
QUESTION_SYSTEM = """Eres un experto chef instructor que debe crear un banco de preguntas educativas en español para ayudar a las personas a aprender a preparar recetas.

INSTRUCCIONES PARA GENERAR PREGUNTAS:
Crea minino 15 o mas preguntas necesarias que sirvan para que una persona pueda aprender la receta. Cada pregunta debe:
1. Incluir el nombre de la receta en la formulación
2. Ser educativa y práctica
3. La primera preguntar en primera persona sobre pedir la receta puedes usar estos contextos: cocina informal, cocinar para invitados, cena familiar, cocina de fin de semana, comida rápida, ocasión especial, aprender a cocinar.
4. Ayudar a entender técnicas, ingredientes, pasos, tips, porciones, tiempos y significado cultural.

Haz que la pregunta suene natural y conversacional, como una persona real preguntaría. Varía la estructura de la pregunta y no siempre empieces con "¿Cómo...?" o "¿Cuál...?". Incluye el contexto naturalmente.

FORMATO DE RESPUESTA:
Responde ÚNICAMENTE con un array JSON válido. NO uses markdown, NO uses ```json, NO agregues explicaciones adicionales.
Usa esta estructura exacta para cada pregunta:
[
  {
    "question": "¿Pregunta aquí incluyendo el nombre de la receta?",
    "category": "Ingredientes y preparación",
    "question_type": "conceptual",
  }
]

IMPORTANTE: Responde SOLO con el JSON, sin texto adicional ni formato markdown."""

QUESTION_USER = """INFORMACIÓN DE LA RECETA:
- Nombre: {nombre}
- Dificultad: {dificultad}
- Tiempo: {tiempo}
- Porciones: {racion}
- Categoría: {categoria}
- Ingredientes: {ingredientes}
- Pasos: {pasos}

Genera las 15 preguntas para la receta "{nombre}" en formato JSON:"""

CHOSEN_USER = """Responde la siguiente pregunta sobre la receta "{nombre}" de manera completa, precisa y culturalmente auténtica.

Pregunta: {question}

Información de la receta:
- Nombre: {nombre}
- Ingredientes: {ingredientes}
- Tiempo: {tiempo}
- Dificultad: {dificultad}
- Raciones: {racion}
- Valor nutricional: {valor_nutricional}

Pasos de preparación: {pasos}

Proporciona una respuesta que sea:
1. Técnicamente precisa y completa
2. Culturalmente auténtica para el origen de la receta
3. Práctica y útil para cocinar
4. Clara y en español natural
5. Específica para esta receta"""

REJECTED_SYSTEM = "Responde brevemente sobre cocina, pero no profundices demasiado en los detalles técnicos o culturales."

REJECTED_USER = """Responde la pregunta sobre {nombre} de manera básica.

Pregunta: {question}

Información de la receta:
- Nombre: {nombre}
- Ingredientes: {ingredientes}
- Tiempo: {tiempo}
- Dificultad: {dificultad}
- Raciones: {racion}
- Valor nutricional: {valor_nutricional}

Pasos de preparación: {pasos}

Proporciona una respuesta que sea:
1. Correcta pero incompleta o mal formada
2. General, no específica el origen
3. Breve y con detalles técnicos pero sin profundidad
4. Sin contexto cultural específico"""

# (token cap, temperature) of each request kind
QUESTION_LIMITS = (4096, 0.7)
CHOSEN_LIMITS = (8192, 0.7)
REJECTED_LIMITS = (2048, 0.9)
