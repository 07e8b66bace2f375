"""The derived inputs of ``derived.py`` as SQL, shared by all oracle queries."""

from __future__ import annotations

from pairforge import constants as K
from pairforge.operators.pages import CONTAINERS, HEADINGS, PARAGRAPH_ENDS
from pairforge.plans import derived as D


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit(K.RX_STRIP)}, '', 'g')"


def tokens(expr: str) -> str:
    return f"cast(len(regexp_extract_all({expr}, {lit(K.RX_TOKEN)})) as bigint)"


def blank(expr: str) -> str:
    return f"({strip(expr)} = '')"


def sentences(expr: str) -> str:
    pieces = f"regexp_extract_all({expr}, {lit(K.RX_SENTENCE)})"
    return f"list_filter(list_transform({pieces}, lambda s: {strip('s')}), lambda s: s <> '')"


def words(expr: str) -> str:
    stop = ", ".join(lit(word) for word in D.STOP_WORDS)
    found = f"regexp_extract_all(lower({expr}), {lit(K.RX_WORD)})"
    return f"list_filter({found}, lambda w: w not in ({stop}))"


def mapped(expr: str, table: dict[str, str], default: str) -> str:
    arms = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in table.items())
    return f"(case {expr} {arms} else {lit(default)} end)"


def category(expr: str) -> str:
    return mapped(f"coalesce({expr}, {lit(K.DEFAULT_BANK_CATEGORY)})", K.CATEGORY_MAP, K.DEFAULT_CATEGORY)


def difficulty(expr: str) -> str:
    return mapped(expr, K.DIFFICULTY_MAP, K.DEFAULT_DIFFICULTY)


def system_text(expr: str) -> str:
    kind = mapped(expr, K.MESSAGE_TYPE_MAP, K.DEFAULT_MESSAGE_TYPE)
    return mapped(kind, K.SYSTEM_MESSAGES, K.SYSTEM_MESSAGES[K.DEFAULT_MESSAGE_TYPE])


def template(text: str, fields: dict[str, str]) -> str:
    out = lit(text)
    for name, expr in fields.items():
        out = out.replace("{" + name + "}", f"' || {expr} || '")
    return f"({out})"


def label(key: str) -> str:
    return f"([{', '.join(lit(x) for x in D.BANK_LABELS)}])[{key} % {len(D.BANK_LABELS)} + 1]"


def question_type(key: str) -> str:
    return f"(case {key} % 3 when 0 then 'conceptual' when 1 then 'contextual' else 'practical' end)"


def decode(expr: str) -> str:
    for name, char in sorted(K.ENTITIES.items(), key=lambda entity: entity[1] == "&"):
        expr = f"replace({expr}, {lit(name)}, {lit(char)})"
    return expr


def attr(expr: str, name: str) -> str:
    pattern = rf"""(?is)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    value = f"regexp_extract({expr}, {lit(pattern)}, 1)"
    return decode(f"""regexp_replace({value}, '^["'']|["'']$', '', 'g')""")


def round_percent(part: str, total: str) -> str:
    return f"round({part} * 100.0 / cast({total} as double), 2)"


def chatml(*turns: tuple[str, str]) -> str:
    return " || ".join(f"'<|im_start|>{role}' || chr(10) || {text} || '<|im_end|>' || chr(10)" for role, text in turns)


def _decor(templates: list[str]) -> str:
    arms = " ".join(
        f"when {i} then replace({lit(t)}, '{{id}}', cast(page_id as varchar))" for i, t in enumerate(templates)
    )
    return f"(case page_id % 6 {arms} else '' end)"


_HEADINGS = ", ".join(lit(tag) for tag in HEADINGS)
_CONTAINERS = ", ".join(lit(tag) for tag in CONTAINERS)
_P_ENDS = ", ".join(lit(tag) for tag in PARAGRAPH_ENDS)
_SESSIONS = ", ".join(lit(s) for s in D.SESSIONS)
_DECOR = [D.FEATURED if i == 4 else "" for i in range(6)]

# markup pieces, written apart from the pattern that the operators use
_MARKUP = r"""<[[:alpha:]/!?](?:"[^"]*"|'[^']*'|[^'">])*>|<[[:alpha:]/!?][^>]*>|(?:[^<]|<[^[:alpha:]/!?<])+|<"""

CTES = {
    "d_recipe": f"""
        select doc_id as id, 'Receta ' || doc_id as nombre,
          regexp_extract_all(text, {lit(K.RX_WORD)}) as ingredientes, {sentences("text")} as pasos,
          '30 min' as tiempo, case when doc_id % 11 <> 0 then 'Media' end as dificultad, '4' as racion,
          case when doc_id % 3 <> 0 then '200 kcal' end as valor_nutricional,
          case when doc_id % 7 <> 0 then source end as categoria,
          case when doc_id % 2 <> 0 then 'Colombia' end as pais
        from documents""",
    "d_question": f"""
        select case when conv_id % 10 <> 0 then conv_id end as recipe_id, 'Receta ' || conv_id as recipe_name,
          case when turn % 5 = 4 then '' else text end as questions, {label("conv_id")} as questions_category,
          {question_type("turn")} as question_type, turn as position
        from conversations where role = 'user'""",
    "d_pair": f"""
        select conv_id, sys, usr, chosen, rejected, case when conv_id % 10 <> 0 then conv_id end as recipe_id,
          'Receta ' || conv_id as recipe_name, {category(label("conv_id"))} as category,
          {question_type("conv_id")} as context
        from (select role, conv_id * 1000003 + turn as conv_id, text as usr,
            coalesce(last_value(case when role = 'system' then text end ignore nulls) over (partition by conv_id
              order by turn rows between unbounded preceding and current row), {lit(D.DEFAULT_SYSTEM)}) as sys,
            lead(case when role = 'assistant' then text end) over (partition by conv_id order by turn) as chosen,
            first_value(case when role = 'assistant' then text end ignore nulls) over (partition by conv_id
              order by turn rows between 2 following and unbounded following) as rejected
          from conversations)
        where role = 'user'""",
    "d_session_pair": f"""
        select *, ([{_SESSIONS}])[conv_id % {len(D.SESSIONS)} + 1] as session_id,
          {difficulty("category")} as difficulty_level
        from d_pair""",
    "valid_pair": """
        select * from d_session_pair
        where length(chosen) >= 50 and length(rejected) >= 20 and chosen <> rejected and recipe_id is not null""",
    "d_conv": """
        select conv_id, sys, usr, chosen, rejected,
          case when chosen is null then '' else
            concat_ws(chr(10), 'System: ' || sys, 'User: ' || usr, 'Assistant: ' || chosen) end as chosen_text,
          case when rejected is null then '' else
            concat_ws(chr(10), 'System: ' || sys, 'User: ' || usr, 'Assistant: ' || rejected) end as rejected_text
        from d_pair""",
    "measured": f"""
        select *, {tokens("chosen_text")} as chosen_length, {tokens("rejected_text")} as rejected_length,
          {blank("chosen_text")} and {blank("rejected_text")} as blank
        from d_conv""",
    "whole_conv": f"""
        select p.conv_id,
          case when p.chosen is null then '' else before || chr(10) || 'Assistant: ' || p.chosen end as chosen_text,
          case when p.rejected is null then '' else before || chr(10) || 'Assistant: ' || p.rejected end as rejected_text
        from d_pair p join (
          select q.conv_id * 1000003 + q.turn as conv_id, concat_ws(chr(10),
            case when not bool_or(c.role = 'system' and c.text is not null) then 'System: ' || {lit(D.DEFAULT_SYSTEM)} end,
            string_agg(upper(c.role[1]) || c.role[2:] || ': ' || c.text, chr(10) order by c.turn)) as before
          from conversations q join conversations c on c.conv_id = q.conv_id and c.turn <= q.turn
          where q.role = 'user' group by q.conv_id, q.turn) using (conv_id)""",
    "whole_measured": f"""
        select *, {tokens("chosen_text")} as chosen_length, {tokens("rejected_text")} as rejected_length,
          {blank("chosen_text")} and {blank("rejected_text")} as blank
        from whole_conv""",
    "d_response": """
        select q.conv_id as recipe_id, q.text as question,
          max(case when q.turn % 4 <> 2 then r.text end) as chosen, max('Breve: ' || r.text) as rejected
        from conversations q join conversations r on q.conv_id = r.conv_id and r.turn = q.turn + 1
        where q.role = 'user' and r.role = 'assistant' and q.turn % 5 <> 4 and q.conv_id % 10 <> 0
        group by 1, 2""",
    "asked": f"""
        select r.id as recipe_id, r.nombre as recipe_name, q.questions as question,
          {category("q.questions_category")} as category, coalesce(q.question_type, 'contextual') as question_type,
          r.* exclude (id, nombre)
        from d_recipe r join d_question q on r.id = q.recipe_id
        where r.id <> 0 and length(q.questions) > 0""",
    "d_page": f"""
        select page_id, url, case when page_id % 6 = 5
            then replace(h, '<head>', replace({lit(D.SHARED_IMAGE)}, '{{id}}', cast(page_id as varchar))) else h end as html
        from (select page_id, url, replace(replace(replace(html, '<article>',
            {_decor(_DECOR)} || '<div class="entry-content wide">' || {_decor(D.DECOR)}),
            '</article>', '</div>'), '<h1>', '<h1 class="entry-title">') as h from pages)""",
    "raw_tokens": f"""
        select page_id, i as pos, l[i + 1] as token
        from (select page_id, regexp_extract_all(
                regexp_replace(html, {lit(K.RX_HTML_HIDDEN)}, '', 'g'), {lit(_MARKUP)}) as l from d_page),
          unnest(range(len(l))) as t(i)""",
    "tok": f"""
        select page_id, pos,
          case when not is_tag then 'text' when token[1:2] = '</' then 'close' else 'open' end as kind,
          lower(regexp_extract(token, {lit(K.RX_HTML_TAG)}, 1)) as tag,
          case when is_tag and token[1:2] <> '</'
            then regexp_extract(token, '(?s)^<[a-zA-Z][a-zA-Z0-9]*(.*?)/?>$', 1) else '' end as attrs,
          case when not is_tag then {decode("token")} else '' end as text
        from (select *, regexp_matches(token, '^<[[:alpha:]/!?]') as is_tag from raw_tokens)""",
    "content_start": f"""
        select page_id, min(pos) as c0 from tok
        where kind = 'open' and tag = 'div'
          and list_contains(regexp_split_to_array({attr("attrs", "class")}, '\\s+'), 'entry-content')
        group by page_id""",
    "content_depth": """
        select page_id, pos, c0, sum(case when tag <> 'div' then 0 when kind = 'open' then 1
            when kind = 'close' then -1 else 0 end) over (partition by page_id order by pos) as depth
        from tok join content_start using (page_id) where pos >= c0""",
    "content": """
        select page_id, c0, coalesce(min(case when depth = 0 and pos > c0 then pos end), 2147483647) as c1
        from content_depth group by page_id, c0""",
    "marked": f"""
        select t.*, coalesce(pos > c0 and pos < c1, false) as inside,
          coalesce(last_value(case when kind = 'open' and tag = 'p' then pos
            when kind <> 'text' and tag in ({_P_ENDS}) then -1 end ignore nulls) over w, -1) as p,
          coalesce(last_value(case when kind = 'open' and tag in ({_HEADINGS}) then pos
            when kind <> 'text' and tag in ({_HEADINGS}, {_CONTAINERS}) then -1 end ignore nulls) over w, -1) as h,
          coalesce(last_value(case when kind = 'open' and tag in ('strong', 'b') then pos
            when kind <> 'text' and tag in ('strong', 'b', {_P_ENDS}) then -1 end ignore nulls) over w, -1) as b,
          sum(case when kind <> 'text' and tag in ('ul', 'ol') then case kind when 'open' then 1 else -1 end else 0 end) over w as list_level,
          sum(case when kind <> 'text' and tag = 'ul' then case kind when 'open' then 1 else -1 end else 0 end) over w as ul_level,
          sum(case when kind <> 'text' and tag = 'ol' then case kind when 'open' then 1 else -1 end else 0 end) over w as ol_level,
          sum(case when kind <> 'text' and tag in ({_CONTAINERS}) then case kind when 'open' then 1 else -1 end else 0 end) over w as level
        from tok t left join content using (page_id)
        window w as (partition by t.page_id order by t.pos rows between unbounded preceding and current row)""",
    "paragraph": f"""
        select page_id, p as spot, {strip("string_agg(case when kind = 'text' then text else '' end, '' order by pos)")} as text,
          bool_or(inside and pos = p) as inside, max(case when pos = p then level end) as level
        from marked where p >= 0 and (kind = 'text' or pos = p) group by page_id, p""",
    "heading": """
        select page_id, spot, kind, string_agg(text, '' order by pos) as text, max(tag) as tag, max(attrs) as attrs,
          bool_or(inside) as inside, max(level) as level, bool_or(in_p) as in_p
        from (
          select page_id, pos, h as spot, 'h' as kind, text, case when pos = h then tag end as tag,
            case when pos = h then attrs end as attrs, inside and pos = h as inside,
            case when pos = h then level end as level, p >= 0 and pos = h as in_p
          from marked where h >= 0 and (kind = 'text' or pos = h)
          union all
          select page_id, pos, b, 'b', text, case when pos = b then tag end, case when pos = b then attrs end,
            inside and pos = b, case when pos = b then level end, p >= 0 and pos = b
          from marked where b >= 0 and (kind = 'text' or pos = b))
        group by page_id, spot, kind""",
    "li_end": """
        select a.page_id, a.pos as spot, coalesce(min(b.pos), 2147483647) as stop
        from marked a left join marked b on b.page_id = a.page_id and b.pos > a.pos and (
          (b.kind <> 'text' and b.tag = 'li' and b.list_level = a.list_level)
          or (b.kind = 'close' and b.tag in ('ul', 'ol') and b.list_level < a.list_level))
        where a.kind = 'open' and a.tag = 'li' and a.list_level > 0 group by a.page_id, a.pos""",
    "item": f"""
        select e.page_id, e.spot, {strip("coalesce(string_agg(t.text, '' order by t.pos), '')")} as text
        from li_end e left join marked t on t.page_id = e.page_id and t.kind = 'text' and t.pos > e.spot and t.pos < e.stop
        group by e.page_id, e.spot""",
    "d_done": """
        select 'https://site.test/r/' || page_id as url from pages where url like 'http://%'""",
    "d_video": """
        select page_id as id, case page_id % 4
            when 0 then 'https://www.youtube.com/embed/' || md5(cast(page_id as varchar))[1:11] || '?feature=oembed'
            when 1 then 'https://www.youtube.com/watch?v=' || md5(cast(page_id as varchar))[1:11]
            when 2 then 'https://youtu.be/' || md5(cast(page_id as varchar))[1:11]
            else case when page_id % 8 = 7 then 'https://video.test/' || page_id end end as youtube_url,
          page_id as votos
        from pages""",
    "video_key": f"""
        select *, nullif(case when contains(youtube_url, 'embed') then regexp_extract(youtube_url, {lit(K.RX_EMBED)}, 1)
            else regexp_extract(youtube_url, {lit(K.RX_PLAIN_VIDEO)}, 1) end, '') as vid
        from d_video""",
    "d_video_page": """
        select case when page_id % 5 <> 0 then md5(cast(page_id as varchar))[1:11] end as video_id,
          html || case page_id % 7 when 0 then '"label":"1,' || lpad(cast(page_id * 7 as varchar), 3, '0') || ' likes"'
            when 1 then '"likeCount":"' || page_id * 7 || '"' when 2 then '"likesText":"' || page_id * 7 || '"'
            when 3 then '"likes":' || page_id * 7 when 4 then 'like this video along with ' || page_id * 7
            when 5 then '"likes":9 "likeCount":"' || page_id * 7 || '"' else '' end as html
        from pages""",
    "likes": f"""
        select video_id, coalesce(try_cast(replace(coalesce({
            ", ".join(f"nullif(regexp_extract(html, {lit(rx)}, 1), '')" for rx in K.RX_LIKES)
        }), ',', '') as bigint), 0) as n from d_video_page""",
    "d_segment": f"""
        select md5(cast(doc_id as varchar))[1:11] as video_id, i as seq, l[i + 1] as text
        from (select doc_id, {sentences("text")} as l from documents), unnest(range(len(l))) as t(i)""",
    "transcript": """
        select video_id, string_agg(text, ' ' order by seq) as transcript from d_segment group by video_id""",
    "told": f"""
        select k.*, case when coalesce(youtube_url, '') = '' then {lit(K.NO_VIDEO_URL)}
            when vid is null then {lit(K.BAD_VIDEO_URL)}
            when transcript is null then {lit(K.TRANSCRIPT_ERROR + ": ")} || vid || '.'
            else transcript end as youtube_transcript
        from video_key k left join transcript t on k.vid = t.video_id""",
}


def summarised(source: str, key: str, text: str, k: int = 5) -> str:
    """CTEs ending in ``summary(key, text, summary)`` over a source relation."""
    return f"""
      sent as (select {key} as k, i, l[i + 1] as body, len(l) as n_sent
        from (select {key}, {sentences(text)} as l from {source}
              where {text} <> '' and not starts_with({text}, 'Error')
                and not starts_with({text}, {lit(K.TRANSCRIPT_MISSING)})), unnest(range(len(l))) as t(i)),
      occ as (select k, i, n_sent, unnest({words("body")}) as word from sent),
      freq as (select k, word, count(*) as n from occ group by k, word),
      score as (select o.k, o.i, o.n_sent, cast(sum(f.n) as bigint) as score
        from occ o join freq f on o.k = f.k and o.word = f.word group by o.k, o.i, o.n_sent),
      best as (select *, row_number() over (partition by k order by score desc, i) as rank from score),
      picked as (select b.k, string_agg(s.body, ' ' order by b.i) as picks
        from best b join sent s on b.k = s.k and b.i = s.i where b.rank <= {k} and b.n_sent > {k} group by b.k),
      summary as (select s.{key} as k, s.{text} as text,
          case when {text} = '' or starts_with({text}, 'Error') or starts_with({text}, {lit(K.TRANSCRIPT_MISSING)})
            or len({sentences(text)}) <= {k} then {text} else coalesce(picks, '') end as summary
        from {source} s left join picked p on s.{key} = p.k)"""


def with_ctes(sql: str, extra: str = "") -> str:
    """Prefix the CTEs that ``sql`` needs, in dependency order."""
    import re

    needed: set[str] = set()
    frontier = sql + extra
    while True:
        found = {name for name in CTES if re.search(rf"\b{name}\b", frontier)} - needed
        if not found:
            break
        needed |= found
        frontier = " ".join(CTES[name] for name in found)
    parts = [f"{name} as ({body})" for name, body in CTES.items() if name in needed]
    if extra:
        parts.append(extra.strip())
    return (f"with {', '.join(parts)} " if parts else "") + sql
