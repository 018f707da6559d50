"""DuckDB SQL for the queries of this subpackage."""

from __future__ import annotations

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _bare(c: str) -> str:
    return f"translate({c}, {WS}, '')"


def line_dedup(table: str) -> str:
    """CTEs that end in ``cleaned``: id, lines before, lines dropped, text left."""
    return f"""
split_lines as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from {table}),
lines as (
  select doc_id, unnest(ls) as line, unnest(generate_series(1, len(ls))) as pos from split_lines),
keyed as (
  select *, {LOWER.format(f"trim(line, {WS})")} as key from lines),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key
  having count(distinct doc_id) >= 5),
marked as (
  select keyed.*, keeper is not null and keeper <> doc_id as dropped from keyed left join shared using (key)),
cleaned as (
  select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
         coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '') as text
  from marked group by doc_id)"""


LINE_DEDUP = f"""with {line_dedup("documents")}
select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256 from cleaned"""


def _count(c: str, chars: str) -> str:
    return f"(length({c}) - length(translate({c}, '{chars}', '')))"


def _list_count(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{WORD}'))"


FURNITURE = (
    r"(?i)\b(cookie policy|accept cookies|enable javascript|privacy policy|terms of use|terms of service|all rights reserved"
    r"|lorem ipsum|click here|sign up|log in|subscribe to|read more|share this|back to top|skip to content|page not found)\b"
)


def quality(table: str) -> str:
    """CTEs that end in ``judged``."""
    return f"""
given as (select *, coalesce(text, '') as body from {table}),
raw_lines as (
  select doc_id, unnest(string_split(body, chr(10))) as line,
         unnest(generate_series(1, len(string_split(body, chr(10))))) as pos from given),
ruled as (
  select doc_id, pos, line, length({_bare("line")}) as chars, {_list_count("line")} as words,
         {_count("line", "|<>»·•")} as bars from raw_lines),
line_rules as (
  select *, chars > 0 and (
      not regexp_matches(line, '[.!?:;…。！？]')
      or {_count("line", "#*$%&|<>")} * 100 > chars * 10
      or {_count("line", "!")} * 100 > chars * 8
      or (bars >= 3 and bars * 6 >= words)
      or (words <= 30 and regexp_matches(line, '{FURNITURE}'))) as bad from ruled),
by_line as (
  select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not bad), '') as clean,
         coalesce(sum(chars) filter (where bad), 0)::bigint as lost_chars,
         count(*) filter (where chars > 0) - count(distinct line) filter (where chars > 0) as n_dup_lines
  from line_rules group by doc_id),
word_lists as (select doc_id, regexp_extract_all(body, '{WORD}') as ws from given),
word_rows as (
  select doc_id, unnest(ws) as w, unnest(generate_series(1, len(ws))) as i from word_lists),
grams as (
  select doc_id, i, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o
         || ' ' || lead(w, 4) over o as g
  from word_rows window o as (partition by doc_id order by i)),
repeated as (
  select doc_id, i from grams where g is not null qualify count(*) over (partition by doc_id, g) > 1),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from repeated, (select unnest(generate_series(0, 4)) as k) group by doc_id),
counted as (
  select g.*, len(ws) as n_words, length({_bare("body")}) as word_chars,
         {_count("body", "#*$%&|<>")} as n_symbols, n_dup_lines, lost_chars, clean,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from given g join word_lists using (doc_id) join by_line using (doc_id) left join covered using (doc_id)),
judged as (
  select *, base_failed is false and lost_chars * 100 <= word_chars * 50 as kept
  from (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted))"""


QUALITY = f"""with {quality("documents")}
select doc_id, n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines, n_repeat_words,
       lost_chars, base_failed, kept from judged"""


def _secrets() -> str:
    from heatlane.llm.secret_scan import RULES

    quoted = lambda p: p.replace("'", "''")
    parts = ",\n".join(
        f"""found_{k} as (
  select doc_id, unnest(gaps) as gap, unnest(found) as hit, unnest(vals) as val, unnest(generate_series(1, len(gaps))) as i
  from (select doc_id, string_split_regex(body, '{quoted(r.pattern)}') as gaps,
               regexp_extract_all(body, '{quoted(r.pattern)}', 0) as found,
               regexp_extract_all(body, '{quoted(r.pattern)}', {r.group}) as vals from given
        where regexp_matches(body, '{quoted(r.pattern)}'))),
spans_{k} as (
  select doc_id, {k} as k, '{r.kind}' as kind, val,
         sum(length(gap)) over w + coalesce(sum(length(hit)) over (w rows between unbounded preceding and 1 preceding), 0) as start,
         length(hit) as size
  from found_{k} window w as (partition by doc_id order by i))"""
        for k, r in enumerate(RULES)
    )
    union = " union all ".join(
        f"select doc_id, k, kind, start::bigint as start, (start + size)::bigint as stop from spans_{k} where length(val) >= {r.least}"
        for k, r in enumerate(RULES)
    )
    return f"""with given as (select doc_id, coalesce(text, '') as body from documents),
{parts},
spans as ({union}),
told as (
  select doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access,
         count(*) filter (where k = 2) as n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) filter (where k < 3) as base,
         string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) as spans from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from given left join told using (doc_id)"""


def _licenses() -> str:
    from heatlane.llm.license_scan import TEMPLATES

    quoted = lambda t: t.replace("'", "''")
    rows = ", ".join(f"('{name}', {i}, '{quoted(t)}')" for i, (name, t) in enumerate(TEMPLATES))
    other = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda c: f"list_filter(string_split_regex({LOWER.format(c)}, '{other}'), lambda x: x <> '')"
    grams = lambda c: f"list_distinct(list_transform(generate_series(1, len({c}) - 1), lambda i: {c}[i] || ' ' || {c}[i + 1]))"
    return f"""with templates as (
  select name, no, ws, {grams("ws")} as grams from (select name, no, {words("t")} as ws from (values {rows}) v(name, no, t))),
given as (select doc_id, coalesce(text, '') as body from documents),
blocks as (select doc_id, body, string_split_regex(body, '\\n[\\x20\\x09-\\x0D]*\\n') as bs from given),
units as (
  select doc_id, 'line' as unit, unnest(string_split(body, chr(10))) as part,
         unnest(generate_series(0, len(string_split(body, chr(10))) - 1)) as pos from given
  union all
  select * from (select doc_id, 'paragraph', unnest(bs) as part, unnest(generate_series(0, len(bs) - 1)) from blocks)
  where contains(part, chr(10))
  union all select doc_id, 'document', body, 0 from blocks where len(bs) > 1),
sized as (select *, {grams("ws")} as grams from (select *, {words("part")} as ws from units) where len(ws) between 2 and 3000),
matches as (
  select doc_id, unit, pos, name, 2.0::double * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams)) as dice
  from sized s join templates t on len(s.grams) * 8 <= len(t.grams) * 12 and len(t.grams) * 8 <= len(s.grams) * 12
  where len(list_intersect(s.grams, t.grams)) * 20 >= (len(s.grams) + len(t.grams)) * 8
  qualify row_number() over (partition by doc_id, unit, pos order by dice desc, name desc) = 1)
select g.doc_id, count(name) as n_matches, coalesce(string_agg(distinct name, ',' order by name), '') as licenses,
       first(name order by dice desc, name desc) as best, max(dice) as dice
from given g left join matches m using (doc_id) group by g.doc_id"""


SECRETS, LICENSES = _secrets(), _licenses()


def mixed(table: str) -> str:
    """CTEs that end in ``copies``: all columns, copy and rate."""
    return f"""
sizes as (select source, sum(length(coalesce(text, '')))::double as size from {table} group by source),
weighed as (select *, case when size > 0 then pow(size, 0.7) else 0 end as weight from sizes),
rates as (
  select source, case when size > 0 then weight / (select sum(weight) from weighed) * (select sum(size) from weighed) / size
                 else 0 end as rate from weighed),
dists as (
  select *, greatest(ceil(rate / 16), 1)::bigint as draws from rates),
cdfs as (
  select *, list_transform(generate_series(0, 63), lambda k: list_sum(list_transform(generate_series(0, k), lambda i:
              case when rate = 0 then case when i = 0 then 1.0::double else 0 end
                   else exp(-rate / draws + i * ln(rate / draws) - lgamma(i + 1)) end))) as cdf from dists),
drawn as (
  select d.*, rate, list_sum(list_transform(generate_series(1, draws), lambda j: len(list_filter(cdf, lambda c:
           c <= ('0x' || substr(md5(concat_ws('|', 42, j, doc_id)), 1, 13))::bigint / pow(2, 52)))))::bigint as times
  from {table} d join cdfs c on d.source is not distinct from c.source),
copies as (select *, unnest(generate_series(1, times)) as copy from drawn where times > 0)"""


MIX = f"""with {mixed("documents")}
select * exclude (times, rate), round(rate, 9) as rate from copies"""

TOP_K = """with fine as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
vectors as (select vec_id, min(v) as v from fine group by vec_id),
scores as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
from scores qualify rank <= 20"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = f"""with terms as (
  select row_number() over () as row, doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '{TERM}')) as term from documents where text is not null),
lengths as (select row, any_value(doc_id) as doc_id, count(*) as n from terms group by row),
whole as (select count(*) as n_docs, sum(n)::bigint as n_terms from lengths),
counts as (select row, term, count(*) as tf from terms group by row, term),
asked as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all({LOWER.format("text")}, '{TERM}')) as term from benchmark where text is not null)),
weights as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counts, whole where term in (select term from asked) group by term),
found as (
  select item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint as score
  from asked join weights using (term) join counts using (term) join lengths using (row), whole group by item_id, row, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank, doc_id, score
from found where score > 0 qualify rank <= 50"""

_CONTROL = r"(<)(\\*)(/?s>|\|[A-Za-z0-9_]*\|>|</?SYS>>)|(\[)(\\*)(/?INST\])"
_ESCAPED = f"regexp_replace({{0}}, '{_CONTROL}', '\\1\\4\\\\\\2\\5\\3\\6', 'g')"

CHAT = f"""with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
ordered as (
  select *, row_number() over turns as place, role = 'assistant' as target,
         12 + length(replace({_ESCAPED.format("role")}, chr(10), '<|nl|>')) + 1 + length({_ESCAPED.format("text")}) + 11 as size
  from given window turns as (partition by conv_id order by turn nulls last, role, text)),
summed as (
  select *, sum(size) over upto as so_far, lead(place) over upto is null as final
  from ordered window upto as (partition by conv_id order by place))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (where target), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where target), '')) as loss_sha256,
  sum(so_far) filter (where target or final)::bigint as formatted_chars
from summed group by conv_id"""

HARD_NEGATIVES = """with fine as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
vectors as (
  select vec_id, pair.label as label, pair.v as v from (
    select vec_id, min({'label': label, 'v': v}) as pair from fine group by vec_id)),
scores as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from vectors a join vectors c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
  (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::integer as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10"""
