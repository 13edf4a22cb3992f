"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from pagetables.llm import chat_format, line_dedup, quality_rules, sharding, url_filter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_PLACES = ", ".join(
    f"({_text(r.name)}, {_text(r.name.partition('/')[0])}, {_text('/' + r.name.partition('/')[2])}, {_text(r.verdict)})"
    for r in url_filter.PLACES
)
_WORDS = ", ".join(f"({_text(w)})" for w in url_filter.WORDS)

OP1 = f"""
with parsed as (
  select page_id, coalesce(url, '') as url, instr(coalesce(url, ''), '://') as mark from pages
), cut as (
  select page_id, case when mark > 0 then substr(url, mark + 3) else '' end as rest from parsed
), split as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut
), urls as (select distinct host, path from split
), places(rule, rhost, rpath, action) as (values {_PLACES}
), words(word) as (values {_WORDS}
), by_place as (
  select host, path, arg_max(rule, (length(rule), rule)) as rule, arg_max(action, (length(rule), rule)) as action
  from urls, places
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by all
), by_word as (
  select host, path, arg_max(word, (length(word), word)) as word from urls, words
  where regexp_matches(host || path, '(?i)(?:^|[^a-z0-9])' || word || '(?:[^a-z0-9]|$)')
  group by all
)
select page_id, s.host, s.path, p.rule,
  coalesce(p.action, case when w.word is not null then 'block' else 'allow' end) as verdict,
  case when p.rule is null then w.word end as pattern
from split s
left join by_place p on s.host = p.host and s.path = p.path
left join by_word w on s.host = w.host and s.path = w.path
"""


def _escaped(value: str) -> str:
    out = f"replace({value}, '\\', '\\\\')"
    for c in chat_format.CHATML.control:
        out = f"replace({out}, {_text(c)}, {_text(c[0] + chr(92) + c[1:])})"
    return out


_BEGIN, _END = chat_format.CHATML.begin, chat_format.CHATML.end

OP2 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as every,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
    string_agg(role, ',' order by turn, role, text) as roles,
    sum(length({_escaped('role')}) + length({_escaped('text')})
      + {len(_BEGIN) + 1 + len(_END)})::bigint as formatted_chars
  from turns group by conv_id
)
select conv_id, n_turns, sha256(every) as turns_sha256, length(loss) as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars,
  regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') as valid
from joined
"""

_RULE = line_dedup.Boilerplate()

OP5 = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents
), pages as (select distinct host, text from docs
), totals as (select host, count(*) as pages from pages group by host
), lines as (
  select distinct host, text, trim(unnest(string_split(text, chr(10))), ' \t\n\x0b\x0c\r') as line from pages
), gone as (
  select host, line from (select host, line, count(*) as n from lines where line <> '' group by all)
  join totals using (host) where n >= {_RULE.min_pages} and n * 100 > pages * {_RULE.percent}
), placed as (
  select r, host, generate_subscripts(string_split(text, chr(10)), 1) as i,
    unnest(string_split(text, chr(10))) as raw from docs
), judged as (
  select p.r, p.i, p.raw, g.line is not null as dropped,
    trim(p.raw, ' \t\n\x0b\x0c\r') <> '' as full_line
  from placed p left join gone g on p.host = g.host and trim(p.raw, ' \t\n\x0b\x0c\r') = g.line
), built as (
  select r, count(*) filter (full_line) as n_lines, count(*) filter (dropped) as n_dropped,
    coalesce(string_agg(raw, chr(10) order by i) filter (not dropped), '') as text
  from judged group by r
)
select doc_id, n_lines, n_dropped, b.text from docs join built b using (r)
"""

_Q = quality_rules.Rules()
_SYMBOLS = "[#*$%&|<>]"

OP6 = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), raw as (
  select r, generate_subscripts(string_split(text, chr(10)), 1) as i,
    unnest(string_split(text, chr(10))) as line from docs
), lines as (
  select r, i, line, list_filter(regexp_split_to_array(line, '{SPACE}'), lambda x: x <> '') as w from raw
), judged as (
  select r, i, line, w, len(w) as n, len(w) > 0 and (
      length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) * 100 > length(line) * {_Q.symbol_percent}
      or (length(regexp_replace(line, '[^|»›·•]', '', 'g')) >= 3
        and length(regexp_replace(line, '[^|»›·•]', '', 'g')) * 100 > len(w) * {_Q.separator_percent})
      or (len(w) >= 4 and len(regexp_extract_all(line, '{_Q.shouts}')) * 100 > len(w) * {_Q.shout_percent})
      or (len(w) <= {_Q.fragment_words}
        and not regexp_matches(line, '[.!?…:;。！？]["''”’»)\\]]*[\\x20\\x09-\\x0D]*$'))
      or (len(w) >= 10 and len(list_distinct(w)) * 100 < len(w) * {_Q.distinct_percent})
      or regexp_matches(line, '{_Q.boilerplate}')
    ) as fails
  from lines
), tokens as (
  select r, flatten(list(w order by i)) as w, sum(n) as n_words,
    coalesce(sum(n) filter (not fails), 0) as clean_words, count(*) filter (fails) as n_dropped_lines,
    count(*) filter (n > 0) - count(distinct line) filter (n > 0) as n_dup_lines
  from judged group by r
), windows as (
  select r, k, array_to_string(w[k:k + 4], ' ') as five
  from (select r, w, unnest(range(1, greatest(len(w) - 3, 1)::bigint)) as k from tokens)
), twice as (
  select r, k from (select r, k, count(*) over (partition by r, five) as c from windows) where c > 1
), repeated as (
  select r, count(distinct k + d) as n from twice, (select unnest(range(0, 5)) as d) group by r
), counted as (
  select doc_id, t.n_words::bigint as n_words,
    length(regexp_replace(text, '{SPACE}', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    n_dup_lines, coalesce(p.n, 0) as n_repeat_words, n_dropped_lines, clean_words::bigint as clean_words
  from docs join tokens t using (r) left join repeated p using (r)
)
select *, n_words < {_Q.min_words} or 100 * n_repeat_words > {_Q.max_repeat_percent} * n_words as base_failed,
  not (n_words < {_Q.min_words} or 100 * n_repeat_words > {_Q.max_repeat_percent} * n_words)
    and clean_words * 100 >= n_words * {_Q.min_left_percent} as kept
from counted
"""

_S = sharding.Shards()

OP8 = f"""
with docs as (
  select row_number() over () as r, doc_id, strlen(coalesce(text, '')) as bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, {sharding.KEY_BITS // 4}))::bigint as hash
  from documents
), nodes as (
  select depth, hash >> ({sharding.KEY_BITS} - depth)::int as prefix, sum(bytes)::bigint as bytes, count(*) as n
  from docs, (select unnest(range(0, {sharding.KEY_BITS + 1})) as depth) group by all
), fits as (select depth, prefix, bytes from nodes where bytes <= {_S.limit} or n = 1
), leaves as (
  select r, min(depth) as depth, arg_min(f.bytes, depth) as shard_bytes
  from docs d join fits f on f.prefix = d.hash >> ({sharding.KEY_BITS} - f.depth)::int group by r
)
select doc_id, bytes, depth, shard_bytes,
  case when depth = 0 then 'root'
    else right(lpad(bin(hash >> ({sharding.KEY_BITS} - depth)::int), {sharding.KEY_BITS}, '0'), depth) end as shard
from docs join leaves using (r)
"""

OP11 = """
with records as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
  select payload_digest, min(page_id) as first from records where payload_bytes >= 100 group by all
), judged as (
  select r.*, case when first is not null and r.page_id is distinct from first then first end as refers_to
  from records r left join firsts f on f.payload_digest = r.payload_digest
)
select page_id, payload_bytes, payload_digest,
  case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to
from judged
"""
