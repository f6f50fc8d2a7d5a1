"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

OP2 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words
),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
both_ways as (select x, y from links union all select y, x from links),
reached(doc_id, other) as (
  select doc_id, doc_id from sets
  union
  select reached.doc_id, both_ways.y from reached join both_ways on reached.other = both_ways.x
),
least as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join least using (doc_id)
"""

OP4 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
sized as (
  select *, length('<|im_start|>') + length(role) + 1 + length(text)
      + (length(text) - length(replace(text, '\', '')))
      + (length(text) - length(replace(text, '<|', ''))) // 2
      + length('<|im_end|>') + 1 as size
  from turns
),
joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss,
    sum(size) as formatted_chars
  from sized group by conv_id
)
select conv_id, cast(n_turns as bigint) as n_turns, sha256(whole) as turns_sha256,
  cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from joined
"""

OP9 = r"""
with parts as (
  select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
),
split as (
  select page_id, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from parts
),
thin as (
  select distinct host || path as address from split
  where host <> '' and length(regexp_replace(coalesce(html, ''), '<[^>]*>', '', 'g')) < 1000
),
rules(rule_host, rule_path, rule_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
ruled as (
  select split.*,
    (select {'rule': rule_host || rule_path, 'verdict': rule_verdict} from rules
      where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
      order by length(rule_host || rule_path) desc limit 1) as best
  from split
)
select page_id, host, path, best.rule as rule,
  coalesce(best.verdict, case when host <> '' and host || path in (select address from thin) then 'block' else 'allow' end) as verdict
from ruled
"""

OP7 = r"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
pieces as (
  select doc_id, kind, kind_no, matches, counted, between
  from (
    select doc_id, 'assign' as kind, 0 as kind_no, regexp_extract_all(text, p) as matches,
      regexp_extract_all(text, p, 2) as counted, string_split_regex(text, p) as between
    from texts, (select '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' as p)
    union all
    select doc_id, 'access', 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
      regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+') from texts
    union all
    select doc_id, 'hex', 2, regexp_extract_all(text, '[0-9a-f]{32,}'),
      regexp_extract_all(text, '[0-9a-f]{32,}'), string_split_regex(text, '[0-9a-f]{32,}') from texts
  )
),
numbered as (
  select *, unnest(range(1, len(matches) + 1)) as i from pieces where len(matches) > 0
),
spans as (
  select doc_id, kind, kind_no, length(counted[i]) as counted,
    cast(list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i-1], lambda x: length(x))), 0) as bigint) as begin_at,
    length(matches[i]) as size
  from numbered
),
kept as (
  select * from spans where counted >= case kind when 'assign' then 8 when 'access' then 16 else 32 end
),
per_doc as (
  select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
    count(*) filter (where kind = 'hex') as n_hex,
    string_agg(kind || ':' || begin_at || ':' || (begin_at + size), ',' order by begin_at, kind_no) as spans
  from kept group by doc_id
)
select texts.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_doc using (doc_id)
"""

OP5 = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, d.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(d.v as double[])) as bigint) as score
  from vectors q join vectors d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""



def _step(key: str, cost: str, letter: str) -> str:
    """SQL: a (cost, audit) key, cost in twelve digits, with one more edit."""
    return f"lpad(cast(cast(substr({key}, 1, 12) as bigint) + {cost} as varchar), 12, '0') || substr({key}, 13) || '{letter}'"


# The crc32 of a plain text, bit by bit.
CRC = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""

OP13 = f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations
),
kinds as (select *, {CRC} % 20 as kind from keyed),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then replace(replace(replace(text, '.', ''), '!', ''), '?', '') else text end as text
  from kinds, (values (1), (2)) copies(copy) where kind <> 0 and (copy = 1 or kind = 3)
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as trimmed
  from damaged
),
faults as (
  select *, case when trimmed = '' then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when right(trimmed, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    left(role, 1) as initial,
    lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from placed
),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id
),
-- the best (cost, audit) after i turns with nothing, a system, a user or an assistant turn last, inserts included
search(conv_id, i, nothing, sys, usr, asst) as (
  select conv_id, 0::bigint, lpad('', 12, '0'), null::varchar, {_step("lpad('', 12, '0')", "3", "I")},
    {_step("lpad('', 12, '0')", "6", "II")} from counts
  union all
  select conv_id, i, nothing, sys, least(usr, {_step("least(nothing, sys, asst)", "3", "I")}) as usr,
    least(asst, {_step("least(usr, " + _step("least(nothing, sys, asst)", "3", "I") + ")", "3", "I")}) as asst
  from (
    select s.conv_id, f.i, {_step("nothing", "4", "D")} as nothing,
      least({_step("sys", "4", "D")}, case when keeps and initial = 's' then {_step("nothing", "extra", "K")} end) as sys,
      least({_step("usr", "4", "D")}, case when keeps and initial = 'u' then {_step("least(nothing, sys, asst)", "extra", "K")} end,
        case when keeps then {_step("least(nothing, sys, asst)", "3 + extra", "R")} end) as usr,
      least({_step("asst", "4", "D")}, case when keeps and initial = 'a' then {_step("usr", "extra", "K")} end,
        case when keeps then {_step("usr", "3 + extra", "R")} end) as asst
    from search s join (
      select *, fault not in ('blank', 'duplicate') as keeps, case when fault = 'truncated' then 3 else 0 end as extra from faults
    ) f on f.conv_id is not distinct from s.conv_id and f.i = s.i + 1
  )
),
best as (
  select c.conv_id, least(nothing, asst) as key from search s join counts c
    on c.conv_id is not distinct from s.conv_id and c.n = s.i
),
letters as (
  select conv_id, p, substr(key, 12 + p, 1) as letter
  from (select conv_id, key, unnest(range(1, length(key) - 11)) as p from best)
),
edits as (
  select *, sum((letter <> 'I')::int) over w as i, sum((letter <> 'D')::int) over w as e from letters
  window w as (partition by conv_id order by p)
),
kept as (
  select edits.conv_id, p, e, letter, role, text, max((e = 1 and letter = 'K' and initial = 's')::int) over (partition by edits.conv_id) as head
  from edits left join faults on faults.conv_id is not distinct from edits.conv_id and faults.i = edits.i and letter <> 'I'
  where letter <> 'D'
),
texts as (
  select conv_id, string_agg(case when letter = 'K' then role when (e - head) % 2 = 1 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by p) as whole from kept group by conv_id
)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  cast(coalesce(substr(key, 1, 12), '0') as bigint) as cost, coalesce(substr(key, 13), '') as audit,
  sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
  left join counts c on c.conv_id is not distinct from o.conv_id
  left join best b on b.conv_id is not distinct from o.conv_id
  left join texts t on t.conv_id is not distinct from o.conv_id
"""

OP12 = """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
sized as (
  select *, cast(strlen(payload) as bigint) as payload_bytes, max(page_id) over (partition by payload) as original from payloads
)
select page_id, payload_bytes, sha1(payload) as payload_digest,
  case when payload_bytes >= 1000 and (page_id is null or page_id < original) and original is not null then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and (page_id is null or page_id < original) then original end as refers_to
from sized
"""

SQL = {
    "op2_minhash_near_dedup": OP2,
    "op4_chat_formatting": OP4,
    "op5_exact_top_k": OP5,
    "op7_secret_scans": OP7,
    "op9_url_filters": OP9,
    "op12_warc_archives": OP12,
    "op13_conversation_repair": OP13,
}
