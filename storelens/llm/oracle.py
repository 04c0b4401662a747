"""DuckDB SQL for the registered queries that SQL can express, over the same tables."""

from __future__ import annotations

from storelens.llm.chat import ASSISTANT, CONTROLS, END, HEAD, PART
from storelens.llm.licenses import TEMPLATES, TERM, THRESHOLD

# Length of the texts that may be licence files.
LICENCE_FILE_CHARS = 2000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _escaped(value: str) -> str:
    made = f"replace({value}, '\\', '\\\\')"
    for c in CONTROLS:
        made = f"replace({made}, '{c}', '{c[0]}\\{c[1:]}')"
    return made


_ROLE_HEAD = f"{len(HEAD) + 1} + length(replace({_escaped('role')}, chr(10), '\\' || chr(10)))"

_CHAT = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), ordered as (
    select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(sum(case when role = '{ASSISTANT}' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(case when role = '{ASSISTANT}' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
    cast({len(END)} + sum(length({_escaped('text')}) + case when before is null then {_ROLE_HEAD}
        when before = role then {len(PART)} else {len(END) + 1} + {_ROLE_HEAD} end) as bigint) as formatted_chars
from ordered group by conv_id
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAM = rf"""
with items as (select cast(item_id as varchar) as item_id, {_WORDS} as words from benchmark),
windows as (
    select distinct item_id, least(13, len(words)) as n, array_to_string(list_slice(words, i, i + least(13, len(words)) - 1), ' ') as said
    from items, unnest(range(1, greatest(1, len(words) - 12) + 1)) as u(i) where len(words) > 0
), docs as (select doc_id, {_WORDS} as words from documents),
places as (
    select doc_id, i, s.n, array_to_string(list_slice(words, i, i + s.n - 1), ' ') as said
    from docs, (select distinct n from windows) as s, unnest(range(1, greatest(0, len(words) - s.n + 1) + 1)) as u(i)
), hits as (
    select p.doc_id, p.i, p.n, p.said from places p where exists (select 1 from windows w where w.n = p.n and w.said = p.said)
), covered as (
    select doc_id, count(distinct place) as n_hit from hits, unnest(range(i, i + n)) as u(place) group by doc_id
), found as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as listed
    from (select distinct h.doc_id, w.item_id from hits h join windows w on w.n = h.n and w.said = h.said) as x group by doc_id
)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs d left join covered using (doc_id) left join found using (doc_id)
"""

_SAID = ", ".join(
    f"('{name}', {number}, '{text.replace(chr(39), chr(39) * 2)}')" for name, said in TEMPLATES.items() for number, text in enumerate(said)
)

_LICENCES = rf"""
with files as (
    select doc_id, concat_ws('/', source, lang, cast(cast(floor(doc_id / 100.0) as bigint) as varchar), cast(doc_id as varchar)) || '.txt' as path, text,
        coalesce(length(text) <= {{most}} and regexp_matches(lower(text), 'licen[cs]e'), false) as speaks
    from documents where doc_id is not null
), templates(licence, number, said) as (values {_SAID}),
template_terms as (
    select licence, number, term, count(*) as n
    from (select licence, number, unnest(regexp_extract_all(lower(said), '{TERM}')) as term from templates) as x group by all
), total as (select count(*) as n from files where text is not null),
frequency as (
    select term, count(*) as n from (select distinct path, unnest(regexp_extract_all(lower(text), '{TERM}')) as term from files) as x
    where term in (select term from template_terms) group by term
), weights as (
    select term, ln((total.n + 1) / (coalesce(f.n, 0) + 1)) + 1 as w
    from (select distinct term from template_terms) as t left join frequency f using (term), total
), vectors as (
    select licence, number, term, t.n * w / sqrt(sum(t.n * w * t.n * w) over (partition by licence, number)) as share
    from template_terms t join weights using (term)
), lines as (
    select path, generate_subscripts(parts, 1) - 1 as line, unnest(parts) as said
    from (select path, string_split(text, chr(10)) as parts from files where text is not null) as x
), line_terms as (
    select path, line, term, count(*) as n
    from (select path, line, unnest(regexp_extract_all(lower(said), '{TERM}')) as term from lines) as x group by all
), weighed as (
    select l.*, l.n * coalesce(w, ln(total.n + 1) + 1) as value from line_terms l left join weights using (term), total
), lengths as (select path, line, sqrt(sum(value * value)) as norm from weighed group by path, line),
close as (
    select path, line, licence, round(dot / norm, 9) as similarity
    from (select path, line, licence, number, sum(value * share) as dot from weighed join vectors using (term) group by all) as x join lengths using (path, line)
), own as (
    select * from close where similarity >= {THRESHOLD}
    qualify row_number() over (partition by path order by similarity desc, line, licence desc) = 1
), known as (
    select f.doc_id, f.path, regexp_replace(f.path, '/?[^/]*$', '') as directory, f.speaks, o.line, o.licence, o.similarity from files f left join own o using (path)
), speaking as (
    select directory as above, licence as held from known where speaks and licence is not null
    qualify row_number() over (partition by directory order by similarity desc, path) = 1
), above as (
    select directory, array_to_string(list_slice(parts, 1, n), '/') as above
    from (select distinct directory, string_split(directory, '/') as parts from known) as x, unnest(range(0, len(parts) + 1)) as u(n)
), nearest as (
    select * from above join speaking using (above) qualify row_number() over (partition by directory order by length(above) desc) = 1
)
select k.doc_id, k.path, k.directory, k.licence as own, round(k.similarity, 6) as similarity, k.line,
    case when k.licence is null then n.above end as inherited_from, coalesce(k.licence, n.held) as licence
from known k left join nearest n using (directory)
"""

_NEAR_DUP = rf"""
with recursive texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as words from documents
), shingles as (
    select distinct doc_id, array_to_string(list_slice(words, i, i + least(5, len(words)) - 1), ' ') as said
    from texts, unnest(range(1, greatest(1, len(words) - 4) + 1)) as u(i) where len(words) > 0
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select x, y from (
        select a.doc_id as x, b.doc_id as y, count(*) as shared from shingles a join shingles b on a.said = b.said and a.doc_id <> b.doc_id group by all
    ) as pairs join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y where 100 * shared >= 85 * (sx.n + sy.n - shared)
), reached(doc_id, other) as (
    select doc_id, doc_id from texts union select r.doc_id, l.y from reached r join links l on l.x = r.other
), roots as (select doc_id, min(other) as component_id from reached group by doc_id)
select t.doc_id, coalesce(n, 0) as n_shingles, component_id, t.doc_id = component_id as kept
from texts t left join sizes using (doc_id) join roots using (doc_id)
"""

_HARD_NEGATIVES = """
with rows as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
    from embeddings
    where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), anchors as (select * from rows where vec_id % 100 = 0),
scored as materialized (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_inner_product(a.q, r.q) as bigint) as score
    from anchors a join rows r on r.vec_id <> a.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""

_SPELLING = rf"""
with recursive runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents
    ) as x group by all
), hashed as (
    select run, n, xor(list_reduce(
        list_transform(range(0, cast(octet_length(said) as bigint)), lambda i: cast('0x' || hex(said)[2 * i + 1:2 * i + 2] as ubigint)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda c, unused: xor(c >> 1, (c & 1) * 3988292384::ubigint)),
        4294967295::ubigint), 4294967295::ubigint) as h
    from (select run, n, encode(coalesce(cast(doc_id as varchar), '') || ':' || run) as said from runs) as x
), words as materialized (
    select word, cast(sum(n) as bigint) as n from (
        select case when h % 97 = 0 then left(run, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word, n from hashed
    ) as x where length(word) >= 5 group by word having sum(n) >= 3
), less as materialized (
    select word, n, i, left(word, i) || substr(word, i + 2) as rest from words, unnest(range(0, length(word))) as u(i)
), near as materialized (
    select a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select a.word, a.n, b.word, b.n from less a join words b on a.rest = b.word
    union select b.word, b.n, a.word, a.n from less a join words b on a.rest = b.word
), best as (
    select word, n, count(*) over (partition by word) as n_near, other, other_n from near
    qualify row_number() over (partition by word order by other_n desc, other) = 1
), judged as materialized (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * w.n then other end as form, case when other_n >= 2 * w.n then other_n end as form_n
    from words w left join best b using (word)
), chain(word, reached, step) as (
    select word, word, 0 from judged union all
    select c.word, j.form, step + 1 from chain c join judged j on j.word = c.reached where j.form is not null
), roots as (select word, max_by(reached, step) as root from chain group by word)
select word, form, root, n, n_near, form_n from judged join roots using (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_licences": _LICENCES.replace("{most}", str(LICENCE_FILE_CHARS)), "op3_near_dup": _NEAR_DUP, "op8_chat": _CHAT, "op9_decontam": _DECONTAM,
    "op11_hard_negatives": _HARD_NEGATIVES, "op13_spelling": _SPELLING,
}
