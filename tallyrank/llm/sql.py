"""SQL twins of the queries in this folder, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
select doc_id,
       max(doc_id) over same as keep_id,
       count(*) over same as group_size,
       row_number() over (partition by {_LOWER} order by doc_id desc nulls last) = 1 as kept,
       sha256({_LOWER}) as text_sha256
from documents
window same as (partition by {_LOWER})
"""

# CRC-32 byte by byte: a table of 256 from eight rounds of shifts, then one step per byte.
_ROUNDS = ",\n".join(
    f"round{k} as (select i, xor(x >> 1, (x & 1) * 3988292384) as x from round{k - 1})"
    for k in range(1, 9)
)
_DIGIT = "instr('0123456789ABCDEF', digits[(2 * i + {})::bigint]) - 1"
SHARDING = f"""
with round0 as (select i, i::ubigint as x from range(256) t(i)),
{_ROUNDS},
crc_table as (select list(x order by i) as steps from round8),
texts as (
    select doc_id, hex(encode(coalesce(text, ''))) as digits from documents
), sized as (
    select doc_id, (length(digits) / 2)::bigint + 16 as size,
           xor(4294967295::ubigint, list_reduce(
               list_transform(range(0, (length(digits) / 2)::bigint), lambda i:
                   (16 * ({_DIGIT.format(1)}) + {_DIGIT.format(2)})::ubigint),
               lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)::bigint]),
               4294967295::ubigint))::bigint as text_crc32
    from texts, crc_table
), placed as (
    select *, sum(size) over (order by doc_id) - size as first_byte, sum(size) over () as total
    from sized
), sharded as (
    select *, ((2 * first_byte + size) * 40 // (2 * total))::int as shard from placed
)
select doc_id, size, text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by doc_id) - 1 as slot,
       null::int as grown_shard
from sharded
"""

_BENCH_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Every window of every item against every window of that size of every document.
DECONTAMINATION = f"""
with items as (
    select item_id::varchar as name, words, least(10, len(words)) as size
    from (select item_id, {_BENCH_WORDS} as words from benchmark) where len(words) > 0
), item_windows as (
    select distinct name, size, list_slice(words, start, start + size - 1) as win
    from (select *, unnest(range(1, len(words) - size + 2)) as start from items)
), docs as (
    select doc_id, {_BENCH_WORDS} as words from documents
), doc_windows as (
    select doc_id, size, start, list_slice(words, start, start + size - 1) as win
    from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as start
          from docs, (select distinct size from item_windows))
), hits as (
    select doc_id, name, size, start from doc_windows join item_windows using (size, win)
), places as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(start, start + size)) as place from hits) group by doc_id
), names as (
    select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
    from (select distinct doc_id, name from hits) group by doc_id
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join places using (doc_id) left join names using (doc_id)
"""

# Base 32 of a SHA-1: its 160 bits in 32 groups of five.
WARC = """
with payloads as (
    select page_id, encode(coalesce(html, '')) as payload from pages
), digests as (
    select page_id, octet_length(payload) as payload_bytes, payload,
           sha1(payload) as hex
    from payloads
), bits as (
    select *, list_aggregate(list_transform(range(1, 41), lambda i:
           right(bin(16 + instr('0123456789abcdef', substr(hex, i::int, 1)) - 1), 4)),
           'string_agg', '') as bits
    from digests
), ranked as (
    select *, first_value(page_id) over same as first_page, row_number() over same as place
    from bits
    window same as (partition by payload order by page_id nulls last)
)
select page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda g:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + list_sum(list_transform(range(1, 6), lambda b:
                      case when substr(bits, (5 * g + b)::int, 1) = '1'
                           then (1 << (5 - b)::int) else 0 end))::int, 1)),
           'string_agg', '') as payload_digest,
       case when place = 1 then 'response' else 'revisit' end as record_type,
       case when place > 1 then first_page end as refers_to
from ranked
"""

CHAT_FORMATTING = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations
    union all
    select -7, turn, role, '\### Assistant: </turn> ok'
    from (values (0, 'user'), (1, 'assistant')) as t(turn, role)
), marked as (
    select *,
           regexp_replace(text, '(\\*)(</?turn>|<part/>)', '\1\1\\\2', 'g') as escaped,
           replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A') as coded,
           role = lag(role) over (partition by conv_id order by turn nulls first, role, text)
               as same
    from turns
), sized as (
    select *, length(escaped) + case when same then 9
           else 7 + length(coded) + case when same is null then 0 else 9 end end as chars
    from marked
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
              order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
              filter (role = 'assistant'), '')) as loss_sha256,
       (sum(chars) + 9)::bigint as formatted_chars
from sized
group by conv_id
"""

_GROUP = "('0x' || substr(sha256('1:' || coalesce(doc_id::varchar, '')), {}, 8))::bigint"
FILL_IN_MIDDLE = f"""
with hashed as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
           {_GROUP.format(1)} as h1, {_GROUP.format(9)} as h2,
           {_GROUP.format(17)} as h3, {_GROUP.format(25)} as h4
    from documents
), cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when n = 0 or contains(text, '<P>') or contains(text, '<S>')
                     or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from hashed
), parts as (
    select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle,
           substr(text, b + 1) as suffix
    from cuts
)
select doc_id, n, form,
       case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text
              when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""

def _assignment(turn: int) -> str:
    """Nearest entries (ties: the lower index) of codebook ``turn``; squares are whole numbers."""
    return f"""
near{turn} as materialized (
    select id, part, min(((p.sq + b.sq - 2 * list_inner_product(p.x, b.x))::bigint) * 256 + entry)
               as best
    from parts p join book{turn} b using (part) group by id, part
)"""


def _next_book(turn: int) -> str:
    return f"""
sums{turn} as (
    select part, best % 256 as entry, i, sum(x[i])::bigint as s, count(*) as n
    from (select part, best, x, unnest(range(1, len(x) + 1)) as i
          from near{turn} join parts using (id, part))
    group by all
), mean{turn} as (
    select part, entry, list(((s - ((s % n) + n) % n) // n)::double order by i) as x
    from sums{turn} group by part, entry
), book{turn + 1} as materialized (
    select part, entry, coalesce(m.x, b.x) as x,
           list_inner_product(coalesce(m.x, b.x), coalesce(m.x, b.x)) as sq
    from book{turn} b left join mean{turn} m using (part, entry)
)"""


EMBEDDING_DEDUP = """
with recursive valid as materialized (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
    select a.vec_id as x, b.vec_id as y
    from valid a join valid b
      on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
     and list_cosine_similarity(a.v, b.v) >= 0.93
), reached(x, y) as (
    select vec_id, vec_id from embeddings
    union
    select reached.x, links.y from reached join links on reached.y = links.x
)
select vec_id, (select count(*) from links where x = vec_id) as n_links,
       component_id, vec_id = component_id as kept
from (select x as vec_id, min(y) as component_id from reached group by x)
"""

_ODD = "len(list_filter(embedding, lambda x: x is null or not isfinite(x)))"
VECTOR_CODES = f"""
with kept as materialized (
    select vec_id, label, row_number() over (order by vec_id nulls last, v) - 1 as id, v
    from (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
          from embeddings where embedding is not null and {_ODD} = 0)
), parts as materialized (
    select id, part, x, list_inner_product(x, x) as sq
    from (select id, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) as x
          from (select id, v, unnest(range(4)) as part from kept))
), book0 as materialized (
    select part, id as entry, x, sq from parts where id < 256
),{",".join(_assignment(t) + "," + _next_book(t) for t in range(4))},{_assignment(4)},
numbers as (
    select sha256(string_agg(number::bigint::varchar, ',' order by part, entry, i)) as digest
    from (select part, entry, unnest(x) as number, unnest(range(len(x))) as i from book4)
), coded as (
    select id, string_agg(lower(lpad(hex(best % 256), 2, '0')), '' order by part) as code,
           sum(best // 256)::bigint as error
    from near4 group by id
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       digest as codebooks_sha256
from kept join coded using (id), numbers
"""


def queries() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op2_sharding": SHARDING,
        "op4_warc": WARC,
        "op9_decontamination": DECONTAMINATION,
        "op10_chat_formatting": CHAT_FORMATTING,
        "op11_embedding_dedup": EMBEDDING_DEDUP,
        "op12_vector_codes": VECTOR_CODES,
        "op13_fill_in_middle": FILL_IN_MIDDLE,
    }
