"""DuckDB SQL with the same rows as the queries of this subpackage, where SQL can express
the operator on whole tables."""

from __future__ import annotations

# The table of CRC-32 (reflected polynomial, fixed value) and the checksum of a byte list.
CRC_TABLE = """crc as (select list(v order by i) as t from (select i, list_reduce(
    list_prepend(i, range(8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384)
    else x >> 1 end) as v from range(256) r(i)))"""


def crc32(codes: str) -> str:
    """SQL of the unsigned CRC-32 of a list of byte values; needs ``t`` of ``CRC_TABLE``."""
    return (f"xor(list_reduce(list_prepend(4294967295, {codes}), "
            "lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8)), 4294967295)")


WORDS = r"[^\x20\x09-\x0D]+"

PREFIX_TRIE = f"""
with {CRC_TABLE},
said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null),
own as (select conv_id, list({{'role': role, 'text': text}} order by turn nulls first,
        md5(length(role)::varchar || ':' || role || text)) as turns from said group by conv_id),
h as (select conv_id, turns, ({crc32("list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)")} % 4)::int as h
    from own, crc),
rebuilt as (select h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) as seq
    from h left join own b on b.conv_id = h.conv_id - h.conv_id % 20),
path as (select conv_id, seq, unnest(range(len(seq) + 1)) as depth from rebuilt),
node as (select seq[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
        string_agg(case when len(seq) = depth then conv_id::varchar end, ',' order by conv_id) as ends
    from path group by 1, 2),
child as (select prefix[1:depth - 1] as prefix, count(*) as n_children from node where depth > 0 group by 1),
worth as (select node.*, coalesce(n_children, 0) as n_children, case when depth = 0 then 0 else
        (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '{WORDS}')) end as saved
    from node left join child using (prefix)),
up as (select prefix, saved, n_children, unnest(range(depth + 1)) as cut from worth),
below as (select prefix[1:cut] as prefix, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
    from up group by 1)
select w.conv_id, w.depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, b.n_leaves,
    b.saved_tokens::bigint as saved_tokens, sha256(coalesce(w.ends, '')) as ends_sha256
from worth w join below b using (prefix)
left join node p on w.depth > 0 and p.prefix = w.prefix[1:w.depth - 1] and p.depth = w.depth - 1
"""

# Near words share a word with one letter removed; both removed at one place: a replacement.
SPELLING = f"""
with recursive {CRC_TABLE},
run as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
said as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
    count(*) as n from run group by 1, 2),
code as (select run, n, {crc32("flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, (unicode(c) - 64)::bigint] end))")} as h
    from said, crc),
form0 as (select case when h % 97 = 0 then left(run, (h % length(run))::int)
        || substr(run, (h % length(run))::int + 2) else run end as word, n from code),
word as (select word, sum(n)::bigint as n from form0 where length(word) >= 5 group by 1 having sum(n) >= 3),
gone as (select word, n, unnest(range(length(word))) as i from word),
less as (select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest from gone),
pair as (select distinct a.word, b.word as near, b.n as near_n from less a join less b
        on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union select a.word, w.word, w.n from less a join word w on a.rest = w.word
    union select w.word, a.word, a.n from less a join word w on a.rest = w.word),
best as (select word, count(*) as n_near, max(near_n) as top from pair group by 1),
choice as (select b.word, n_near, top, min(near) as near from best b join pair p on p.word = b.word and near_n = top
    group by 1, 2, 3),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 2 * w.n then near end as form,
        case when top >= 2 * w.n then top end as form_n from word w left join choice c using (word)),
walk as (select word, word as at_word, form from formed
    union all select walk.word, f.word, f.form from walk join formed f on walk.form = f.word)
select f.word, f.n, f.n_near, f.form, f.form_n, w.at_word as root
from formed f join walk w on w.word = f.word and w.form is null
"""

CHOSEN_PATH = f"""
with recursive doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') as w from documents),
sets as (select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1),
        lambda i: array_to_string(w[i:i + 3], ' '))) as s from doc),
part as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
pairs as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as k
    from part a join part b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2, 3, 4),
link as (select a, b from pairs where 100 * k >= 80 * (na + nb - k)),
reach as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b),
least_id as (select a, min(b) as b from reach group by 1)
select doc_id, len(s) as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id,
    doc_id = least(doc_id, coalesce(b, doc_id)) as kept
from sets left join least_id on a = doc_id
"""
