"""DuckDB SQL that states what queries of this package return."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = rf"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, unnest(case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), sizes as (
    select d.doc_id, count(s.s) as n from documents d left join shingles s using (doc_id) group by 1
), links as (
    select a.doc_id as x, b.doc_id as y
    from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, m.n, n.n
    having 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reached as (
    select doc_id as x, doc_id as y from documents
    union
    select r.x, l.y from reached r join links l on l.x = r.y
)
select s.doc_id, s.n as n_shingles, min(r.y) as component_id
from sizes s join reached r on r.x = s.doc_id group by 1, 2
"""

OP4 = """
with docs as (
    select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), strings as (
    select doc_id, unnest(range(0, greatest(length(h) // 2 - 99, 0))) as i, h from docs
), again as (
    select doc_id, i from (
        select doc_id, i, row_number() over (
            partition by substr(h, cast(2 * i + 1 as bigint), 200) order by doc_id, i) as n
        from strings) t
    where n > 1
), marked as (
    select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 100
        then 1 else 0 end as new from again
), runs as (
    select doc_id, i, sum(new) over (partition by doc_id order by i) as run from marked
), spans as (
    select doc_id, min(i) as a, max(i) + 100 as b from runs group by doc_id, run
), pieces as (
    select s.doc_id, s.a, s.b, d.h,
        coalesce(lag(s.b) over (partition by s.doc_id order by s.a), 0) as free
    from spans s join docs d using (doc_id)
), kept as (
    select doc_id, cast(sum(b - a) as bigint) as n_removed, count(*) as n_spans,
        string_agg(substr(h, cast(2 * free + 1 as bigint), cast(2 * (a - free) as bigint)), ''
            order by a) || substr(any_value(h), cast(2 * max(b) + 1 as bigint)) as h
    from pieces group by doc_id
)
select d.doc_id, length(d.h) // 2 as n_bytes, coalesce(k.n_removed, 0) as n_removed,
    coalesce(k.n_spans, 0) as n_spans, sha256(unhex(coalesce(k.h, d.h))) as kept_sha256
from docs d left join kept k using (doc_id)
"""

OP6 = """
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as line,
        generate_subscripts(string_split(text, chr(10)), 1) as i
    from documents where text is not null
), hashed as (
    select doc_id, line, i, md5(line) as h,
        coalesce(lag(md5(line)) over (partition by doc_id order by i), '') as before,
        count(*) over (partition by doc_id) as n
    from lines
), numbered as (
    select doc_id, line, i, coalesce(sum(case
            when substr(md5(before || h), 1, 1) between '0' and '4' or i = n then 1 else 0 end)
        over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as pos
    from hashed
), chunks as (
    select doc_id, pos, string_agg(line, chr(10) order by i) as bytes,
        sum(case when trim(line) <> '' then 1 else 0 end) as worded
    from numbered group by 1, 2
), later as (
    select doc_id, pos from (
        select doc_id, pos, row_number() over (partition by bytes order by doc_id, pos) as n
        from chunks where worded >= 2) t
    where n > 1
), joined as (
    select l.doc_id, l.line, l.i, l.pos, g.pos as gone
    from numbered l left join later g on g.doc_id = l.doc_id and g.pos = l.pos
)
select doc_id, count(*) as n_lines, count(gone) as n_removed_lines,
    count(distinct gone) as n_removed_chunks,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (where gone is null), '')) as kept_sha256
from joined group by doc_id
union all
select doc_id, 0, 0, 0, null from documents where text is null
"""

OP12 = """
with e as (
    select distinct vec_id,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v,
        case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
        cast(list_inner_product(a.v, b.v) as bigint) as score
    from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), p as (
    select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select p.anchor_id, p.positive_id, cast(row_number() over w as integer) as rank,
    s.other as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
    and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.other)
qualify row_number() over w <= 3
"""

OP13 = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null
), words as materialized (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i : i + k - 1], ' '))) as phrase
    from words, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k
), f as materialized (
    select lang, k, phrase, count(*) as a from grams group by all
), total as (
    select lang, sum(a) as n from f where k = 1 group by lang
), c as materialized (
    select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1 and a >= 30
), parts as materialized (
    select lang, phrase, a, i, array_to_string(w[1 : i], ' ') as head,
        array_to_string(w[i + 1 : k], ' ') as rest
    from c, (select unnest([1, 2, 3]) as i) s where i < k
), cuts as (
    select p.lang, p.phrase, p.a, p.i, l.a as l, r.a as r,
        cast((2000000 * p.a::hugeint) // (l.a + r.a) as bigint) as score
    from parts p join f l on l.lang = p.lang and l.phrase = p.head
    join f r on r.lang = p.lang and r.phrase = p.rest
), scored as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, i) = 1
), inside as (
    select lang, a, array_to_string(w[i : i + m - 1], ' ') as phrase
    from c, (select unnest([2, 3]) as m) x, (select unnest([1, 2, 3]) as i) y
    where m < k and i + m - 1 <= k
), longer as (
    select lang, phrase, max(a) as most from inside group by all
)
select s.lang, cast(row_number() over w as integer) as rank, s.phrase, s.a, s.l, s.r,
    cast(t.n as bigint) as n, s.score
from scored s join total t on t.lang = s.lang
left join longer g on g.lang = s.lang and g.phrase = s.phrase
where g.most is null or 100 * g.most::hugeint < 80 * s.a::hugeint
window w as (partition by s.lang order by s.score desc, s.a desc, s.phrase)
qualify row_number() over w <= 2000
"""

ORACLE_SQL = {
    "op2_ngram_trie_join": OP2,
    "op4_prefix_free_dedup": OP4,
    "op6_line_chunk_dedup": OP6,
    "op12_multi_index_negatives": OP12,
    "op13_collocations": OP13,
}
