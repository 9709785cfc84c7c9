"""DuckDB SQL for the queries of this subpackage that SQL can express."""

#: Reads back what the formatter must have kept: the turns of the table and of conversation -7.
_CHATS = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -7, i, case i when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) t(i)
),
marked as (
    select *, row_number() over w as place,
        lag(role) over w as role_before, lead(role) over w as role_after,
        replace(replace(text, '\', '\0'), '<', '\1') as escaped,
        replace(replace(replace(role, '\', '\0'), '<', '\1'), '|', '\2') as escaped_role
    from turns
    window w as (partition by conv_id order by turn nulls last, role, text)
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
    cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by place), '')) as loss_sha256,
    cast(sum(length(escaped)
        + case when role_before = role then length('<|+|>') else length(escaped_role) + 4 end
        + case when role_after = role then 0 else length('<|end|>') end) as bigint) as formatted_chars
from marked group by conv_id
"""

_MIX = r"""
with sized as (
    select doc_id, source, md5(coalesce(text, '')) as digest,
        cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
        row_number() over (partition by doc_id, source, coalesce(text, '')) as copy
    from documents
),
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
    select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from per_source
),
ordered as (
    select *, sum(source_size) over () as total, sum(weight) over () as weights,
        coalesce(sum(source_size) over w, 0) as size_before, coalesce(sum(weight) over w, 0) as weight_before
    from weighed
    window w as (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
filled as (
    select *, 3 * source_size * (weights - weight_before) <= weight * (total - 3 * size_before) as is_full from ordered
),
planned as (
    select source, source_size,
        case when is_full then (3 * source_size)::double
        else weight::double
            * (total - 3 * sum(case when is_full then source_size else 0 end) over ())::double
            / (weights - sum(case when is_full then weight else 0 end) over ())::double end as target
    from filled
),
rates as (
    select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from planned
),
wholes as (
    select *, least(floor(rate), 3)::bigint as whole,
        round(target)::bigint - least(floor(rate), 3)::bigint * source_size as missing
    from rates
),
classes as (select source, length(bin(size)) - 1 as class, sum(size)::bigint as class_size from sized group by 1, 2),
summed as (
    select c.*, w.missing,
        coalesce(sum(class_size) over (partition by c.source order by class desc rows between unbounded preceding and 1 preceding), 0) as size_before,
        sum((class + 1) * class_size) over (partition by c.source order by class rows between unbounded preceding and current row) as weighed_rest
    from classes c join wholes w on c.source is not distinct from w.source
),
judged as (select *, missing > 0 and (class + 1) * (missing - size_before) >= weighed_rest as certain from summed),
chances as (
    select source, class, certain,
        missing - sum(case when certain then class_size else 0 end) over (partition by source) as left_over,
        sum(case when certain then 0 else (class + 1) * class_size end) over (partition by source) as uncertain
    from judged
),
drawn as (
    select s.*, w.source_size, w.target, w.whole, c.certain, c.left_over, case when c.certain then 0 else s.size end as asks,
        least(greatest(case when uncertain > 0 then left_over::double / uncertain::double else 0.0::double end
            * (class + 1)::double, 1e-12::double), 1 - 1e-12::double) as p,
        (('0x' || substr(md5('42|' || coalesce(s.doc_id::varchar, 'null') || '|' || s.size::varchar || '|' || s.digest || '|'
            || s.copy::varchar), 1, 13))::bigint::double + 0.5::double) / 4503599627370496.0::double as u
    from sized s join wholes w on s.source is not distinct from w.source
        join chances c on s.source is not distinct from c.source and length(bin(s.size)) - 1 = c.class
),
placed as (
    select *, coalesce(sum(asks) over (partition by source order by (u / (1 - u)) / (p / (1 - p)), doc_id, size, digest, copy
        rows between unbounded preceding and 1 preceding), 0) as start
    from drawn
)
select doc_id, size, source_size, target,
    cast(whole * size + case when certain then size else least(size, greatest(0, left_over - start)) end as bigint) as taken
from placed
"""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

#: Links by counting shared shingles of every pair that shares one; components by passing on the smallest id.
_NEAR = rf"""
with recursive words as (
    select doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents
),
shingles as (
    select distinct doc_id, unnest(case len(w) when 0 then [] when 1 then [w[1]]
        else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as shingle
    from words
),
sizes as (select doc_id, count(*) as n from shingles group by 1),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
),
links as (
    select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * s.n >= 80 * (x.n + y.n - s.n)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
    select doc_id, doc_id as other from documents
    union
    select r.doc_id, l.b from reach r join both_ways l on r.other = l.a
),
smallest as (select doc_id, min(other) as component_id from reach group by 1)
select d.doc_id, coalesce(s.n, 0) as n_shingles, component_id, component_id = d.doc_id as kept
from documents d join smallest using (doc_id) left join sizes s using (doc_id)
"""

_REPEATED_WORDS = rf"""
with words as (select doc_id, coalesce({_WORDS.format('text')}, []) as w from documents),
windows as (
    select doc_id, i, array_to_string(w[i : i + 12], ' ') as said
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words) places
),
firsts as (select said, min(doc_id) as first_doc from windows group by 1),
gone as (
    select distinct doc_id, unnest(range(i, i + 13)) as place
    from windows join firsts using (said) where first_doc < doc_id
),
kept as (
    select doc_id, p.place, p.word
    from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words) p
    anti join gone g using (doc_id, place)
),
left_over as (select doc_id, count(*) as n, string_agg(word, ' ' order by place) as said from kept group by 1)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
    sha256(coalesce(said, '')) as kept_sha256
from words left join left_over using (doc_id)
"""

#: The exact neighbours. The operator finds them all at the sizes at which SQL is compared.
_NEAREST = r"""
with vectors as (
    select vec_id, embedding::double[] as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored as (
    select q.vec_id as query_id, c.vec_id,
        list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) as score
    from vectors q join vectors c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 20
"""

_KEYWORD = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
)
_ASSIGN = _KEYWORD + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

#: A document is a repository of its source. Spans by the lengths of the pieces between the matches.
_SECRETS = rf"""
with texts as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
patterns as (
    select * from (values (0, 'assign', '{_ASSIGN}', 6), (1, 'access', 'AKIA[A-Z0-9]+', 20), (2, 'hex', '[0-9a-f]+', 24),
        (3, 'token', '[A-Za-z0-9+/_=-]+', 20)) t(kind_no, kind, pattern, least)
),
pieces as (
    select r, doc_id, source, kind_no, kind, pattern, least, string_split_regex(text, pattern) as gaps,
        regexp_extract_all(text, pattern) as matches
    from texts, patterns where regexp_matches(text, pattern)
),
each as (
    select r, doc_id, source, kind_no, kind, pattern, least, unnest(matches) as said, unnest(gaps[:len(matches)]) as gap,
        generate_subscripts(matches, 1) as nth
    from pieces
),
ends as (
    select *, sum(length(gap) + length(said)) over (partition by r, kind_no order by nth) as "end",
        case kind when 'assign' then regexp_extract(said, pattern, 2) else said end as value
    from each
),
found as (select *, "end" - length(said) as start from ends where length(value) >= least),
owned as (
    select value, count(distinct coalesce(doc_id::varchar, 'none') || '|' || coalesce(source, 'none')) as repositories,
        count(distinct coalesce('s' || source, 'none')) as owners
    from found group by 1
),
taken as (
    select f.* from found f join owned o using (value)
    where kind_no < 3 or (
        owners < 3 and repositories < 20
        and regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
        and len(list_distinct(string_split(value, ''))) >= 10
        and not regexp_matches(lower(value), 'example|sample|dummy|placeholder|changeme|your|xxxx|1234567|abcdef|redacted')
        and not exists (select 1 from found b where b.r = f.r and b.kind_no < 3 and b.start < f."end" and f.start < b."end")
    )
),
told as (
    select r, count(*) filter (where kind_no = 0) as n_assign, count(*) filter (where kind_no = 1) as n_access,
        count(*) filter (where kind_no = 2) as n_hex,
        string_agg(kind || ':' || start || ':' || "end", ',' order by start, kind_no) filter (where kind_no < 3) as base,
        string_agg(kind || ':' || start || ':' || "end", ',' order by start, kind_no) as spans
    from taken group by 1
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join told using (r)
"""

_LEXICAL = r"""
with spoken as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
),
asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
counted as (select doc_id, term, count(*) as tf from spoken group by 1, 2),
lengths as (select doc_id, sum(tf)::bigint as n from counted group by 1),
corpus as (select count(*) as docs, sum(n)::bigint as words from lengths),
weighed as (
    select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from counted, corpus group by 1
),
scored as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::bigint as score
    from asked join counted using (term) join weighed using (term) join lengths using (doc_id), corpus
    group by 1, 2
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0 qualify rank <= 10
"""

#: CRC-32 bit by bit: a byte comes in, or -1 asks for one shift. Nodes are told by their whole paths, subtrees by a row per ancestor.
_TRIE = r"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first,
            md5(octet_length(encode(coalesce(role, '')))::varchar || ' ' || coalesce(role, '') || coalesce(text, ''))) - 1 as place
    from conversations where conv_id is not null
),
convs as (
    select conv_id, conv_id - conv_id % 5 as first,
        xor(list_reduce(
            list_prepend(4294967295, flatten(list_transform(string_split(conv_id::varchar, ''),
                lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda x, t: case when t >= 0 then xor(x, t) when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end
        ), 4294967295) % 9 as taken
    from (select distinct conv_id from turns)
),
rebuilt as (
    select c.conv_id, 0 as part, place, role, text from convs c join turns t on t.conv_id = c.first and t.place < c.taken
    union all
    select c.conv_id, 1, place, role, text from convs c join turns t on t.conv_id = c.conv_id and t.place >= c.taken
),
numbered as (
    select *, row_number() over w as depth,
        string_agg(length(role) || ':' || length(text) || ':' || role || text, '') over w as path
    from rebuilt window w as (partition by conv_id order by part, place rows between unbounded preceding and current row)
),
steps as (
    select conv_id, 0 as depth, '' as path, null as parent, '' as text from convs
    union all
    select conv_id, depth, path, coalesce(lag(path) over (partition by conv_id order by depth), ''), text from numbered
),
nodes as (
    select path, depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
        any_value(octet_length(encode(text))) as size
    from steps group by path, depth
),
children as (select parent as path, count(*) as n from nodes where parent is not null group by 1),
whole as (
    select n.*, coalesce(c.n, 0) as n_children, (n_convs - 1) * size as saved, c.n is null as leaf
    from nodes n left join children c using (path)
),
below as (
    select s.path, sum(w.saved) as saved_tokens, count(*) filter (where w.leaf) as n_leaves
    from whole w join steps s on s.conv_id = w.conv_id and s.depth <= w.depth group by 1
),
ends as (
    select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
    from (select conv_id, max_by(path, depth) as path from steps group by 1) group by 1
)
select w.conv_id, cast(w.depth as bigint) as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children,
    b.n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from whole w join below b using (path) left join whole p on p.path = w.parent left join ends e on e.path = w.path
"""

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": _NEAR,
    "op2_mix_sources": _MIX,
    "op6_chat_formatting": _CHATS,
    "op7_substring_dedup": _REPEATED_WORDS,
    "op8_nearest_neighbours": _NEAREST,
    "op11_secret_scan": _SECRETS,
    "op12_lexical_search": _LEXICAL,
    "op13_prefix_trie": _TRIE,
}
