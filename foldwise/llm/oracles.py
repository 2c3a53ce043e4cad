"""DuckDB SQL for the rows of the queries that SQL can express."""

EXACT_DEDUP = r"""
with d as (select doc_id, length(coalesce(text, '')) c, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256 from documents),
r as (select *, row_number() over w k, first_value(doc_id) over w keep_id, count(*) over (partition by text_sha256) group_size
  from d window w as (partition by text_sha256 order by c desc, doc_id nulls last))
select doc_id, keep_id, group_size, k = 1 kept, text_sha256 from r
"""

COLLOCATIONS = r"""
with p as (select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
w as materialized (select lang, row_number() over () pid, regexp_extract_all(piece, '[^\x20\x09]+') ws from p),
t as (select lang, pid, unnest(ws) w1, generate_subscripts(ws, 1) i from w where len(ws) > 0),
lead_ as (select lang, w1, lead(w1, 1) over z w2, lead(w1, 2) over z w3, lead(w1, 3) over z w4, lead(w1, 4) over z w5 from t window z as (partition by pid order by i)),
g as materialized (select lang, w1, w2, w3, w4, w5, count(*) n from lead_ group by all),
total as (select lang, sum(n) n from g group by lang),
f as materialized (select lang, len(x) k, array_to_string(x, ' ') phrase, x, sum(n) f from (
  select lang, [w1] x, n from g union all select lang, [w1, w2], n from g where w2 is not null union all select lang, [w1, w2, w3], n from g where w3 is not null
  union all select lang, [w1, w2, w3, w4], n from g where w4 is not null union all select lang, [w1, w2, w3, w4, w5], n from g where w5 is not null) group by lang, x having sum(n) >= 100),
cuts as materialized (select lang, phrase, f a, j, array_to_string(x[1:j], ' ') px, array_to_string(x[j + 1:], ' ') py from (select *, unnest(range(1, k)) j from f where k > 1)),
cut as (select c.lang, c.phrase, a, j, fx.f l, fy.f r, n, (1000::hugeint * a * n) // (fx.f::hugeint * fy.f) score
  from cuts c join f fx on fx.lang = c.lang and fx.phrase = px join f fy on fy.lang = c.lang and fy.phrase = py join total on total.lang = c.lang),
scored as (select * from cut qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (select lang, array_to_string(x[s:s + m - 1], ' ') phrase, max(f) most from (select *, unnest(range(1, k - m + 2)) s from (select *, unnest(range(2, k)) m from f where k > 2)) group by 1, 2)
select scored.lang, row_number() over (partition by scored.lang order by score desc, a desc, scored.phrase) rank, scored.phrase, a::bigint a, l::bigint l, r::bigint r, n::bigint n, score::bigint score
from scored left join inside on inside.lang = scored.lang and inside.phrase = scored.phrase
where most is null or 100 * most < 100 * a
qualify row_number() over (partition by scored.lang order by score desc, a desc, scored.phrase) <= 2000
"""

#: crc32 by its definition: the reversed polynomial, bit by bit.
PREFIX_TRIE = r"""
with own as (select conv_id, list(sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) order by turn nulls first, sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) ks,
  list(octet_length(encode(coalesce(text, ''))) order by turn nulls first, sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) sz
  from conversations where conv_id is not null group by conv_id),
heads as (select *, (xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 9)::int h from own),
rebuilt as (select a.conv_id, coalesce(b.ks, [])[1:a.h] || a.ks[a.h + 1:] ks, coalesce(b.sz, [])[1:a.h] || a.sz[a.h + 1:] sz from heads a left join own b on b.conv_id = a.conv_id - a.conv_id % 5),
spot as materialized (select conv_id, d, array_to_string(ks[1:d], '') p, case when d > 0 then array_to_string(ks[1:d - 1], '') end up, case when d > 0 then sz[d] else 0 end size, len(ks) = d is_end
  from (select *, unnest(range(0, len(ks) + 1)) d from rebuilt)),
node as materialized (select p, d depth, min(conv_id) conv_id, any_value(up) up, count(*) n_convs, any_value(size) size,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (is_end), '')) ends_sha256 from spot group by p, d),
kids as (select up p, depth - 1 depth, count(*) n_children from node where up is not null group by 1, 2),
full_ as materialized (select node.*, coalesce(n_children, 0) n_children from node left join kids using (p, depth)),
under as (select a.p, a.d depth, sum((n_children = 0)::bigint) n_leaves, sum((n_convs - 1) * f.size) saved from full_ f join spot a on a.conv_id = f.conv_id and a.d <= f.depth group by 1, 2)
select f.conv_id, f.depth, u.conv_id parent_conv_id, f.n_convs, f.n_children, n_leaves::bigint n_leaves, saved::bigint saved_tokens, f.ends_sha256
from full_ f join under using (p, depth) left join node u on u.p = f.up and u.depth = f.depth - 1
"""
