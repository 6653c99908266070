"""DuckDB SQL of the queries that SQL can express.

The token queries (2, 4) need the tokenizers library, 5 adds spans by hashes of
terms, 6 hashes with a seeded XXH64, 9 is a trained model and the pipeline
holds three of these; they have no SQL and are tested against brute force.
"""

WORD = r"[^\x20\x09-\x0D]+"

# 1: word lists, each with its deletions; a line goes when an earlier one agrees with it on one.
OP1 = rf"""
with raw as (
  select d.doc_id, u.pos - 1 as pos, d.lines[u.pos] as line from
    (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents) d, unnest(range(1, len(d.lines) + 1)) u(pos)),
occ as (select doc_id, pos, line, regexp_extract_all(line, '{WORD}') as w from raw),
worded as (select * from occ where len(w) > 0),
first_of as (select line, any_value(w) as w, min(doc_id * 2147483648::hugeint + pos) as ord from worded group by line),
long_of as (select ord, w, len(w) as n from first_of where len(w) >= 2),
cut as (select ord, n, p, w[1:p - 1] || w[p + 1:n] as left_over from long_of, unnest(range(1, n + 1)) u(p)),
swap_min as (select n, p, left_over, min(ord) as m from cut group by all),
less_min as (select left_over, min(ord) as m from cut group by all),
same_min as (select w, min(ord) as m from long_of group by all),
near as (
  select c.ord from cut c join swap_min s on s.n = c.n and s.p = c.p and s.left_over = c.left_over where s.m < c.ord
  union select c.ord from cut c join same_min s on s.w = c.left_over where s.m < c.ord
  union select l.ord from long_of l join less_min s on s.left_over = l.w where s.m < l.ord),
kept as (select f.ord from first_of f where f.ord not in (select ord from near)),
lists as (
  select (ord // 2147483648)::bigint as doc_id, count(*) as n_kept,
         string_agg((ord % 2147483648)::varchar, ',' order by ord) as kept_lines from kept group by 1),
counts as (select doc_id, count(*) as n_lines from worded group by 1)
select d.doc_id, coalesce(c.n_lines, 0)::bigint as n_lines, coalesce(l.n_kept, 0)::bigint as n_kept,
       coalesce(l.kept_lines, '') as kept_lines
from documents d left join counts c using (doc_id) left join lists l using (doc_id)"""

OP3 = rf"""
with w as (select doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
win as (select doc_id, p, w[p:p + 2] as g from w, unnest(range(1, len(w) - 1)) u(p)),
again as (select doc_id, p from (select doc_id, p, count(*) over (partition by doc_id, g) as c from win) where c > 1),
hit as (select doc_id, count(distinct p + o) as n_repeat_words from again, unnest([0, 1, 2]) u(o) group by 1),
line as (select doc_id, unnest(string_split(t, chr(10))) as line from w),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines, count(*) as n_lines from line where regexp_matches(line, '{WORD}') group by 1),
m as (
  select w.doc_id, w.source, len(w.w)::bigint as n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(dup.n_dup_lines, 0)::bigint as n_dup_lines, coalesce(hit.n_repeat_words, 0)::bigint as n_repeat_words,
         coalesce(dup.n_lines, 0)::bigint as n_lines
  from w left join dup using (doc_id) left join hit using (doc_id)),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
s as (
  select *, base_failed or 100 * n_symbols > 10 * word_chars or 100 * n_repeat_words > 30 * n_words
         or 100 * n_dup_lines > 30 * n_lines as strict_failed from j),
host as (select source, count(*) as n, sum(base_failed::int) as f from s group by 1),
pop as (
  select sum(f) / sum(n)::double as mean, count(*) / sum(n)::double as r, sum(1.0 * f / n * f / n * n) / sum(n) as sq, count(*) as h from host),
mom as (select *, mean * (1 - mean) as v, sq - mean * mean as spread from pop),
prior as (
  select mean, case when h < 2 or v <= 0 or spread <= v * r then null else greatest(1e-6, (v - spread) / (spread - v * r)) end as strength from mom),
rate as (
  select source, case when strength is null then mean else (f + mean * strength) / (n + strength) end as host_rate from host, prior)
select s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       not base_failed and not (host_rate > 0.5 and strict_failed) as kept, host_rate, host_rate > 0.5 as host_rejected
from s join rate on s.source is not distinct from rate.source"""

OP7 = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::varchar, '-' || coalesce(text, ''))), 1, 15))::bigint as place from documents),
s as (select source, sum(size) as source_size from d group by 1),
r as (select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from s),
c as (select *, 2.0::double * source_size as cap, least(1.5 * sum(source_size) over (), 2.0 * sum(source_size) over ())::double as total from r),
o as (
  select *, (total - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level from c),
t as (select *, least(cap, coalesce(max(case when level * weight <= cap then level end) over (), 'infinity'::double) * weight) as target from o),
u as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from t),
v as (select *, round(target - whole * source_size)::bigint as part from u),
x as (
  select d.*, v.source_size, v.target, v.whole, v.part,
         coalesce(sum(size) over (partition by d.source order by place range between unbounded preceding and 1 preceding), 0) as before,
         sum(size) over (partition by d.source, place) as here, count(*) over (partition by d.source, place) as twins
  from d join v on d.source is not distinct from v.source)
select doc_id, size, source_size::bigint as source_size, target,
       (whole * size + case when part <= before then 0 when part >= before + here then size
                            else least(floor((part - before) / twins), size) end)::bigint as taken
from x"""

OP8 = r"""
with added as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from added),
e as (
  select *, replace(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), '<|', '<\|') as shown from m)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('### ' || role || ': ' || shown || '</turn>' || chr(10)))::bigint as formatted_chars
from e group by conv_id"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP10 = f"""
with b as (select item_id, regexp_extract_all({_LOWER.format('text')}, '{_TERM}') as w from benchmark),
win as (select distinct item_id, w[p:p + 9] as g from b, unnest(range(1, greatest(2, len(w) - 8))) u(p) where len(w) > 0),
sizes as (select distinct len(g) as k from win),
d as (select doc_id, regexp_extract_all({_LOWER.format('text')}, '{_TERM}') as w from documents),
spot as (select doc_id, p, k, w[p:p + k - 1] as g from d, sizes, unnest(range(1, greatest(1, len(w) - k + 2))) u(p)),
found as (select spot.doc_id, spot.p, spot.k, win.item_id from spot join win on spot.g = win.g),
hit as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + k)) as q from found) group by 1),
items as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, item_id::varchar as i from found) group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)"""

OP11 = f"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER.format('text')}, '{WORD}') as w from documents),
sh as (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [w]
                               else list_transform(range(1, len(w) - 2), lambda p: w[p:p + 3]) end) as g from w)),
size as (select doc_id, count(*) as n from sh group by 1),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (
  select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join link l on l.a = r.b),
comp as (select a, min(b) as component_id from reach group by 1)
select d.doc_id, coalesce(size.n, 0)::bigint as n_shingles, comp.component_id
from documents d left join size using (doc_id) left join comp on comp.a = d.doc_id"""

# CRC-32 of a list of bytes, by its table.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end))"
_CRC = "xor(list_reduce([4294967295] || {}, lambda c, b: xor(c // 256, crc.t[(xor(c, b) % 256 + 1)::int])), 4294967295)"

# 12: words near each other agree after deleting the same place, or one is the other without a place.
OP12 = rf"""
with recursive crc as materialized (select {_CRC_TABLE} as t),
runs as (
  select doc_id, r, count(*) as n from (
    select doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[A-Za-zÀ-ÿ]+')) as r from documents) group by 1, 2),
bytes as (
  select r, n, list_transform(string_split(doc_id::varchar || ':', ''), lambda x: unicode(x)::bigint) || flatten(list_transform(
    string_split(r, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [195, unicode(x)::bigint - 64] end)) as b from runs),
hashed as (select r, n, {_CRC.format('b')} as h from bytes, crc),
seen as (
  select case when h % 97 = 0 then r[1:(h % length(r))::int] || r[(h % length(r))::int + 2:] else r end as word, n from hashed),
words as (select word, sum(n)::bigint as n from seen where length(word) >= 5 group by 1 having sum(n) >= 3),
cut as (select word, n, length(word) as m, p, word[1:p - 1] || word[p + 1:] as left_over from words, unnest(range(1, length(word) + 1)) u(p)),
near as (
  select a.word, b.word as other, b.n as other_n from cut a join cut b on a.m = b.m and a.p = b.p and a.left_over = b.left_over and a.word <> b.word
  union select a.word, b.word, b.n from cut a join words b on b.word = a.left_over
  union select b.word, a.word, a.n from cut a join words b on b.word = a.left_over),
best as (
  select word, count(*) as n_near, first(other order by other_n desc, encode(other)) as other, max(other_n) as other_n from near group by 1),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near, case when b.other_n >= 2 * w.n then b.other end as form,
         case when b.other_n >= 2 * w.n then b.other_n end as form_n from words w left join best b using (word)),
path(word, spot, step) as (
  select word, word, 0 from formed union all select p.word, f.form, p.step + 1 from path p join formed f on f.word = p.spot where f.form is not null),
root as (select word, max_by(spot, step) as root from path group by 1)
select word, form, root, n, n_near, form_n from formed join root using (word)"""

# 13: a source's digests as a list, halved sixteenfold by recursion; siblings by level.
_FIELD = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_RUNS = "list_transform(range(0, (len({0}) + 15) // 16), lambda i: sha256(array_to_string({0}[i * 16 + 1:i * 16 + 16], '')))"
OP13 = f"""
with recursive crc as materialized (select {_CRC_TABLE} as t),
leaf as (
  select doc_id, source, {_LEAF.format('text')} as leaf, {_LEAF.format('low')} as changed, {_CRC.format('b')} % 5 = 0 as tampered
  from (select *, {_LOWER.format('text')} as lowered, case when text is not null then lowered end as low,
               list_transform(string_split(doc_id::varchar, ''), lambda x: unicode(x)::bigint) as b from documents), crc),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from leaf),
low(source, k, d) as (
  select source, 0, list(leaf order by place) from placed group by 1
  union all select source, k + 1, {_RUNS.format('d')} from low where len(d) > 1),
sub as (select source, max(k) as height, max_by(d, k)[1] as subroot from low group by 1),
subs as (select *, row_number() over (order by source nulls first) - 1 as place from sub),
high(k, d) as (
  select 0, list(subroot order by place) from subs having count(*) > 0
  union all select k + 1, {_RUNS.format('d')} from high where len(d) > 1),
tree as (
  select source, k, d from low where len(d) > 1
  union all select source, s.height + k, d from high, subs s where len(d) > 1),
top as (select max_by(d, k)[1] as root from high),
levels as (
  select p.doc_id, p.source, p.leaf, t.k, t.d,
         case when t.k < s.height then p.place // (16 ** t.k)::bigint else s.place // (16 ** (t.k - s.height))::bigint end as spot
  from placed p join subs s on s.source is not distinct from p.source join tree t on t.source is not distinct from p.source),
beside as (
  select doc_id, source, leaf, k, array_to_string(d[spot - spot % 16 + 1:spot], '') as l, array_to_string(d[spot + 2:spot - spot % 16 + 16], '') as r
  from levels),
proof as (select doc_id, source, leaf, string_agg(l || r, '' order by k) as siblings from beside group by 1, 2, 3),
fold(doc_id, source, leaf, k, digest) as (
  select doc_id, source, leaf, 0, case when tampered then changed else leaf end from leaf
  union all
  select f.doc_id, f.source, f.leaf, f.k + 1, sha256(b.l || f.digest || b.r) from fold f join beside b
    on b.doc_id is not distinct from f.doc_id and b.source is not distinct from f.source and b.leaf = f.leaf and b.k = f.k),
folded as (select doc_id, source, leaf, max_by(digest, k) as folded_root from fold group by 1, 2, 3)
select f.doc_id, f.leaf, s.subroot, top.root, sha256(coalesce(p.siblings, '')) as proof_sha256, f.folded_root, f.folded_root = top.root as verified
from folded f join subs s on s.source is not distinct from f.source cross join top
left join proof p on p.doc_id is not distinct from f.doc_id and p.source is not distinct from f.source and p.leaf = f.leaf"""

SQL = {"op1_line_dedup": OP1, "op3_quality_rules": OP3, "op7_mixing": OP7, "op8_chat_format": OP8, "op10_decontamination": OP10,
       "op11_ngram_join": OP11, "op12_spelling": OP12, "op13_merkle": OP13}
