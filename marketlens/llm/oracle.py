"""SQL giving the expected rows of a query, for the engine that checks them."""

from __future__ import annotations

# fixed values of the contracts: words, the mixture's seed and the chat template
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_JACCARD = f"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s from words),
tokens as (select doc_id, unnest(s) as t from sets),
sizes as (select doc_id, len(s) as n from sets),
shared as (select t from tokens group by t having count(*) > 1),
posted as (select doc_id, t from tokens semi join shared using (t)),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as k from posted a join posted b using (t)
  where a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * k >= 75 * (x.n + y.n - k)),
edges as (select a, b from links union all select b, a from links),
reach as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a)
select doc_id, cast(n as bigint) as n_shingles, least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) as component_id
from sizes
"""

_MIXING = """
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size from documents),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighted as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from sources),
levels as (
  select *, cast(sum(source_size) over () as bigint) - 3 * cast(coalesce(sum(source_size) over earlier, 0) as bigint) as rest,
    cast(sum(weight) over () as bigint) - cast(coalesce(sum(weight) over earlier, 0) as bigint) as weights from weighted
  window earlier as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
open as (select rest / weights as level from levels where rest * weight <= 3 * source_size * weights
  order by source_size / weight, source nulls last limit 1),
targets as (select source, source_size, least(cast(3 * source_size as double), coalesce((select level from open), 'inf'::double) * weight) as target
  from levels),
rates as (select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate
  from sized d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, size * (cast(floor(rate) as bigint) + cast(
  cast(('0x' || substr(md5('mix-1' || coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) / 4503599627370496.0
    < rate - floor(rate) as bigint)) as taken
from rates
"""

_CHAT = """
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (select *, length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) as coded_chars from said),
levels as (
  select conv_id, bool_or(regexp_matches(role, '</?s>|\\[/?INST\\]') or regexp_matches(text, '</?s>|\\[/?INST\\]')) as coded
  from said group by conv_id)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(1 + sum(20 + case when coded then coded_chars else length(role || text) end) as bigint) as formatted_chars
from marked join levels using (conv_id) group by conv_id
"""


_EXACT = """
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm, length(coalesce(text, '')) as chars
  from documents),
grouped as (
  select *, cast(count(*) over (partition by norm) as bigint) as group_size,
    first_value(doc_id) over (partition by norm order by chars desc, doc_id rows between unbounded preceding and unbounded following) as keep_id
  from texts)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from grouped
"""

_DIVERGENCE = f"""
with docs as (
  select row_number() over () as n, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select n, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as word from docs),
said as (select n, lang, source, translate(word, '{_UPPER}', '{_LOWER}') as term from words),
kept as (select lang, term, count(*) as total from said group by lang, term having count(distinct n) >= 10),
groups as (select distinct lang, source from docs),
counts as (
  select g.lang, g.source, k.term, k.total, coalesce(c.n, 0) as count
  from groups g join kept k using (lang) left join (select lang, source, term, count(*) as n from said group by all) c
    on c.lang = g.lang and c.source = g.source and c.term = k.term),
shares as (
  select lang, source, term, count,
    1 + (1000000000::hugeint * (count + 2)) // (sum(count) over (partition by lang, source) + 2 * count(*) over (partition by lang, source)) as p,
    1 + (1000000000::hugeint * (total + 2)) // (sum(total) over (partition by lang, source) + 2 * count(*) over (partition by lang, source)) as q
  from counts),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join shares x on x.lang = a.lang and x.source = a.source
    left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all),
terms as (
  select lang, source, term as item, cast(((p - q) * (p - q)) // (p + q) as bigint) as value from shares where count > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms)
select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from ranked
qualify part = 'pair' or rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op1_ngram_jaccard": _JACCARD, "op4_mixing": _MIXING, "op5_chat_format": _CHAT,
            "op11_exact_dedup": _EXACT, "op12_source_divergence": _DIVERGENCE}
