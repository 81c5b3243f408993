"""The operators in SQL, written without regard to how they are run."""

URLS = r"""
with parts as (
    select page_id, coalesce(instr(url, '://'), 0) > 0 as known,
        substr(url, instr(url, '://') + 3) as rest from pages),
split as (
    select page_id, case when known then translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
        case when known then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path from parts),
rules(rule_host, rule_path, action) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
    select page_id, rule_host || rule_path as rule, action from split, rules
    where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)),
best as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(action, length(rule)) as action
    from fits group by page_id)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from split left join best using (page_id)
"""

PAYLOADS = r"""
with payloads as (select page_id, coalesce(html, '') as payload from pages),
firsts as (select payload, min(page_id) as first from payloads group by payload),
hashed as (select page_id, first, octet_length(encode(payload)) as payload_bytes, sha1(payload) as hex
    from payloads join firsts using (payload)),
bits as (select page_id, string_agg(lpad(bin(('0x' || substr(hex, i * 5 + 1, 5))::bigint), 20, '0'), '' order by i)
    as bits from hashed, range(8) r(i) group by page_id),
fives as (select page_id, i, substr(bits, i * 5 + 1, 5) as five from bits, range(32) r(i)),
base32 as (select page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * five[1]::integer + 8 * five[2]::integer + 4 * five[3]::integer + 2 * five[4]::integer
        + five[5]::integer, 1), '' order by i) as payload_digest
    from fives group by page_id)
select page_id, payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from hashed join base32 using (page_id)
"""

QUALITY = r"""
with texts as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents),
windows as (
    select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
    from texts, unnest(range(1, greatest(1, len(words) - 1))) u(i)),
again as (select doc_id, i from windows qualify count(*) over (partition by doc_id, gram) > 1),
repeats as (select doc_id, count(distinct i + k) as n from again, range(3) r(k) group by doc_id),
lines as (
    select doc_id, count(*) as n, count(*) - count(distinct line) as again
    from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
figures as (
    select doc_id, text, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(again, 0) as n_dup_lines,
        coalesce(repeats.n, 0) as n_repeat_words, coalesce(lines.n, 0) as n_lines
    from texts left join repeats using (doc_id) left join lines using (doc_id)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not (base_failed or 10 * n_symbols > n_words or 10 * n_dup_lines > 3 * n_lines
        or word_chars > 15 * n_words or word_chars < 2 * n_words
        or 2 * len(regexp_extract_all(text, '\p{Lu}')) > word_chars
        or 10 * len(regexp_extract_all(text, '!!+')) > 3 * n_words) as kept
from judged
"""

DIVERGENCE = r"""
with docs as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
words as (select doc, lang, source, unnest(terms) as term from docs),
kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct doc) >= 10),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(n) as total from kept group by lang),
sizes as (
    select g.lang, g.source, coalesce(sum(n), 0) as total
    from (select distinct lang, source from docs) g left join counts using (lang, source) group by all),
shares as (
    select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
        1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (s.total + 2 * v)::hugeint as p,
        1 + (1000000000::hugeint * (k.n + 2)) // (l.total + 2 * v)::hugeint as q
    from sizes s join langs l using (lang) join kept k using (lang) left join counts c using (lang, source, term)),
sums as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from shares a join shares b using (lang, term) where a.source <> b.source group by all),
found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
    from sizes a join sizes b using (lang) left join sums s
        on s.lang = a.lang and s.source = a.source and s.item = b.source
    where a.source <> b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from shares where n > 0 and p > q)
select lang, source, part, item, value,
    row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
from found qualify part = 'pair' or rank <= 10
"""

PASSAGES = r"""
with docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
items as (
    select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
windows as (
    select distinct item, least(10, len(words)) as width, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') as phrase
    from items, unnest(range(1, greatest(2, len(words) - 8))) u(i) where len(words) > 0),
places as (
    select doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') as phrase
    from docs, (select distinct width from windows), unnest(range(1, greatest(1, len(words) - width + 2))) u(i)),
hits as (select doc_id, item, i, width from places join windows using (width, phrase)),
covered as (select doc_id, count(distinct i + k) as n_hit from hits, range(10) r(k) where k < width group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as joined
    from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(joined, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (doc_id) left join named using (doc_id)
"""

REPEATS = r"""
with raws as (select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as raw from documents),
sizes as (select *, length(raw) // 2 as n_bytes from raws),
strings as (select doc_id, i, sha256(substr(raw, 2 * i + 1, 400)) as string from sizes, unnest(range(0, n_bytes - 199)) u(i)),
again as (select doc_id, i from strings qualify count(*) over (partition by string) > 1),
edges as (select *, i > coalesce(lag(i) over (partition by doc_id order by i), -1000) + 200 as new from again),
numbered as (select *, sum(new::integer) over (partition by doc_id order by i) as span from edges),
spans as (select doc_id, span, min(i) as low, max(i) + 200 as high from numbered group by doc_id, span),
gaps as (
    select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as before from spans),
cut as (
    select doc_id, sum(high - low)::bigint as n_removed, count(*) as n_spans, max(high) as last,
        string_agg(substr(raw, 2 * before + 1, 2 * (low - before)), '' order by low) as kept
    from gaps join sizes using (doc_id) group by doc_id)
select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
    sha256(unhex(coalesce(kept || substr(raw, 2 * last + 1), raw))) as kept_sha256
from sizes left join cut using (doc_id)
"""
