"""SQL twins, for DuckDB, of the queries that SQL can express.

Fingerprints, trained scores and token ids are compared with brute force in ``tests/llm`` instead.
"""

from __future__ import annotations

# Letters to lower-case, the two word patterns' separators.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = r"[\x20\x09-\x0D]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str, pattern: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{pattern}'), lambda x: x <> '')"


def alnum(text: str) -> str:
    return words(LOWER.format(f"coalesce({text}, '')"), SEPARATORS)


# A mark (a private code point) stands where a blank follows a sentence end; marks have no length in the text.
SUBSTRINGS = r"""
with pieces as (
 select doc_id, unnest(x) as p, unnest(range(len(x))) as i
 from (select doc_id, regexp_extract_all(
         regexp_replace(text, '([.!?])([ \t\x0B\x0C\r])', '\1' || chr(57344) || '\2', 'g'),
         '[^\n\x{E000}]+|\n') as x from documents)),
placed as (
 select doc_id, p, i, cast(sum(length(p)) over (partition by doc_id order by i) - length(p) as int) as start,
        count(*) filter (p = chr(10)) over (partition by doc_id order by i) as line,
        regexp_extract_all(lower(p), '[\p{L}\p{N}_]+') as w
 from pieces),
units as (
 select *, list_sum(list_transform(w, lambda x: strlen(x))) as bytes,
        row_number() over (partition by doc_id order by start) as n,
        row_number() over (partition by doc_id, line order by start) = 1 as opens,
        row_number() over (partition by doc_id, line order by start desc) = 1 as closes
 from placed where len(w) > 0),
firsts as (select w, min(row(doc_id, start)) as f from units group by w having count(*) > 1),
copies as (
 select u.doc_id, u.n, u.start, cast(u.start + length(u.p) as int) as stop, len(u.w) as n_words, u.bytes, u.opens,
        u.closes, f.f, u.n - row_number() over (partition by u.doc_id order by u.n) as run
 from units u join firsts f on f.w = u.w where row(u.doc_id, u.start) <> f.f)
select doc_id, min(start) as start, max(stop) as stop, cast(sum(n_words) as bigint) as n_words,
       arg_min(f, n)[1] as first_doc_id, arg_min(f, n)[2] as first_start
from copies group by doc_id, run
having sum(bytes) >= 60 or (min(n) filter (opens) <= max(n) filter (closes) and sum(bytes) >= 30)
"""

LINES = f"""
with recursive lines as (
 select doc_id, unnest(l) as line, unnest(range(len(l))) as no
 from (select doc_id, string_split(text, chr(10)) as l from documents)),
masked as (
 select *, {words("regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g')", BLANKS)} as m,
        {words("line", BLANKS)} as raw
 from lines),
parsed as (
 select doc_id, no, len(m) as n, list_slice(m, 1, 3) as head, if(m = ['<*>'], raw, m) as t
 from masked where len(m) > 0),
forms as (
 select n, head, t, row_number() over (order by min(row(doc_id, no))) as id, min(row(doc_id, no)) as f,
        min(doc_id) as lo, max(doc_id) as hi
 from parsed group by n, head, t),
alike as (
 select a.id as a, b.id as b from forms a join forms b on a.n = b.n and a.t[1:3] = b.t[1:3] and a.id <> b.id
 where len(list_filter(range(1, a.n + 1), lambda i: a.t[i] = b.t[i])) >= 0.75 * a.n),
reached(id, root) as (
 select id, id from forms union select e.b, r.root from reached r join alike e on e.a = r.id where e.b > r.root),
templates as (select id, min(root) as root from reached group by id),
kept as (
 select root, min(f) as f from forms join templates using (id) group by root having min(lo) <> max(hi)),
gone as (
 select p.doc_id, p.no from parsed p join forms f using (n, head, t) join templates t on t.id = f.id
 join kept k on k.root = t.root where row(p.doc_id, p.no) <> k.f)
select l.doc_id, count(*) as n_lines, count(g.no) as n_dropped,
       coalesce(string_agg(cast(g.no as varchar), ',' order by g.no), '') as dropped,
       coalesce(string_agg(l.line, chr(10) order by l.no) filter (g.no is null), '') as text
from lines l left join gone g on g.doc_id = l.doc_id and g.no = l.no
group by l.doc_id
"""

QUALITY = f"""
with d as (
 select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
w as (
 select *, {words('t', BLANKS)} as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
 from d),
grams as (
 select k, i, list_slice(w, i, i + 2) as g from (select k, w, unnest(range(1, len(w) - 1)) as i from w)),
again as (select k, g from grams group by k, g having count(*) > 1),
covered as (
 select k, count(distinct j) as n from (
  select k, unnest([i, i + 1, i + 2]) as j from grams join again using (k, g)) group by k),
m as (
 select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
        len(l) as n_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09]*[-*•●‣]'))) as n_bullets,
        len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) as n_ellipses,
        len(list_intersect(w, s.stops)) as n_stop_kinds,
        len(list_filter(w, lambda x: list_contains(s.stops, lower(x)))) as n_stops
 from w cross join (select string_split('the be to of and that have with der die und den das von zu mit '
            || 'le la les de et des en un que el los las y del se por con', ' ') as stops) s left join covered c on c.k = w.k),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars / n_words between 2 and 12 and n_symbols / n_words <= 0.1 and n_stop_kinds >= 2
        and n_stops / n_words >= 0.03
        and n_dup_lines / greatest(n_lines, 1) <= 0.3 and n_bullets / greatest(n_lines, 1) <= 0.9
        and n_ellipses / greatest(n_lines, 1) <= 0.3 as kept
from f
"""

DECONTAMINATION = f"""
with d as (select row_number() over () as k, doc_id, {alnum('text')} as w from documents),
items as (
 select cast(item_id as varchar) as item_id, {alnum('text')} as w from benchmark),
phrases as (
 select distinct item_id, list_slice(w, i, i + 12) as p
 from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0)),
tokens as (select k, unnest(w) as term, unnest(range(1, len(w) + 1)) as pos from d),
found as (
 select distinct d.k, p.item_id, t.pos as s, len(p.p) as n
 from phrases p join tokens t on t.term = p.p[1] join d on d.k = t.k
 where list_slice(d.w, t.pos, t.pos + len(p.p) - 1) = p.p),
hit as (
 select k, count(distinct j) as n from (select k, unnest(range(s, s + n)) as j from found) group by k),
ids as (select k, list(distinct item_id) filter (item_id is not null) as ids from found group by k),
frequency as (select term, count(*) as n from tokens group by term),
ranked as (
 select item_id, p, o, x.term, row_number() over (partition by item_id, p order by coalesce(n, 0), o) as r
 from (select item_id, p, unnest(p) as term, unnest(range(len(p))) as o from phrases) x
 left join frequency f on f.term = x.term),
rare as (
 select item_id, p, max(term) filter (r = 1) as t1, coalesce(max(term) filter (r = 2), max(term) filter (r = 1)) as t2
 from ranked where r <= 2 group by item_id, p),
near as (
 select a.k, count(distinct r.item_id) as n
 from (select distinct item_id, t1, t2 from rare) r join tokens a on a.term = r.t1
 join tokens b on b.k = a.k and b.term = r.t2 and abs(a.pos - b.pos) <= 50
 group by a.k)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(h.n, 0) as n_hit,
       cast(coalesce(len(i.ids), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(list_sort(i.ids), ','), '')) as items_sha256,
       coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(d.w) as contaminated, coalesce(n.n, 0) as n_near
from d left join hit h on h.k = d.k left join ids i on i.k = d.k left join near n on n.k = d.k
"""


def license_sql(phrases: dict[str, str], templates: tuple[tuple[str, str], ...], threshold: float) -> str:
    longest = max(len(t.split()) for _, t in templates)
    base = ", ".join(f"('{label}', string_split('{p}', ' '))" for p, label in phrases.items())
    sets = ", ".join(f"({i}, '{label}', list_distinct(string_split('{t}', ' ')))" for i, (label, t) in enumerate(templates))
    return f"""
with d as (select row_number() over () as k, doc_id, coalesce(text, '') as t, {alnum('text')} as w from documents),
base(label, p) as (values {base}),
templates(id, label, t) as (values {sets}),
tokens as (select k, w, unnest(w) as term, unnest(range(1, len(w) + 1)) as pos from d),
places as (
 select t.k, t.pos, b.label from tokens t join base b on t.term = b.p[1]
 where list_slice(t.w, t.pos, t.pos + len(b.p) - 1) = b.p),
per_base as (
 select k, count(*) as n, min(pos) - 1 as lo, max(pos) - 1 as hi, list(distinct label) as labels from places group by k),
paragraphs as (
 select k, unnest(regexp_split_to_array(t, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n')) as p from d),
units as (
 select k, list_filter(list_transform(
   string_split(regexp_replace(p, '([.!?]){BLANKS}', '\\1' || chr(10), 'g'), chr(10)),
   lambda u: {words('lower(u)', SEPARATORS)}), lambda u: len(u) > 0) as u
 from paragraphs),
sets as (
 select k, list_distinct(u[i] || list_slice(flatten(list_slice(u, i + 1, i + {longest})), 1, {longest})) as s
 from (select k, u, unnest(range(1, len(u) + 1)) as i from units)),
met as (
 select s.k, x.label, len(list_intersect(s.s, x.t)) / len(x.t) as c
 from sets s join templates x on len(list_intersect(s.s, x.t)) >= {threshold} * len(x.t) - 1e-9),
per_block as (select k, list(distinct label) as labels, max(c) as c from met group by k)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(p.n, 0) as n_base, cast(p.lo as bigint) as first_word,
       cast(p.hi as bigint) as last_word, coalesce(array_to_string(list_sort(p.labels), ','), '') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(b.labels, [])))), ',')
         as labels,
       cast(if(p.n > 0, 1.0, coalesce(b.c, 0.0)) as double) as score
from d left join per_base p on p.k = d.k left join per_block b on b.k = d.k
"""


WARC = """
with p as (select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as n from pages),
latest as (select h, max(page_id) as of from p where n >= 1000 group by h)
select p.page_id, p.n as payload_bytes, sha1(p.h) as payload_digest,
       if(l.of is not null and l.of is distinct from p.page_id, 'revisit', 'response') as record_type,
       if(l.of is distinct from p.page_id, l.of, null) as refers_to
from p left join latest l on l.h = p.h
"""


def url_sql(rules: tuple, max_bytes: int) -> str:
    values = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    return f"""
with p as (
 select row_number() over () as k, page_id, coalesce(url, '') as u, strlen(coalesce(html, '')) as n,
        {LOWER.format(f"regexp_extract(coalesce(url, ''), '{shape}', 1)")} as host,
        regexp_extract(coalesce(url, ''), '{shape}', 2) as path,
        regexp_extract(coalesce(url, ''), '{shape}', 3) as query
 from pages),
c as (
 select *, case when contains(u, '://') then regexp_replace(host, '^www\\.', '')
   || regexp_replace(path, '(/index)?(\\.html?)?/*$', '')
   || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
        lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&'), ''), '') end
   as canonical
 from p),
listed as (select distinct canonical from c where n < {max_bytes} and canonical is not null),
rules(h, q, verdict) as (values {values}),
fits as (
 select c.k, arg_max(r.h || r.q, length(r.h || r.q)) as rule, arg_max(r.verdict, length(r.h || r.q)) as verdict
 from c join rules r on (c.host = r.h or ends_with(c.host, '.' || r.h)) and starts_with(c.path, r.q) group by c.k)
select c.page_id, c.host, c.path, f.rule, l.canonical is not null as listed,
       coalesce(f.verdict, if(l.canonical is null, 'allow', 'block')) as verdict
from c left join fits f on f.k = c.k left join listed l on l.canonical = c.canonical
"""
