"""DuckDB SQL for the queries that SQL can express over whole tables.

The others (hashes, a tokenizer, a trained model, substrings of bytes) are held against
plain versions in the tests.
"""

from __future__ import annotations

from postmill.llm import divergence, licenses
from postmill.llm.common import ASCII_LOWER, ASCII_UPPER
from postmill.llm.secret_scans import BASE_RULES, RULES

_RULES = """(values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')) rules(rule, domain, begin, verdict)"""

OP1 = f"""with rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{ASCII_UPPER}', '{ASCII_LOWER}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rest),
fits as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from parts, {_RULES}
  where (host = domain or ends_with(host, '.' || domain)) and starts_with(path, begin)
  group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join fits using (page_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Patterns for the second engine, which has no possessive loops and looks at nothing ahead.
#: Keys without their END line are not in it: the tests hold those against a plain version.
_SECOND = {
    "private_key": r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?s:.*?)"
    r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----",
    "credentials": r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]*:([^\s/:@]{3,})@",
}


def _spans(rank: int) -> str:
    """Spans of one rule: a match begins after all pieces and matches before it."""
    rule = RULES[rank]
    pattern = _quoted(_SECOND.get(rule.kind, rule.pattern))
    return f"""
  select doc_id, {rank} as rank, {_quoted(rule.kind)} as kind,
    list_sum(list_transform(pieces[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) as start,
    length(matches[i]) as width
  from (
    select *, unnest(range(1, len(matches) + 1)) as i
    from (
      select doc_id, regexp_split_to_array(text, {pattern}) as pieces,
        regexp_extract_all(text, {pattern}, 0) as matches, regexp_extract_all(text, {pattern}, {rule.group}) as kept
      from documents where regexp_matches(text, {pattern})))
  where length(kept[i]) >= {rule.least}"""


_LISTED = "string_agg(kind || ':' || cast(start as bigint) || ':' || cast(start + width as bigint), ',' order by start, rank)"
_BASE = len(BASE_RULES)

OP3 = f"""with spans as ({" union all ".join(_spans(rank) for rank in range(len(RULES)))}),
found as (
  select doc_id, {", ".join(f"count(*) filter (rank = {k}) as n_{rule.kind}" for k, rule in enumerate(BASE_RULES))},
    sha256(coalesce({_LISTED} filter (rank < {_BASE}), '')) as base_sha256, {_LISTED} as spans
  from spans group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in BASE_RULES)},
  coalesce(base_sha256, sha256('')) as base_sha256, coalesce(spans, '') as spans
from documents d left join found f on d.doc_id = f.doc_id"""

_WORDS = (
    r"regexp_extract_all(translate({}, '" + ASCII_UPPER + "', '" + ASCII_LOWER + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP5 = f"""with item_words as (
  select item_id, {_WORDS.format("text")} as words from benchmark where text is not null),
items as (
  select item_id, least(len(words), 10) as size, words from item_words where len(words) > 0),
windows as (
  select distinct size, item_id, array_to_string(words[i:i + size - 1], ' ') as win
  from (select *, unnest(range(1, len(words) - size + 2)) as i from items)),
doc_words as (select doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents),
places as (
  select doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') as win
  from (
    select *, unnest(range(1, cast(len(words) - size + 2 as bigint))) as i
    from doc_words, (select distinct size from windows) sizes)),
matches as (
  select doc_id, p.i, p.size, item_id from places p join windows w on p.size = w.size and p.win = w.win),
hit as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as place from matches) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from matches where item_id is not null) group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
from doc_words d left join hit h on d.doc_id = h.doc_id left join named n on d.doc_id = n.doc_id"""

OP7 = """with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
  from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5"""

#: The pages of the given tables have one article of headings and paragraphs.
OP10 = r"""with blocks as (
  select page_id, url,
    list_transform(
      regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>((?s:.*?))</article>', 1), '</?(?:p|h1)>'),
      lambda b: trim(regexp_replace(regexp_replace(b, '<[a-z/][^<>]*>', ' ', 'g'), '\s+', ' ', 'g'))) as blocks
  from pages),
texts as (
  select page_id, url,
    replace(replace(replace(replace(replace(
      array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10)),
      '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as text
  from blocks)
select page_id, url, text, length(text) as n_chars from texts"""

_PHRASES = [t for t in licenses.TEMPLATES if t.phrase]
_NOTICES = [t for t in licenses.TEMPLATES if not t.phrase]
_STRIDE = max(len(t.words) for t in _NOTICES)
_REACH = 2 * _STRIDE - 1


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_quoted, values)) + "]"


OP12 = f"""with phrases(label, base, phrase) as (
  values {", ".join(f"({_quoted(t.label)}, {str(t.base).lower()}, {_list(t.words)})" for t in _PHRASES)}),
notices(label, need, tokens) as (
  values {", ".join(f"({_quoted(t.label)}, {t.need}, {_list(t.tokens)})" for t in _NOTICES)}),
doc_words as (select doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents),
places as (
  select doc_id, label, base, i - 1 as place
  from (
    select *, unnest(range(1, cast(len(words) - len(phrase) + 2 as bigint))) as i
    from doc_words, phrases where list_contains(words, phrase[1]))
  where words[i:i + len(phrase) - 1] = phrase),
blocks as (
  select doc_id, list_distinct(words[k * {_STRIDE} + 1:k * {_STRIDE} + {_REACH}]) as block
  from (select *, unnest(range(0, cast(ceil(len(words) / {_STRIDE}) as bigint))) as k from doc_words)),
held as (
  select doc_id, label, need, len(tokens) as size, len(list_intersect(block, tokens)) as overlap from blocks, notices),
found as (
  select doc_id, label, base, place, 1.0 as score from places
  union all select doc_id, label, false, null, overlap / size from held where overlap >= need),
summed as (
  select doc_id, count(*) filter (base) as n_base, min(place) filter (base) as first_word,
    max(place) filter (base) as last_word,
    coalesce(string_agg(distinct label, ',' order by label) filter (base), '') as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(cast(score as double)) as score
  from found group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from doc_words d left join summed s on d.doc_id = s.doc_id"""

OP13 = f"""with texts as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}') as text
  from documents),
terms as (
  select row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from texts),
kept as (
  select lang, term, count(*) as total from terms group by lang, term
  having count(distinct row) >= {divergence.LEAST_DOCUMENTS}),
langs as (
  select lang, count(term) as v, coalesce(sum(total), 0) as total
  from (select distinct lang from texts) left join kept using (lang) group by lang),
groups as (select distinct lang, source from texts),
counts as (
  select g.lang, g.source, k.term, k.total, count(t.term) as n
  from groups g join kept k on g.lang = k.lang
    left join terms t on t.lang = g.lang and t.source = g.source and t.term = k.term
  group by all),
sums as (select lang, source, sum(n) as n from counts group by all),
priced as (
  select c.lang, c.source, c.term, c.n,
    1 + cast({divergence.SCALE} as hugeint) * (c.n + {divergence.SMOOTHING}) // (s.n + {divergence.SMOOTHING} * v) as p,
    1 + cast({divergence.SCALE} as hugeint) * (c.total + {divergence.SMOOTHING}) // (l.total + {divergence.SMOOTHING} * v) as q
  from counts c join sums s on c.lang = s.lang and c.source = s.source join langs l on c.lang = l.lang),
pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all select lang, source, 'term', term, p - q from priced where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}"""

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": OP1,
    "op3_secret_scan": OP3,
    "op5_decontamination": OP5,
    "op7_top_k": OP7,
    "op10_html_extraction": OP10,
    "op12_license_scan": OP12,
    "op13_source_divergence": OP13,
}
