"""The registered queries in SQL, for a second engine over the same files."""

from __future__ import annotations

from registered.inputs import DOMAIN, LEXICON, OTHER_DOMAIN, SHORT_YEAR_MILLIS, STOP_WORDS

_LEXICON_ROWS = ", ".join(f"('{word}', {score})" for word, score in LEXICON)
_STOP_ROWS = ", ".join(f"('{word}')" for word in STOP_WORDS)

_MAIL = """
k as (
  select doc_id as seq,
         case when doc_id % 10 = 9 then doc_id - 9 else doc_id end as kk,
         text
  from documents),
mail as (
  select seq,
    concat('user', cast(kk % 37 as varchar),
           case when (kk % 37) % 3 = 0 then '@partner.example.org'
                else '@corp.example.com' end) as sender,
    915148800000 + ((kk * 7919) % 1460) * 86400000 + (kk % 86400) * 1000 as ts,
    case when seq % 10 = 9 then null
         when seq % 5 = 0 then concat('user', cast((seq * 7 + 3) % 11 as varchar), '@corp.example.com, USER',
                                      cast((seq * 11 + 5) % 13 as varchar), '@Corp.example.com,')
         else concat('user', cast((seq * 7 + 3) % 11 as varchar), '@corp.example.com') end as recipients,
    case when seq % 13 = 0 then null else concat('Subject ', cast(seq as varchar)) end as subject,
    case when seq % 4 = 0 then 'cc@corp.example.com' end as x_cc,
    case when seq % 8 = 0 then 'bcc@corp.example.com' end as x_bcc,
    text
  from k)"""

_CLEAN = r"regexp_replace(replace({}, '''', ''), '\W+', ' ', 'g')"

_EMAILS = f"""{_MAIL},
messages as (
  select seq, sender, ts, concat('m', cast(seq as varchar)) as mid, recipients, subject,
    coalesce(x_bcc, x_cc) as cc,
    {_CLEAN.format("chr(10) || text || chr(10)")} as body
  from mail),
emails as (
  select sender as "from", ts, arg_max(mid, seq) as mid, ts as date,
    arg_max(recipients, seq) as "to", arg_max(subject, seq) as subject,
    arg_max(cc, seq) as cc, cast(null as varchar) as bcc, arg_max(body, seq) as body
  from messages group by sender, ts)"""

_SCORED = f"""{_EMAILS},
lexicon(word, score) as (values {_LEXICON_ROWS}),
tokens as (
  select "from", ts, unnest(string_split(lower(body), ' ')) as word from emails),
scores as (
  select t."from", t.ts,
    cast(case when count(l.score) > 0 then cast(sum(l.score) as double) / count(l.score) else 0 end as float)
      as sentiment
  from tokens t left join lexicon l on t.word = l.word
  group by t."from", t.ts),
scored as (
  select e.*, s.sentiment from emails e join scores s on e."from" = s."from" and e.ts = s.ts)"""

_COUNTS = f"""{_EMAILS},
stop(word) as (values {_STOP_ROWS}),
all_words as (
  select "from", ts, unnest(string_split(lower(body), ' ')) as word from emails),
counts as (
  select "from", ts, word, count(*) as tf from all_words
  where length(word) >= 3 and word not in (select word from stop)
  group by "from", ts, word),
frequency as (select word, cast(count(*) as double) as df from counts group by word),
idf as (select word, log2((select sum(df) from frequency) / df) as idf from frequency)"""


def _imported(mid: str, to: str, cc: str, bcc: str) -> str:
    body = _CLEAN.format("chr(10) || rtrim(text, chr(10)) || chr(10)")
    return f"""{_MAIL},
good as (
  select seq, sender, case when seq % 101 = 8 then {SHORT_YEAR_MILLIS} else ts end as ts, {mid} as mid, {to} as recipients, subject, {cc} as cc, {bcc} as bcc,
    case when rtrim(text, chr(10)) = '' then '' else {body} end as body
  from mail where seq % 101 not in (1, 2, 3, 4, 5)),
emails as (
  select sender as "from", ts, arg_max(mid, seq) as mid, ts as date,
    arg_max(recipients, seq) as "to", arg_max(subject, seq) as subject,
    arg_max(cc, seq) as cc, arg_max(bcc, seq) as bcc, arg_max(body, seq) as body
  from good group by sender, ts)"""


_IMPORTED = _imported(
    "concat('m', cast(seq as varchar))", "recipients", "coalesce(x_bcc, x_cc)", "cast(null as varchar)"
)
_IMPORTED_INTENDED = _imported(
    "concat('m', cast(seq as varchar), 'x')",
    "case when seq % 7 = 0 then recipients || chr(9) || 'late@corp.example.com' else recipients end",
    "x_cc",
    "x_bcc",
)
_REASON = """case seq % 101 when 1 then 'no_date' when 2 then 'bad_date' when 3 then 'no_id'
  when 4 then 'no_from' when 5 then 'bad_id' end"""

_STAMP = """case seq % 101
  when 6 then strftime(make_timestamp(ts * 1000) - interval 1 day, '%a, %d %b %Y ')
    || printf('%02d', hour(make_timestamp(ts * 1000)) + 24) || strftime(make_timestamp(ts * 1000), ':%M:%S +0000')
  when 7 then strftime(make_timestamp(ts * 1000), '%a, %d %b %Y ') || '0:0:' || cast(ts // 1000 % 86400 as varchar) || ' +0000'
  when 8 then 'Mon, 14 May 01 16:39:00 -0700'
  when 9 then strftime(make_timestamp(ts * 1000), '%a, %d %b %Y %H:%M:%S GMT')
  else strftime(make_timestamp(ts * 1000), '%a, %d %b %Y %H:%M:%S +0000') end"""

_TURN_CELLS = """
cells as (
  select conv_id, turn as ts, 'role' as "column", role as value from conversations where role is not null
  union all
  select conv_id, turn, 'text', text from conversations where text is not null),
text_cells as (
  select conv_id, turn as ts, text as value from conversations where text is not null)"""

_LINES = """
lines as (
  select case event_type
    when 'error' then concat(event_type, ':', cast(user_id as varchar), ':x')
    when 'signup' then concat(event_type, ':u', cast(user_id as varchar))
    when 'view' then concat(event_type, ':-', cast(user_id as varchar))
    else concat(event_type, ':', cast(user_id as varchar)) end as value
  from events),
parsed as (
  select value, string_split(value, ':')[1] as key, try_cast(string_split(value, ':')[2] as integer) as number
  from lines)"""

_WEEK = "(year({0}) - {1}) * 52 + weekofyear({0})"
_EMAIL_DAY = "cast(make_timestamp(ts * 1000) as date)"

ORACLE_SQL: dict[str, str] = {
    "top_senders": f"""with {_EMAILS}
select "from", count(*) as email_count from emails group by "from"
order by email_count desc, "from" limit 10""",
    "top_senders_by_versions": f"""with {_EMAILS}
select "from", count(mid) as count from emails group by "from"
order by count desc, "from" limit 10""",
    "correspondent_counts": f"""with {_EMAILS},
kept as (
  select "from" as sender, "to" as whole, rtrim("to", ',') as head from emails where "to" is not null),
parts as (
  select sender, unnest(case when whole = '' then [''] when head = '' then []
                        else string_split(head, ',') end) as part
  from kept)
select sender, lower(trim(part)) as recipient, count(*) as email_count
from parts group by sender, lower(trim(part))""",
    "top_correspondents": f"""with {_EMAILS},
kept as (
  select "from" as sender, "to" as whole, rtrim("to", ',') as head from emails where "to" is not null),
parts as (
  select sender, unnest(case when whole = '' then [''] when head = '' then []
                        else string_split(head, ',') end) as part
  from kept)
select sender, lower(trim(part)) as recipient, count(*) as email_count
from parts group by sender, lower(trim(part))
order by email_count desc, sender, recipient limit 10""",
    "correspondent_version_counts": f"""with {_EMAILS},
parts as (select "from", unnest(string_split("to", ',')) as part from emails where "to" is not null)
select "from", trim(part) as "to", count(*) as count from parts group by "from", trim(part)""",
    "top_correspondents_by_versions": f"""with {_EMAILS},
parts as (select "from", unnest(string_split("to", ',')) as part from emails where "to" is not null)
select "from", trim(part) as "to", count(*) as count from parts group by "from", trim(part)
order by count desc, "from", "to" limit 10""",
    "weekly_sentiment": f"""with {_SCORED}
select cast({_WEEK.format(_EMAIL_DAY, 1999)} as integer) as weeknum,
  round(avg(cast(sentiment as double)), 6) as avgsentiment,
  round(stddev_pop(cast(sentiment as double)), 6) as stddevsentiment,
  count(*) as nummessages
from scored where regexp_replace("from", '.*@', '') = '{DOMAIN}'
group by 1""",
    "weekly_event_values": f"""
select cast({_WEEK.format("cast(ts as date)", 2024)} as integer) as weeknum,
  round(avg(value), 4) as avgvalue, round(stddev_pop(value), 4) as stddevvalue, count(*) as numevents
from events group by 1""",
    "words_by_sentiment": f"""with {_SCORED},
words as (
  select unnest(string_split(body, ' ')) as word, sentiment from scored
  where regexp_replace("from", '.*@', '') = '{DOMAIN}')
select lower(word) as word, round(sum(cast(sentiment as double)), 6) as totalsentiment
from words where word <> '' group by lower(word) order by totalsentiment, word""",
    "message_sentiment": f"""with {_SCORED} select "from", ts, sentiment from scored""",
    "message_sentiment_by_join": f"""with {_SCORED} select "from", ts, sentiment from scored""",
    "sentiment_cells": f"""with {_SCORED}
select "from", ts as message_ts, cast(1000000000000 as bigint) as ts, sentiment as value from scored""",
    "message_keywords": f"""with {_COUNTS},
scores as (
  select "from", ts, c.word, tf * idf as score from counts c join idf i on c.word = i.word where idf <> 0),
ranked as (
  select *, row_number() over (partition by "from", ts order by score desc, word) as rank from scores)
select concat('EntityId(', "from", ',', cast(ts as varchar), ')') as doc, word, round(score, 6) as score
from ranked where rank <= 10""",
    "term_counts": f"""with {_COUNTS} select "from", ts, word, tf from counts""",
    "term_counts_stop_table": f"""with {_EMAILS},
lexicon(word, score) as (values {_LEXICON_ROWS}),
stop as (
  select lower(event_type) as word from events
  union select lower(r_name) from region
  union select word from lexicon),
all_words as (
  select "from", ts, unnest(string_split(lower(body), ' ')) as word from emails)
select "from", ts, word, count(*) as tf from all_words
where length(word) >= 3 and word not in (select word from stop)
group by "from", ts, word""",
    "document_frequency": f"""with {_COUNTS} select word, df from frequency""",
    "document_frequency_of_counts": f"""with {_COUNTS} select word, df from frequency""",
    "inverse_document_frequency": f"""with {_COUNTS} select word, round(idf, 6) as idf from idf""",
    "row_normalised_values": """
with sums as (select user_id, sum(abs(value)) as total from events where value <> 0 group by user_id)
select e.user_id as row, e.event_id as col, round(e.value / s.total, 6) as value
from events e join sums s on e.user_id = s.user_id where e.value <> 0""",
    "imported_emails": f"""with {_IMPORTED} select * from emails""",
    "imported_emails_intended": f"""with {_IMPORTED_INTENDED} select * from emails""",
    "imported_employee": f"""with {_IMPORTED}
select "from" as employee, ts, 'mid' as "column", mid as value from emails where mid is not null
union all select "from", ts, 'from', "from" from emails
union all select "from", ts, 'date', cast(date as varchar) from emails
union all select "from", ts, 'to', "to" from emails where "to" is not null
union all select "from", ts, 'subject', subject from emails where subject is not null
union all select "from", ts, 'cc', cc from emails where cc is not null
union all select "from", ts, 'body', body from emails where body is not null""",
    "import_rejects": f"""with {_MAIL}
select concat('inbox/', lpad(cast(seq as varchar), 15, '0')) as path, {_REASON} as reason
from mail where seq % 101 in (1, 2, 3, 4, 5)""",
    "import_tally": """
select count(*) as files, count(*) filter (doc_id % 101 not in (1, 2, 3, 4, 5)) as parsed,
  count(*) filter (doc_id % 101 in (1, 2, 3, 4, 5)) as rejected
from documents""",
    "clean_bodies": f"""select doc_id, {_CLEAN.format("text")} as body from documents""",
    "upserted_emails": f"""with {_EMAILS} select * from emails""",
    "merged_emails": f"""with {_EMAILS}
select "from", ts, mid || '-again' as mid, date, "to",
  case when ts % 2000 = 0 then 'seen again' else subject end as subject, cc, bcc, body
from emails""",
    "all_versions": f"""with {_TURN_CELLS} select conv_id, ts, "column", value from cells""",
    "latest_versions": f"""with {_TURN_CELLS}
select conv_id, max(ts) as ts, arg_max(value, ts) as value from text_cells group by conv_id""",
    "newest_versions": """
select user_id, ts, value from (
  select user_id, event_id as ts, value,
    row_number() over (partition by user_id order by event_id desc) as rank
  from events where value is not null)
where rank <= 10""",
    "version_arrays": f"""with {_TURN_CELLS},
ranked as (
  select *, row_number() over (partition by conv_id order by ts desc) - 1 as pos from text_cells)
select conv_id, cast(pos as integer) as pos, ts, value from ranked where pos < 3""",
    "version_counts": f"""with {_TURN_CELLS}
select conv_id, count(*) as versions from text_cells group by conv_id""",
    "version_timestamps": f"""with {_TURN_CELLS} select conv_id, ts from text_cells""",
    "value_at_version": f"""with {_TURN_CELLS} select conv_id, ts, value from text_cells where ts = 1""",
    "selected_cells": f"""with {_TURN_CELLS},
ranked as (
  select *, row_number() over (partition by conv_id, "column" order by ts desc) as rank from cells)
select conv_id, ts, "column", value from ranked where rank <= 2""",
    "copied_column": f"""with {_TURN_CELLS}
select conv_id, ts, 'text_copy' as "column", value from text_cells""",
    "value_counts": """
select event_type as id, count(*) as n from events where event_type is not null group by event_type""",
    "value_pairs": """
select event_type as id, cast(1 as bigint) as one from events where event_type is not null""",
    "keyed_ints": f"""with {_LINES} select key, number as int from parsed where number is not null""",
    "keyed_int_rejects": f"""with {_LINES} select value from parsed where number is null""",
    "domain_messages": f"""with {_EMAILS}
select "from", ts, mid from emails where regexp_replace("from", '.*@', '') = '{DOMAIN}'""",
    "page_hosts": """
select regexp_replace(regexp_replace(url, '.*//', ''), '/.*', '') as id, count(*) as n
from pages where url is not null group by 1""",
    "document_sentences": f"""
with lists as (
  select doc_id, list_filter(string_split({_CLEAN.format("text")}, ' '), lambda w: w <> '') as words from documents)
select doc_id, cast(generate_subscripts(words, 1) - 1 as integer) as pos, unnest(words) as word from lists""",
    "email_cells": f"""with {_SCORED}
select "from", ts, cast({_WEEK.format(_EMAIL_DAY, 1999)} as integer) as weeknum, "to", sentiment from scored""",
}
ORACLE_SQL |= {
    "top_senders_sql": ORACLE_SQL["top_senders_by_versions"],
    "top_correspondents_sql": ORACLE_SQL["top_correspondents_by_versions"],
    "words_by_sentiment_sql": ORACLE_SQL["words_by_sentiment"],
    "chosen_cells": """
select page_id as id, url as address from pages where page_id is not null and url is not null""",
    "word_scores": f"""with {_COUNTS}
select "from", ts, c.word, round(tf * idf, 6) as score
from counts c join idf i on c.word = i.word where idf <> 0""",
    "version_table": f"""with {_TURN_CELLS},
ranked as (
  select *, row_number() over (partition by conv_id, "column" order by ts desc) - 1 as pos from cells),
kept as (select * from ranked where pos < 4)
select conv_id,
  cast(sum(count(*) filter ("column" = 'role')) over same as integer) as n_roles,
  cast(sum(count(*) filter ("column" = 'text')) over same as integer) as n_texts,
  cast(pos as integer) as pos,
  max(ts) filter ("column" = 'role') as role_ts, max(value) filter ("column" = 'role') as role,
  max(ts) filter ("column" = 'text') as text_ts, max(value) filter ("column" = 'text') as text
from kept group by conv_id, pos window same as (partition by conv_id)""",
    "weekly_sentiment_sql": ORACLE_SQL["weekly_sentiment"],
    "weekly_event_values_merged": ORACLE_SQL["weekly_event_values"],
    "words_by_sentiment_from_index": f"""with {_SCORED},
words as (
  select regexp_replace("from", '.*@', '') as domain, unnest(string_split(body, ' ')) as word, sentiment from scored)
select domain, lower(word) as word, round(sum(cast(sentiment as double)), 6) as totalsentiment
from words where word <> '' and domain in ('{DOMAIN}', '{OTHER_DOMAIN}') group by all""",
    "message_sentiment_by_filter": ORACLE_SQL["message_sentiment"],
    "top_correspondents_by_sketch": ORACLE_SQL["top_correspondents"],
    "message_keywords_of_counts": ORACLE_SQL["message_keywords"],
    "upserted_buckets": ORACLE_SQL["merged_emails"],
    "compacted_versions": ORACLE_SQL["newest_versions"],
    "values_as_of": """
with bought as (
  select user_id, event_id as ts, value from events where event_type = 'purchase' and value is not null)
select e.user_id, e.event_id as at, coalesce(b.ts, -1) as ts, b.value
from events e asof left join bought b on e.user_id = b.user_id and e.event_id >= b.ts""",
    "document_frequency_by_deltas": f"""with {_EMAILS},
stop(word) as (values {_STOP_ROWS}),
bodies as (
  select "from", ts, case when ts % 4000 = 0 then body || ' seen again' else body end as body from emails
  union all select 're-' || "from", ts, 'late reply ' || subject from emails where subject is not null),
all_words as (select "from", ts, unnest(string_split(lower(body), ' ')) as word from bodies)
select word, cast(count(distinct ("from", ts)) as double) as df from all_words
where length(word) >= 3 and word not in (select word from stop) group by word""",
    "import_ledger": f"""with {_MAIL},
whole as (
  select seq, recipients is not null or seq % 6 = 0 as first, x_cc is not null as grown,
    concat(case when seq % 101 = 3 then '' when seq % 101 = 5 then 'Message-ID: <>' || chr(10)
             else 'Message-ID: <m' || cast(seq as varchar) || 'x>' || chr(10) end,
      case when seq % 101 = 1 then '' else 'Date: ' || {_STAMP} || case when seq % 101 = 2 then '' else ' (UTC)' end || chr(10) end,
      case when seq % 101 = 4 then '' else 'From: ' || sender || chr(10) end,
      case when seq % 6 = 0 then 'To: ' || chr(10) else '' end,
      coalesce('To: ' || recipients || chr(10), ''),
      case when seq % 7 = 0 and recipients is not null
        then chr(9) || 'late@corp.example.com' || chr(10) || 'To: other@corp.example.com' || chr(10) else '' end,
      coalesce('Subject: ' || subject || chr(10), ''), coalesce('X-cc: ' || x_cc || chr(10), ''),
      coalesce('X-bcc: ' || x_bcc || chr(10), ''), chr(10), text, chr(10)) as value
  from mail),
sized as (
  select *, strlen(case when seq % 3 = 0 then replace(value, chr(10), chr(13) || chr(10)) else value end) as size from whole)
select concat('inbox/', lpad(cast(seq as varchar), 15, '0')) as path, {_REASON} as reason,
  cast(size + case when grown then 5 else 0 end as bigint) as length,
  cast(1 + cast(first and grown as integer) as bigint) as opened, cast(not first or grown as integer) as load
from sized""",
    "newest_by_sender_sql": f"""with {_EMAILS},
ranked as (
  select *, row_number() over (partition by "from" order by ts desc) as rank,
    count(*) over (partition by "from") as n from emails)
select "from", cast(least(max(n), 12) as integer) as versions, arg_max(mid, ts) as newest,
  min(ts) as oldest_ts, max(n) > 12 as truncated
from ranked where rank <= 12 group by "from\"""",
    "newest_correspondents_sql": f"""with {_EMAILS},
ranked as (
  select *, row_number() over (partition by "from" order by ts desc) as rank from emails where "to" is not null),
parts as (select "from", unnest(string_split("to", ',')) as part from ranked where rank <= 12)
select "from", trim(part) as "to", count(*) as count from parts group by "from", trim(part)""",
    "row_normalised_texts": """
with named as (
  select case when user_id % 7 = 0 then null when user_id % 7 = 1 then ' ' else event_type end as row,
    event_id as col, value from events where value <> 0),
sums as (select row, sum(abs(value)) as total from named group by row)
select n.row, n.col, round(n.value / s.total * 1e6, 4) as value
from named n join sums s on n.row is not distinct from s.row""",
    "raw_term_counts": f"""with stop(word) as (values {_STOP_ROWS}),
raw as (
  select doc_id, lower(replace(replace(text, ', ', ',' || chr(9)), '.' || chr(10),
    '.' || chr(13) || chr(10) || ' ' || chr(1))) as body
  from documents),
pieces as (select doc_id, unnest(regexp_split_to_array(body, '[ \t\n\x0b\f\r]+')) as piece from raw),
words as (
  select doc_id, regexp_replace(piece, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') as word from pieces)
select doc_id, word, count(*) as tf from words
where length(word) + length(regexp_replace(word, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) >= 3
  and word not in (select word from stop)
group by doc_id, word""",
}
