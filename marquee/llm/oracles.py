"""SQL counterparts of the training-data queries that SQL can express.

Written from the definitions, not from the operators: windows and runs are
compared as text, item windows are joined whole, and the binomial tail comes
from the gamma function.
"""

from __future__ import annotations

from marquee.llm.quality import RULES

SPACE = r"[\x20\x09-\x0D]+"
WORDED = r"[^\x20\x09-\x0D]"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RISK = LEVEL = 0.05

_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"
_ITEM_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    f"'abcdefghijklmnopqrstuvwxyz'), '{ITEM_WORD}')")

_CASES = ", ".join(f"('{rule}', {at}, {cut})" for rule, _, grid in RULES for at, cut in enumerate(grid))
_MEASURE = "case rule " + " ".join(f"when '{rule}' then {m}" for rule, m, _ in RULES) + " end"

QUALITY = f"""with d as (select doc_id, lang as stratum, coalesce(text, '') as text, {_WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORDED}')) as l
  from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as s
  from d, unnest(range(1, len(w) - 6)) as t(i)),
twice as (select doc_id, s from windows group by doc_id, s having count(*) > 1),
covered as (select doc_id, count(distinct p) as n from windows join twice using (doc_id, s),
  unnest(range(i, i + 8)) as u(p) group by doc_id),
m as (select d.doc_id, stratum, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from d left join covered using (doc_id)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m),
good as (select doc_id from labels where doc_id is not null and quality is not null
  group by doc_id having min(quality) = 1),
cases(rule, step, cutoff) as (values {_CASES}),
tests as (select stratum, rule, step, cutoff, count(*) as n,
    count(*) filter (where {_MEASURE} > cutoff) as k
  from judged join good using (doc_id), cases where not base_failed group by all),
tested as (select *, case when k > n * {RISK / len(RULES)} then 1 else list_sum(list_transform(
    range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({RISK / len(RULES)}) + (n - i) * ln(1 - {RISK / len(RULES)})))) end
    <= {LEVEL} / ({len(RULES)} * (select count(*) from (select distinct stratum from judged))) as safe
  from tests),
chosen as (select stratum, rule, max_by(cutoff, step) as cutoff from (select *,
    min(step) filter (where not safe) over (partition by stratum, rule) as stop from tested)
  where stop is null or step < stop group by stratum, rule),
rejected as (select doc_id from judged join chosen on judged.stratum is not distinct from chosen.stratum
  where {_MEASURE} > cutoff group by doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from rejected) as kept from judged"""

LINES = f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as idx from documents),
worded as (select *, lead(line) over w as after, lead(idx) over w as after_idx
  from l where regexp_matches(line, '{WORDED}') window w as (partition by doc_id order by idx)),
ranked as (select *, row_number() over (partition by line, after order by doc_id, idx) as n
  from worded where after is not null),
long as (select doc_id, idx, row_number() over (partition by line order by doc_id, idx) as n from l
  where len(list_filter(string_split_regex(line, '{SPACE}'), lambda x: x <> '')) > 20),
gone as (select doc_id, unnest([idx, after_idx]) as idx from ranked where n > 1
  union select doc_id, idx from long where n > 1)
select doc_id, count(l.idx) as n_lines, count(gone.idx) as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by l.idx) filter (where gone.idx is null), ''))
    as kept_sha256
from documents left join l using (doc_id) left join gone using (doc_id, idx) group by doc_id"""

DECONTAMINATION = f"""with items as (select item_id, {_ITEM_WORDS} as w from benchmark where item_id is not null),
windows as (select distinct item_id, least(len(w), 10) as n,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
  from items, unnest(range(1, greatest(len(w) - 8, 2))) as t(i) where len(w) > 0),
d as (select doc_id, {_ITEM_WORDS} as w from documents),
places as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as s
  from d, (select distinct n from windows), unnest(range(1, len(w) - n + 2)) as t(i)),
hits as (select doc_id, i, n, item_id from places join windows using (n, s)),
words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as u(p)
  group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join found using (doc_id)"""

PHRASES = f"""with d as (select doc_id, {_WORDS} as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as s
  from d, unnest(range(1, len(w) - 11)) as t(i)),
firsts as (select s, min(doc_id) as first from windows group by s),
gone as (select distinct doc_id, p from windows join firsts using (s),
  unnest(range(i, i + 13)) as u(p) where first < doc_id),
words as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d)
select doc_id, count(words.p) as n_words, count(gone.p) as n_removed,
  sha256(coalesce(string_agg(x, ' ' order by p) filter (where gone.p is null), '')) as kept_sha256
from d left join words using (doc_id) left join gone using (doc_id, p) group by doc_id"""



def _templates(depth: int, wide: int) -> str:
    """One expression per level: a segment, or a wildcard under a wide parent."""
    out = []
    for level in range(1, depth + 1):
        segment = f"regexp_replace(segments[{level}], '[0-9]+', '{{n}}', 'g')"
        out.append(f"""t{level} as (select * replace (case when segments[{level}] is null then t
      else t || '/' || case when count(distinct {segment}) over (partition by host, t) > {wide}
        then '{{*}}' else {segment} end end as t) from t{level - 1})""")
    return ",\n".join(out)


URLS = f"""with cut as (select page_id, case when contains(url, '://')
    then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut),
parts as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from hosts),
rules(verdict, over, prefix) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ruled as (select parts.*, r.rule, r.label from parts left join (
    select page_id, max_by(over || prefix, length(over || prefix)) as rule,
      max_by(verdict, length(over || prefix)) as label
    from parts join rules on (host = over or ends_with(host, '.' || over)) and starts_with(path, prefix)
    group by page_id) r using (page_id)),
t0 as (select host, path, '' as t, string_split(regexp_replace(path, '^/', ''), '/') as segments,
    count(*) filter (where label = 'allow') as good, count(*) filter (where label = 'block') as bad
  from ruled group by host, path),
{_templates(6, 50)},
placed as (select host, path, good, bad,
  case when len(segments) > 6 then t || '/{{**}}' else t end as template from t6),
sums as (select host, template, regexp_replace(template, '^/[^/]*', '/{{+}}') as branch,
  sum(good) as good, sum(bad) as bad from placed group by host, template),
pools as (select *, sum(good) over b as pool_good, sum(bad) over b as pool_bad from sums
  window b as (partition by host, branch)),
shares as (select *, pool_good / greatest(pool_good + pool_bad, 1) as share from pools),
alike as (select *, good + bad = 0 or abs(good / greatest(good + bad, 1) - share)
    <= 1.96 * sqrt(share * (1 - share) / greatest(good + bad, 1)) as same from shares),
merged as (select host, template, good, bad,
  case when same then sum(good) filter (where same) over b else good end as near_good,
  case when same then sum(bad) filter (where same) over b else bad end as near_bad
  from alike window b as (partition by host, branch)),
overall as (select (sum(good) + 1.0::double) / ((sum(good) + 1.0::double) + (sum(bad) + 1.0::double)) as prior
  from placed),
above as (select *, sum(good) over t as all_good, sum(bad) over t as all_bad,
  sum(good) over h as host_good, sum(bad) over h as host_bad
  from merged window t as (partition by template), h as (partition by host)),
drawn as (select *, (all_good + 20.0::double * prior) / (all_good + all_bad + 20.0::double) as over_share
  from above, overall),
hosted as (select *, (host_good + 20.0::double * over_share) / (host_good + host_bad + 20.0::double) as host_share
  from drawn),
pooled as (select *, (near_good + 20.0::double * host_share) / (near_good + near_bad + 20.0::double) as near_share
  from hosted),
pure as (select host, template, (good + 20.0::double * near_share) / (good + bad + 20.0::double) as purity
  from pooled)
select page_id, host, path, rule, coalesce(label, case when purity < 0.5::double * prior then 'block'
  else 'allow' end) as verdict, template, purity
from ruled join placed using (host, path) join pure using (host, template), overall"""

DIVERGENCE = """with d as (select row_number() over () as row_no, coalesce(lang, '') as lang,
    coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as found from documents),
w as (select row_no, lang, source, unnest(found) as term from d),
kept as (select lang, term, count(distinct row_no) as docs from w group by all having docs >= 10),
sources as (select distinct lang, source from d),
dense as (select s.lang, s.source, k.term, coalesce(n, 0) as n from sources s join kept k using (lang)
  left join (select lang, source, term, count(*) as n from w group by all) using (lang, source, term)),
billions as (select *, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over g + 2 * count(*) over g) as p
  from dense window g as (partition by lang, source)),
whole as (select lang, term, 1 + (1000000000::hugeint * (sum(n) + 2))
    // (sum(sum(n)) over g + 2 * count(*) over g) as q
  from dense group by lang, term window g as (partition by lang)),
terms as (select lang, source, 'term' as part, term as item,
    cast((p - q) * (p - q) // (p + q) as bigint) as value
  from billions join whole using (lang, term) where n > 0 and p > q),
sums as (select a.lang, a.source, b.source as item,
    cast(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as bigint) as value
  from billions a join billions b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from sources a join sources b on a.lang = b.lang and a.source <> b.source
  left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source)
select lang, source, part, item, value, cast(row_number() over (
    partition by lang, source, part order by value desc, item) as int) as rank
from (select * from pairs union all select * from terms)
qualify part = 'pair' or rank <= 10"""


def _edit(label: str, cost: str, letter: str) -> str:
    """A label (cost in nine digits, then its audit) after one more edit."""
    return (f"lpad(cast(cast(substr({label}, 1, 9) as int) + {cost} as varchar), 9, '0') "
            f"|| substr({label}, 10) || '{letter}'")


_MORE = "case when x[2] = 't' then 3 else 0 end"
_STAYS = "x[2] not in ('b', 'd')"
_OPEN = "least(l[1], l[2], l[4])"
# Labels l of: nothing yet, after s, after u, after a; x is a row (initial, fault) or an insertion.
_LATTICE = f"""case x[1]
  when '+u' then [l[1], l[2], least(l[3], {_edit(_OPEN, '3', 'I')}), l[4]]
  when '+a' then [l[1], l[2], l[3], least(l[4], {_edit('l[3]', '3', 'I')})]
  else [{_edit('l[1]', '4', 'D')},
    least({_edit('l[2]', '4', 'D')}, case when {_STAYS} and x[1] = 's' then {_edit('l[1]', _MORE, 'K')} end),
    least({_edit('l[3]', '4', 'D')}, case when {_STAYS} and x[1] = 'u' then {_edit(_OPEN, _MORE, 'K')} end,
      case when {_STAYS} then {_edit(_OPEN, '3 + ' + _MORE, 'R')} end),
    least({_edit('l[4]', '4', 'D')}, case when {_STAYS} and x[1] = 'a' then {_edit('l[3]', _MORE, 'K')} end,
      case when {_STAYS} then {_edit('l[3]', '3 + ' + _MORE, 'R')} end)] end"""

REPAIR = f"""with crc as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as tab from range(256) t(i)),
keyed as (select conv_id, turn, coalesce(cast(conv_id as varchar), ' ') as conv, coalesce(role, ' ') as role,
  coalesce(text, ' ') as text,
  coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as id from conversations),
coded as (select keyed.*, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(id, ''),
    lambda x: cast(ord(x) as bigint)), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 20 as code
  from keyed, crc),
damaged as (select conv, turn, case when code = 4 then 'user' else role end as role,
    case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when code = 3 then [0, 1] else [0] end) as copy from coded where code <> 0),
numbered as (select conv, turn, role, text, case when left(role, 1) in ('s', 'u', 'a') then left(role, 1)
    else 'x' end as initial, row_number() over (partition by conv order by turn nulls first, role, md5(text), copy) as i
  from damaged),
faults as (select *, case when not regexp_matches(text, '{WORDED}') then 'b'
    when row_number() over (partition by conv, role, text order by i) > 1 then 'd'
    when regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) in ('.', '!', '?') then '-'
    else 't' end as fault, lag(initial) over (partition by conv order by i) || initial as two from numbered),
lists as (select conv, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
    count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
    count(*) filter (where fault = 't') as truncated,
    count(*) filter (where two not in ('su', 'ua', 'au')) as illegal,
    list([initial, fault] order by i) as rows from faults group by conv),
solved as (select *, list_reduce([['000000000', null, null, null], ['+u'], ['+a']] || flatten(list_transform(rows,
    lambda r: [r, ['+u'], ['+a'], ['+u'], ['+a']])), lambda l, x: {_LATTICE}) as ends from lists),
audits as (select *, least(ends[1], ends[4]) as best, substr(best, 10) as audit from solved),
letters as (select conv, letter, p, count(*) filter (where letter <> 'I') over w as i,
    count(*) filter (where letter <> 'D') over w as k,
    count(*) filter (where letter <> 'D') over (partition by conv) % 2 as odd
  from (select conv, unnest(string_split(audit, '')) as letter,
    generate_subscripts(string_split(audit, ''), 1) as p from audits where audit <> '')
  window w as (partition by conv order by p)),
lines as (select l.conv, p, case when letter = 'K' then role when (k + odd) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case when letter = 'I' then '' else text end as line
  from letters l left join numbered n on n.conv = l.conv and n.i = l.i where letter <> 'D'),
hashed as (select conv, string_agg(line, chr(10) order by p) as whole from lines group by conv)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(cast(left(best, 9) as bigint), 0) as cost, coalesce(audit, '') as audit,
  sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id, conv from keyed) left join audits using (conv) left join hashed using (conv)"""

ORACLES = {
    "op1_quality_rules": QUALITY,
    "op4_line_dedup": LINES,
    "op6_decontamination": DECONTAMINATION,
    "op7_phrase_automata": PHRASES,
    "op8_url_filter": URLS,
    "op11_source_divergence": DIVERGENCE,
    "op12_conversation_repair": REPAIR,
}
