"""ANSI-style SQL counterparts of the registered queries.

Written by another route than the DataFrame code wherever one exists: pages are
read by unnesting lines and counting cells instead of splitting, ranks and
batches come from window numbers instead of limits and ``min_by``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
WS = r"[\s\p{Z}\x0B\x1c-\x1f\x85]"
WS_SET = r"\s\p{Z}\x0B\x1c-\x1f\x85"
WS_CHARS = (
    "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) "
    "|| chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) "
    "|| chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) "
    "|| chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288))"
)
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"
MARKUP = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<ref[^>]*>.*?</ref>", ""),
    (r"(?i)<ref[^/]*/>", ""),
    (rf"(?i)<br{WS}*/?>", ", "),
    (r"<[^>]+>", ""),
    (r"(?i)\{\{(?:ubl|plainlist|plain list|unbulleted list)\|", ""),
    (r"\{\{nowrap\|([^{}]+)\}\}", r"\1"),
    (r"\{\{flag\|([^{}|]+).*?\}\}", r"\1"),
    (r"(?i)\{\{convert\|([^{}|]+)\|([^{}|]+)\|?.*?\}\}", r"\1 \2"),
    (r"(?i)\{\{(?:lang|native name|small|abbr)[^{}]*\}\}", ""),
    (r"\{\{[^{}]+\}\}", ""),
    (r"\{\{[^{}]*", ""),
    (rf"\|group{WS}*={WS}*[^}}|]+", ""),
    (r"\[\[[^|\]]+\|([^\]]+)\]\]", r"\1"),
    (r"\[\[([^\]]+)\]\]", r"\1"),
    (rf"\[[a-z]+://[^\]{WS_SET}]+{WS}+([^\]]+)\]", r"\1"),
    (r"'{2,}", ""),
    (r"\}\}", ""),
    (r"&nbsp;|\x{a0}", " "),
    (r"\*", ", "),
    (rf"{WS}+", " "),
]
MONEY = r"(?i)(?:US\$|\$|USD\s*)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(billion|million|m)?"
NUMBER = (
    r"[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?"
)
COLUMNS = [
    "tconst", "primaryTitle", "startYear", "genres", "lead_actors_ids", "runtimeMinutes",
    "averageRating", "Language", "Country", "numVotes", "budget", "BoxOffice", "plot",
]
# -----------------------------------------------------------------------------


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def round2(x: str) -> str:
    return f"cast(format('{{:.2f}}', {x}) as double)"


def clean(x: str) -> str:
    for pattern, new in MARKUP:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(new)}, 'g')"
    return f"trim({x}, ' ,|')"


def first(x: str) -> str:
    return f"case when {x} is null or {x} = 'N/A' then '' else {strip(f'split_part({x}, chr(44), 1)')} end"


def clean_int(x: str) -> str:
    return f"try_cast(replace(regexp_extract({x}, '[0-9][0-9,]*'), ',', '') as bigint)"


def clean_float(x: str) -> str:
    cell = strip(f"replace({x}, ',', '')")
    return (
        f"case when regexp_full_match({cell}, {lit(NUMBER)}) "
        f"then try_cast(replace({cell}, '_', '') as double) end"
    )


def items(x: str) -> str:
    return (
        f"case when {x} is null or {x} in ('', '\\N', 'N/A') then [] else "
        f"list_filter(list_transform(string_split({x}, ','), lambda i: {strip('i')}), lambda i: i <> '') end"
    )


def safe(x: str) -> str:
    return f"left(regexp_replace({x}, '[^A-Za-z0-9_.-]+', '_', 'g'), 120)"


def money(cleaned_once: str) -> str:
    """Uses a lateral name ``m`` for the text cleaned a second time."""
    found = f"regexp_extract_all({cleaned_once}, {lit(MONEY)}, 1)"
    unit = f"coalesce(regexp_extract_all({cleaned_once}, {lit(MONEY)}, 2)[i], '')"
    number = "cast(replace(d, ',', '') as double)"
    scaled = (
        f"case when lower({unit}) = 'billion' then {number} * 1000 "
        f"when lower({unit}) <> 'million' and (contains(d, ',') or {number} > 10000) "
        f"then {number} / 1000000 else {number} end"
    )
    amounts = f"list_transform({found}, lambda d, i: {scaled})"
    return (
        f"case when contains({cleaned_once}, 'N/A') or len({found}) = 0 then null else "
        f"{round2(f'list_sum({amounts}) / len({found})')} end"
    )


# ---- common table expressions: name -> (needs, body) ---------------------------
NL = "chr(10)"
HEAD = f"'{{{{Infobox film' || {NL} || '| name = ' || p_name || {NL}"
PLOT = f"'}}}}' || {NL} || 'Lead.' || {NL} || '== Plot ==' || {NL} || body || {NL} || '== Cast =='"
CONTENT = f"""case v
 when 0 then ''
 when 1 then {HEAD} || '| language = {{{{plainlist|' || {NL} || '* ' || p_brand || {NL}
   || '* Other' || {NL} || '}}}}' || {NL} || '| country = [[' || n_name || ']]' || {NL} || {PLOT}
 when 2 then {HEAD} || '| Country = [[' || n_name || ' (state)|' || n_name || ']], Other' || {NL}
   || '| language = [[' || p_brand || ' language]]<ref name="a">r</ref>' || {NL}
   || '| budget = $' || p_size || ' million' || {NL} || '| other = x' || {NL} || {PLOT}
 when 3 then {HEAD} || '| budget = US$' || (p_size + 1) || ',250,000<br />est.' || {NL}
   || '| country = ' || n_name || {NL} || 'and more' || {NL} || '| x = y' || {NL} || {PLOT}
 when 4 then {HEAD} || '| gross = $' || p_size || '.5 billion' || {NL} || {PLOT}
 when 5 then {HEAD} || '| budget = $' || p_size || ' million – $' || (p_size + 7) || ' million'
   || {NL} || '| language = {{{{ubl|' || p_brand || '|Other}}}}' || {NL} || '| x =' || {NL} || {PLOT}
 when 6 then {HEAD} || '| country = ' || n_name || {NL} || '| country = ' || {NL}
   || '| language = ' || repeat(chr(39), 3) || p_brand || repeat(chr(39), 3) || ', Other' || {NL}
   || '| x =' || {NL} || {PLOT}
 when 7 then {HEAD} || '| language = {{{{nowrap|' || p_brand || '}}}} <!-- note -->' || {NL}
   || '| x =' || {NL} || '}}}}' || {NL} || body
 when 8 then '{{{{Infobox film| country = ' || n_name || {NL} || '  | language = N/A' || {NL}
   || '| x =' || {NL} || '}}}}' || chr(13) || {NL} || ' == SYNOPSIS ==' || {NL} || '{{{{long}}}}' || {NL}
   || body || {NL} || '=== Sub ===' || {NL} || 'More.' || {NL} || '==End==' || {NL} || 'Gone'
 else {HEAD} || '| budget = USD ' || p_size || 'm' || {NL} || '}}}}' || {NL} || body
end"""

YEAR = "cast(1980 + p_size as varchar)"
RUNTIME = "cast(50 + 6 * p_size as varchar)"

CTES: dict[str, tuple[list[str], str]] = {
    "titles": ([], """select cast(p_partkey as varchar) as tconst, p_type as titleType,
      p_name as primaryTitle, cast(1980 + p_size as bigint) as startYear,
      cast(50 + 6 * p_size as bigint) as runtimeMinutes,
      p_brand || ', ' || p_type as genres from part"""),
    "raw_titles": ([], f"""select cast(p_partkey as varchar) as tconst, p_type as titleType,
      case p_partkey % 7 when 0 then '  ' || p_name || chr(9) when 1 then upper(p_name)
        else p_name end as primaryTitle,
      case p_partkey % 11 when 0 then '\\N' when 1 then 'N/A' when 2 then ''
        when 3 then 'c. ' || {YEAR} else {YEAR} end as startYear,
      case p_partkey % 9 when 0 then '\\N' when 1 then {RUNTIME} || ' min'
        when 2 then '0,' || {RUNTIME} || ',' else {RUNTIME} end as runtimeMinutes,
      case p_partkey % 5 when 0 then '\\N' when 1 then ' ' || p_brand || ' , ,' || p_type
        else p_brand || ',' || p_type end as genres from part"""),
    "typed_titles": (["raw_titles"], f"""select tconst, titleType,
      {strip('primaryTitle')} as primaryTitle, {clean_int('startYear')} as startYear,
      {clean_int('runtimeMinutes')} as runtimeMinutes, {items('genres')} as genre_items
      from raw_titles"""),
    "ratings": ([], f"""select cast(l_partkey as varchar) as tconst,
      {round2('avg(l_quantity)')} as averageRating,
      nullif(count(*) filter (where l_returnflag = 'R' and l_discount >= 0.08), 0) as numVotes
      from lineitem group by l_partkey"""),
    "rated": (["titles", "ratings"], """select tconst, primaryTitle, startYear, runtimeMinutes,
      genres, averageRating, numVotes from titles join ratings using (tconst)
      where titleType = 'STANDARD' and upper(left(primaryTitle, 1)) = 'L' and startYear <= 2024
        and runtimeMinutes between 60 and 300
        and averageRating is not null and numVotes is not null"""),
    "ranked": (["rated"], """select * from (select *, row_number() over (
        order by numVotes desc, lower(primaryTitle), tconst) as rank from rated)
      where rank <= 20"""),
    "credits": ([], """select cast(l_partkey as varchar) as tconst, l_returnflag as category,
      'nm' || l_suppkey as nconst, l_orderkey * 10 + l_linenumber as ordering from lineitem"""),
    "actor_rank": (["credits"], """select tconst, nconst, place from (
      select tconst, nconst, row_number() over (partition by tconst order by o, nconst) as place
      from (select tconst, nconst, min(ordering) as o from credits where category = 'A'
        group by tconst, nconst)) where place <= 5"""),
    "actors": (["actor_rank"], """select tconst,
      string_agg(nconst, ', ' order by place) as lead_actors_ids from actor_rank group by tconst"""),
    "page_base": ([], """select p_partkey, p_name, p_brand, p_size, n_name,
      coalesce(text, 'Story of ' || p_name) as body from part
      join nation on p_partkey % 25 = n_nationkey left join documents on doc_id = p_partkey"""),
    "page_texts": (["page_base"], f"""select part, slot, {CONTENT} as content from (
      select *, p_partkey as part, (p_partkey + slot) % 10 as v from page_base,
      unnest([1, 2, 3]) as s(slot))"""),
    # One line per row, then cells by a running count of cell starts.
    "page_lines": (["page_texts"], f"""select part, slot, line, ln, {strip('line')} as t from (
      select part, slot, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as ln from (
        select part, slot, string_split_regex(content, {lit(LINE_BREAK)}) as ls from page_texts))"""),
    "page_cells": (["page_lines"], """select part, slot, cell,
      max(case when is_start then lower(k) end) as k, string_agg(x, ' ' order by ln)
        filter (where is_start or not starts_with(t, '}}')) as v
      from (select *, sum(cast(is_start as int)) over (partition by part, slot order by ln) as cell
        from (select *, starts_with(t, '|') and contains(t, '=') as is_start,
          """ + strip("split_part(substr(t, 2), '=', 1)") + """ as k,
          case when starts_with(t, '|') and contains(t, '=')
            then substr(t, instr(t, '=') + 1) else t end as x from page_lines))
      where cell > 0 group by part, slot, cell"""),
    "page_last": (["page_cells"], f"""select part, slot, k, {clean('v')} as v from (
      select *, row_number() over (partition by part, slot, k order by cell desc) as back
      from page_cells where k in ('budget', 'gross', 'language', 'country')) where back = 1"""),
    "page_box": (["page_texts", "page_last"], f"""select part, slot,
      max(v) filter (where k = 'budget') as budget, max(v) filter (where k = 'gross') as BoxOffice,
      max({first('v')}) filter (where k = 'language') as Language,
      max({first('v')}) filter (where k = 'country') as Country
      from page_texts left join page_last using (part, slot) group by part, slot"""),
    "page_plot": (["page_texts", "page_lines"], rf"""select part, slot,
      coalesce({strip(f"left({clean('raw')}, 2000)")}, '') as plot
      from page_texts left join (
        select l.part, l.slot, string_agg(line, ' ' order by ln) as raw from page_lines l
        join (select h.part, h.slot, h.head, min(s.ln) as stop from (
            select part, slot, min(ln) as head from page_lines where regexp_full_match(
              t, '(?i)=={WS}*(?:Plot|Synopsis|Premise){WS}*=={WS}*') group by part, slot) h
          left join page_lines s on s.part = h.part and s.slot = h.slot and s.ln > h.head
            and regexp_matches(s.t, '^==[^=].*=={WS}*$') group by h.part, h.slot, h.head) b
        on l.part = b.part and l.slot = b.slot and l.ln > b.head
          and (b.stop is null or l.ln < b.stop)
        where not (starts_with(t, '{{{{') or starts_with(t, '|') or starts_with(t, '[[File:')
          or starts_with(t, '[[Image:')) group by l.part, l.slot) using (part, slot)"""),
    "page_money": (["page_box"], f"""select part, slot, {money('b')} as budget,
      {money('x')} as BoxOffice from (select part, slot, {clean('budget')} as b,
      {clean('BoxOffice')} as x from page_box)"""),
    "keyed_parts": ([], f"""select p_partkey, {safe(f"p_name || ' ' || {YEAR} || ' film'")}
      as lookup_key from part"""),
    # Every part adds its pages, in part order; ``part`` is the first that has any.
    "owners": (["keyed_parts"], """select lookup_key,
      min(p_partkey) filter (where p_partkey % 10 <> 0) as part from keyed_parts
      group by lookup_key"""),
    "response_pages": (["keyed_parts", "page_texts", "page_box", "page_plot", "page_money", "page_base"],
      """select lookup_key, part, slot,
      coalesce(case part % 4 when 0 then 4 - slot
        when 1 then case when slot = 1 then null else slot end else slot end, 999) as idx,
      case when part % 10 = 3 and slot = 2 then '' else p_name || ' (' || slot || ')' end as title,
      Language, Country, plot, m.budget, m.BoxOffice
      from (select lookup_key, p_partkey as part from keyed_parts)
      join page_box b using (part) join page_plot using (part, slot)
      join page_money m using (part, slot) join page_base on p_partkey = part
      where part % 10 <> 0"""),
    "hits": (["response_pages"], """select * from (select *, row_number() over (
        partition by lookup_key order by idx, part, slot) as n from response_pages
      where plot <> '' or coalesce(Language, '') <> '' or coalesce(Country, '') <> '')
      where n = 1"""),
    "misses": (["owners", "hits", "response_pages"], """select lookup_key,
      case when max(title) is null then 'no Wikipedia search result'
        else 'no usable Wikipedia fields in candidates: ' || string_agg(
          case when title = '' then 'unknown page' else title end, ', ' order by idx, p.part, slot) end
        as reason
      from owners left join response_pages p using (lookup_key)
      where lookup_key not in (select lookup_key from hits) group by lookup_key"""),
    "lookups": (["owners", "hits", "misses"], """select owners.lookup_key, hits.title as page,
      hits.lookup_key is not null as hit, reason, Language, Country, budget, BoxOffice, plot
      from owners left join hits using (lookup_key) left join misses using (lookup_key)"""),
    "two_call": (["owners", "page_texts", "page_box", "page_money", "page_plot"], """select
      lookup_key, case when owners.part is not null then 'Page ' || lookup_key end as page,
      x.part is not null as has_text, Language, Country, m.budget, m.BoxOffice, plot from owners
      left join page_texts x on x.part = owners.part and x.slot = 1 and content <> ''
      left join page_box b on b.part = x.part and b.slot = 1
      left join page_money m on m.part = x.part and m.slot = 1
      left join page_plot p on p.part = x.part and p.slot = 1"""),
    "collected": (["ranked", "actors", "two_call"], f"""select tconst, primaryTitle,
      startYear, genres, coalesce(lead_actors_ids, '') as lead_actors_ids, runtimeMinutes,
      averageRating, coalesce(Language, '') as Language, coalesce(Country, '') as Country, numVotes,
      budget, BoxOffice, coalesce(plot, '') as plot
      from ranked left join actors using (tconst) left join two_call on rank <= 8 and lookup_key =
        {safe("primaryTitle || ' ' || startYear || ' film'")} where rank <= 12"""),
    "dataset": ([], """select p_partkey as pos,
      case when p_type = 'MEDIUM' then '' else cast(p_partkey as varchar) end as tconst,
      case when p_type = 'MEDIUM' then p_name || ' ' || p_partkey else p_name end as primaryTitle,
      1980 + p_size as startYear,
      case when p_size = 9 then '' else p_brand || ', ' || p_type end as genres,
      '' as lead_actors_ids, 50 + 6 * p_size as runtimeMinutes,
      case when p_size = 3 then cast('nan' as double) else cast(p_size as double) end as averageRating,
      case when p_type = 'LARGE' then 'French' else '' end as Language,
      case when p_type = 'LARGE' and p_size > 20 then 'France' else '' end as Country,
      p_partkey + 1 as numVotes, case when p_size < 15 then p_size * 1.5::double end as budget,
      cast(null as double) as BoxOffice,
      case when p_type = 'SMALL' and p_size > 25 then 'Known story'
        when p_type = 'LARGE' and p_size > 40 then 'Old story' else '' end as plot from part"""),
    "keyed_dataset": (["dataset"], f"""select *, plot <> '' or Language <> '' or Country <> ''
      as enriched, case when tconst <> '' then tconst else primaryTitle || ':' || startYear end
      as key, {safe("primaryTitle || ' ' || startYear || ' film'")} as lookup_key from dataset"""),
    "state": ([], """select case when p_type = 'MEDIUM'
        then p_name || ' ' || p_partkey || ':' || (1980 + p_size)
        else cast(p_partkey as varchar) end as key, p_name as title,
      cast(1980 + p_size as varchar) as year, 'earlier miss' as reason,
      case when p_size = 7 then null else p_size % 9 end as retry_search_limit from part
      where p_type = 'PROMO' or (p_type in ('SMALL', 'MEDIUM') and p_size <= 12)"""),
    "modes": ([], """select false as retry, 250 as batch_rows union all select true, 150"""),
    "decided": (["modes", "keyed_dataset", "state"], """select m.retry, batch_rows, d.*, case
        when enriched then 'ignore'
        when not m.retry then case when s.key is null then 'attempt' else 'skip' end
        when coalesce(s.retry_search_limit, 0) >= 8 then 'skip'
        when s.key is null then 'ignore' else 'attempt' end as action
      from modes m, keyed_dataset d left join state s on d.key = s.key"""),
    "batch": (["decided"], """select * from (select *, row_number() over (
        partition by retry order by pos) as n from decided where action = 'attempt')
      where n <= batch_rows"""),
    "outcomes": (["batch", "lookups"], """select retry, pos, key, primaryTitle, startYear,
      case when l.lookup_key is null then 'no_response' when hit then 'enriched' else 'missed' end
        as outcome, l.reason, l.Language, l.Country, l.budget, l.BoxOffice, l.plot
      from batch b left join lookups l on b.lookup_key = l.lookup_key"""),
    "drained": (["decided", "lookups"], """select pos, key, primaryTitle, startYear, hit, l.reason,
      l.Language, l.Country, l.budget, l.BoxOffice, l.plot
      from decided d join lookups l on d.lookup_key = l.lookup_key
      where not retry and action = 'attempt'"""),
    "merged": (["modes", "dataset", "outcomes"], """select m.retry, d.* replace (
        coalesce(o.Language, d.Language) as Language, coalesce(o.Country, d.Country) as Country,
        coalesce(o.plot, d.plot) as plot,
        case when o.pos is null then d.budget else o.budget end as budget,
        case when o.pos is null then d.BoxOffice else o.BoxOffice end as BoxOffice)
      from modes m cross join dataset d
      left join outcomes o on o.retry = m.retry and o.pos = d.pos and o.outcome = 'enriched'"""),
}


def query(needs: list[str], body: str) -> str:
    """``body`` behind the expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in CTES[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n][1]})" for n in ordered) + "\n" + body


def _missing(column: str, source: str) -> str:
    test = f"{column} is null"
    if column in ("tconst", "primaryTitle", "Language", "Country", "plot", "genres", "lead_actors_ids"):
        test += f" or {column} = ''"
    if column in ("averageRating", "budget", "BoxOffice"):
        test += f" or isnan({column})"
    return (
        f"select '{column}' as field, count(*) filter (where {test}) as missing_count, "
        f"{round2(f'count(*) filter (where {test}) / count(*) * 100')} as missing_percent from {source}"
    )


def profile(source: str) -> str:
    return " union all ".join(_missing(c, source) for c in COLUMNS)


COUNTERS = """count(*) as movie_count,
  count(*) filter (where plot <> '' or Language <> '' or Country <> '') as wikipedia_enriched_count,
  count(*) filter (where plot <> '' and Language <> '' and Country <> '')
    as wikipedia_core_complete_count"""

METRICS = """select count(*) as row_count,
  count(*) filter (where upper(left(primaryTitle, 1)) <> 'L') as wrong_initials,
  cast(max(startYear) as bigint) as max_year, cast(min(runtimeMinutes) as bigint) as min_runtime,
  cast(max(runtimeMinutes) as bigint) as max_runtime,
  count(*) filter (where plot <> '' or Language <> '' or Country <> '') as enriched_rows from dataset"""


CTES["profile"] = (["dataset"], profile("dataset"))
# A first drain over all stored answers, then one that retries the failures known before it.
CTES["twice"] = (["decided", "lookups"], """select pos, key, primaryTitle, startYear, hit, l.reason,
      l.Language, l.Country, l.budget, l.BoxOffice, l.plot
      from decided d join lookups l on d.lookup_key = l.lookup_key where action = 'attempt'""")
CTES["dataset_twice"] = (["dataset", "twice"], """select d.* replace (
      coalesce(o.Language, d.Language) as Language, coalesce(o.Country, d.Country) as Country,
      coalesce(o.plot, d.plot) as plot,
      case when o.pos is null then d.budget else o.budget end as budget,
      case when o.pos is null then d.BoxOffice else o.BoxOffice end as BoxOffice)
      from dataset d left join (select * from twice where hit) o using (pos)""")
CTES["profile_twice"] = (["dataset_twice"], profile("dataset_twice"))
CTES["metrics"] = (["dataset"], METRICS)


def _profile_document() -> str:
    cells = []
    for column in COLUMNS:
        for name in ("count", "percent"):
            cells.append(
                f"(select missing_{name} from profile where field = '{column}') as {column}_{name}")
    return query(["profile"], f"""select c.*, 'L' as team_letter,
      cast(12 as bigint) as target_movie_count, cast(20 as bigint) as candidate_pool_size,
      false as require_wikipedia_page, cast(8 as bigint) as wikipedia_enrich_limit,
      {', '.join(cells)} from (select {COUNTERS} from dataset) c""")


ORACLES: dict[str, str] = {
    "candidate_projection": query(["typed_titles"], """select tconst, titleType, primaryTitle,
      startYear, runtimeMinutes, array_to_string(genre_items, ', ') as genres from typed_titles"""),
    "eligible_titles": query(["typed_titles"], """select tconst, titleType, primaryTitle,
      startYear, runtimeMinutes, array_to_string(genre_items, ', ') as genres from typed_titles
      where titleType = 'STANDARD' and upper(left(primaryTitle, 1)) = 'L' and startYear <= 2024
        and runtimeMinutes between 60 and 300"""),
    "title_prefix": query(["titles"], """select tconst, primaryTitle from titles
      where upper(left(primaryTitle, 1)) = 'L'"""),
    "last_rating": """select tconst, averageRating, numVotes from (
      select cast(l_partkey as varchar) as tconst, l_quantity as averageRating,
        cast(floor(l_extendedprice) as bigint) as numVotes, row_number() over (
          partition by l_partkey order by l_orderkey * 10 + l_linenumber desc, l_suppkey desc) as n
      from lineitem) where n = 1""",
    "rated_candidates": query(["rated"], "select * from rated"),
    "candidate_pool": query(["ranked"], "select * exclude (rank) from ranked"),
    "ranked_pool": query(["ranked"], "select *, rank <= 8 as looked_up from ranked"),
    "large_pool": """select tconst, numVotes, rank from (select cast(l_partkey as varchar) as tconst,
      cast(floor(l_extendedprice) as bigint) as numVotes, row_number() over (
        order by floor(l_extendedprice) desc, l_orderkey * 10 + l_linenumber, l_suppkey) as rank
      from lineitem) where rank <= 30000""",
    "credits_semi": query(["credits", "titles"], """select tconst, category, nconst, ordering
      from credits where tconst in (select tconst from titles where titleType = 'STANDARD'
        and upper(left(primaryTitle, 1)) = 'L' and startYear <= 2024
        and runtimeMinutes between 60 and 300)"""),
    "lead_actors_rank": query(["actor_rank"], "select * from actor_rank"),
    "lead_actors": query(["titles", "actors"], """select tconst,
      coalesce(lead_actors_ids, '') as lead_actors_ids from titles left join actors using (tconst)"""),
    "clean_int": query(["raw_titles"], f"""select tconst, {clean_int('startYear')} as year,
      {clean_int('runtimeMinutes')} as runtime, {clean_int('genres')} as in_genres from raw_titles"""),
    "clean_float": query(["raw_titles"], f"""select tconst, {clean_float('startYear')} as year,
      {clean_float('runtimeMinutes')} as runtime from raw_titles"""),
    "list_field": query(["raw_titles"], f"""select tconst, case when len({items('genres')}) = 0
      then '[]' else '["' || array_to_string({items('genres')}, '", "') || '"]' end as genres
      from raw_titles"""),
    "first_value": f"select doc_id, {first('text')} as head from documents",
    "lookup_key": query(["typed_titles"], f"""select tconst,
      {safe("primaryTitle || coalesce(' ' || nullif(startYear, 0), '') || ' film'")} as search_key,
      {safe("primaryTitle || ' ' || coalesce(cast(startYear as varchar), '') || ' film'")}
        as combined_key from typed_titles"""),
    "markup_clean": f"""select page_id, md5(c) as digest, length(c) as n_chars
      from (select page_id, {clean('html')} as c from pages)""",
    "infobox_fields": query(["page_box"], """select part, cast(slot as bigint) as slot, budget,
      BoxOffice, Language, Country from page_box"""),
    "plot_section": query(["page_plot"], "select part, cast(slot as bigint) as slot, plot from page_plot"),
    "money_millions": query(["page_money"], """select part, cast(slot as bigint) as slot, budget,
      BoxOffice from page_money"""),
    "first_usable_page": query(["hits"], """select lookup_key, title as page, Language, Country,
      plot from hits"""),
    "miss_reason": query(["misses"], "select lookup_key, reason from misses"),
    "page_lookup": query(["titles", "lookups"], f"""select tconst, asked as lookup_key,
      l.lookup_key is not null as has_response, page, reason, Language as page_Language,
      Country as page_Country, budget as page_budget, BoxOffice as page_BoxOffice, plot as page_plot
      from (select tconst, startYear, {safe("primaryTitle || ' ' || startYear || ' film'")} as asked
        from titles)
      left join lookups l on l.lookup_key = asked and startYear < 2020"""),
    "strict_selection": query(["ranked", "two_call"], f"""select rank, tconst, page from (
      select rank, tconst, page, row_number() over (order by rank) as n from ranked join two_call
      on has_text and lookup_key = {safe("primaryTitle || ' ' || startYear || ' film'")})
      where n <= 10"""),
    "final_rows": query(["collected"], "select * from collected"),
    "final_enriched_only": query(["collected"], """select * from collected
      where plot <> '' or Language <> '' or Country <> ''"""),
    "enriched_flag": query(["dataset"], """select pos, plot <> '' or Language <> '' or Country <> ''
      as enriched, plot <> '' and Language <> '' and Country <> '' as core_complete from dataset"""),
    "missing_profile": query(["profile"], "select * from profile"),
    "dataset_counters": query(["dataset"], f"select {COUNTERS} from dataset"),
    "missing_report_lines": query(["profile"], """select field, field || ': ' || missing_count
      || ' missing (' || missing_percent || '%)' as line from profile"""),
    "profile_document": _profile_document(),
    "profile_diff": query(["profile", "merged"], f"""select o.field, o.missing_count as stored_count,
      o.missing_percent as stored_percent, n.missing_count as current_count,
      n.missing_percent as current_percent from profile o
      join ({profile('(select * from merged where not retry)')}) n on o.field = n.field
      where o.missing_count <> n.missing_count or o.missing_percent <> n.missing_percent"""),
    "validation_metrics": query(["metrics"], "select * from metrics"),
    "quality_checks": query(["metrics"], """select 'minimum_rows' as "check", row_count as observed, row_count >= 1000 as passed from metrics
      union all select 'columns', 13, true
      union all select 'initials', wrong_initials, wrong_initials = 0 from metrics
      union all select 'max_year', max_year, max_year <= 2024 from metrics
      union all select 'min_runtime', min_runtime, min_runtime >= 60 from metrics
      union all select 'max_runtime', max_runtime, max_runtime <= 300 from metrics
      union all select 'all_enriched', enriched_rows, enriched_rows = row_count from metrics"""),
    "pending_rows": query(["keyed_dataset", "state"], """select pos, key from keyed_dataset
      where not enriched and key not in (select key from state)"""),
    "run_decisions": query(["decided"], "select retry, pos, key, action from decided"),
    "next_batch": query(["batch"], "select retry, pos, key from batch"),
    "imported_batch": query(["modes", "decided", "batch"], """select b.retry, b.pos, b.key,
      (select count(*) from decided d where d.retry = b.retry and d.action = 'skip' and (
        d.pos < (select max(pos) from batch c where c.retry = b.retry)
        or b.batch_rows > (select count(*) from batch c where c.retry = b.retry)))
        as skipped_failed from batch b"""),
    "run_outcomes": query(["outcomes"], "select retry, pos, key, outcome, reason from outcomes"),
    "merge_enriched": query(["merged"], """select retry, pos, Language, Country, budget, BoxOffice,
      plot from merged"""),
    "state_after": query(["modes", "state", "outcomes"], """select retry, key, title, year, reason,
      cast(retry_search_limit as bigint) as retry_search_limit from (
      select retry, s.* from modes cross join state s
      where (retry, key) not in (select (retry, key) from outcomes where outcome <> 'no_response')
      union all select retry, key, primaryTitle, cast(startYear as varchar), reason,
        case when retry then 8 else 0 end from outcomes where outcome = 'missed')"""),
    "run_counters": query(["modes", "decided", "outcomes"], """select m.retry,
      (select count(*) from outcomes o where o.retry = m.retry) as attempted,
      (select count(*) from outcomes o where o.retry = m.retry and outcome = 'enriched') as enriched,
      (select count(*) from outcomes o where o.retry = m.retry and outcome = 'missed') as newly_failed,
      (select count(*) from decided d where d.retry = m.retry and action = 'skip' and (
        d.pos < (select max(pos) from outcomes o where o.retry = m.retry)
        or m.batch_rows > (select count(*) from outcomes o where o.retry = m.retry)))
        as skipped_failed from modes m"""),
    "tsv_scan": query(["typed_titles"], """select tconst, titleType, primaryTitle,
      startYear, runtimeMinutes, array_to_string(genre_items, ', ') as genres from typed_titles"""),
    "dataset_csv": query(["dataset"], """select tconst, primaryTitle,
      cast(startYear as bigint) as startYear, genres, lead_actors_ids,
      cast(runtimeMinutes as bigint) as runtimeMinutes, averageRating, Language, Country, numVotes,
      budget, BoxOffice, plot from dataset"""),
    "profile_json": query(["profile"], "select * from profile"),
    "state_lines": query(["state"], """select key, title, year, reason,
      cast(retry_search_limit as bigint) as retry_search_limit from state"""),
    "scan_responses": query(["keyed_parts", "page_texts", "page_base"], """select lookup_key,
      cast(coalesce(case part % 4 when 0 then 4 - slot
        when 1 then case when slot = 1 then null else slot end else slot end, 999) as bigint)
        as "index",
      case when part % 10 = 3 and slot = 2 then '' else p_name || ' (' || slot || ')' end as title,
      md5(content) as digest
      from (select lookup_key, p_partkey as part from keyed_parts)
      join page_texts using (part) join page_base on p_partkey = part
      where part % 10 <> 0"""),
    "two_call_lookup": query(["ranked", "two_call"], f"""select tconst, page,
      Language as page_Language, Country as page_Country, budget as page_budget,
      BoxOffice as page_BoxOffice, plot as page_plot
      from ranked join two_call
      on lookup_key = {safe("primaryTitle || ' ' || startYear || ' film'")}"""),
    "two_call_every": query(["titles", "two_call"], f"""select tconst, t.page,
      Language as page_Language, Country as page_Country, budget as page_budget,
      BoxOffice as page_BoxOffice, plot as page_plot
      from titles left join two_call t
      on lookup_key = {safe("primaryTitle || ' ' || startYear || ' film'")}"""),
    "enrich_repeated": query(["dataset", "outcomes"], """select
      (select count(*) from dataset) as n_rows, (select count(distinct pos) from dataset) as n_pos,
      (select count(*) from outcomes where not retry) as attempted,
      (select count(*) from outcomes where not retry and outcome = 'enriched') as enriched"""),
    "drain_repeated": query(["dataset", "drained"], """select pos, h.pos is not null or not (
        plot in ('', 'Known story', 'Old story') and Language = '' and Country = '') as enriched
      from dataset left join (select pos from drained where hit) h using (pos)"""),
    "state_json": query(["state"], """select key, title, year, reason,
      cast(retry_search_limit as bigint) as retry_search_limit from state"""),
    "store_restart": query(["dataset", "decided", "outcomes", "lookups"], """select pos,
      coalesce(o.Language, d.Language) as Language, coalesce(o.Country, d.Country) as Country,
      case when o.pos is null then d.budget else o.budget end as budget,
      case when o.pos is null then d.BoxOffice else o.BoxOffice end as BoxOffice,
      coalesce(o.plot, d.plot) as plot
      from dataset d left join (
        select pos, Language, Country, budget, BoxOffice, plot from outcomes
        where not retry and outcome = 'enriched'
        union all select pos, l.Language, l.Country, l.budget, l.BoxOffice, l.plot from (
          select *, row_number() over (order by pos) as n from decided
          where not retry and action = 'attempt' and pos not in (
            select pos from outcomes where not retry and outcome <> 'no_response')) b
        join lookups l on l.lookup_key = b.lookup_key and hit where n <= 250) o using (pos)"""),
    "title_files": query(["raw_titles", "typed_titles"], f"""select tconst, titleType, primaryTitle,
      startYear, runtimeMinutes, array_to_string(genre_items, ', ') as genres from (
      select *, row_number() over (partition by tconst order by file desc) as n from (
        select 0 as file, * from typed_titles
        union all select 1, t.* replace ({strip("'Late ' || r.primaryTitle")} as primaryTitle)
        from typed_titles t join raw_titles r using (tconst) where cast(tconst as int) % 3 = 0)
      where titleType = 'STANDARD' and upper(left(primaryTitle, 1)) = 'L' and startYear <= 9999
        and runtimeMinutes between 0 and 9999) where n = 1"""),
    "enrich_run": query(["merged"], """select pos, Language, Country, budget, BoxOffice, plot
      from merged where not retry"""),
    "drain_stream": query(["dataset", "drained"], """select pos,
      coalesce(o.Language, d.Language) as Language, coalesce(o.Country, d.Country) as Country,
      case when o.pos is null then d.budget else o.budget end as budget,
      case when o.pos is null then d.BoxOffice else o.BoxOffice end as BoxOffice,
      coalesce(o.plot, d.plot) as plot
      from dataset d left join (select * from drained where hit) o using (pos)"""),
    "drain_retry": query(["dataset_twice"], """select pos, Language, Country, budget, BoxOffice, plot
      from dataset_twice"""),
    "drain_retry_state": query(["state", "twice"], """select key, title, year, reason,
      cast(retry_search_limit as bigint) as retry_search_limit from state
      where key not in (select key from twice)
      union all select key, primaryTitle, cast(startYear as varchar), reason, 8 from twice where not hit"""),
    "drain_profile": query(["profile_twice"], "select * from profile_twice"),
    "drain_state": query(["state", "drained"], """select key, title, year, reason,
      cast(retry_search_limit as bigint) as retry_search_limit from state
      where key not in (select key from drained)
      union all select key, primaryTitle, cast(startYear as varchar), reason, 0 from drained
      where not hit"""),
}
