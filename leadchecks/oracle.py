"""The same results in SQL, for DuckDB.

Patterns here are written for the given tables, not for HTML at large; they share
nothing with the library but the fixed values.
"""

from __future__ import annotations

from leadchecks import fixtures
from leadchecks.queries import (
    BAD_SLICES,
    DOCUMENT_PAGES,
    DOCUMENT_PHRASES,
    DOMAIN_END,
    FILE_SLICES,
    LANGUAGE,
    LINK_MARK,
    STREAM_BATCHES,
)
from placeleads import constants as c
from placeleads.functions.text import web_space

_TABLES = {"customer": "customer", "nation": "nation"}
_EMAIL = c.EMAIL


def _has_any(text: str, parts) -> str:
    return "(" + " or ".join(f"contains({text}, '{p}')" for p in parts) + ")"


def _phone(text: str) -> str:
    tries = []
    for pattern in c.PHONE_PATTERNS:
        match = f"regexp_extract({text}, '{web_space(pattern)}')"
        digits = rf"length(regexp_replace({match}, '\D', '', 'g'))"
        tries.append(f"case when {digits} >= {c.MIN_PHONE_DIGITS} then {match} end")
    return f"coalesce({', '.join(tries)})"


def _emails(text: str, blocked) -> str:
    found = f"regexp_extract_all({text}, '{_EMAIL}')"
    if not blocked:
        return found
    return f"list_filter({found}, lambda e: not {_has_any('lower(e)', blocked)})"


def _stripped(html: str) -> str:
    return f"regexp_replace({html}, '<[^>]*>', '', 'g')"


# Pages of the given table: body, without comments and tags, with the four entities in use.
_BODY = (
    r"regexp_replace(regexp_replace(html, '(?s)^.*?<body[^>]*>', ''), '(?s)<!--.*?-->', '', 'g')"
)


def _decoded(text: str) -> str:
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


_PAGE_TEXT = _decoded(_stripped(_BODY))
_PAGE_NAME = "nullif(trim(" + _decoded(
    _stripped("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")
) + "), '')"
_LINKS = r"list_filter(regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"', 1), lambda h: contains(h, '%s'))"


def _first_positions(links: str, html_table: str, keep: str) -> str:
    """One row per distinct link of a page, numbered by first position."""
    return (
        f"(select {keep}, href, cast(row_number() over (partition by page_id order by p) - 1 as int)"
        f" as link_pos from (select {keep}, href, min(p) as p from (select {keep}, "
        f"unnest({links}) as href, generate_subscripts({links}, 1) as p from {html_table}) "
        f"group by {keep}, href))"
    )


_PAGE_LINKS = _first_positions(_LINKS % LINK_MARK, "pages", "page_id, url")

_SEGMENT = "regexp_extract(url, 'place/([^/]+)', 1)"
_PANEL = "regexp_extract(html, 'role=\"main\">(.*)</div></body>', 1)"
_PHONE_ELEMENT = (
    "case when contains(html, 'data-item-id=\"phone:') then "
    "regexp_extract(html, 'data-item-id=\"phone:[^\"]*\">(.*?)</button>', 1) "
    "when contains(html, 'data-tooltip=\"Copy phone number\"') then "
    "regexp_extract(html, 'data-tooltip=\"Copy phone number\">(.*?)</span>', 1) end"
)
_ADDRESS_ELEMENT = (
    "case when contains(html, 'data-item-id=\"address\"') then "
    "regexp_extract(html, 'data-item-id=\"address\">(.*?)</button>', 1) end"
)


def _records(source: str) -> str:
    """All pages of a run, readable or not."""
    return f"""
    select page_id, location, query_seq, search_query, url,
      nullif(trim(regexp_extract(html, '<h1>(.*?)</h1>', 1)), '') as name,
      nullif(trim({_ADDRESS_ELEMENT}), '') as address,
      coalesce({_phone(_PHONE_ELEMENT)}, {_phone(_stripped(_PANEL))}) as phone,
      {_emails(_stripped(_PANEL), c.PAGE_BLOCKED_DOMAINS)} as emails,
      contains(html, 'data-item-id="authority"') or contains(html, 'data-tooltip="Open website"')
        as has_website,
      case when not contains(url, '%ZZ') then nullif(url_decode({_SEGMENT}), '') end as place_id,
      not {_has_any(f"lower({_stripped(_PANEL)})", c.CLOSED_PHRASES)} as is_active
    from {source}"""


_CITY = (
    "case when address like '%,%' then trim(string_split(address, ',')[-2]) else '' end"
)
_VISIBLE = (
    "regexp_replace(regexp_replace(regexp_replace(html, '^.*<body>|<script>.*?</script>', '', 'g'), "
    "'</?(p|div|body)>', chr(10), 'g'), '<[^>]*>', '', 'g')"
)

_CTES = {
    "place_pages": fixtures.place_pages_sql().format(**_TABLES),
    "second_pages": fixtures.place_pages_sql(fixtures.SECOND_RUN_ID).format(**_TABLES),
    "lookup_pages": fixtures.lookup_pages_sql().format(**_TABLES),
    "result_pages": fixtures.result_pages_sql().format(**_TABLES),
    "places": _records("place_pages where not contains(url, '%ZZ')"),
    "second_places": _records("second_pages where not contains(url, '%ZZ')"),
    "leads": """
      select * exclude (rank) from (select *, row_number() over
        (partition by lower(name) order by page_id) as rank from places where name is not null)
      where rank = 1 and not has_website and is_active""",
    "branches": """
      select * exclude (rank) from (select *, row_number() over
        (partition by lower(name), lower(coalesce(address, '')) order by page_id) as rank
        from places where name is not null)
      where rank = 1 and not has_website and is_active""",
    "lookup_texts": f"""
      select lookup_id, lookup_query, concat({_VISIBLE}, coalesce(
        ' ' || nullif(regexp_extract(html, 'href="([^"]*)"', 1), ''), '')) as text
      from lookup_pages""",
    "candidates": f"""
      select lookup_id, lookup_query, {_emails('text', c.LOOKUP_BLOCKED_DOMAINS)} as found
      from lookup_texts""",
    "preferred": f"""
      select lookup_id, lookup_query, coalesce(list_filter(found, lambda e:
        contains(lower(e), '{c.PREFERRED_DOMAIN}'))[1], found[1]) as email from candidates""",
    "lookup_emails": """
      select lookup_query, arg_min(email, lookup_id) filter (where lookup_id = first_id) as email
      from (select *, min(lookup_id) over (partition by lookup_query) as first_id from preferred)
      group by lookup_query""",
    "enriched": f"""
      select l.* exclude (emails), case when len(l.emails) = 0 and m.email is not null
        then [m.email] else l.emails end as emails
      from leads l left join lookup_emails m
        on m.lookup_query = concat(l.name, ' ', {_CITY}, ' email')""",
    "locations": "select s_suppkey, location, trim(string_split(location, ',')[1]) as area, "
    "array_to_string(list_transform(string_split(location, ',')[2:], lambda p: trim(p)), ', ') "
    f"as country from ({fixtures.locations_sql()})".format(
        supplier="supplier", nation="nation", region="region"
    ),
}


def _with(body: str, *ctes: str) -> str:
    """Puts the named tables, and those they read, in front of a query."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in _CTES:
            if other != name and other in _CTES[name] and other not in needed:
                add(other)
        if name not in needed:
            needed.append(name)

    for name in ctes:
        add(name)
    return "with " + ", ".join(f"{n} as ({_CTES[n]})" for n in needed) + " " + body


_RECORD = (
    "page_id, location, query_seq, search_query, name, address, phone, "
    "array_to_string(emails, ' ') as emails, has_website, place_id, is_active"
)
_PLACE = (
    "name, address, phone, array_to_string(emails, ' ') as emails, has_website, place_id, is_active"
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_SUB_LOCATIONS = (
    "list_concat([location], "
    f"list_transform({_list(c.DIRECTIONS)}, lambda d: concat(d, ' ', area, tail)), "
    f"list_transform({_list(c.AREA_SUFFIXES)}, lambda s: concat(area, ' ', s, tail)), "
    "[concat('near ', area, tail)])"
)


def _zones(zones: int) -> str:
    return (
        f"list_concat([location], flatten(list_transform(range(1, {zones + 1}), lambda i: "
        "[concat(area, ' district ', i, tail), concat(area, ' zone ', i, tail)])), "
        f"list_transform(range(1, {min(zones, c.MAX_AREA_SEARCHES) + 1}), "
        "lambda i: concat(area, ' area ', i, tail)))"
    )


_LOCATED = (
    "(select s_suppkey, location, area, "
    "case when country <> '' then concat(', ', country) else '' end as tail from locations)"
)


def _variants(values: str) -> str:
    return _with(
        f"select s_suppkey, cast(i - 1 as int) as seq, v[i] as place from (select s_suppkey, "
        f"{values} as v from {_LOCATED}) cross join generate_series(1, 60) as g(i) where i <= len(v)",
        "locations",
    )


def _plan(variants: str, source: str, keys: str) -> str:
    """Variants x categories, numbered in order, first of equal texts only."""
    return f"""
    select {keys}, cast(row_number() over (partition by {keys} order by seq) - 1 as int)
        as query_seq, search_query
    from (
      select {keys}, min(i * 100 + j) as seq, concat(cats[j], ' in ', v[i]) as search_query
      from (select {keys}, {variants} as v, {_list(c.CATEGORIES)} as cats from {source})
        cross join generate_series(1, 60) as g(i) cross join generate_series(1, 20) as h(j)
      where i <= len(v)
      group by {keys}, concat(cats[j], ' in ', v[i]))"""


_FULL_PLAN = _plan(_SUB_LOCATIONS, _LOCATED, "s_suppkey, location")
_NATION_PLAN = _plan(
    _SUB_LOCATIONS, "(select n_name as location, n_name as area, '' as tail from nation)", "location"
)
_CTES["nation_plan"] = _NATION_PLAN
_CTES["result_links"] = (
    "select r.page_id, r.search_query, r.href, r.link_pos, p.location, p.query_seq from "
    + _first_positions(
        r"""list_filter(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1), lambda h: """
        f"contains(h, '{c.PLACE_LINK_MARK}'))",
        "result_pages",
        "page_id, search_query",
    )
    + " r join nation_plan p on r.search_query = p.search_query"
)


def _absolute(link: str) -> str:
    return f"case when {link} like 'http%' then {link} else concat('{c.SITE_HOST}', {link}) end"


_CTES["sightings"] = f"""
    select * exclude (rank) from (
      select location, query_seq, page_id as result_page_id, link_pos, {_absolute('href')} as u,
        row_number() over (partition by location, {_absolute('href')}
          order by query_seq, page_id, link_pos) as rank from result_links)
    where rank = 1"""
_CTES["visited"] = f"""
    select s.location, s.query_seq, s.result_page_id, s.link_pos,
      p.* exclude (location, query_seq, search_query, url)
    from sightings s join places p on s.u = {_absolute('p.url')}"""
_CTES["planned_leads"] = """
    select * exclude (rank) from (select *, row_number() over
        (partition by location, lower(name) order by query_seq, result_page_id, link_pos) as rank
      from visited where name is not null)
    where rank = 1 and not has_website and is_active"""
_CTES["planned_enriched"] = _CTES["enriched"].replace("from leads l", "from planned_leads l")
_CTES["planned_unique"] = """
    select * exclude (rank) from (select *, row_number() over
        (partition by location, coalesce(nullif(place_id, ''), lower(name))
         order by query_seq, result_page_id, link_pos) as rank from planned_enriched)
    where rank = 1"""

_KEY = "coalesce(nullif(place_id, ''), lower(name))"
_NEW_BY_ID = """place_id is not null and not exists
    (select 1 from places e where e.place_id = n.place_id)"""
_NEW_BY_NAME = """place_id is null and not exists
    (select 1 from places e where e.place_id is null and lower(e.name) = lower(n.name))"""
_SUMMARY = (
    "select count(*) filter (where phone <> '') as with_phone, "
    "count(*) filter (where len(emails) > 0) as with_email, count(*) as total from "
)


def _running(rows: str, key: str, run: str, query: str, *ctes: str) -> str:
    body = f"""
    select {run}, {query}, cast(found as bigint) as found, cast(new_unique as bigint) as new_unique,
      cast(sum(new_unique) over (partition by {run} order by {query}) as bigint) as total_unique
    from (
      select r.{run}, r.{query}, count(*) as found, count(distinct f.k) as new_unique
      from (select *, {key} as k from {rows}) r
      left join (select {run}, {key} as k, min({query}) as q from {rows} where {key} is not null
                 group by all) f
        on f.{run} = r.{run} and f.k = r.k and f.q = r.{query}
      group by r.{run}, r.{query})"""
    return _with(body, *ctes) if ctes else body


_NAMED_PAGES = (
    f"(select page_id, regexp_extract(url, '{DOMAIN_END}', 1) as site, "
    f"regexp_extract(url, '{LANGUAGE}', 1) as lang, lower({_PAGE_NAME}) as name_key from pages)"
)
_PAGES_FIRST = f"""
    select page_id, name, name_key from (select *, row_number() over
      (partition by name_key order by page_id) as rank
      from (select page_id, {_PAGE_NAME} as name, lower({_PAGE_NAME}) as name_key from pages)
      where name is not null) where rank = 1"""
_DOC_EMAILS = "select distinct doc_id, email from (select doc_id, unnest(%s) as email from documents)"

# Batches of the stream, by position between the first and the last page.
_BATCH = (
    "(page_id - (select min(page_id) from place_pages)) // "
    f"((select max(page_id) - min(page_id) from place_pages) // {STREAM_BATCHES} + 1)"
)

ORACLE = {
    "page_scan": "select page_id, url, md5(html) as html_md5 from pages",
    "search_result_scan": _with("select * from result_links", "result_links"),
    "searched_page_scan": _with("select * from result_links", "result_links"),
    "results_sink": _with(f"select {_PLACE} from leads", "leads"),
    "document_split": _with(f"select {_PLACE} from leads", "leads"),
    "results_scan": _with(f"select {_PLACE} from leads", "leads"),
    "results_store": _with(
        f"select {_PLACE}, cast(0 as bigint) as run_id from places union all "
        f"select {_PLACE}, cast(1 as bigint) as run_id from second_places n "
        f"where ({_NEW_BY_ID}) or ({_NEW_BY_NAME})",
        "places",
        "second_places",
    ),
    "results_totals": _with(
        "select 'food & drink' as query, 'all' as location, (select count(*) from places) + "
        "(select count(*) from second_places n "
        f"where ({_NEW_BY_ID}) or ({_NEW_BY_NAME})) as total_found, true as updated",
        "places",
        "second_places",
    ),
    "results_documents": _with(
        "select name, phone, array_to_string(emails, ' ') as emails, place_id, "
        f"cast(null as bigint) as corrupt from leads where page_id // {DOCUMENT_PAGES} % 3 <> 1 "
        f"union all select distinct null, null, null, null, page_id // {DOCUMENT_PAGES} from leads "
        f"where page_id // {DOCUMENT_PAGES} % 3 = 1",
        "leads",
    ),
    "results_envelope": _with(
        "select 'food & drink' as query, 'all' as location, count(*) as total_found from leads",
        "leads",
    ),
    "unreadable_files": "select page_id, null::bigint as slice, null::varchar as reason from pages "
    f"where page_id % {FILE_SLICES} not in {BAD_SLICES} union all select null, s::bigint, "
    f"'not a Parquet file, or cut off' from (select unnest({list(BAD_SLICES)}) as s)",
    "failed_searches": _with(
        "select location, query_seq, search_query, case when n is null then 'not captured' else "
        "'missing html' end as reason from nation_plan left join (select search_query, count(*) as n, "
        "count(*) filter (where page_id % 3 <> 0) as readable from result_pages "
        "where page_id % 4 <> 0 group by search_query) using (search_query) "
        "where coalesce(readable, 0) = 0",
        "nation_plan",
        "result_pages",
    ),
    "failed_lookups": _with(
        "select lookup_query, leads, case when n is null then 'not captured' else 'missing html' end "
        f"as reason from (select concat(name, ' ', {_CITY}, ' email') as lookup_query, "
        "count(*) as leads from leads where len(emails) = 0 group by 1) left join "
        "(select lookup_query, count(*) as n, count(*) filter (where lookup_id % 5 <> 0) as readable "
        "from lookup_pages where lookup_id % 3 <> 0 group by 1) using (lookup_query) "
        "where coalesce(readable, 0) = 0",
        "leads",
        "lookup_pages",
    ),
    "stream_leads": _with(f"select page_id, {_PLACE} from leads", "leads"),
    "stream_resume": _with(f"select page_id, {_PLACE} from leads", "leads"),
    "stream_hooks": _with(
        "select count(*) as processed, count(*) filter (where contains(url, '%ZZ')) as quarantined, "
        "(select count(*) from leads) as found, (select count(*) from leads) as received "
        "from place_pages",
        "place_pages",
        "leads",
    ),
    "stream_batches": _with(
        f"select page_id, {_BATCH} as batch_id, {_PLACE} from leads", "place_pages", "leads"
    ),
    "stream_progress": _with(
        f"select {_BATCH} as batch_id, count(*) as processed, "
        "count(*) filter (where contains(url, '%ZZ')) as quarantined, "
        "count(*) filter (where page_id in (select page_id from leads)) as found "
        "from place_pages group by all",
        "place_pages",
        "leads",
    ),
    "stream_totals": _with("select count(*) as total_found, true as updated from leads", "leads"),
    "stream_quarantine": _with(
        "select page_id, url, 'malformed url' as reason from place_pages where contains(url, '%ZZ')",
        "place_pages",
    ),
    "stream_branches": _with(f"select page_id, {_PLACE} from branches", "branches"),
    "stream_dedup": f"select page_id, name_key from ({_PAGES_FIRST})",
    "stream_append": _with(_SUMMARY + "enriched", "enriched"),
    "category_dim": "select s_suppkey, cast(j - 1 as int) as cat_seq, "
    f"({_list(c.CATEGORIES)})[j] as category from supplier cross join generate_series(1, 20) as g(j)",
    "location_parse": _with("select s_suppkey, area, country from locations", "locations"),
    "subdivide_location": _variants(_SUB_LOCATIONS),
    "zone_searches": _variants(_zones(10)),
    "search_plan": _with(_FULL_PLAN, "locations"),
    "search_plan_zones": _with(
        _plan(f"list_concat({_SUB_LOCATIONS}, {_zones(5)})", _LOCATED, "s_suppkey, location"),
        "locations",
    ),
    "plan_preview": _with(
        "select s_suppkey, location, query_seq, search_query, cast(greatest(total - 5, 0) as int) "
        "as more from (select *, count(*) over (partition by s_suppkey) as total "
        f"from ({_FULL_PLAN})) where query_seq < 5",
        "locations",
    ),
    "search_text": "select p_partkey, concat(case when p_partkey % 3 = 0 then 'businesses' "
    "else p_type end, ' in ', n_name) as search_query "
    "from part join nation on p_partkey % 25 = n_nationkey",
    "text_content": f"select page_id, {_PAGE_TEXT} as text from pages",
    "element_pick": _with(
        f"select page_id, {_PHONE_ELEMENT} as phone_element, {_ADDRESS_ELEMENT} as address_element, "
        f"{_stripped(_PANEL)} as panel from place_pages",
        "place_pages",
    ),
    "selector_pick": "select c_custkey as page_id, concat('Place ', n, 'First ', n, 'Second ', n, 'a', n, "
    "'b', n, 'no item') as container, case when c_custkey % 4 = 0 then concat('Place ', n, 'First ', n, "
    "'Second ', n, 'a', n, 'b', n) else '' end as items, concat('/maps/place/', n) as link, "
    "concat('First ', n, '|Second ', n) as paragraphs, concat('a', n, '|b', n) as points, "
    "c_custkey % 4 = 3 as in_pane from (select c_custkey, c_custkey::varchar as n from customer)",
    "place_name": f"select page_id, {_PAGE_NAME} as name from pages",
    "place_id": _with(
        "select page_id, case when not contains(url, '%ZZ') then "
        f"nullif(url_decode({_SEGMENT}), '') end as place_id from place_pages",
        "place_pages",
    ),
    "is_active": _with("select page_id, is_active from places", "places"),
    "is_active_documents": "select doc_id, not "
    f"{_has_any('lower(text)', DOCUMENT_PHRASES)} as is_active from documents",
    "extract_phone": f"select doc_id, {_phone('text')} as phone from documents",
    "extract_phone_pages": f"select page_id, {_phone('text')} as phone "
    f"from (select page_id, {_PAGE_TEXT} as text from pages)",
    "place_phone": _with("select page_id, phone from places", "places"),
    "place_address": _with("select page_id, address from places", "places"),
    "has_website": _with("select page_id, has_website from places", "places"),
    "extract_emails": _DOC_EMAILS % _emails("text", ("mail1.",)),
    "extract_emails_default": "select doc_id, cast(len(list_distinct("
    f"{_emails('text', c.PAGE_BLOCKED_DOMAINS)})) as int) as emails_left from documents",
    "page_links": f"select page_id, link_pos, href from {_PAGE_LINKS}",
    "absolute_url": f"select page_id, link_pos, {_absolute('href')} as url from {_PAGE_LINKS}",
    "place_record": _with(f"select {_RECORD} from places", "places"),
    "address_city": _with(
        f"select page_id, case when address is null then '' else {_CITY} end as city from places",
        "places",
    ),
    "lookup_query": _with(
        "select page_id, case when name is not null then concat(name, ' ', case when address is null "
        f"then '' else {_CITY} end, ' email') end as lookup_query from places",
        "places",
    ),
    "url_component": "select page_id, replace(replace(replace(replace(replace(url_encode(name), "
    "'%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*') as component "
    f"from (select page_id, {_PAGE_NAME} as name from pages)",
    "lookup_text": _with("select lookup_id, text from lookup_texts", "lookup_texts"),
    "lookup_candidates": _with(
        "select lookup_id, cast(i - 1 as int) as pos, found[i] as email from candidates "
        "cross join generate_series(1, 9) as g(i) where i <= len(found)",
        "candidates",
    ),
    "preferred_email": _with("select lookup_id, email from preferred", "preferred"),
    "lead_filter": _with(
        f"select {_RECORD} from places where not has_website and is_active and name is not null",
        "places",
    ),
    "dedup_name": _PAGES_FIRST,
    "dedup_key": _with(
        f"select page_id, place_key, name from (select *, {_KEY} as place_key, row_number() over "
        f"(partition by {_KEY} order by page_id) as rank from places where {_KEY} is not null) "
        "where rank = 1",
        "places",
    ),
    "email_enrich": _with(
        "select page_id, name, array_to_string(emails, ' ') as emails from enriched", "enriched"
    ),
    "merge_anti_id": _with(
        f"select page_id, place_id, name from second_places n where {_NEW_BY_ID}",
        "places",
        "second_places",
    ),
    "merge_anti_name": _with(
        f"select page_id, place_id, name from second_places n where {_NEW_BY_NAME}",
        "places",
        "second_places",
    ),
    "merge_results": _with(
        f"select {_RECORD}, 'existing' as side from places union all "
        f"select {_RECORD}, 'new' as side from second_places n "
        f"where ({_NEW_BY_ID}) or ({_NEW_BY_NAME})",
        "places",
        "second_places",
    ),
    "quarantine": _with(
        "select page_id, url, 'malformed url' as reason from place_pages where contains(url, '%ZZ')",
        "place_pages",
    ),
    "contact_summary": _with(_SUMMARY + "leads", "leads"),
    "links_per_query": f"select regexp_extract(url, '{LANGUAGE}', 1) as lang, "
    f"count(distinct href) as places_found from {_PAGE_LINKS} group by 1",
    "running_unique": _running("places", _KEY, "location", "query_seq", "places"),
    "running_unique_pages": _running(_NAMED_PAGES, "name_key", "site", "lang"),
    "progress_counts": _with(
        "select p.query_seq, count(*) as processed, count(l.page_id) as found from place_pages p "
        "left join leads l on p.page_id = l.page_id group by p.query_seq",
        "place_pages",
        "leads",
    ),
    "progress_observed": _with(
        "select count(*) as processed, (select count(*) from leads) as found from place_pages",
        "place_pages",
        "leads",
    ),
    "leads": _with(f"select {_RECORD} from enriched", "enriched"),
    "subdivided_leads": _with(
        f"select location, query_seq, result_page_id, link_pos, page_id, {_PLACE} "
        "from planned_unique",
        "planned_unique",
    ),
}
