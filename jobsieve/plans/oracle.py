"""The same questions as the named queries, asked in DuckDB's SQL."""

from __future__ import annotations

from jobsieve import constants as C
from jobsieve.plans import derived

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[^\p{L}\p{N}_]"
CHECKED_AT = "2024-01-01T00:00:00+00:00"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def flat(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


def nt(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{WS}+|{WS}+$', '', 'g')"


def nd(x: str) -> str:
    bare = f"replace(replace(replace({nt(x)}, 'https://', ''), 'http://', ''), 'www.', '')"
    return f"trim(split_part({bare}, '/', 1))"


def nu(x: str) -> str:
    return f"rtrim({strip(x)}, '/')"


def host(x: str) -> str:
    return nd(f"regexp_extract(coalesce({x}, ''), '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)")


def has(x: str, phrases: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, {q(p)})" for p in phrases) + ")"


def count(x: str, phrases: list[str]) -> str:
    return "(" + " + ".join(f"cast(contains({x}, {q(p)}) as int)" for p in phrases) + ")"


def attachment(x: str) -> str:
    ends = " or ".join(f"ends_with({nt(x)}, {q(e)}) or contains({nt(x)}, {q(e + '?')})" for e in C.ATTACHMENT_EXTENSIONS)
    return f"({ends})"


def blocked(x: str) -> str:
    h = host(x)
    return "(" + " or ".join(f"{h} = {q(d)} or ends_with({h}, {q('.' + d)})" for d in C.BLOCKED_BOARDS) + ")"


def ats(x: str) -> str:
    return has(nt(x), C.ATS_PATTERNS)


def bad(x: str) -> str:
    return has(nt(x), C.BAD_URL_FRAGMENTS)


def profile(x: str) -> str:
    return has(nt(x), C.PROFILE_URL_FRAGMENTS)


def own(x: str, domain: str) -> str:
    return f"({host(x)} = {nd(domain)} or ends_with({host(x)}, '.' || {nd(domain)}))"


def describe(x: str) -> str:
    out = flat(x)
    for pattern in C.NOISE_PATTERNS:
        out = f"regexp_replace({out}, {q('(?is)' + pattern)}, ' ', 'g')"
    return flat(out)


def closed(x: str) -> str:
    return f"({x} = '' or {has(x, C.CLOSED_SIGNALS)})"


def apply_only(x: str) -> str:
    a, d = count(x, C.APPLY_SIGNALS), count(x, C.DESCRIPTION_SIGNALS)
    return f"({x} = '' or ({a} >= 7 and {d} <= 1) or ({a} >= 9 and {d} <= 2))"


def real_steps(source: str, text: str, keep: str) -> str:
    """CTEs d0..d3 ending in ``real(keep..., description, apply_only, real_description)``."""
    return f"""
d0 as (select {keep}, {describe(text)} as description from {source}),
d1 as (select *, {describe('description')} as again from d0),
d2 as (select *, {nt('description')} as low, {nt('again')} as low2 from d1),
real as (select {keep}, description, {apply_only('low')} as apply_only,
  length(again) >= {C.MIN_DESCRIPTION_CHARS} and not {closed('low2')} and not {apply_only('low2')}
    and {count('low2', C.DESCRIPTION_SIGNALS)} >= 2 as real_description from d2)"""


def is_title(x: str) -> str:
    return f"(length({nt(x)}) between 4 and 120 and not {has(nt(x), C.TITLE_REFUSED)} and {has(nt(x), C.TITLE_HINTS)})"


def heads(x: str) -> str:
    breaks = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
    lines = f"list_transform(regexp_split_to_array(coalesce({x}, ''), '{breaks}'), lambda s: {flat('s')})"
    return f"list_filter({lines}, lambda s: regexp_full_match(s, {q(C.HEADING_CHARS)}))"


def best_title(card: str, link: str, nearby: str) -> str:
    return (
        f"case when {is_title(strip(card))} then {strip(card)} when {is_title(strip(link))} then {strip(link)} "
        f"else coalesce(list_filter({heads(nearby)}, lambda h: {is_title('h')})[1], '') end"
    )


def location(x: str) -> str:
    found = []
    for pattern in (C.LOCATION_WORDS, C.LOCATION_PAIR, C.LOCATION_COUNTRY, C.LOCATION_COUNTRY_SHORT):
        body = pattern.replace("{ws}", WS).replace("(remote", "(?:remote")
        found.append(f"nullif(regexp_extract({x}, '(?i)(?:^|{WORD})({body})(?:$|{WORD})', 1), '')")
    return f"coalesce({', '.join(found)}, '')"


KEYS = f"""
list_rows as ({derived.LIST_ROWS}),
all_keys as (
  select distinct list_name, 'domain' as key_kind, {nd('company_website')} as key from list_rows
  union select distinct list_name, 'name', {nt('company_name')} from list_rows
  union select distinct list_name, 'url', {nu('external_url')} from list_rows),
list_keys as (select * from all_keys where key <> '')"""


def on(name: str, domain: str = "company_domain", company: str = "company_name") -> str:
    return (
        f"({nd(domain)} in (select key from list_keys where list_name = '{name}' and key_kind = 'domain')"
        f" or {nt(company)} in (select key from list_keys where list_name = '{name}' and key_kind = 'name'))"
    )


def active_url(url: str = "job_url") -> str:
    return f"({nu(url)} in (select key from list_keys where key_kind = 'url'))"


def keyword(title: str = "job_title") -> str:
    return f"exists (select 1 from ({derived.KEYWORDS}) kw where contains({nt(title)}, kw.keyword))"


def removed(domain: str = "company_domain", company: str = "company_name", title: str = "job_title", url: str = "job_url") -> str:
    return f"({on('blacklist', domain, company)} or {on('customers', domain, company)} or {keyword(title)} or {active_url(url)})"


def label(domain: str = "company_domain", company: str = "company_name") -> str:
    return f"case when {on('churned', domain, company)} then 'churned' when {on('active', domain, company)} then 'active' else 'inactive' end"


def job_key(url: str, domain: str, title: str) -> str:
    return f"coalesce(nullif({nu(url)}, ''), {nd(domain)} || '|' || {nt(title)})"


JOBS = f"jobs as ({derived.JOB_PAGES})"

BARE = r"regexp_replace(url, '^https?://([^/]+).*$', '\1')"

# Shared by the two questions about the sites: seeds joined with what is known of their pages.
SITES = f"""
with {KEYS},
pages_ as ({derived.SITE_PAGES}),
texts as (select doc_id, {nu('url')} as url, {nu("coalesce(nullif(final_url, ''), url)")} as final_url, posted, {flat('body')} as body from pages_),
{real_steps('texts', 'body', 'doc_id, url, final_url, posted, body')},
answers as (select {nu('url')} as url, try_cast(response_text as json) as data from ({derived.SITE_ANSWERS}) a),
seeds as ({derived.SITE_SEEDS}),
titles as (select page_url, count(distinct nullif({nt('job_title')}, '')) as n from seeds group by page_url)"""

RESULTS = SITES + f""",
joined as (
  select s.*, {nu('s.job_url')} as seed_url, t.n as title_count,
    p.description as p_description, p.real_description as p_real, {nt('p.body')} as p_nt,
    coalesce(j.real_description, false) as j_real, coalesce(j.apply_only, true) as j_apply, coalesce(j.final_url, {nu('s.job_url')}) as j_final,
    left(coalesce(j.body, ''), 1000) as j_sample, coalesce(j.description, '') as j_description, coalesce(j.posted, '') as j_posted,
    coalesce(a.data, cast('{{}}' as json)) as data
  from seeds s join titles t using (page_url) left join real p on p.url = s.page_url
    left join real j on j.url = {nu('s.job_url')} left join answers a on a.url = j.final_url and j.real_description),
same_page as (
  select *, coalesce(data ->> 'company_name', '') as a_company, coalesce(data ->> 'job_title', '') as a_title, coalesce(data ->> 'job_url', '') as a_url,
    coalesce(data ->> 'job_location', '') as a_location, coalesce(data ->> 'job_posted_date', '') as a_date, coalesce(data ->> 'job_posted_date_source', '') as a_date_source,
    coalesce(data ->> 'confidence', '') as a_confidence, coalesce(data ->> 'reason', '') as a_reason,
    coalesce(json_type(data -> 'is_valid_open_job') = 'BOOLEAN' and data ->> 'is_valid_open_job' = 'false', false) as refused,
    case when p_nt = '' or trim(job_title) = '' then {q(C.SAME_PAGE_NO_URL)}
      when title_count >= 6 or (title_count >= 3 and {has('p_nt', C.BOARD_SIGNALS)}) then {q(C.SAME_PAGE_BOARD)}
      when not contains(p_nt, {nt('job_title')}) then {q(C.SAME_PAGE_NO_TITLE)}
      when not p_real then {q(C.SAME_PAGE_NO_DESCRIPTION)} end as same_reason
  from joined),
stepped as (
  select *, case
    when seed_url = '' and ({has('lower(reason)', C.ATTACHMENT_REASON_WORDS)}) then 'attachment_reason'
    when seed_url = '' and same_reason is null then 'same'
    when seed_url = '' then 'same_refused'
    when {attachment('seed_url')} then 'attachment'
    when {profile('seed_url')} then 'profile'
    when {profile('j_final')} then 'final_profile'
    when not j_real and same_reason is null then 'same'
    when not j_real and j_apply then 'apply'
    when not j_real then 'closed'
    when refused and same_reason is null then 'same'
    when refused then 'refused'
    else 'job' end as step
  from same_page),
resolved as (
  select *, case step when 'attachment_reason' then {q(C.ATTACHMENT_ONLY)} when 'attachment' then {q(C.ATTACHMENT_ONLY)} when 'same_refused' then same_reason
      when 'profile' then {q(C.PROFILE_PAGE)} when 'final_profile' then {q(C.PROFILE_PAGE)} when 'apply' then {q(C.APPLY_FORM)}
      when 'closed' then {q(C.CLOSED_PAGE)} when 'refused' then {q(C.MODEL_REFUSED)} end as invalid,
    case when step = 'same' then page_url when step = 'same_refused' and same_reason <> {q(C.SAME_PAGE_NO_URL)} then page_url
      when step in ('attachment', 'profile') then seed_url when step in ('final_profile', 'apply', 'closed', 'refused') then j_final
      when step = 'job' then {nu("coalesce(nullif(a_url, ''), j_final)")} end as named,
    case when step in ('final_profile', 'apply', 'closed') then j_sample when step = 'same_refused' and same_reason = {q(C.SAME_PAGE_NO_DESCRIPTION)} then left(p_description, 1000) else '' end as early_sample,
    trim(case when step = 'same' then company_name else coalesce(nullif(a_company, ''), company_name) end) as r_company,
    trim(case when step = 'same' then job_title else coalesce(nullif(a_title, ''), job_title) end) as r_title,
    trim(case when step = 'same' then job_location else coalesce(nullif(a_location, ''), job_location) end) as r_location,
    trim(coalesce(nullif(case when step = 'same' then confidence else coalesce(nullif(a_confidence, ''), confidence) end, ''), 'medium')) as r_confidence,
    case when step = 'same' then coalesce(nullif(trim(reason), ''), {q(C.SAME_PAGE_ACCEPTED)}) else trim(coalesce(nullif(a_reason, ''), reason)) end as r_reason,
    case when step = 'same' then '' else coalesce(nullif(a_date, ''), j_posted) end as r_date,
    case when step = 'same' then '' else coalesce(nullif(a_date_source, ''), case when j_posted = '' then '' else 'meta_date' end) end as r_date_source,
    case when step = 'same' then p_description else j_description end as r_description
  from stepped),
urls as (select *, {nu("coalesce(nullif(named, ''), job_url)")} as r_url from resolved),
results as (
  select *, case when invalid is not null then invalid when r_title = '' then {q(C.GATE_NO_TITLE)} when r_url = '' then {q(C.GATE_NO_URL)}
      when {blocked('r_url')} then {q(C.GATE_BLOCKED_BOARD)} when {bad('r_url')} then {q(C.GATE_BAD_URL)} when {profile('r_url')} then {q(C.GATE_PROFILE)}
      when {removed('company_domain', 'r_company', 'r_title', 'r_url')} then {q(C.GATE_LISTED)} end as skip_reason
  from urls)"""

SQL = {
    "normalize_keys": f"""
with raws as (select 'company' as src, cid as id, company_website as raw, company_name as name from ({derived.COMPANIES}) c
  union all select 'page', page_id, url, cast(null as string) from pages)
select src, id, {nt('raw')} as nt, {nt('name')} as nt_name, {nd('raw')} as domain, {nu('raw')} as url, 'https://' || {nd('raw')} as website,
  {host('ltrim(raw)')} as host, case when starts_with(raw, 'http') then raw else 'https://' || raw end as schemed,
  {job_key("case when src = 'page' then raw end", 'raw', 'name')} as job_key
from raws""",
    "url_flags": f"""
with {JOBS}, urls as (select 'job' as src, doc_id as id, job_url as url, company_domain from jobs
  union all select 'page', page_id, url, 'example.com' from pages)
select src, id, {own('url', 'company_domain')} as own, {attachment('url')} as attachment, {ats('url')} as ats, {blocked('url')} as blocked,
  {bad('url')} as bad, {profile('url')} as profile, ({has(nt('url'), C.CAREER_LINK_KEYWORDS)} or {ats('url')}) as career
from urls""",
    "clean_description": f"""
with {JOBS}, d as (select doc_id, {flat('page_text')} as page_text, {describe('page_text')} as description from jobs)
select *, length(description) as description_length from d""",
    "signal_counts": f"""
with {JOBS}, {real_steps('jobs', 'page_text', 'doc_id, page_text')}, n as (select *, {nt('page_text')} as x from real)
select doc_id, {count('x', C.DESCRIPTION_SIGNALS)} as n_describe, {count('x', C.APPLY_SIGNALS)} as n_apply, {closed('x')} as closed,
  {apply_only('x')} as apply_only, {has('x', C.RETRY_SIGNALS)} as retry_signal, real_description from n""",
    "title_screen": f"with {JOBS} select doc_id, {is_title('job_title')} as is_title, {keyword()} as has_keyword from jobs",
    "location_from_text": f"with {JOBS} select doc_id, {location('page_text')} as location from jobs",
    "headings": f"""
with c as (select 'card' as src, cast(card_ord as bigint) as id, card_title, link_text, nearby_text from ({derived.CARDS}) x
  union all select 'document', doc_id, '', '', text from documents)
select src, id, array_to_string({heads('nearby_text')}, '|') as headings, {best_title('card_title', 'link_text', 'nearby_text')} as title from c""",
    "list_counts": f"with {KEYS} select list_name, key_kind, count(*) as n_keys from list_keys group by 1, 2",
    "list_membership": f"""
with {KEYS}, {JOBS} select doc_id, {on('blacklist')} as on_blacklist, {on('customers')} as on_customers, {on('churned')} as on_churned,
  {on('active')} as on_active, {active_url()} as on_active_url from jobs""",
    "screen_jobs": f"""
with {KEYS}, {JOBS}, {real_steps('jobs', 'page_text', 'doc_id, company_domain, company_name, job_title, job_url')},
kept as (select * from real where real_description and not {bad('job_url')} and not {blocked('job_url')} and not {profile('job_url')} and not {removed()}),
firsts as (select * from kept qualify row_number() over (partition by {job_key('job_url', 'company_domain', 'job_title')} order by doc_id) = 1)
select doc_id, {label()} as "List", company_domain, company_name, job_title, {nu('job_url')} as job_url, length(description) as job_description_length
from firsts""",
    "dedupe_jobs": f"""
with {JOBS}, k as (select doc_id, {job_key('job_url', 'company_domain', 'job_title')} as job_key from jobs)
select min(doc_id) as doc_id, job_key from k group by job_key""",
    "label_jobs": f"with {KEYS}, {JOBS} select doc_id, {label()} as list_label, {removed()} as is_removed from jobs",
    "input_companies": f"""
select {nd('company_website')} as company_domain, min(cid) as ord from ({derived.COMPANIES}) c where {nd('company_website')} <> '' group by 1""",
    "input_pages": f"""
with raws as (select url as raw, page_id as ord from pages union all select {BARE}, page_id + 1000000000 from pages),
n as (select case when starts_with({nu('raw')}, 'http') then {nu('raw')} else 'https://' || {nu('raw')} end as career_page, ord from raws where {nu('raw')} <> '')
select min(ord) as ord, {host('career_page')} as company_domain, career_page from n where {host('career_page')} <> '' group by career_page""",
    "first_inputs": f"""
with n as (select {nu('url')} as career_page, min(page_id) as ord from pages group by 1)
select ord, {host('career_page')} as company_domain, career_page from n where {host('career_page')} <> '' order by ord limit {C.MAX_INPUTS}""",
    "rule_seeds": f"""
with c as (select *, {nu('href')} as u, {best_title('card_title', 'link_text', 'nearby_text')} as job_title from ({derived.CARDS}) x),
kept as (select *, case when {attachment('u')} then '' else u end as job_url from c
  where job_title <> '' and (u = '' or (not {blocked('u')} and not {bad('u')} and not {profile('u')} and ({own('u', 'company_domain')} or {ats('u')}))))
select page_url, card_ord as seed_ord, job_title, job_url, {location('nearby_text')} as job_location, 'medium' as confidence,
  case when job_url = '' then {q(C.CARD_SEED_REASON_NO_URL)} else {q(C.CARD_SEED_REASON)} end as reason
from kept qualify row_number() over (partition by page_url, {nt('job_title')}, coalesce(nullif(job_url, ''), page_url) order by card_ord) = 1""",
    "merge_seeds": f"""
with s as (select page_url, seed_ord, origin, job_title, case when {bad(nu('job_url'))} or {profile(nu('job_url'))} then '' else job_url end as job_url
  from ({derived.SEEDS}) x where {nt('job_title')} <> ''),
m as (select * from s qualify row_number() over (partition by page_url, {nt('job_title')}, {nu('job_url')} order by origin desc, seed_ord) = 1)
select page_url, seed_ord, origin, job_title, job_url from m""",
    "large_board": f"""
with g as (select page_url, any_value({nt('page_text')}) as x, cast(count(distinct nullif({nt('job_title')}, '')) as int) as title_count from ({derived.SEEDS}) s group by page_url)
select page_url, title_count, title_count >= 6 or (title_count >= 3 and {has('x', C.BOARD_SIGNALS)}) as large_board from g""",
    "same_page_job": RESULTS + " select event_id, cast(title_count as int) as title_count, coalesce(same_reason, '') as same_reason from same_page",
    "classify_jobs": RESULTS + f"""
select seed_ord, page_url as root_url, company_domain, {label('company_domain', 'r_company')} as "List", {q(C.SOURCE_LABEL)} as source, r_company as company_name, r_title as job_title,
  r_url as job_url, r_location as job_location, {strip('r_description')} as job_description, length(r_description) as job_description_length, r_date as job_posted_date,
  r_date_source as job_posted_date_source, r_confidence as confidence, r_reason as reason from results where skip_reason is null""",
    "skip_log": RESULTS + f"""
select company_domain, page_url as career_page_url, job_title as seed_job_title, job_url as seed_job_url,
  case when invalid is not null or skip_reason = {q(C.GATE_NO_TITLE)} then coalesce(named, job_url) when skip_reason = {q(C.GATE_NO_URL)} then '' else r_url end as final_job_url,
  skip_reason, case when invalid is not null then early_sample when skip_reason = {q(C.GATE_LISTED)} then left(r_description, 1000) else '' end as job_page_text_sample,
  '{CHECKED_AT}' as checked_at_utc from results where skip_reason is not null""",
    "skip_counts": RESULTS + " select coalesce(skip_reason, '') as skip_reason, count(*) as n_rows from results group by 1",
}

_FENCED = f"case when starts_with({strip('response_text')}, '```') then trim(regexp_replace(trim(regexp_replace({strip('response_text')}, '^```(?:json)?', '', 'i')), '```$', '')) else {strip('response_text')} end"
ANSWERS = f"""
with texts as (select doc_id, {_FENCED} as x from ({derived.MODEL_ANSWERS}) m),
whole as (select *, try_cast(x as json) as w, try_cast(regexp_extract(x, '(?s)\\{{.*\\}}') as json) as b from texts),
picked as (select doc_id, coalesce(w, b) as j from whole),
parsed as (select doc_id, case when json_type(j) = 'OBJECT' then j end as data from picked)"""


def json_text(data: str, field: str) -> str:
    kind, value = f"json_type({data} -> '{field}')", f"{data} ->> '{field}'"
    return (
        f"case when {data} is null or {kind} is null or {kind} = 'NULL' then '' when {kind} = 'BOOLEAN' then case when {value} = 'true' then 'True' else '' end "
        f"when {kind} in ('UBIGINT', 'BIGINT', 'DOUBLE') and try_cast({value} as double) = 0 then '' else {value} end"
    )


def _refuses(data: str) -> str:
    return f"coalesce(json_type({data} -> 'is_valid_open_job') = 'BOOLEAN' and {data} ->> 'is_valid_open_job' = 'false', false)"


SQL |= {
    "llm_parse": ANSWERS + f"""
select doc_id, data is not null as is_object, {_refuses('data')} as refuses, {json_text('data', 'job_title')} as job_title, {json_text('data', 'job_url')} as job_url,
  {json_text('data', 'job_location')} as job_location, {json_text('data', 'reason')} as reason from parsed""",
    "llm_jobs": ANSWERS + f""",
lists as (select doc_id, cast(data -> 'jobs' as json[]) as items from parsed where json_type(data -> 'jobs') = 'ARRAY'),
items as (select doc_id, unnest(items) as item, unnest(range(len(items))) as pos from lists)
select doc_id, cast(pos as int) as seed_ord, {json_text('item', 'job_title')} as job_title, {json_text('item', 'job_url')} as job_url, {json_text('item', 'reason')} as reason
from items where json_type(item) = 'OBJECT'""",
    "llm_requests": f"""
with {JOBS}, {real_steps('jobs', 'page_text', 'doc_id, company_domain, job_url')}
select 'job' as stage, job_url as url, concat_ws(chr(10), 'Describe the open job on this page. Answer with one JSON object and nothing else.',
  'Answer {{"is_valid_open_job": false}} when the page holds no real job description; an apply form next to a real description is fine.',
  'Form of the answer otherwise: {{"is_valid_open_job":true,"company_name":"","job_title":"","job_url":"","job_location":"","job_posted_date":"","job_posted_date_source":"","confidence":"","reason":""}}',
  'Company domain: ' || company_domain, 'Job page: ' || job_url, 'Posting date found in the page: ', 'Where it was found: ', 'Text of the page:', description) as prompt
from real where real_description""",
}

# Pages have one fixed frame: navigation links, an advertisement, an article with one h1, a footer.
_NO_HEAD = "regexp_replace(regexp_replace(html, '(?s)<head>.*?</head>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
_INLINE = f"regexp_replace({_NO_HEAD}, '</?(?:a|b)(?: [^>]*)?>', '', 'g')"


def unescape(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"


_SHOWN = flat(unescape(f"regexp_replace({_INLINE}, '<[^>]*>', ' ', 'g')"))
# The same with the line breaks that count before the cut at 3,500 characters.
# An article's last paragraph may be left open; it ends with the article.
_LINES = f"replace(replace(regexp_replace({_INLINE}, '[ \\n\\t\\r]+', ' ', 'g'), '<br></article>', '<br></p></article>'), '<br>', chr(10))"
_LINES = f"regexp_replace({_LINES}, '(?:<[^>]*>)*</?p>(?:<[^>]*>)*', chr(10) || chr(10), 'g')"
_LINES = f"regexp_replace({_LINES}, '(?:<[^>]*>)+', chr(10), 'g')"
_LINES = unescape(f"regexp_replace({_LINES}, ' *(\\n+) *', '\\1', 'g')")
_NEARBY = flat(strip(_LINES))
_RAW_LINKS = """
raw_links as (select url, html, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) as path, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) as label,
  unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>')))) as pos from pages),
links as (select *, regexp_extract(url, '^(https?://[^/?#]+)', 1) || path as href from raw_links)"""

_HOME = """
ids as (select c_custkey as c, unnest(range(c_custkey % 25)) as i from customer),
kinds as (select c, i, (i * 7 + c) % 8 as kind, (i + c) % 4 as word, 'https://company' || c || '.example.com' as home from ids),
anchors as (select *, case kind when 0 then home || '/careers/' || i when 1 then 'https://www.company' || c || '.example.com/jobs-' || i
    when 2 then 'https://boards.greenhouse.io/co' || c || '/' || i when 6 then home || '/about/' || (i % 3) end as href
  from kinds where kind in (0, 1, 2, 6) and (kind = 2 or word in (0, 2))),
firsts as (select c, home, href, any_value(kind) as kind, min(i) as i from anchors group by c, home, href)"""

SQL |= {
    "page_text": f"select url, {_SHOWN} as body_text from pages",
    "page_links": f"""
with {_RAW_LINKS} select url, cast(pos as int) as pos, href, {strip('label')} as text, '<a href="' || path || '">' || label || '</a>' as outer_html from links""",
    "page_cards": f"""
with {_RAW_LINKS},
t as (select {nu('url')} as page, url, pos, {nu('href')} as href, {flat(unescape('label'))} as link_text, {flat(unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))} as card_title,
  {_NEARBY} as nearby_text from links),
f as (select * from t qualify row_number() over (partition by url, href, card_title, link_text, nearby_text order by pos) = 1)
select url, cast(row_number() over (partition by url order by pos) - 1 as int) as pos, href, link_text, nearby_text, card_title from f""",
    "next_pages": f"""
with {_HOME} select home as url, cast(row_number() over (partition by c order by i) - 1 as int) as pos, href as next_page from firsts""",
    "career_urls": f"""
with {_HOME},
paths as (select unnest([{', '.join(q(p) for p in C.CAREER_PATHS)}]) as path, unnest(range({len(C.CAREER_PATHS)})) as n),
both_ as (select c, href as url, i from firsts where kind <> 6 union all select c_custkey, 'https://company' || c_custkey || '.example.com' || path, 1000 + n from customer, paths),
ranked as (select c, url, row_number() over (partition by c order by min(i)) - 1 as pos from both_ group by c, url)
select c as ord, 'company' || c || '.example.com' as company_domain, cast(pos as int) as pos, url as career_url from ranked""",
    "posted_dates": """
with d as (select doc_id % 8 as kind, doc_id, 'https://x.example.com/' || doc_id as url from documents),
hits as (
  select url, 0 as pos, '2024-' || doc_id as date, 'structured_data_datePosted' as source from d where kind = 0
  union all select url, 1, '2023-01-01', 'structured_data_createdAt' from d where kind = 0
  union all select url, 0, '2024-' || doc_id, 'meta_date' from d where kind = 1
  union all select url, 0, '2021', 'structured_data_date created' from d where kind = 2
  union all select url, 1, '2020-' || doc_id, 'meta_article:published_time' from d where kind = 2
  union all select url, 0, cast(doc_id as string), 'structured_data_Upload_Date' from d where kind = 3 and doc_id <> 0
  union all select url, 0, '2024-' || doc_id, 'meta_ DatePosted ' from d where kind = 5
  union all select url, 0, '{''x'': 1}', 'structured_data_dateposted' from d where kind = 6
  union all select url, 0, 'True', 'structured_data_postedDate' from d where kind = 7
  union all select url, 1, '2022', 'structured_data_datePublished' from d where kind = 7)
select url, pos, date, source from hits""",
}
SQL["first_date"] = f"""
with hits as ({SQL['posted_dates']}), urls as (select 'https://x.example.com/' || doc_id as url from documents)
select urls.url, coalesce(date, '') as date, coalesce(source, '') as source from urls left join hits on hits.url = urls.url and pos = 0"""


# The five kinds of site, worked out by hand: which pages are opened, which seeds they give, what becomes of them.
_TITLE = "case doc_id % 5 when 0 then 'Data Engineer ' when 1 then 'Barista ' when 2 then 'Sales Manager ' when 3 then 'CAD Technician ' else 'Buyer ' end || doc_id"
CRAWL = f"""
with {KEYS},
docs as (select doc_id, cast(floor(doc_id / 5) as bigint) as site, page_text, {_TITLE} as title from ({derived.JOB_PAGES}) j),
sites as (select site, site % 5 as kind, 'company' || site || '.example.com' as domain, 'https://company' || site || '.example.com/careers' as root,
    'About the role: ' || string_agg(title, ', ' order by doc_id) || '. Responsibilities and skills. ' || max(case when doc_id % 5 = 0 then page_text end) as about
  from docs group by site),
all_texts as (select 'job' as what, doc_id as id, page_text as body from docs union all select 'root', site, about from sites where kind = 4),
{real_steps('all_texts', 'body', 'what, id, body')},
opened as (
  select site, 0 as page_ord, 0 as pass, root as page, case kind when 0 then root || '/more' when 3 then root || '/a|' || root || '/b' else '' end as next_pages,
    kind <> 2 as found, kind in (0, 1, 3) or (kind = 4 and {has(nt('about'), C.RETRY_SIGNALS)}) as may_retry from sites
  union all select site, 1, 0, root || '/more', '', false, false from sites where kind = 0
  union all select site, 1, 0, root || '/a', '', true, true from sites where kind = 3
  union all select site, 2, 0, root || '/b', root, true, true from sites where kind = 3),
seeds as (
  select site, kind, domain, root, doc_id, case when kind = 3 then case when doc_id % 5 < 3 then 1 else 2 end else 0 end as page_ord,
    case when kind = 1 then 1 else 0 end as pass, doc_id % 5 as seed_ord, title,
    case when kind = 4 and doc_id % 5 = 4 then '' else 'https://' || domain || '/jobs/' || doc_id end as url
  from docs join sites using (site) where kind = 4 or (kind in (0, 1, 3) and doc_id % 5 <> 1)
  union all select site, 0, domain, root, null, 0, 0, 5, title, root || '/more' from docs join sites using (site) where kind = 0 and doc_id % 5 = 0
  union all select site, 3, domain, root, null, 2, 0, 5, title, root from docs join sites using (site) where kind = 3 and doc_id % 5 = 3),
facts as (
  select seeds.*, coalesce(j.real_description, false) as j_real, coalesce(j.apply_only, true) as j_apply, coalesce(j.description, '') as j_description,
    left({flat('j.body')}, 1000) as j_sample, coalesce(r.description, '') as r_description,
    case when kind <> 4 then '' when {has(nt('r.body'), C.BOARD_SIGNALS)} then {q(C.SAME_PAGE_BOARD)} when not r.real_description then {q(C.SAME_PAGE_NO_DESCRIPTION)} end as same_reason
  from seeds left join real j on j.what = 'job' and j.id = seeds.doc_id left join real r on r.what = 'root' and r.id = seeds.site and seeds.kind = 4),
steps as (
  select *, case when same_reason is null and (url = '' or not j_real or doc_id % 8 = 1) then 'same' when url = '' then 'same_refused'
    when kind = 3 and doc_id is null then 'closed' when not j_real and j_apply then 'apply' when not j_real then 'closed' when doc_id % 8 = 1 then 'refused' else 'job' end as step
  from facts),
results as (
  select *, case when step = 'same' then root when step = 'same_refused' then root else url end as final_url,
    case when step = 'same' then r_description else j_description end as description,
    case step when 'same_refused' then same_reason when 'apply' then {q(C.APPLY_FORM)} when 'closed' then {q(C.CLOSED_PAGE)} when 'refused' then {q(C.MODEL_REFUSED)}
      else case when {removed('domain', "''", 'title', "case when step = 'same' then root else url end")} then {q(C.GATE_LISTED)} end end as skip_reason
  from steps),
kept as (select * from results where skip_reason is null)"""

SQL |= {
    "crawl_jobs": CRAWL + f""",
firsts as (select * from kept qualify row_number() over (partition by final_url order by site, page_ord, seed_ord) = 1)
select {label('domain', "''")} as "List", {q(C.SOURCE_LABEL)} as source, domain as company_domain, '' as company_name, root as career_page_url, title as job_title, final_url as job_url,
  '' as job_location, {strip('description')} as job_description, length(description) as job_description_length, case when step = 'job' then '2024-05-06' else '' end as job_posted_date,
  case when step = 'job' then 'meta_date' else '' end as job_posted_date_source, case when kind = 4 then 'high' else 'medium' end as confidence,
  case when step = 'same' then {q(C.SAME_PAGE_ACCEPTED)} when kind = 4 then '' else {q(C.CARD_SEED_REASON)} end as reason, '{CHECKED_AT}' as checked_at_utc
from firsts""",
    "crawl_skips": CRAWL + f"""
select domain as company_domain, root as career_page_url, title as seed_job_title, url as seed_job_url, final_url as final_job_url, skip_reason,
  case when step = 'closed' and doc_id is null then 'View jobsView jobs' when step in ('apply', 'closed') then j_sample
    when step = 'same_refused' and same_reason = {q(C.SAME_PAGE_NO_DESCRIPTION)} then left(r_description, 1000)
    when skip_reason = {q(C.GATE_LISTED)} then left(description, 1000) else '' end as job_page_text_sample, '{CHECKED_AT}' as checked_at_utc
from results where skip_reason is not null""",
    "raw_trace": CRAWL + f""",
counts as (select site, page_ord, pass, count(*) filter (skip_reason is null) as n_jobs from results group by all),
first_pass as (select o.*, coalesce(n_jobs, 0) as n_kept from opened o left join counts using (site, page_ord, pass)),
passes as (select site, page_ord, 0 as pass, page, next_pages, found from first_pass
  union all select f.site, page_ord, 1, page, '', kind = 1 from first_pass f join sites using (site) where may_retry and n_kept = 0),
shown as (
  select site, page_ord, pass, 'page' as kind, '' as title, null as url, case when pass = 1 then {q(C.RETRY_REASON)} else '' end as reason from passes
  union all select site, page_ord, pass, 'next', '', unnest(string_split(next_pages, '|')), '' from passes where next_pages <> ''
  union all select site, page_ord, pass, 'seed', title, url, '' from results
  union all select site, page_ord, pass, 'job', title, final_url, case when step = 'same' then {q(C.SAME_PAGE_ACCEPTED)} when kind = 4 then '' else {q(C.CARD_SEED_REASON)} end from kept
  union all select site, page_ord, pass, 'skip', title, final_url, skip_reason from results where skip_reason is not null)
select domain as company_domain, page as processed_page_url, pass = 1 as force_deeper, case when found then '' else {q(C.PAGE_ERROR)} end as error,
  shown.kind, title, coalesce(url, root) as url, reason
from shown join passes using (site, page_ord, pass) join sites using (site)""",
}

SQL |= {
    "keyword_index": f"""
with titles as (select doc_id, array_to_string(string_split(text, ' ')[1:12], ' ') as t from documents), kw as ({derived.MANY_KEYWORDS}),
n as (select doc_id, {nt('t')} as t from titles)
select doc_id, exists (select 1 from kw where keyword <> '' and contains(t, keyword)) as has_keyword from n""",
    "first_jobs": f"select * from ({SQL['screen_jobs']}) order by doc_id limit 10",
    "first_seeds": f"""
select * from ({SQL['merge_seeds']}) qualify row_number() over (partition by page_url order by origin desc, seed_ord) <= 5""",
}


SQL |= {
    "discovered_jobs": SQL["crawl_jobs"],
    "unvisited_pages": CRAWL + """,
left_ as (select site, 1 as page_ord, root || '/more' as page_url from sites where kind = 0
  union all select site, 1, root || '/a' from sites where kind = 3 union all select site, 2, root || '/b' from sites where kind = 3)
select domain as company_domain, root as career_page_url, page_ord, page_url from left_ join sites using (site)""",
    "file_lists": f"""
with {KEYS}, kw as ({derived.MANY_KEYWORDS}) select list_name, key_kind, key from list_keys
union all select distinct 'keywords', 'keyword', {nt('keyword')} from kw where {nt('keyword')} <> ''""",
    "file_inputs": f"""
with c as (select cid as o, company_website as x from ({derived.COMPANIES}) a union all select cid + 1000000000, upper(trim(company_website)) from ({derived.COMPANIES}) b),
n as (select row_number() over (order by o) - 1 as ord, {nd('x')} as company_domain from c),
p as (select page_id as o, url as x from pages union all select page_id + 1000000000, url || '/' from pages),
m as (select row_number() over (order by o) - 1 as ord, {nu('x')} as career_page from p)
select 'company' as kind, min(ord) as ord, company_domain, '' as career_page from n group by company_domain
union all select 'page', min(ord), {host('career_page')}, career_page from m where {host('career_page')} <> '' group by career_page""",
    "file_outputs": f"select cast(doc_id as string) as doc_id, * exclude (doc_id, job_description_length), cast(job_description_length as string) as job_description_length from ({SQL['screen_jobs']})",
    "snapshot_store": f"""
with own as (select page_id, url || '?p=' || page_id as u, ' ' || page_id || ' ' || html as h from pages),
d as (
  select 0 as delivery, u || case when page_id % 3 = 0 then '/' else '' end as raw, 0 as render_pass, true as fetch_ok, 'first' || h as html from own
  union all select 0, u || '//', 0, true, 'twice' || h from own where page_id % 5 = 0
  union all select 0, u, 0, false, 'failed' || h from own where page_id % 6 = 0
  union all select 0, u, 1, true, 'deeper' || h from own where page_id % 7 = 0
  union all select 1, ' ' || u, 0, true, 'anew' || h from own where page_id % 4 = 0
  union all select 2, u, 0, false, 'late' || h from own where page_id % 9 = 0)
select {nu('raw')} as url, render_pass, cast(delivery as bigint) as delivery, fetch_ok, html from d
qualify row_number() over (partition by {nu('raw')}, render_pass order by delivery desc, not fetch_ok, raw <> {nu('raw')}, raw) = 1""",
    "career_requests": f"""
with cards as ({SQL['page_cards']}), texts as ({SQL['page_text']}),
listed as (select url, to_json(list(struct_pack(href := href, link_text := link_text, nearby_text := nearby_text, card_title := card_title) order by pos)) as j from cards group by url),
p as (select {nu('url')} as u, body_text, coalesce(j, '[]') as j from texts left join listed using (url))
select 'career' as stage, u as url, concat_ws(chr(10), 'List every open job that this career page shows. Answer with one JSON object and nothing else.',
  'Give the address of a job''s own HTML page as job_url. Leave job_url empty for a job that is only shown on this page or only linked as a document, and say in reason when it is a document. Legal, '
  || 'privacy, cookie, team and people pages are no job pages. Invent nothing.',
  'Form of the answer: {{"jobs":[{{"company_name":"","job_title":"","job_url":"","job_location":"","confidence":"","reason":""}}]}}',
  'Company domain: ' || {host('u')}, 'Career page: ' || u, 'Text of the page:', body_text, 'Cards on the page:', j) as prompt
from p""",
}


def frontier_sql(budget: int) -> str:
    """The queue of every root, a level at a time; a level adds at least one page to each root that goes on, so there are at most ``budget`` of them."""
    levels = ["l0 as (select c_custkey as root_ord, 0 as page_ord, 'u' || c_custkey as page_url from customer)"]
    for n in range(1, budget + 1):
        last = f"l{n - 1}"
        before = " union all ".join(f"select root_ord, page_url from l{k}" for k in range(n))
        levels.append(f"""
f{n} as (select l.root_ord, dst as page_url, min(l.page_ord * 1000000000 + pos) as found_at from {last} l join links on src = page_url where l.page_ord < {budget} group by all),
l{n} as materialized (
  select f.root_ord, done + row_number() over (partition by f.root_ord order by found_at) - 1 as page_ord, page_url
  from f{n} f join (select root_ord, max(page_ord) + 1 as done from {last} group by 1) d using (root_ord)
  where not exists (select 1 from ({before}) b where b.root_ord = f.root_ord and b.page_url = f.page_url))""")
    pages = " union all ".join(f"select * from l{k}" for k in range(budget + 1))
    return f"with links as ({derived.LINKS}), {', '.join(levels)} select root_ord, cast(page_ord as int) as page_ord, page_url, page_ord < {budget} as visited from ({pages})"


SQL["frontier"] = frontier_sql(C.MAX_PAGES_PER_ROOT)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
