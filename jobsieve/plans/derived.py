"""Tables derived from the test tables, as SQL that Spark and DuckDB read alike.

The test tables hold almost none of the phrases, boards and paths that the rules look for, so these views spread them
over all rows. ``row_id`` order columns are explicit.
"""

TABLES = ("documents", "pages", "customer", "lineitem", "events", "part", "labels")

COMPANIES = """
select cast(c_custkey as bigint) as cid,
  '  https://WWW.company' || cast(c_custkey as string) || '.example.com/ ' as company_website,
  case when c_custkey % 9 = 0 then null else 'Company  ' || cast(c_custkey as string) || ' LTD' end as company_name,
  case c_custkey % 10 when 1 then 'customers' when 2 then 'blacklist' when 3 then 'churned' when 4 then 'active' else 'none' end as list_name
from customer
"""

JOB_PAGES = """
select doc_id, doc_id % 150 as cid,
  case when doc_id % 3 = 0 then 'other' || cast(doc_id % 150 as string) else 'company' || cast(doc_id % 150 as string) end || '.example.com' as company_domain,
  case when doc_id % 4 = 0 then '' else 'Company ' || cast(doc_id % 150 as string) || ' Ltd' end as company_name,
  case (doc_id % 97) % 5 when 0 then 'Senior Data  Engineer' when 1 then 'Barista' when 2 then 'Sales Manager (UK)' when 3 then 'Privacy Officer' else 'CAD Technician' end as job_title,
  case doc_id % 13 when 0 then 'https://boards.greenhouse.io/c/' || cast(doc_id % 400 as string)
    when 1 then 'https://uk.linkedin.com/jobs/' || cast(doc_id % 400 as string)
    when 2 then 'https://company' || cast(doc_id % 150 as string) || '.example.com/team/' || cast(doc_id % 400 as string)
    when 3 then 'https://company' || cast(doc_id % 150 as string) || '.example.com/spec.PDF?v=1'
    when 4 then 'https://blog.company' || cast(doc_id % 150 as string) || '.example.com/jobs/1'
    when 5 then ''
    else 'https://www.company' || cast(doc_id % 150 as string) || '.example.com/jobs/' || cast(cast(floor(doc_id / 300) as bigint) as string) || case doc_id % 11 when 0 then '//' else '' end end as job_url,
  case doc_id % 7 when 0 then text
    when 1 then 'About the role ' || text || ' Responsibilities and skills. Salary. London, United Kingdom'
    when 2 then 'Apply for this job. Submit application. Attach your file. Drag and drop. Maximum file size. First name, last name, email address, phone number, upload CV. ' || text
    when 3 then 'The role: requirements. This vacancy has closed. ' || text
    when 4 then 'We use cookies to help. Accept. Skip to content Job description ' || text || ' Benefits. Remote'
    when 5 then 'The role. Skills.'
    else text || ' duties, experience; error 404' end as page_text
from documents
"""

# Toxic documents stand for jobs that are listed already.
ACTIVE_URLS = """
select distinct 'https://www.company' || cast(doc_id % 150 as string) || '.example.com/jobs/' || cast(cast(floor(doc_id / 300) as bigint) as string) as external_url
from labels where toxic = 1
"""

LIST_ROWS = f"""
select list_name, company_website, company_name, cast(null as string) as external_url from ({COMPANIES}) c where list_name <> 'none'
union all
select 'active', cast(null as string), cast(null as string), external_url from ({ACTIVE_URLS}) u
"""

KEYWORDS = "select * from (values ('bar'), ('cad'), ('lab technician')) as k(keyword)"

# Pieces of the documents' texts, and two very short ones.
MANY_KEYWORDS = """
select distinct lower(trim(substr(text, 5 + cast(doc_id % 40 as int), 5 + cast(doc_id % 5 as int)))) as keyword from documents where doc_id % 5 = 0
union select 'q' as keyword union select 'xy' as keyword
"""

LINKS = """
select distinct 'u' || cast(l_orderkey as string) as src, 'u' || cast(l_partkey as string) as dst, l_partkey as pos
from lineitem
"""

SEEDS = """
select 'https://company' || cast(user_id as string) || '.example.com/careers' as page_url,
  cast(event_id as int) as seed_ord,
  case when event_id % 3 = 0 then 'llm' else 'rule' end as origin,
  case when event_id % 29 = 0 then ' ' else 'Data Engineer  ' || cast(event_id % (1 + user_id % 9) as string) end as job_title,
  case event_id % 5 when 0 then '' when 1 then 'https://x.com/jobs/' || cast(event_id % 400 as string) || '/' when 2 then 'https://x.com/jobs/' || cast(event_id % 400 as string) when 3 then 'https://x.com/team/a' else 'https://x.com/news/b' end as job_url,
  case when user_id % 2 = 0 then 'Search  JOBS here' else 'Our people' end as page_text
from events
"""

CARDS = """
select cast(p_partkey as int) as card_ord,
  'https://company' || p_brand || '.example.com/careers' as page_url,
  'company' || p_brand || '.example.com' as company_domain,
  case p_partkey % 9 when 0 then '' when 1 then 'https://company' || p_brand || '.example.com/jobs/' || cast(p_size as string) || '/'
    when 2 then 'https://jobs.company' || p_brand || '.example.com/' || cast(p_size as string) when 3 then 'https://elsewhere.example.org/jobs/1'
    when 4 then 'https://jobs.lever.co/x/' || cast(p_size as string) when 5 then 'https://www.reed.co.uk/jobs/lever.co'
    when 6 then 'https://company' || p_brand || '.example.com/spec.pdf' when 7 then 'https://company' || p_brand || '.example.com/our-people/a'
    else 'https://company' || p_brand || '.example.com/terms' end as href,
  case p_partkey % 4 when 0 then '' when 1 then 'Data Analyst' when 2 then 'Learn more' else 'Privacy Manager' end as card_title,
  case p_partkey % 7 when 0 then 'View Details' when 1 then ' Account Executive – UK ' when 2 then p_name || ' buyer' else '' end as link_text,
  case p_partkey % 5 when 0 then 'Project Lead ' || p_name when 1 then 'Señor Developer' when 2 then 'ab' when 3 then 'Remote finance, Leeds, UK' else p_name || ' | ' || p_type end as nearby_text
from part
"""

MODEL_ANSWERS = """
select doc_id, case doc_id % 10 when 0 then '```json
{"is_valid_open_job": true, "company_name": "", "job_title": "Lead Analyst", "job_url": ""}
```' when 1 then 'Sure: {"is_valid_open_job": false} ok'
  when 2 then '{"is_valid_open_job": "false", "job_title": 5}'
  when 3 then '[1]' when 4 then 'no json here'
  when 5 then '{"is_valid_open_job": false, "jobs": {"job_title": "Data Engineer"}}'
  when 6 then '{"a": 1} and {"b": 2}'
  when 7 then '[1] {"job_title": "Buyer", "job_location": 0, "reason": false}'
  when 8 then '```{"jobs": []}```'
  else '{"jobs": [{"job_title": "Data Engineer ' || cast(doc_id as string) || '", "job_url": "https://x.com/jobs/1/"}, "str", null, {"job_title": null, "reason": "only a pdf"}]}' end as response_text
from documents
"""

# One company site per document: a career page, a job page behind it, and what the model says about the job.
SITE_PAGES = """
select doc_id, 'https://company' || cast(doc_id as string) || '.example.com/careers' as url,
  'https://company' || cast(doc_id as string) || '.example.com/careers' as final_url,
  '' as posted,
  case doc_id % 6 when 0 then text
    when 1 then 'About the role: Data Engineer 1, Barista, Sales Manager. Responsibilities and skills. ' || text
    when 2 then 'Search jobs. About the role: Data Engineer 2. Duties and hours. ' || text
    when 3 then ''
    when 4 then 'Barista Sales Manager Data Engineer 0 Data Engineer 1 Data Engineer 2 Data Engineer 3 share this job ' || text
    else 'Data Engineer 3. The role. Skills. ' || text end as body
from documents
union all
select doc_id, 'https://company' || cast(doc_id as string) || '.example.com/jobs/open',
  case when doc_id % 19 = 0 then 'https://company' || cast(doc_id as string) || '.example.com/team/x' when doc_id % 23 = 0 then ''
    else 'https://company' || cast(doc_id as string) || '.example.com/jobs/open/' || cast(doc_id % 5 as string) || '/' end,
  case when doc_id % 3 = 0 then '' else '2024-01-0' || cast(1 + doc_id % 9 as string) end,
  page_text
from (JOB_PAGES) j
""".replace("JOB_PAGES", JOB_PAGES)

SITE_ANSWERS = """
select 'https://company' || cast(doc_id as string) || '.example.com/jobs/open' || case when doc_id % 23 = 0 and doc_id % 19 <> 0 then '' else '/' || cast(doc_id % 5 as string) end as url,
  case doc_id % 8 when 0 then '{"is_valid_open_job": true, "company_name": "Company ' || cast(doc_id % 150 as string) || ' Ltd", "job_title": "  ", "job_url": "https://news.example.com/x"}'
    when 1 then '{"is_valid_open_job": false}'
    when 2 then '{"is_valid_open_job": "false", "job_title": "Lead Analyst", "job_location": "Leeds", "confidence": "high", "reason": "clear"}'
    when 3 then '{"job_title": "CAD Lead", "job_posted_date": "2020-02-02", "job_posted_date_source": "text"}'
    when 4 then '{"job_url": "https://www.indeed.com/x"}'
    when 5 then '{"job_url": "https://a.example.com/staff/x"}'
    when 6 then '{"job_url": "https://a.example.com/blog/x"}' else 'sorry' end as response_text
from documents
where doc_id % 31 <> 0
"""

# Every event is a seed on one of the sites, so the sites' seeds grow with the events.
SITE_SEEDS = """
select event_id, doc_id, 'https://company' || cast(doc_id as string) || '.example.com/careers' as page_url,
  case when doc_id % 3 = 0 then 'other' || cast(doc_id % 150 as string) else 'company' || cast(doc_id % 150 as string) end || '.example.com' as company_domain,
  cast(event_id as int) as seed_ord,
  case when event_id % 7 = 0 then 'Company  ' || cast(doc_id % 150 as string) || ' Ltd' else '' end as company_name,
  case when doc_id % 5 < 2 then 'Data Engineer ' || cast(doc_id % 4 as string) else case k % 7 when 0 then ' Barista' when 1 then 'Sales Manager ' when 2 then '' else 'Data Engineer ' || cast(k % 4 as string) end end as job_title,
  case k % 9 when 0 then '' when 1 then '/' when 2 then 'https://company.example.com/job.docx' when 3 then 'https://company.example.com/people/1'
    when 4 then 'https://company.example.com/jobs/none' else 'https://company' || cast(doc_id as string) || '.example.com/jobs/open' || case when k % 2 = 0 then '/' else '' end end as job_url,
  case when k % 5 = 0 then 'Leeds' else '' end as job_location,
  case when k % 2 = 0 then 'medium' else '' end as confidence,
  case when event_id % 4 = 0 then 'Listed as a PDF' when event_id % 4 = 1 then 'seen' else '' end as reason
from (select event_id, event_id % (select count(*) from documents) as doc_id,
        cast(floor(event_id / (select count(*) from documents)) as bigint) + event_id % 5 as k from events) e
"""

POSTING_KINDS = 8
