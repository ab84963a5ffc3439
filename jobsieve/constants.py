"""Fixed values.

Every list, pattern, cap and message below decides results, so each must stay exactly as it is.
"""

# --- output columns, in output order -------------------------------------------------------------

JOB_COLUMNS = [
    "List", "source", "company_domain", "company_name", "career_page_url", "job_title", "job_url",
    "job_location", "job_description", "job_description_length", "job_posted_date",
    "job_posted_date_source", "confidence", "reason", "checked_at_utc",
]

SKIP_COLUMNS = [
    "company_domain", "career_page_url", "seed_job_title", "seed_job_url", "final_job_url",
    "skip_reason", "job_page_text_sample", "checked_at_utc",
]

SOURCE_LABEL = "playwright + gemini"

# --- default caps and thresholds -----------------------------------------------------------------

MAX_INPUTS = 5
MAX_JOBS = 500
MAX_SEEDS_PER_PAGE = 200
MAX_PAGES_PER_ROOT = 10
MIN_DESCRIPTION_CHARS = 180
MAX_DESCRIPTION_CHARS = 60000
MAX_PAGE_CHARS = 90000
MAX_PROMPT_CHARS = 70000
MAX_NEARBY_CHARS = 3500
MAX_CARDS = 1000
MAX_NEXT_PAGES = 100
MAX_PROMPT_CARDS = 250
MAX_CAREER_URLS = 20
USED_CAREER_URLS = 8
TRACE_NEXT_PAGES = 20
TRACE_CARDS = 60
PAGE_SAMPLE_CHARS = 5000
JOB_SAMPLE_CHARS = 1000
CARD_KEY_CHARS = 140
OUTER_HTML_CHARS = 700
MAX_HEADINGS = 20

# --- links ---------------------------------------------------------------------------------------

CAREER_LINK_KEYWORDS = [
    "careers", "career", "jobs", "join-us", "join us", "work-with-us", "work with us", "vacancies",
    "open roles", "opportunities", "hiring", "recruitment",
]

NEXT_PAGE_KEYWORDS = [
    "open positions", "positions", "vacancies", "current vacancies", "view vacancies",
    "see vacancies", "see jobs", "view jobs", "job openings", "open roles", "browse roles",
    "search jobs", "find jobs", "opportunities", "join our team", "our vacancies", "explore roles",
    "all jobs", "learn more", "load more", "show more",
]

CAREER_PATHS = [
    "/careers", "/career", "/jobs", "/join-us", "/join", "/vacancies", "/work-with-us",
    "/opportunities", "/recruitment",
]

ATTACHMENT_EXTENSIONS = [".pdf", ".doc", ".docx"]

ATS_PATTERNS = [
    "greenhouse.io", "lever.co", "workable.com", "ashbyhq.com", "smartrecruiters.com",
    "pinpointhq.com", "bamboohr.com", "recruitee.com", "teamtailor.com", "workdayjobs.com",
    "myworkdayjobs.com", "icims.com", "jobvite.com", "personio.com", "oraclecloud.com",
    "kallidusrecruit.com", "freshteam.com", "dayforcehcm.com", "current.jobs", "climbgs.com",
    "hrpartner.io",
]

BLOCKED_BOARDS = [
    "builtin.com", "indeed.com", "glassdoor.com", "linkedin.com", "wellfound.com", "monster.com",
    "reed.co.uk", "totaljobs.com", "cv-library.co.uk", "ziprecruiter.com",
]

BAD_URL_FRAGMENTS = [
    "/privacy", "/cookie", "/cookies", "/terms", "/legal", "/policy", "/policies",
    "/accessibility", "/sitemap", "/modern-slavery", "/gender-pay", "/news", "/blog", "/contact",
]

PROFILE_URL_FRAGMENTS = [
    "/people/", "/team/", "/employees/", "/our-people/", "/leadership/", "/staff/", "/member/",
    "/members/", "/person/", "/profile/", "/profiles/",
]

# --- titles --------------------------------------------------------------------------------------

TITLE_MIN_CHARS = 4
TITLE_MAX_CHARS = 120

TITLE_REFUSED = ["privacy", "cookie", "contact", "about us", "leadership team"]

TITLE_HINTS = [
    "engineer", "developer", "manager", "executive", "assistant", "specialist", "consultant",
    "analyst", "coordinator", "designer", "administrator", "architect", "lead", "head of",
    "director", "technician", "associate", "officer", "advisor", "marketing", "sales", "finance",
    "account", "support", "product", "operations", "project", "data", "scientist", "recruiter",
    "buyer", "electrician", "mechanic", "warehouse", "bookkeeper",
]

HEADING_CHARS = r"[A-Za-z0-9&,\-–—'()/+. ]{3,120}"

# Tried in this order; the first pattern that matches anywhere in the text wins.
LOCATION_WORDS = r"(remote|hybrid|onsite)"
LOCATION_PAIR = r"[A-Z][a-z]+,{ws}*[A-Z][a-z]+"
LOCATION_COUNTRY = r"[A-Z][a-z]+{ws}*,{ws}*United Kingdom"
LOCATION_COUNTRY_SHORT = r"[A-Z][a-z]+{ws}*,{ws}*UK"

# --- page text -----------------------------------------------------------------------------------

# Removed from descriptions in this order.
NOISE_PATTERNS = [
    r"cookie policy.*?(accept all|reject all|manage preferences)",
    r"we use cookies.*?(accept|reject|manage)",
    r"skip to content",
    r"share this job",
]

DESCRIPTION_SIGNALS = [
    "responsibilities", "requirements", "the role", "about the role", "job description",
    "what you will do", "what you'll do", "essential criteria", "key responsibilities", "skills",
    "experience", "about you", "qualifications", "benefits", "salary", "location", "full time",
    "part time", "permanent", "contract", "hybrid", "remote", "hours", "person specification",
    "what we are looking for", "what we're looking for", "duties",
]

APPLY_SIGNALS = [
    "apply for this job", "submit application", "attach your file", "attach your file(s)",
    "drag and drop", "maximum file size", "first name", "last name", "email address",
    "phone number", "upload cv", "upload resume", "report this job",
]

CLOSED_SIGNALS = [
    "page not found", "404", "not found", "vacancy is no longer available",
    "job is no longer available", "position is no longer available", "this job is closed",
    "this vacancy has closed", "applications are closed", "no longer accepting applications",
    "this role is closed", "this position has been filled", "job has expired",
    "vacancy has expired", "expired vacancy", "sorry, this vacancy is no longer available",
    "the page you are looking for could not be found",
]

RETRY_SIGNALS = [
    "vacancies", "open positions", "search jobs", "view jobs", "loading", "apply now",
    "open roles", "job openings", "join our team", "current vacancies", "learn more",
]

BOARD_SIGNALS = ["search jobs", "job openings", "open positions", "filter by", "all jobs"]
BOARD_MIN_TITLES = 6
BOARD_MIN_TITLES_WITH_SIGNAL = 3

ATTACHMENT_REASON_WORDS = ["attachment", "pdf", "doc"]

# --- posted dates --------------------------------------------------------------------------------

# Compared after lower-casing the JSON key and removing its spaces and underscores.
DATE_KEYS = [
    "dateposted", "datepublished", "posteddate", "createdat", "published_at", "datecreated",
    "uploaddate",
]

# Compared after lower-casing the name or property of a meta tag.
DATE_META_NAMES = [
    "article:published_time", "datepublished", "date", "publish_date", "published_time",
    "dateposted",
]

DATE_JSON_PREFIX = "structured_data_"
DATE_META_PREFIX = "meta_"

# --- messages ------------------------------------------------------------------------------------

CARD_SEED_CONFIDENCE = "medium"
CARD_SEED_REASON = "Deterministic page-card extraction."
CARD_SEED_REASON_NO_URL = (
    "Visible job found on career page, but no separate normal HTML job URL was available."
)

SAME_PAGE_NO_URL = "Visible vacancy found, but no specific normal job URL was available."
SAME_PAGE_BOARD = "Page is a large jobs board; same-page fallback was not allowed."
SAME_PAGE_NO_TITLE = (
    "Visible vacancy found, but the job title could not be confidently matched on the same page."
)
SAME_PAGE_NO_DESCRIPTION = (
    "Visible vacancy found, but the same page does not contain a real job description."
)
SAME_PAGE_ACCEPTED = (
    "Job appears directly on the career page and was kept using the same-page URL."
)
DEFAULT_CONFIDENCE = "medium"

ATTACHMENT_ONLY = (
    "Visible vacancy found, but only PDF/DOC attachment exists and no normal HTML job page is available."
)
PROFILE_PAGE = "Resolved URL is a people/team profile page, not a job page."
APPLY_FORM = (
    "Job page appears to be mostly an apply form and does not contain enough real job description content."
)
CLOSED_PAGE = "Job page is closed, invalid, not found, or has no real job description."
MODEL_REFUSED = "Gemini classified job page as invalid/closed."

GATE_NO_TITLE = "Missing job title after job page extraction."
GATE_NO_URL = "Missing job URL."
GATE_BLOCKED_BOARD = "Removed because URL belongs to blocked external job board."
GATE_BAD_URL = "Removed because resolved URL was a non-job legal/policy page."
GATE_PROFILE = "Removed because resolved URL was a people/team profile page."
GATE_DESCRIPTION = "Final row removed because job_description is missing/too short/invalid."
GATE_LISTED = "Removed by blacklist/customers/current jobs/irrelevant names logic."

PAGE_ERROR = "Could not open page."
RETRY_REASON = "Zero jobs found on first pass; stronger retry executed."
