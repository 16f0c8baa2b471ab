"""Independent SQL for the registered queries, in DuckDB's dialect."""


from .listings import listings_sql
from .registry import BATCH, REPORT_DATE

LISTING = "title, url, source, keyword, company, location, work_type, salary, tags, posted"
SILVER = (
    "title, url, source, keyword, company, work_type, salary_raw, tags, posted, "
    "min_salary, max_salary, currency, location_std"
)

_NUM = r"(\d{1,3}(?:[.,]\d{3})*(?:\.\d+)?|\d+(?:\.\d+)?)"
_AFTER_DASH = r"-\s*" + _NUM
_END = r"($|[^\p{L}\p{Mn}\p{Nd}_])"
_START_W, _END_W = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
_BLANK = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


# ---- expressions ----------------------------------------------------------

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def fold(x: str) -> str:
    return strip(f"lower(strip_accents(replace(replace(coalesce({x}, ''), 'đ', 'd'), 'Đ', 'D')))")


def posted_currency(s: str) -> str:
    return rf"CASE WHEN regexp_matches({s}, 'usd|\$') THEN 'USD' ELSE 'VND' END"


def posted_multiplier(s: str, currency: str) -> str:
    return (
        f"CASE WHEN {currency} = 'USD' THEN 1.0::DOUBLE"
        f" WHEN regexp_matches({s}, 'triệu|tr{_END}|million') THEN 1000000.0::DOUBLE"
        f" WHEN regexp_matches({s}, 'nghìn|k{_END}|thousand') THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END"
    )


def posted_number(s: str, pattern: str = _NUM) -> str:
    return f"TRY_CAST(regexp_replace(regexp_extract({s}, '{pattern}', 1), '[,.]', '', 'g') AS FLOAT)"


def lower_text(x: str) -> str:
    return f"lower(trim(coalesce({x}, ''), ' '))"


def location(x: str, dialect: str) -> str:
    if dialect == "folded":
        x = fold(x)
        rules = [
            ("ho chi minh|hcm|saigon|sai gon", "Ho Chi Minh"),
            (f"ha noi|hanoi|{_START_W}hn{_END_W}", "Ha Noi"),
            ("da nang|danang", "Da Nang"),
            ("remote|work from home", "Remote"),
        ]
    else:
        x = lower_text(x)
        accented = dialect == "accented"
        rules = [
            ("hồ chí minh|ho chi minh|hcm|sài gòn|saigon" if accented else "ho chi minh|hcm|saigon", "Ho Chi Minh"),
            (f"hà nội|ha noi|hanoi|hn{_END}" if accented else f"ha noi|hn{_END}|hanoi", "Ha Noi"),
            ("đà nẵng|da nang|danang" if accented else "da nang|danang", "Da Nang"),
            ("remote", "Remote"),
        ]
    whens = " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{label}'" for p, label in rules)
    return f"CASE {whens} ELSE 'Other' END"


def search(title: str, tags: str) -> str:
    return f"lower(regexp_replace(coalesce({title}, '') || ' ' || coalesce({tags}, ''), '[^a-zA-Z0-9+#. ]', ' ', 'g'))"


def money(x: str) -> str:
    return f"format('{{:,}}', CAST(round(coalesce({x}, 0)) AS BIGINT))"


# ---- common tables --------------------------------------------------------

def ctes(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"


RAW = ("listings", listings_sql())
DATED = ("listings", listings_sql(batches=True))


def posted(source: str = "listings", name: str = "posted", dialect: str = "ascii", salary: str = "salary", trim_keys: bool = False) -> list:
    """Posted-dialect normalisation of a table with a salary and a location."""
    everything = "* REPLACE (trim(title, ' ') AS title, trim(url, ' ') AS url)" if trim_keys else "*"
    return [
        (f"{name}_s", f"SELECT *, {lower_text(salary)} AS s FROM {source}"),
        (f"{name}_c", f"SELECT *, {posted_currency('s')} AS currency FROM {name}_s"),
        (f"{name}_n", f"SELECT *, {posted_multiplier('s', 'currency')} AS m, {posted_number('s')} AS v1, "
                      f"{posted_number('s', _AFTER_DASH)} AS v2 FROM {name}_c"),
        (name, f"SELECT {everything}, salary AS salary_raw, "
               "CASE WHEN NOT contains(s, 'up to') THEN CAST(v1 AS DOUBLE) * m END AS min_salary, "
               "CASE WHEN contains(s, 'up to') THEN CAST(v1 AS DOUBLE) * m WHEN v2 > 0 THEN CAST(v2 AS DOUBLE) * m "
               f"WHEN v2 IS NULL THEN CAST(v1 AS DOUBLE) * m END AS max_salary, {location('location', dialect)} AS location_std "
               f"FROM {name}_n"),
    ]


def best(source: str, keys: str, name: str = "silver") -> tuple[str, str]:
    rest = [c.strip() for c in SILVER.split(",") if c.strip() not in keys and c.strip() != "title"]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["title", *rest])
    return (
        name,
        f"SELECT {SILVER} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "
        f"coalesce(max_salary, min_salary, 0) DESC NULLS LAST, {order}) AS rn FROM {source}) WHERE rn = 1",
    )


def prepared(report: str = REPORT_DATE) -> tuple[str, str]:
    return (
        "ready",
        f"SELECT *, DATE '{report}' AS report_date, (min_salary IS NOT NULL OR max_salary IS NOT NULL) AS has_salary FROM silver",
    )


LOCAL = [RAW, *posted(), best("posted", "url")]
CLOUD_ROWS = [
    RAW, *posted(dialect="accented", trim_keys=True),
    ("kept", "SELECT * FROM posted WHERE length(trim(title, ' ')) > 0 AND length(trim(url, ' ')) > 0"),
]
CLOUD = [*CLOUD_ROWS, best("kept", "source, url")]
READY = [*LOCAL, prepared()]
READY_CLOUD = [*CLOUD, prepared()]
DAYS = [DATED, *posted(), ("days", "SELECT *, CAST(batch_date AS DATE) AS report_date, "
                                   "(min_salary IS NOT NULL OR max_salary IS NOT NULL) AS has_salary FROM posted")]

AVERAGES = (
    "round(avg(min_salary), 2) AS avg_min_salary, round(avg(max_salary), 2) AS avg_max_salary, max(max_salary) AS highest_salary"
)
WITH_SALARY = "CAST(count(*) FILTER (WHERE has_salary) AS BIGINT) AS jobs_with_salary"
HIGH = "((currency = 'USD' AND min_salary >= 1000) OR (currency = 'VND' AND min_salary >= 20000000))"
CLEAN = "(title IS NOT NULL AND url IS NOT NULL AND source IS NOT NULL AND regexp_matches(url, '^https?://.*'))"

MARTS = {
    "overview": "SELECT report_date, count(DISTINCT url) AS total_jobs, count(DISTINCT company) AS total_companies, "
                "count(DISTINCT source) AS total_sources, count(DISTINCT location_std) AS total_locations, "
                f"{WITH_SALARY} FROM ready GROUP BY report_date",
    "overview_pairs": "SELECT report_date, count(DISTINCT (source, url)) FILTER (WHERE source IS NOT NULL AND url IS NOT NULL) AS total_jobs, "
                      "count(DISTINCT company) AS total_companies, count(DISTINCT source) AS total_sources, "
                      f"count(DISTINCT location_std) AS total_locations, {WITH_SALARY} FROM ready GROUP BY report_date",
    "sources": "SELECT source, report_date, count(DISTINCT url) AS job_count, count(DISTINCT company) AS company_count, "
               f"{WITH_SALARY} FROM ready GROUP BY source, report_date",
    "by_location": "SELECT location_std, source, currency, report_date, count(DISTINCT url) AS job_count, "
                   f"{AVERAGES} FROM ready WHERE has_salary GROUP BY location_std, source, currency, report_date",
    "locations": "SELECT location_std, source, currency, report_date, count(DISTINCT url) AS job_count, "
                 f"{WITH_SALARY}, {AVERAGES} FROM ready GROUP BY location_std, source, currency, report_date",
    "companies": "SELECT company, source, location_std, report_date, count(DISTINCT url) AS job_count, "
                 "max(max_salary) AS highest_salary FROM ready WHERE company IS NOT NULL "
                 "GROUP BY company, source, location_std, report_date",
    "alerts": "SELECT title, company, url, source, location_std, salary_raw, min_salary, max_salary, currency, report_date "
              f"FROM ready WHERE {HIGH}",
    "health": f"SELECT 'gold_aggregation' AS pipeline_name, 'success' AS status, count(*) AS records_in, "
              f"DATE '{REPORT_DATE}' AS report_date FROM silver",
    "jobs": "SELECT keyword, title, url, company, location_std AS location, work_type, salary_raw AS salary, tags, posted, "
            "report_date FROM ready WHERE source = 'itviec'",
    "summary": f"SELECT location_std, currency, report_date, count(url) AS total_jobs, {AVERAGES} "
               "FROM ready WHERE min_salary IS NOT NULL GROUP BY location_std, currency, report_date",
    "stats": "SELECT source, report_date, count(url) AS jobs_count FROM ready GROUP BY source, report_date",
    "daily": f"SELECT title, url, min_salary, max_salary, currency, source, location_std, report_date FROM ready WHERE {HIGH}",
}


def _skills(whole_words: bool = False) -> tuple[str, str]:
    def quoted(s):
        return s.replace("'", "''")

    def pattern(s):
        escaped = "".join("\\" + c if c in "+.#" else c for c in s)
        return f"(^|[^a-z0-9+#.]){escaped}($|[^a-z0-9+#])"

    # The skill dictionary, written out again.
    skills = (
        "python", "sql", "spark", "airflow", "docker", "kafka", "aws", "azure", "gcp", "java", "javascript", "typescript",
        "react", "node", "php", "c#", ".net", "golang", "go", "devops", "linux", "power bi", "tableau", "machine learning",
        "data engineer", "data analyst", "etl", "dbt",
    )
    rows = ", ".join(f"('{quoted(s)}', '{quoted(s.title())}', '{pattern(s)}')" for s in skills)
    return ("skills", f"SELECT * FROM (VALUES {rows}) v(needle, skill, pattern)")


SEARCHED = ("searched", f"SELECT url, {search('title', 'tags')} AS st, count(*) AS k FROM listings GROUP BY 1, 2")


def skill_mart(source: str = "ready") -> str:
    return (
        "SELECT skill, source, location_std, report_date, count(DISTINCT url) AS job_count "
        f"FROM (SELECT *, {search('title', 'tags')} AS st FROM {source}) JOIN skills ON contains(st, needle) "
        "GROUP BY skill, source, location_std, report_date"
    )


def rule(name: str, column: str, source: str, evaluated: str, failed: str, mostly: float = 1.0) -> str:
    return (
        f"SELECT '{name}' AS rule, '{column}' AS \"column\", e AS evaluated, f AS failed, "
        f"CASE WHEN e > 0 THEN CAST(e - f AS DOUBLE) / e END AS ratio, CAST({mostly} AS DOUBLE) AS threshold, "
        f"coalesce(CAST(e - f AS DOUBLE) / nullif(e, 0) >= CAST({mostly} AS DOUBLE), true) AS passed "
        f"FROM (SELECT {evaluated} AS e, {failed} AS f FROM {source})"
    )


def _not_null(c: str, source: str = "listings") -> str:
    return rule("not_null", c, source, "count(*)", f"count(*) FILTER (WHERE {c} IS NULL)")


SUITE = [
    _not_null("title"), _not_null("url"), _not_null("source"),
    rule("match_regex", "url", "listings", "count(url)", "count(*) FILTER (WHERE NOT regexp_matches(url, '^https?://.*'))", 0.95),
    rule("length_between", "title", "listings", "count(title)", "count(*) FILTER (WHERE NOT (length(title) BETWEEN 5 AND 200))", 0.98),
]


def union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


# ---- inputs beyond listings -----------------------------------------------

TEXTS = [RAW, ("texts", "SELECT salary FROM listings UNION ALL SELECT text FROM documents")]
PLACES = [RAW, ("places", "SELECT location FROM listings UNION ALL SELECT text FROM documents")]
TEXT_KEY = "md5(coalesce(salary, 'missing')) AS text_md5"

ORDER_UPDATE = [
    ("target", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"),
    ("incoming", "SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, 'changed' AS o_orderpriority "
                 "FROM target WHERE o_orderstatus = 'O' UNION ALL "
                 "SELECT -o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM target WHERE o_orderstatus = 'P'"),
]

_LANES = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))


def checksum(source: str, name: str) -> list:
    return [
        (f"{name}_h", f"SELECT event_type, day, sha256(replace(props, ' ', '')) AS h FROM {source}"),
        (name, "SELECT event_type, day, count(*) AS record_count, "
               f"sha256(concat_ws(':', CAST(count(*) AS VARCHAR), {_LANES})) AS checksum FROM {name}_h GROUP BY event_type, day"),
    ]


BATCH_SUMS = [
    ("ev", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, props FROM events"),
    ("old", "SELECT event_type, day, CASE WHEN event_type = 'error' THEN '{\"k\": 0}' ELSE props END AS props "
            "FROM ev WHERE event_type <> 'purchase'"),
    *checksum("ev", "incoming"), *checksum("old", "stored"),
]


def decision(differs: str) -> str:
    return (
        f"CASE WHEN s.checksum IS NULL THEN 'UPLOADED' WHEN s.checksum = i.checksum THEN 'SKIPPED_IDENTICAL' ELSE '{differs}' END"
    )


DECIDED = "FROM incoming i LEFT JOIN stored s ON i.event_type = s.event_type AND i.day = s.day"

LANDED = [
    ("landed", "SELECT doc_id, sha256(text) AS content_hash FROM documents"),
    ("manifest", "SELECT doc_id, CASE WHEN lang = 'de' THEN sha256(text || 'older') ELSE sha256(text) END AS content_hash "
                 "FROM documents WHERE lang <> 'en'"),
    ("seen", "SELECT l.*, m.doc_id IS NOT NULL AS known FROM landed l LEFT JOIN manifest m "
             "ON l.doc_id = m.doc_id AND l.content_hash = m.content_hash"),
]

_ACCENT_FREE_TOKEN = (
    # the separators of one token, judged as in the folded dialect
    "CASE WHEN contains(t, ',') AND contains(t, '.') THEN replace(t, ',', '') "
    "WHEN length(t) - length(replace(t, ',', '')) > 1 THEN replace(t, ',', '') "
    "WHEN length(t) - length(replace(t, '.', '')) > 1 THEN replace(t, '.', '') "
    "WHEN contains(t, ',') AND length(split_part(t, ',', 2)) = 3 AND length(split_part(t, ',', 1)) <= 3 THEN replace(t, ',', '') "
    "WHEN contains(t, ',') THEN replace(t, ',', '.') "
    "WHEN contains(t, '.') AND length(split_part(t, '.', 2)) = 3 AND length(split_part(t, '.', 1)) <= 3 THEN replace(t, '.', '') "
    "ELSE t END"
)


def folded_salary(source: str) -> list:
    """Folded-dialect salary of a table with a salary column; adds a row id."""
    return [
        ("f0", f"SELECT *, row_number() OVER () AS rid, {fold('salary')} AS s FROM {source}"),
        ("f1", "SELECT *, s <> '' AND NOT regexp_matches(s, 'thoa thuan|negotiable|hidden|login to view|khong hien thi|"
               "salary not shown|competitive|you''ll love it') AS shown FROM f0"),
        ("f2", "SELECT *, CASE WHEN NOT shown THEN 'UNKNOWN' WHEN contains(salary, '$') OR contains(s, 'usd') THEN 'USD' "
               "WHEN regexp_matches(s, 'vnd|₫|trieu|tr | tr|million') THEN 'VND' ELSE 'UNKNOWN' END AS currency FROM f1"),
        ("f3", f"SELECT *, CASE WHEN currency <> 'VND' THEN 1 "
               f"WHEN regexp_matches(s, '{_START_W}(trieu|tr|million){_END_W}') THEN 1000000 "
               f"WHEN regexp_matches(s, '{_START_W}(nghin|k|thousand){_END_W}') THEN 1000 ELSE 1 END AS m, "
               r"regexp_extract_all(s, '\d+(?:[,.]\d+)*') AS tokens FROM f2"),
        ("f4", "SELECT rid, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS t FROM f3 WHERE shown"),
        ("f5", f"SELECT rid, pos, TRY_CAST({_ACCENT_FREE_TOKEN} AS DOUBLE) AS v FROM f4"),
        ("f6", "SELECT rid, v, row_number() OVER (PARTITION BY rid ORDER BY pos) AS k FROM f5 WHERE v IS NOT NULL"),
        ("f7", "SELECT rid, max(v) FILTER (WHERE k = 1) AS a, max(v) FILTER (WHERE k = 2) AS b FROM f6 WHERE k <= 2 GROUP BY rid"),
        ("folded", "SELECT f3.*, CASE WHEN regexp_matches(s, 'up to|upto|len den|toi da') THEN NULL "
                   "WHEN regexp_matches(s, 'from|starting from|tu ') THEN a * m "
                   "ELSE least(a * m, coalesce(b * m, a * m)) END AS min_salary, "
                   "CASE WHEN regexp_matches(s, 'up to|upto|len den|toi da') THEN a * m "
                   "WHEN regexp_matches(s, 'from|starting from|tu ') THEN NULL "
                   "ELSE greatest(a * m, coalesce(b * m, a * m)) END AS max_salary FROM f3 LEFT JOIN f7 ON f3.rid = f7.rid"),
    ]


REVERSED = [RAW, ("shown", "SELECT * REPLACE ('1.' || salary AS salary) FROM listings"), *posted("shown")]

EVENTS = [("ev", """SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day, props,
  CASE event_type WHEN 'error' THEN '{"meta": [1, {"Session-Token": "x", "inner": ' || props || '}]}'
    WHEN 'purchase' THEN '{"note": "the \\"password\\": none", "p": ' || props || '}'
    WHEN 'click' THEN '{"Authorization": "x", "a": {"cookie": 1}, "p": ' || props || '}' ELSE props END AS payload FROM events""")]
BROKEN = [*EVENTS, ("broken", "SELECT event_id, event_type, day, CASE event_type WHEN 'error' THEN '{}' WHEN 'click' THEN '[' || props || ']' "
                              "WHEN 'purchase' THEN substr(props, 2) ELSE props END AS payload, "
                              "CASE event_type WHEN 'error' THEN 'empty_object' WHEN 'click' THEN 'not_object' "
                              "WHEN 'purchase' THEN 'not_json' ELSE 'ok' END AS verdict FROM ev")]

DATES = [("dates", """SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%-m-%-d')
    WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-') || '31'
    WHEN o_orderstatus = 'F' THEN '' END AS value FROM orders""")]

_BODY = (
    "regexp_replace(h, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<head\\b.*?</head>|<[^>]+>', ' ', 'g')"
)
PAGES = [
    ("seen", "SELECT page_id, url, html, unnest(range(8)) AS variant FROM pages"),
    ("changed", "SELECT page_id, CAST(variant AS INTEGER) AS variant, CASE variant WHEN 1 THEN 429 WHEN 2 THEN 403 ELSE 200 END AS status, "
                "CASE WHEN variant = 3 THEN url || '/dang-nhap' ELSE url END AS u, "
                "CASE variant WHEN 4 THEN replace(html, '<title>', '<title>Attention Required! ') "
                "WHEN 5 THEN replace(html, '<article>', '<article>Verify you are HUMAN ') "
                "WHEN 6 THEN replace(html, '<article>', '<article class=\"job\">') "
                "WHEN 7 THEN replace(html, 'href=', 'name=') ELSE html END AS h FROM seen"),
    ("parts", "SELECT page_id, variant, status, lower(u) AS u, "
              "CAST(len(regexp_extract_all(h, 'class=\"job\"')) AS INTEGER) AS card_count, "
              "CAST(len(regexp_extract_all(h, '<a href=\"/')) AS INTEGER) AS link_count, "
              f"regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1) AS page_title, lower({_BODY}) AS body FROM changed"),
    ("full_text", "SELECT *, lower(page_title) || chr(10) || body AS t FROM parts"),
]
OUTCOME = (
    "CASE WHEN card_count > 0 THEN 'jobs_visible' "
    "WHEN regexp_matches(t, 'attention required|sorry, you have been blocked|cloudflare ray id|error 1020|cf-error') THEN 'cloudflare_block' "
    "WHEN status = 429 THEN 'rate_limited' WHEN status = 403 THEN 'access_denied' "
    "WHEN regexp_matches(t, 'verify you are human|checking your browser|just a moment|performing security verification|turnstile|captcha') "
    "THEN 'anti_bot_challenge' WHEN contains(u, 'dang-nhap') OR contains(u, '/login') THEN 'login_redirect' "
    "WHEN link_count > 0 THEN 'selector_drift' ELSE 'empty_unknown' END"
)
LINKS = [
    ("items", "SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 0)) AS item FROM pages"),
    ("links", "SELECT page_id, regexp_replace(regexp_extract(item, 'href=\"([^\"]*)\"', 1), '\\?.*', '') AS url, "
              "trim(regexp_extract(item, '>([^<]*)</a>', 1), ' ') AS title FROM items"),
]


def top(source: str, order: str, columns: str, n: int) -> str:
    rest = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in columns.split(","))
    return f"SELECT {columns} FROM {source} ORDER BY {order}, {rest} LIMIT {n}"


JOBS_COLUMNS = "keyword, title, url, company, location, work_type, salary, tags, posted, report_date"
SERVING_JOBS = [*DAYS, ("ready", "SELECT * FROM days"), ("jobs", MARTS["jobs"])]

def _batch_silver(name: str, condition: str) -> list:
    return [
        (f"{name}_raw", f"SELECT * FROM listings WHERE {CLEAN} AND {condition}"),
        *posted(f"{name}_raw", f"{name}_p", "accented", trim_keys=True),
        (f"{name}_k", f"SELECT * FROM {name}_p WHERE length(trim(title, ' ')) > 0 AND length(trim(url, ' ')) > 0"),
        best(f"{name}_k", "source, url", name),
    ]


STREAMED = [DATED, *_batch_silver("early", f"batch_date < '{BATCH}'"), *_batch_silver("late", f"batch_date >= '{BATCH}'")]


# The marts' columns, and those of them that hold fractions.
MART_COLUMNS = {
    "mart_job_market_overview": "report_date total_jobs total_companies total_sources total_locations jobs_with_salary",
    "mart_source_performance": "source report_date job_count company_count jobs_with_salary",
    "mart_salary_by_location": "location_std source currency report_date job_count avg_min_salary avg_max_salary highest_salary",
    "mart_company_hiring_trend": "company source location_std report_date job_count highest_salary",
    "mart_skill_demand": "skill source location_std report_date job_count",
    "mart_high_salary_alerts": "title company url source location_std salary_raw min_salary max_salary currency report_date",
    "mart_pipeline_health": "pipeline_name status records_in report_date",
    "itviec_jobs": "keyword title url company location work_type salary tags posted report_date",
    "market_summary": "location_std currency report_date total_jobs avg_min_salary avg_max_salary highest_salary",
    "source_stats": "source report_date jobs_count",
    "daily_alerts": "title url min_salary max_salary currency source location_std report_date",
}
FRACTIONS = {"avg_min_salary", "avg_max_salary", "highest_salary", "min_salary", "max_salary"}


def mart_rows(name: str, sql: str, twice: str | None = None) -> str:
    """A mart's rows as (mart, row); ``twice`` names a key: after two upserts a row that
    lacks it is there twice, as it never matches."""
    text = lambda c: f"coalesce(printf('%.2f', CAST({c} AS DOUBLE)), '-')" if c in FRACTIONS else f"coalesce(CAST({c} AS VARCHAR), '-')"
    row = " || '|' || ".join(text(c) for c in sorted(MART_COLUMNS[name].split()))
    select = f"SELECT '{name}' AS mart, {row} AS row FROM ({sql})"
    return union(select, f"{select} WHERE {twice} IS NULL") if twice else select


def _gold_rows() -> str:
    tables = {
        "mart_job_market_overview": MARTS["overview"], "mart_source_performance": MARTS["sources"],
        "mart_salary_by_location": MARTS["by_location"], "mart_company_hiring_trend": MARTS["companies"],
        "mart_skill_demand": skill_mart(), "mart_high_salary_alerts": MARTS["alerts"], "mart_pipeline_health": MARTS["health"],
        "itviec_jobs": MARTS["jobs"], "market_summary": MARTS["summary"], "source_stats": MARTS["stats"],
        "daily_alerts": MARTS["daily"],
    }
    by_url = ("mart_high_salary_alerts", "itviec_jobs", "daily_alerts")
    return union(*[mart_rows(name, sql, "url" if name in by_url else None) for name, sql in tables.items()])


ORACLE = {
    # scans
    "raw_json_scan": ctes(DATED) + f"SELECT {LISTING}, batch_date FROM listings",
    "file_lineage": ctes(DATED) + "SELECT source, batch_date, count(*) AS row_count, count(*) AS rows_with_file, "
                                  "count(*) AS rows_with_time FROM listings GROUP BY source, batch_date",
    "parquet_scan": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000",
    "batch_partition_scan": ctes(DATED) + f"SELECT {LISTING}, batch_date FROM listings WHERE batch_date = '{BATCH}'",
    "catalog_table_scan": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "inline_rows": f"SELECT 'gold_aggregation' AS pipeline_name, 'success' AS status, count(*) AS records_in, "
                   f"DATE '{REPORT_DATE}' AS report_date FROM lineitem",
    "incremental_landing": ctes(*LANDED) + "SELECT doc_id, content_hash FROM seen WHERE NOT known",
    "incremental_landing_counts": ctes(*LANDED) + "SELECT count(*) FILTER (WHERE NOT known) AS copied, "
                                                  "count(*) FILTER (WHERE known) AS skipped FROM seen",
    "html_listing_extract": ctes(DATED) + (
        "SELECT source AS page_source, crawl_order AS page_order, crawl_line AS page_line, "
        "CASE WHEN source = 'topcv' THEN 'data' END AS keyword, trim(title, ' ') AS title, "
        "CASE WHEN source = 'topcv' AND url IS NULL THEN 'https://www.topcv.vn' "
        "WHEN source = 'topcv' AND url NOT LIKE 'http%' THEN 'https://www.topcv.vn' || url ELSE coalesce(url, '') END AS url, "
        "coalesce(company, '') AS company, coalesce(location, '') AS location, "
        "CASE WHEN source = 'topcv' THEN 'At office' ELSE work_type END AS work_type, "
        "coalesce(salary, CASE WHEN source = 'topcv' THEN 'Thoả thuận' ELSE 'Negotiable' END) AS salary, "
        "coalesce(tags, '[]') AS tags, posted FROM listings WHERE trim(title, ' ') <> ''"
    ),
    "html_page_links": ctes(*LINKS) + "SELECT page_id, title, url, count(*) AS n FROM links WHERE title <> '' GROUP BY page_id, title, url",
    "sql_over_lake": ctes(RAW, *posted()) + "SELECT location_std, currency, count(*) AS jobs, max(max_salary) AS top FROM posted "
                                            "WHERE min_salary IS NOT NULL GROUP BY location_std, currency HAVING count(*) > 1",
    # sinks
    "append_partitioned": ctes(RAW) + "SELECT source, crawled_date, keyword, count(*) AS row_count, count(DISTINCT url) AS urls "
                                      f"FROM listings, (VALUES ('2026-09-29'), ('2026-09-30')) d(crawled_date) WHERE {CLEAN} "
                                      "GROUP BY source, crawled_date, keyword",
    "quarantine_sink": ctes(RAW) + "SELECT source, title, url, salary, concat_ws(',', CASE WHEN title IS NULL THEN 'title_missing' END, "
                                   "CASE WHEN url IS NULL THEN 'url_missing' END, CASE WHEN source IS NULL THEN 'source_missing' END, "
                                   "CASE WHEN NOT regexp_matches(url, '^https?://.*') THEN 'url_not_http' END) AS reasons "
                                   f"FROM listings WHERE NOT coalesce({CLEAN}, false)",
    "batch_partition_replace": ctes(DATED) + "SELECT source, batch_date, count(*) AS row_count, "
                                             f"count(*) FILTER (WHERE batch_date = '{BATCH}') AS rewritten, count(url) AS urls "
                                             "FROM listings GROUP BY source, batch_date",
    "create_table_like": ctes(*CLOUD) + "SELECT source, currency, count(*) AS row_count, max(max_salary) AS highest_salary "
                                        "FROM silver GROUP BY source, currency",
    "keyed_upsert": ctes(*ORDER_UPDATE) + (
        "SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(t.o_orderstatus, i.o_orderstatus) AS o_orderstatus, "
        "coalesce(i.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(i.o_orderpriority, t.o_orderpriority) AS o_orderpriority "
        "FROM target t FULL JOIN incoming i ON t.o_orderkey = i.o_orderkey"
    ),
    "keyed_upsert_table": ctes(
        RAW, *posted(), ("silver", "SELECT * FROM posted"), prepared(), ("before", MARTS["locations"]),
        best("posted", "url", "deduped"),
        ("ready2", f"SELECT *, DATE '{REPORT_DATE}' AS report_date, (min_salary IS NOT NULL OR max_salary IS NOT NULL) AS has_salary FROM deduped"),
        ("after", MARTS["by_location"].replace("FROM ready", "FROM ready2")),
    ) + (
        "SELECT location_std, source, currency, report_date, coalesce(a.job_count, b.job_count) AS job_count, "
        "CASE WHEN a.job_count IS NOT NULL THEN a.highest_salary ELSE b.highest_salary END AS highest_salary "
        "FROM before b FULL JOIN after a USING (location_std, source, currency, report_date)"
    ),
    "insert_only_merge": ctes(*ORDER_UPDATE) + "SELECT * FROM target UNION ALL SELECT * FROM incoming i "
                                               "WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = i.o_orderkey)",
    "publish_nonempty_marts": ctes(*READY) + union(
        mart_rows("mart_source_performance", MARTS["sources"]), mart_rows("mart_company_hiring_trend", MARTS["companies"]),
    ),
    "batch_envelope": ctes(DATED) + "SELECT source, batch_date, count(*) AS total, count(*) AS records, "
                                    "'2026-09-30T00:00:00' AS scraped_at FROM listings GROUP BY source, batch_date",
    # projections
    "schema_guard": ctes(RAW) + "SELECT title, url, source, CAST(NULL AS VARCHAR) AS keyword, company, location, "
                                "CAST(NULL AS VARCHAR) AS work_type, salary, tags, CAST(NULL AS VARCHAR) AS posted FROM listings",
    "flatten_envelope": ctes(DATED) + f"SELECT {LISTING}, batch_date FROM listings",
    "tags_to_json": ctes(RAW) + "SELECT url, title, tags FROM listings",
    "silver_projection": ctes(RAW, *posted(dialect="accented", trim_keys=True)) + f"SELECT {SILVER} FROM posted",
    "batch_stamp": ctes(RAW) + f"SELECT source, url, '{REPORT_DATE}' AS batch_date, DATE '{REPORT_DATE}' AS report_date FROM listings",
    "has_salary_flag": ctes(RAW, *posted()) + "SELECT url, salary_raw, min_salary, max_salary, "
                                              "(min_salary IS NOT NULL OR max_salary IS NOT NULL) AS has_salary FROM posted",
    "search_text": ctes(RAW) + f"SELECT title, tags, {search('title', 'tags')} AS search_text FROM listings",
    "drop_helper_columns": ctes(RAW) + "SELECT * EXCLUDE (source) FROM listings",
    # filters
    "clean_rows": ctes(RAW) + f"SELECT * FROM listings WHERE {CLEAN}",
    "dirty_rows": ctes(RAW) + f"SELECT * FROM listings WHERE NOT coalesce({CLEAN}, false)",
    "nonblank_keys": ctes(RAW) + "SELECT * FROM listings WHERE trim(title, ' ') <> '' AND trim(url, ' ') <> ''",
    "source_filter": ctes(RAW) + "SELECT * FROM listings WHERE source = 'itviec'",
    "salary_present": ctes(RAW, *posted()) + union(
        "SELECT salary_raw, count(*) AS n, 'either_end' AS form FROM posted WHERE min_salary IS NOT NULL OR max_salary IS NOT NULL GROUP BY salary_raw",
        "SELECT salary_raw, count(*), 'lower_end' FROM posted WHERE min_salary IS NOT NULL GROUP BY salary_raw",
    ),
    "company_present": ctes(RAW) + "SELECT CASE WHEN keyword = 'big-data' THEN '' ELSE company END AS company, count(*) AS n "
                                   "FROM listings WHERE keyword = 'big-data' OR company IS NOT NULL GROUP BY 1",
    "high_salary": ctes(RAW, *posted()) + f"SELECT title, url, min_salary, max_salary, currency FROM posted WHERE {HIGH}",
    "report_date_is": ctes(DATED) + f"SELECT title, url, CAST(batch_date AS DATE) AS report_date FROM listings WHERE batch_date = '{BATCH}'",
    # joins
    "merge_equi_join": ctes(RAW) + (
        "SELECT s_name, s_nationkey, coalesce(n, 0) AS jobs FROM supplier LEFT JOIN "
        "(SELECT company, count(*) AS n FROM listings WHERE company IS NOT NULL GROUP BY company) ON company = s_name"
    ),
    "latest_report_rows": ctes(*DAYS) + "SELECT title, url, salary_raw, report_date FROM days WHERE report_date = (SELECT max(report_date) FROM days)",
    "payload_dedupe_decision": ctes(*BATCH_SUMS) + f"SELECT i.event_type, i.day, i.record_count, {decision('CONFLICT')} AS status {DECIDED}",
    "payload_dedupe_new_versions": ctes(*BATCH_SUMS) + f"SELECT i.event_type, {decision('UPLOADED')} AS status, count(*) AS batches {DECIDED} GROUP BY 1, 2",
    # aggregates
    "count_distinct": ctes(RAW) + "SELECT " + ", ".join(f"count(DISTINCT {c}) AS n_{c}" for c in ("url", "company", "source", "location")) + " FROM listings",
    "count_distinct_pair": ctes(RAW) + "SELECT keyword, count(DISTINCT (source, url)) FILTER (WHERE source IS NOT NULL AND url IS NOT NULL) AS pairs "
                                       "FROM listings GROUP BY keyword",
    "count_column": ctes(RAW) + "SELECT source, count(url) AS urls, count(title) AS titles FROM listings GROUP BY source",
    "conditional_count": ctes(RAW, *posted()) + "SELECT source, location_std, count(*) FILTER (WHERE min_salary IS NOT NULL OR max_salary IS NOT NULL) "
                                                "AS jobs_with_salary, count(DISTINCT url) AS urls FROM posted GROUP BY source, location_std",
    "rounded_avg": ctes(RAW, *posted()) + "SELECT source, currency, round(avg(min_salary), 2) AS avg_min_salary, "
                                          "round(avg(max_salary), 2) AS avg_max_salary FROM posted GROUP BY source, currency",
    "max_value": ctes(RAW, *posted()) + "SELECT location_std, currency, max(max_salary) AS highest_salary FROM posted GROUP BY location_std, currency",
    "row_and_sum_totals": ctes(*READY) + f"SELECT count(*) AS cnt, CAST(coalesce(sum(total_jobs), 0) AS BIGINT) AS total_jobs, "
                                         f"CAST(0 AS BIGINT) AS no_jobs FROM ({MARTS['summary']})",
    "source_counts": ctes(RAW) + "SELECT source, count(*) AS row_count FROM listings GROUP BY source",
    # marts
    "mart_job_market_overview": ctes(*READY) + MARTS["overview"],
    "mart_source_performance": ctes(*READY) + MARTS["sources"],
    "mart_salary_by_location": ctes(*READY) + MARTS["by_location"],
    "mart_company_hiring_trend": ctes(*READY) + MARTS["companies"],
    "mart_skill_demand": ctes(*READY, _skills()) + skill_mart(),
    "mart_high_salary_alerts": ctes(*READY) + MARTS["alerts"],
    "mart_pipeline_health": ctes(*LOCAL) + MARTS["health"],
    "overview_cloud": ctes(*READY_CLOUD) + MARTS["overview_pairs"],
    "source_performance_cloud": ctes(*READY_CLOUD) + MARTS["sources"],
    "location_summary_cloud": ctes(*READY_CLOUD) + MARTS["locations"],
    "legacy_itviec_jobs": ctes(*READY) + MARTS["jobs"],
    "legacy_market_summary": ctes(*READY) + MARTS["summary"],
    "legacy_source_stats": ctes(*READY) + MARTS["stats"],
    "legacy_daily_alerts": ctes(*READY) + MARTS["daily"],
    # dedupe
    "dedupe_best_by_url": ctes(*LOCAL) + "SELECT * FROM silver",
    "dedupe_best_by_source_url": ctes(*CLOUD) + "SELECT * FROM silver",
    "dedupe_first_seen": ctes(DATED) + (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(url, ''), title) "
        "ORDER BY crawl_order, crawl_line, " + ", ".join(
            f"{c} ASC NULLS FIRST"
            for c in ("source", "keyword", "title", "url", "company", "location", "work_type", "salary", "tags", "posted", "batch_date")
        ) + ") AS rn FROM listings) WHERE rn = 1"
    ),
    "dedupe_dearest_order": "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
                           "ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1",
    # top-k and sets
    "latest_listings": ctes(*SERVING_JOBS) + top("jobs", "report_date DESC NULLS LAST, url ASC NULLS FIRST", JOBS_COLUMNS, 5),
    "listings_by_keyword": ctes(*SERVING_JOBS) + (
        f"SELECT *, 'keyword' AS mode FROM ({top('jobs WHERE keyword = ' + repr('big-data'), 'report_date DESC NULLS LAST, url ASC NULLS FIRST', JOBS_COLUMNS, 7)})"
        f" UNION ALL SELECT *, 'any' FROM ({top('jobs', 'report_date DESC NULLS LAST, url ASC NULLS FIRST', JOBS_COLUMNS, 7)})"
    ),
    "top_salary_alerts": ctes(*DAYS, ("ready", "SELECT * FROM days"), ("alerts", MARTS["daily"])) + top(
        "alerts WHERE report_date = (SELECT max(report_date) FROM alerts)", "min_salary DESC NULLS LAST",
        "title, min_salary, max_salary, currency, source, url, location_std", 5,
    ),
    "source_ranking": ctes(*DAYS, ("ready", "SELECT * FROM days"), ("stats", MARTS["stats"])) +
                      "SELECT source, jobs_count FROM stats WHERE report_date = (SELECT max(report_date) FROM stats)",
    "market_report": ctes(*READY) + f"SELECT location_std, currency, avg_min_salary, avg_max_salary, total_jobs FROM ({MARTS['summary']})",
    "alert_gate": ctes(*DAYS, ("ready", "SELECT * FROM days")) + (
        f"SELECT alert_count, total_jobs, CASE WHEN alert_count > 0 THEN 'notify' ELSE 'skip' END AS branch FROM "
        f"(SELECT count(*) AS alert_count FROM ({MARTS['daily']}) WHERE report_date = DATE '{BATCH}'), "
        f"(SELECT CAST(coalesce(sum(total_jobs), 0) AS BIGINT) AS total_jobs FROM ({MARTS['summary']}) WHERE report_date = DATE '{BATCH}')"
    ),
    "table_inventory": union(*[
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
                  "pages", "benchmark", "labels", "conversations")
    ]),
    "top_lineitems": top("lineitem", "l_extendedprice DESC NULLS LAST", "l_orderkey, l_linenumber, l_extendedprice", 10),
    "union_by_name": ctes(RAW) + "SELECT url, source, title FROM listings UNION ALL "
                                 "SELECT url, source, title FROM listings WHERE source = 'itviec' AND url IS NULL",
    "sample_distinct": ctes(RAW) + f"SELECT DISTINCT url FROM listings WHERE NOT coalesce({CLEAN}, false) ORDER BY url ASC NULLS FIRST LIMIT 5",
    # salary
    "salary_currency": ctes(*TEXTS) + f"SELECT {TEXT_KEY}, {posted_currency(lower_text('salary'))} AS currency, count(*) AS n FROM texts GROUP BY 1, 2",
    "salary_multiplier": ctes(*TEXTS) + (
        f"SELECT {TEXT_KEY}, {posted_multiplier(lower_text('salary'), posted_currency(lower_text('salary')))} AS multiplier, count(*) AS n "
        "FROM texts GROUP BY 1, 2"
    ),
    "salary_numbers": ctes(*TEXTS) + (
        f"SELECT {TEXT_KEY}, CAST({posted_number(lower_text('salary'))} AS DOUBLE) AS first, "
        f"CAST({posted_number(lower_text('salary'), _AFTER_DASH)} AS DOUBLE) AS second, count(*) AS n FROM texts GROUP BY 1, 2, 3"
    ),
    "salary_range": ctes(*TEXTS, ("placed", "SELECT salary, '' AS title, '' AS url, '' AS location FROM texts"), *posted("placed")) +
                    f"SELECT {TEXT_KEY}, min_salary, max_salary, currency, count(*) AS n FROM posted GROUP BY 1, 2, 3, 4",
    "salary_parse_normalized": ctes(*TEXTS, *folded_salary("texts")) +
                               f"SELECT {TEXT_KEY}, min_salary, max_salary, currency, count(*) AS n FROM folded GROUP BY 1, 2, 3, 4",
    "salary_number_token": ctes(*TEXTS, ("tokens", "SELECT unnest(regexp_extract_all(salary, '[0-9]+(?:[,.][0-9]+)*')) AS t FROM texts")) +
                           f"SELECT t AS token, TRY_CAST({_ACCENT_FREE_TOKEN} AS DOUBLE) AS value, count(*) AS n FROM tokens GROUP BY 1, 2",
    "salary_range_valid": ctes(*REVERSED) + "SELECT salary, coalesce(min_salary >= 0, true) AND coalesce(max_salary >= 0, true) "
                                            "AND coalesce(min_salary <= max_salary, true) AS range_valid, count(*) AS n FROM posted GROUP BY 1, 2",
    # location, title, text
    **{
        f"location_std_{d}": ctes(*PLACES) + f"SELECT md5(coalesce(location, 'missing')) AS text_md5, {location('location', d)} AS location_std, "
                                             "count(*) AS n FROM places GROUP BY 1, 2"
        for d in ("ascii", "accented", "folded")
    },
    "ascii_fold": ctes(RAW, ("texts", f"SELECT lang, {fold('text')} AS folded FROM documents UNION ALL SELECT 'place', {fold('location')} FROM listings")) +
                  "SELECT lang, md5(folded) AS folded_md5, CAST(length(folded) AS INTEGER) AS chars, count(*) AS n FROM texts GROUP BY 1, 2, 3",
    "ascii_fold_compat": ctes(("texts", f"SELECT doc_id, {fold('text')} AS folded FROM documents")) +
                         "SELECT doc_id, md5(folded) AS folded_md5, CAST(length(folded) AS INTEGER) AS chars FROM texts",
    "title_clean": ctes(RAW, ("texts", "SELECT title AS text FROM listings UNION ALL SELECT text FROM documents"),
                        ("cleaned", f"SELECT trim(regexp_replace(coalesce(text, ''), '{_BLANK}+', ' ', 'g'), ' ') AS cleaned FROM texts")) +
                   "SELECT md5(cleaned) AS cleaned_md5, CAST(length(cleaned) AS INTEGER) AS chars, count(*) AS n FROM cleaned GROUP BY 1, 2",
    "skill_match": ctes(RAW, _skills(), SEARCHED) + "SELECT skill, url, CAST(sum(k) AS BIGINT) AS n FROM searched JOIN skills ON contains(st, needle) GROUP BY skill, url",
    "skill_match_words": ctes(RAW, _skills(), SEARCHED) + "SELECT skill, url, CAST(sum(k) AS BIGINT) AS n FROM searched JOIN skills ON regexp_matches(st, pattern) GROUP BY skill, url",
    "tags_decode_top6": ctes(RAW, ("mixed", "SELECT tags FROM listings UNION ALL SELECT concat_ws(', ', keyword, title, ' ', location, work_type, "
                                            "posted, company, source) FROM listings")) + (
        "SELECT tags, array_to_string(list_slice(CASE WHEN tags LIKE '[%' THEN CAST(json_extract_string(tags, '$[*]') AS VARCHAR[]) "
        "ELSE list_filter(list_transform(string_split(tags, ','), lambda x: trim(x, ' ')), lambda x: x <> '') END, 1, 6), '|') AS shown, "
        "count(*) AS n FROM mixed GROUP BY 1, 2"
    ),
    "salary_display": ctes(RAW) + "SELECT url, salary, CASE WHEN salary IS NULL OR salary IN ('Login to view', 'Negotiable', 'Hidden', '') "
                                  "THEN '🔒 You''ll love it' ELSE salary END AS shown FROM listings",
    "salary_range_display": ctes(RAW, *posted()) + (
        "SELECT url, salary_raw, CASE WHEN coalesce(max_salary, 0) > 0 AND coalesce(max_salary, 0) <> coalesce(min_salary, 0) "
        f"THEN {money('min_salary')} || ' - ' || {money('max_salary')} || ' ' || currency ELSE 'Từ ' || {money('min_salary')} || ' ' || currency END "
        "AS shown FROM posted"
    ),
    "location_report_line": ctes(*READY) + (
        "SELECT location_std, currency, CASE WHEN location_std = 'Ho Chi Minh' THEN '🏙️' WHEN location_std = 'Ha Noi' THEN '🏯' ELSE '📍' END "
        "|| ' **' || location_std || '** (' || currency || ')' || chr(10) || ' • Số job tuyển: **' || CAST(total_jobs AS VARCHAR) || '**' || chr(10) "
        f"|| ' • Lương TB (Min): **' || {money('floor(avg_min_salary)')} || '**' || chr(10) || ' • Lương TB (Max): **' "
        f"|| {money('floor(avg_max_salary)')} || '**' || chr(10) AS line FROM ({MARTS['summary']})"
    ),
    # quality
    "expect_not_null": ctes(RAW) + union(*SUITE[:3]),
    "expect_regex_mostly": ctes(RAW) + SUITE[3],
    "expect_length_mostly": ctes(RAW) + SUITE[4],
    "expectation_suite": ctes(RAW) + f"SELECT bool_and(passed) AS success FROM ({union(*SUITE)})",
    "clean_dirty_summary": ctes(RAW) + (
        "SELECT total, clean, total - clean AS dirty, round(100 * CAST(clean AS DOUBLE) / total, 1) AS clean_pct, "
        "round(100 * CAST(total - clean AS DOUBLE) / total, 1) AS dirty_pct "
        f"FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {CLEAN}) AS clean FROM listings)"
    ),
    "expect_in_set": ctes(RAW, *folded_salary("listings")) + union(
        rule("in_set", "source", "folded", "count(source)", "count(*) FILTER (WHERE source NOT IN ('itviec', 'topcv'))"),
        rule("in_set", "currency", "folded", "count(currency)", "count(*) FILTER (WHERE currency NOT IN ('USD', 'VND', 'UNKNOWN'))"),
        rule("in_set", "currency", "folded", "count(currency)", "count(*) FILTER (WHERE currency NOT IN ('USD', 'VND'))"),
    ),
    "expect_unique": ctes(*READY) + union(
        f"SELECT *, 'raw' AS stage FROM ({rule('unique', 'url', 'listings', 'count(url)', 'count(url) - count(DISTINCT url)')})",
        f"SELECT *, 'silver' FROM ({rule('unique', 'url', 'silver', 'count(url)', 'count(url) - count(DISTINCT url)')})",
    ),
    "expect_pair_ordered": ctes(*REVERSED) + union(
        rule("pair_ordered", "min_salary,max_salary", "posted", "count(*) FILTER (WHERE min_salary IS NOT NULL AND max_salary IS NOT NULL)",
             "count(*) FILTER (WHERE max_salary < min_salary)"),
        rule("at_least", "min_salary", "posted", "count(min_salary)", "count(*) FILTER (WHERE min_salary < 0)"),
        rule("at_least", "max_salary", "posted", "count(max_salary)", "count(*) FILTER (WHERE max_salary < 0)"),
    ),
    "quality_metrics": ctes(RAW) + (
        f"SELECT count(*) AS total_records, count(*) FILTER (WHERE {CLEAN}) AS valid_records, "
        f"count(*) FILTER (WHERE NOT coalesce({CLEAN}, false)) AS invalid_records, count(url) - count(DISTINCT url) AS duplicate_url_count, "
        "count(*) FILTER (WHERE coalesce(trim(title, ' '), '') = '') AS missing_title_count, "
        "count(*) FILTER (WHERE coalesce(trim(company, ' '), '') = '') AS missing_company_count, "
        "count(*) FILTER (WHERE coalesce(trim(salary, ' '), '') = '') AS missing_salary_count, "
        f"CAST(count(*) FILTER (WHERE {CLEAN}) AS DOUBLE) / count(*) AS quality_score FROM listings"
    ),
    "gold_checks": ctes(*READY) + union(
        f"SELECT 'overview_total_jobs_positive' AS \"check\", count(*) AS checked, count(*) FILTER (WHERE total_jobs <= 0) AS failed, "
        f"bool_and(total_jobs > 0) AS passed FROM ({MARTS['overview']})",
        f"SELECT 'source_job_count_positive', count(*), count(*) FILTER (WHERE job_count <= 0), bool_and(job_count > 0) FROM ({MARTS['sources']})",
        f"SELECT 'alert_thresholds_hold', count(*), count(*) FILTER (WHERE NOT {HIGH}), coalesce(bool_and{HIGH}, true) FROM ({MARTS['alerts']})",
        f"SELECT 'run_status_known', count(*), count(*) FILTER (WHERE status NOT IN ('success', 'failed')), "
        f"bool_and(status IN ('success', 'failed')) FROM ({MARTS['health']})",
    ),
    "required_columns_gate": ctes(*CLOUD) + "SELECT source, count(*) AS row_count FROM silver GROUP BY source",
    "nonempty_gate": ctes(RAW) + f"SELECT source, count(*) AS row_count FROM listings WHERE {CLEAN} GROUP BY source",
    "expected_sources_gate": ctes(RAW) + (
        "SELECT w.source, count(l.source) AS row_count, count(l.source) > 0 AS present "
        "FROM (VALUES ('itviec'), ('topcv'), ('vietnamworks')) w(source) LEFT JOIN listings l ON w.source = l.source GROUP BY w.source"
    ),
    "row_reconciliation": ctes(*CLOUD) + (
        "SELECT rows_before, rows_after, rows_before = rows_after AS matches FROM (SELECT count(*) AS rows_before, "
        "count(DISTINCT (source, url)) FILTER (WHERE source IS NOT NULL AND url IS NOT NULL) AS rows_after FROM silver)"
    ),
    "removed_rows_metric": ctes(*CLOUD) + "SELECT a AS rows_in, b AS rows_out, a - b AS rows_removed FROM "
                                          "(SELECT count(*) AS a FROM listings), (SELECT count(*) AS b FROM silver)",
    # pages and payloads
    "page_outcome": ctes(*PAGES) + f"SELECT page_id, variant, card_count, link_count, page_title, {OUTCOME} AS outcome FROM full_text",
    "parse_outcome": ctes(*LINKS, ("useful", "SELECT page_id, count(*) AS records FROM links GROUP BY page_id")) + (
        "SELECT p.page_id, coalesce(records, 0) AS records, CASE WHEN coalesce(records, 0) > 0 THEN NULL "
        "WHEN contains(html, '<h1>') THEN 'parser_drift' ELSE 'other' END AS failure FROM pages p LEFT JOIN useful u ON p.page_id = u.page_id"
    ),
    "page_link_counts": "SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS cards, "
                        "CAST(len(regexp_extract_all(html, '<a href=\"/')) AS INTEGER) AS links FROM pages",
    "url_canonical": "SELECT page_id, split_part(url, '?', 1) AS url, 'https://jobs.example.test' || "
                     "split_part(regexp_replace(url, '^https?://[^/]*', ''), '?', 1) AS hosted FROM pages",
    "ordered_unique_tags": ctes(RAW, ("numbered", "SELECT row_number() OVER () AS rid, string_split(concat_ws(',', keyword, title, '  ', work_type, "
                                                  "keyword, location, title), ',') AS tags FROM listings"),
                                ("each_tag", "SELECT rid, trim(unnest(tags), ' ') AS tag, generate_subscripts(tags, 1) AS pos FROM numbered"),
                                ("firsts", "SELECT rid, tag, min(pos) AS pos FROM each_tag WHERE tag <> '' GROUP BY rid, tag")) +
                           "SELECT string_agg(tag, '|' ORDER BY pos) AS tags FROM firsts GROUP BY rid",
    "work_type_whitelist": ctes(RAW, ("either", "SELECT work_type FROM listings UNION ALL SELECT keyword FROM listings")) +
                           "SELECT work_type, CASE WHEN work_type IN ('At office', 'Remote', 'Hybrid', 'At Office') THEN work_type ELSE '' END AS known, "
                           "count(*) AS n FROM either GROUP BY 1, 2",
    "salary_placeholder": ctes(RAW, ("spaced", "SELECT CASE WHEN posted = 'Posted 1 days ago' THEN 'Sign In  to view' || chr(10) || 'salary' "
                                               "ELSE replace(salary, ' ', chr(10) || ' ') END AS salary FROM listings")) + (
        "SELECT CASE WHEN salary IS NULL THEN 'Negotiable' WHEN contains(lower(salary), 'sign in') THEN 'Login to view' ELSE salary END AS first_site, "
        r"CASE WHEN salary IS NULL THEN 'Thoả thuận' ELSE regexp_replace(salary, '\s+', ' ', 'g') END AS second_site, "
        "count(*) AS n FROM spaced GROUP BY 1, 2"
    ),
    "payload_contract": ctes(*BROKEN) + (
        "SELECT event_type, day, count(*) AS record_count, CAST(sum(strlen(payload)) AS BIGINT) AS payload_bytes, "
        "count(*) FILTER (WHERE verdict <> 'ok') AS bad_records, CASE "
        "WHEN count(*) FILTER (WHERE verdict <> 'ok') > 0 THEN 'bad_record' ELSE 'ok' END AS verdict FROM broken GROUP BY event_type, day"
    ),
    "payload_record_verdicts": ctes(*BROKEN) + "SELECT event_id, verdict FROM broken",
    "payload_file_contract": (
        "WITH files AS (SELECT CAST(event_id AS VARCHAR) AS path, event_type, CASE event_type WHEN 'error' THEN '[' || props || ', {}]' "
        "WHEN 'click' THEN props WHEN 'purchase' THEN '[' || props WHEN 'view' THEN '[' || props || ', {\"a\": [{\"Pass-word\": 1, \"COOKIES\": 2}]}]' "
        "ELSE '[' || props || ', ' || props || ']' END AS content FROM events) "
        "SELECT path, strlen(content) AS length, sha256(content) AS content_hash, "
        "CASE WHEN event_type NOT IN ('click', 'purchase') THEN 2 END AS record_count, "
        "CASE event_type WHEN 'error' THEN 'bad_record' WHEN 'click' THEN 'not_array' WHEN 'purchase' THEN 'invalid_json' "
        "WHEN 'view' THEN 'sensitive_key' ELSE 'ok' END AS verdict FROM files"
    ),
    "sensitive_key_scan": (
        "SELECT event_id, CASE event_type WHEN 'error' THEN 'Session-Token' ELSE 'Authorization,cookie' END AS keys, "
        "CASE event_type WHEN 'error' THEN '$.meta[1].Session-Token' ELSE '$.Authorization' END AS key_path "
        "FROM events WHERE event_type IN ('error', 'click')"
    ),
    "payload_key_inventory": ctes(("held", "SELECT unnest(CASE event_type WHEN 'error' THEN ['meta', 'Session-Token', 'inner', 'k'] "
                                          "WHEN 'purchase' THEN ['note', 'p', 'k'] WHEN 'click' THEN ['Authorization', 'a', 'cookie', 'p', 'k'] "
                                          "ELSE ['k'] END) AS key FROM events")) +
                             "SELECT key, count(*) AS records, key IN ('Session-Token', 'Authorization', 'cookie') AS sensitive FROM held GROUP BY key",
    "canonical_checksum": ctes(*BATCH_SUMS) + "SELECT event_type, day, record_count, checksum FROM incoming",
    "batch_date_valid": ctes(*DATES) + r"SELECT o_orderkey, value, coalesce(regexp_full_match(value, '\d{4}-\d{2}-\d{2}') "
                                       "AND TRY_CAST(value AS DATE) IS NOT NULL, false) AS valid FROM dates",
    "resolve_batch_date": ctes(*DATES) + "SELECT o_orderkey, coalesce(value, CASE WHEN o_orderstatus <> 'P' THEN day END) AS batch_date, "
                                         "(value IS NOT NULL OR o_orderstatus <> 'P') AS accepted FROM dates",
    "object_key": ctes(DATED) + "SELECT 'raw/source=' || source || '/batch_date=' || batch_date || '/' || source || '_jobs.json' AS object_key, "
                                "source || '/' || batch_date || '/' || source || '_jobs.json' AS plain_key, count(*) AS records "
                                "FROM listings GROUP BY source, batch_date",
    # streaming and whole jobs
    "incremental_silver": ctes(*STREAMED) + "SELECT * FROM late UNION ALL SELECT * FROM early e "
                                            "WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.source = e.source AND l.url = e.url)",
    "silver_local_crawls": ctes(
        DATED, *[part for name, condition in (("early", f"batch_date < '{BATCH}'"), ("late", f"batch_date >= '{BATCH}'")) for part in (
            (f"{name}_raw", f"SELECT * FROM listings WHERE {condition}"), *posted(f"{name}_raw", f"{name}_p"), best(f"{name}_p", "url", name))]
    ) + "SELECT url, title, salary_raw, max_salary, location_std FROM (SELECT * FROM late UNION ALL SELECT * FROM early "
        "WHERE url NOT IN (SELECT url FROM late WHERE url IS NOT NULL)) WHERE url IS NOT NULL",
    "distinct_sketches": ctes(DATED, ("days", "SELECT DISTINCT batch_date FROM listings")) + (
        "SELECT d.batch_date, count(*) AS row_count, count(DISTINCT url) AS urls, count(DISTINCT company) AS companies, "
        "count(DISTINCT (source, url)) FILTER (WHERE url IS NOT NULL) AS jobs, true AS urls_close, true AS companies_close, true AS jobs_close "
        "FROM days d JOIN listings l ON l.batch_date <= d.batch_date GROUP BY d.batch_date"
    ),
    "incremental_quarantine": ctes(RAW) + (
        "SELECT source, concat_ws(',', CASE WHEN title IS NULL THEN 'title_missing' END, CASE WHEN url IS NULL THEN 'url_missing' END, "
        "CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'url_not_http' END) AS reasons, count(*) AS n "
        f"FROM listings WHERE NOT coalesce({CLEAN}, false) GROUP BY 1, 2"
    ),
    "landing_job": (
        "WITH days AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS n, count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE ts < '2024-01-15') AS early FROM events) "
        "SELECT 1 AS run, early AS copied, 0 AS skipped, 0 AS failed, NULL AS stored FROM days "
        "UNION ALL SELECT 2, n - early, early, 0, NULL FROM days UNION ALL SELECT 3, 0, n, 0, n FROM days"
    ),
    "silver_local": ctes(*LOCAL) + "SELECT * FROM silver",
    # a listing without a url never matches and is there once more after the second run
    "silver_local_table": ctes(*LOCAL) + "SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE url IS NULL",
    "silver_cloud": ctes(*CLOUD) + f"SELECT *, '{BATCH}' AS batch_date FROM silver",
    "gold_local": ctes(*READY, _skills()) + _gold_rows(),
    "gold_cloud": ctes(*CLOUD, prepared(BATCH)) + MARTS["locations"],
    "bronze_validate": ctes(RAW) + f"SELECT CASE WHEN coalesce({CLEAN}, false) THEN 'clean' ELSE 'dirty' END AS verdict, {LISTING} FROM listings",
    "bronze_rule_results": ctes(RAW) + union(*SUITE),
}

# the same results by other ways: through folders, buckets and footers
ORACLE |= {
    "latest_report_partition": ORACLE["latest_report_rows"],
    "keyed_upsert_buckets": ORACLE["keyed_upsert"],
    "table_inventory_footers": ORACLE["table_inventory"],
}
