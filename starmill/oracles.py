"""Checking SQL for the registered queries, for a different engine over the same tables.

Written apart from the Spark plans: window filters, CASE chains and one regex per term, over
whole tables.  Its regex engine has no lookarounds, so word edges are spelled as neighbours.
"""

from __future__ import annotations

import re

from starmill import fixtures, rules

ORACLES: dict[str, str] = {}

WS = (
    r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]"
)
W = r"[\pL\pN_]"
LEFT = r"(?:^|[^\pL\pN_])"
RIGHT = r"(?:$|[^\pL\pN_])"

RAW = fixtures.raw_jobs_sql()
LANDING = fixtures.landing_sql()


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def filled(x: str) -> str:
    return f"({x} IS NOT NULL AND {strip(x)} <> '')"


def items(x: str) -> str:
    split = f"string_split({x}, ',')"
    return f"list_filter(list_transform({split}, lambda s: {strip('s')}), lambda s: s <> '')"


def distinct_items(x: str) -> str:
    inner = items(x)
    return f"list_filter({inner}, lambda s, i: list_position({inner}, s) = i)"


def shown(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def shown_date(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


# --- one rule each ---------------------------------------------------------------------


def token_null(x: str) -> str:
    return f"CASE WHEN {x} IN {in_list(rules.NULL_TOKENS)} THEN NULL ELSE {x} END"


def employment(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in rules.EMPLOYMENT_TYPES.items())
    return f"CASE lower({x}) {whens} ELSE lower({x}) END"


def company(x: str) -> str:
    titled = (
        f"array_to_string(list_transform(regexp_extract_all({x}, '[a-zA-Z]+|[^a-zA-Z]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )
    return f"CASE WHEN {x} = lower({x}) AND regexp_matches({x}, '[a-z]') THEN {titled} ELSE {x} END"


def html_text(x: str) -> str:
    for entity, char in [
        ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&middot;?", "·"), ("&copy;?", "©"),
        ("&amp;?", "&"),
    ]:
        x = f"regexp_replace({x}, '{entity}', '{char}', 'g')"
    return f"nullif({squeeze(f'''regexp_replace({x}, '<[^>]+>', ' ', 'g')''')}, '')"


def clean_list(x: str) -> str:
    return f"nullif(array_to_string({distinct_items(x)}, ', '), '')"


def fetched(x: str) -> str:
    shape = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
    return f"CASE WHEN regexp_full_match({x}, '{shape}') THEN try_cast({x} AS TIMESTAMP) END"


def posted(value: str, at: str) -> str:
    t = f"translate({strip(value)}, '٠١٢٣٤٥٦٧٨٩', '0123456789')"
    whens = [
        f"WHEN {value} IS NULL OR {at} IS NULL THEN NULL",
        f"WHEN {t} IN ('الآن', 'اليوم', 'قبل قليل') THEN {at}",
        f"WHEN {t} IN ('أمس', 'امس', 'قبل يوم', 'قبل يوم واحد') THEN {at} - INTERVAL 1 DAY",
        f"WHEN {t} = 'قبل يومين' THEN {at} - INTERVAL 2 DAY",
    ]
    for words, step in [
        ("دقيقة|دقائق", "to_minutes"), ("ساعة|ساعات", "to_hours"), ("يوم|أيام|ايام", "to_days"),
    ]:
        p = rf"قبل{WS}+(\d+){WS}+(?:{words})"
        whens.append(
            f"WHEN regexp_matches({t}, '{p}') THEN {at} - {step}(CAST(regexp_extract({t}, '{p}', 1) AS INTEGER))"
        )
    p = rf"قبل{WS}+(\d+){WS}+(?:أسبوع|اسبوع|أسابيع|اسابيع)"
    whens += [
        f"WHEN {t} IN ('قبل أسبوع', 'قبل اسبوع') THEN {at} - INTERVAL 7 DAY",
        f"WHEN {t} IN ('قبل أسبوعين', 'قبل اسبوعين') THEN {at} - INTERVAL 14 DAY",
        f"WHEN regexp_matches({t}, '{p}') THEN {at} - to_days(7 * CAST(regexp_extract({t}, '{p}', 1) AS INTEGER))",
        rf"WHEN regexp_matches({t}, '^\d{{4}}-\d{{2}}-\d{{2}}') THEN try_cast({t} AS TIMESTAMP)",
    ]
    return "CASE " + " ".join(whens) + " END"


TITLE_PATTERNS = [
    ("intern(?:ship)?", "Intern"),
    (f"senior{WS}+lead", "Senior Lead"),
    ("principal", "Principal"),
    ("(?:senior|sr)", "Senior"),
    ("(?:lead|team lead|leader)", "Lead"),
    ("(?:manager|manger)", "Manager"),
    ("director", "Director"),
    ("(?:junior|jr|entry[- ]level)", "Junior"),
]
YEARS_PATTERNS = [
    rf"{LEFT}(\d+){WS}*(?:-|to){WS}*\d+{WS}*years?",
    rf"{LEFT}(\d+){WS}*\+{WS}*years?",
    rf"{LEFT}(?:minimum|at least){WS}+(\d+){WS}*years?",
    rf"{LEFT}(\d+){WS}*years?{WS}+(?:of{WS}+)?experience{RIGHT}",
]


def years(description: str) -> str:
    low = f"lower(coalesce({description}, ''))"
    tries = ", ".join(f"nullif(regexp_extract({low}, '{p}', 1), '')" for p in YEARS_PATTERNS)
    digits = f"coalesce({tries})"
    return f"CASE WHEN {digits} IS NOT NULL THEN try_cast({digits} AS BIGINT) END"


def years_level(y: str) -> str:
    return (
        f"CASE WHEN {y} IS NULL THEN NULL WHEN {y} <= 2 THEN 'Junior' "
        f"WHEN {y} <= 5 THEN 'Mid Level' ELSE 'Senior' END"
    )


def level(current: str, title: str, description: str) -> str:
    low = f"lower(coalesce({title}, ''))"
    whens = " ".join(
        f"WHEN regexp_matches({low}, '{LEFT}{p}{RIGHT}') THEN {q(name)}"
        for p, name in TITLE_PATTERNS
    )
    return (
        f"CASE WHEN {current} IN {in_list(rules.LEVELS)} THEN {current} {whens} "
        f"ELSE {years_level(years(description))} END"
    )


def city(current: str, *texts: str) -> str:
    text = " || ' ' || ".join(f"coalesce({t}, '')" for t in texts)
    whens = " ".join(
        f"WHEN regexp_matches({text}, '(?i){LEFT}{re.escape(name)}{RIGHT}') THEN {q(name)}"
        for name in rules.CITIES
    )
    return f"CASE WHEN {current} IS NOT NULL THEN {current} {whens} END"


def remote(a: str, b: str) -> str:
    return (
        f"regexp_matches(lower(coalesce({a}, '') || ' ' || coalesce({b}, '')), "
        f"'{LEFT}remote{RIGHT}')"
    )


def terms(text: str, strict: bool = True) -> str:
    low = f"lower(coalesce({text}, ''))"
    cases = []
    for term in rules.SKILL_TERMS:
        right = W if strict and term[-1] in "+#" else RIGHT
        cases.append(
            f"CASE WHEN regexp_matches({low}, '{LEFT}{re.escape(term.lower())}{right}') "
            f"THEN {q(term)} END"
        )
    return (
        f"coalesce(nullif(array_to_string(list_filter([{', '.join(cases)}], "
        "lambda x: x IS NOT NULL), ', '), ''), 'N/A')"
    )


# --- chains of named steps -------------------------------------------------------------


def columns(exprs: dict[str, str], names: list[str]) -> str:
    return ", ".join(f"{exprs[n]} AS {n}" if n in exprs else n for n in names)


RAW_NAMES = ["ingest_seq", *rules.BRONZE_COLUMNS]
MERGED_NAMES = ["ingest_unlinked", "ingest_run", *RAW_NAMES]


def tokens_step(source: str, names: list[str] = RAW_NAMES) -> str:
    exprs = {c: token_null(c) for c in rules.BRONZE_COLUMNS}
    return f"SELECT {columns(exprs, names)} FROM {source}"


def squeeze_step(source: str, names: list[str] = RAW_NAMES) -> str:
    return f"SELECT {columns({c: squeeze(c) for c in rules.TEXT_COLUMNS}, names)} FROM {source}"


def values_step(source: str, names: list[str] = RAW_NAMES) -> str:
    exprs = {
        "employment_type": employment("employment_type"),
        "company": company("company"),
        "skills": clean_list("skills"),
        "description": html_text("description"),
    }
    return f"SELECT {columns(exprs, names)} FROM {source}"


def dedup_step(source: str, order: str = "ingest_seq") -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY job_title, company, location ORDER BY {order}) = 1"
    )


def silver_steps(source: str, p: str, names: list[str] = RAW_NAMES) -> str:
    """CTEs from ``source`` to ``{p}silver``; ``{p}values`` holds the rows before the rules."""
    typed = columns({"fetched_at": fetched("fetched_at")}, names)
    order = ", ".join(n for n in names if n.startswith("ingest_"))
    ruled = (
        f"SELECT {order}, source, job_title, company, "
        f"{city('city', 'location', 'job_title', 'description')} AS city, location, "
        "employment_type, skills, "
        f"{level('experience_level', 'job_title', 'description')} AS experience_level, "
        f"apply_link, {posted('posted_at', 'fetched_at')} AS posted_at, fetched_at, description, "
        f"{remote('job_title', 'description')} AS is_remote, salary IS NOT NULL AS has_salary "
        f"FROM {p}typed"
    )
    parts = (
        "SELECT *, CAST(posted_at AS DATE) AS posted_date, "
        "CAST(year(posted_at) AS BIGINT) AS posted_year, "
        "CAST(month(posted_at) AS BIGINT) AS posted_month, "
        f"CAST(day(posted_at) AS BIGINT) AS posted_day FROM {p}ruled"
    )
    return (
        f"{p}unique AS ({dedup_step(source, order)}), "
        f"{p}tokens AS ({tokens_step(p + 'unique', names)}), "
        f"{p}squeezed AS ({squeeze_step(p + 'tokens', names)}), "
        f"{p}values AS ({values_step(p + 'squeezed', names)}), "
        f"{p}typed AS (SELECT {typed} FROM {p}values), {p}ruled AS ({ruled}), "
        f"{p}silver AS ({parts})"
    )


JOB_ID = (
    "substr(sha256("
    + " || '|' || ".join(
        f"lower({strip(f'''coalesce({c}, '')''')})"
        for c in ("job_title", "company", "location", "apply_link")
    )
    + "), 1, 16)"
)


def star_steps(p: str) -> str:
    """CTEs of natural-key star rows of one batch, from ``{p}silver``."""
    return (
        f"{p}rows AS (SELECT *, {JOB_ID} AS JOB_ID FROM {p}silver), "
        f"{p}first AS (SELECT * FROM {p}rows QUALIFY row_number() OVER "
        "(PARTITION BY JOB_ID ORDER BY ingest_seq) = 1), "
        f"{p}company AS (SELECT DISTINCT {strip('company')} AS COMPANY_NAME FROM {p}rows "
        f"WHERE {filled('company')}), "
        f"{p}location AS (SELECT DISTINCT city AS CITY, location AS LOCATION FROM {p}rows "
        "WHERE NOT (city IS NULL AND location IS NULL)), "
        f"{p}date AS (SELECT DISTINCT {date_key('posted_date')} AS DATE_KEY, "
        "posted_date AS POSTED_DATE, posted_year AS POSTED_YEAR, posted_month AS POSTED_MONTH, "
        f"posted_day AS POSTED_DAY FROM {p}rows WHERE posted_date IS NOT NULL), "
        f"{p}mention AS (SELECT JOB_ID, unnest({items('skills')}) AS SKILL_NAME FROM {p}rows), "
        f"{p}skill AS (SELECT DISTINCT SKILL_NAME FROM {p}mention), "
        f"{p}fact AS (SELECT JOB_ID, nullif({strip('company')}, '') AS COMPANY_NAME, city AS CITY, "
        f"location AS LOCATION, {date_key('posted_date')} AS DATE_KEY, is_remote AS IS_REMOTE, "
        f"has_salary AS HAS_SALARY FROM {p}first), "
        f"{p}bridge AS (SELECT DISTINCT JOB_ID, SKILL_NAME FROM {p}mention)"
    )


def with_raw(final: str, *steps: str) -> str:
    return f"WITH raw AS (SELECT * EXCLUDE (o_orderdate) FROM ({RAW})), {', '.join(steps)} {final}" if steps else (
        f"WITH raw AS (SELECT * EXCLUDE (o_orderdate) FROM ({RAW})) {final}"
    )


SILVER = silver_steps("raw", "x_")
STAR = star_steps("x_")

# --- landing and history ---------------------------------------------------------------


def or_na(x: str) -> str:
    return f"coalesce(nullif({x}, ''), 'N/A')"


COUNTRY = "CASE WHEN job_country = 'SA' THEN 'Saudi Arabia' ELSE job_country END"
_TITLE, _DESCRIPTION = or_na("job_title"), or_na("job_description")
_PARTS = (
    f"list_filter([nullif(job_city, ''), nullif({COUNTRY}, '')], lambda x: x IS NOT NULL)"
)


def joined(parts: str) -> str:
    return (
        f"array_to_string(list_filter(list_transform({parts}, lambda s: {strip('s')}), "
        "lambda s: s <> ''), ', ')"
    )


NORMALISED = f"""
SELECT ingest_seq, 'JSearch' AS source, {_TITLE} AS job_title,
  {or_na('employer_name')} AS company, {or_na('job_city')} AS city,
  CASE WHEN len({_PARTS}) = 0 THEN 'N/A' ELSE {joined(_PARTS)} END AS location,
  {or_na('job_employment_type')} AS employment_type,
  CASE WHEN job_min_salary IS NULL AND job_max_salary IS NULL THEN 'N/A'
    ELSE concat_ws(' - ', job_min_salary, job_max_salary)
      || coalesce(' ' || nullif(job_salary_currency, ''), '')
      || coalesce(' / ' || nullif(job_salary_period, ''), '') END AS salary,
  CASE WHEN job_required_skills LIKE '[%' AND job_required_skills <> '[]'
      THEN {joined("from_json(job_required_skills, '[\"VARCHAR\"]')")}
    WHEN job_required_skills <> '[]' THEN job_required_skills
    ELSE {terms(f"{_TITLE} || ' ' || {_DESCRIPTION}")} END AS skills,
  CASE WHEN no_experience_required THEN 'No experience required'
    WHEN required_experience_in_months <> 0
      THEN CAST(required_experience_in_months AS VARCHAR) || ' months experience'
    WHEN experience_mentioned THEN 'Experience mentioned (unspecified)'
    ELSE 'N/A' END AS experience_level,
  coalesce(nullif(job_apply_link, ''), nullif(job_google_link, ''), '') AS apply_link,
  {or_na('job_posted_at')} AS posted_at, '{fixtures.FETCHED_AT}' AS fetched_at,
  {_DESCRIPTION} AS description
FROM ({LANDING})
""".replace(
    "from_json(job_required_skills",
    "from_json(CASE WHEN job_required_skills LIKE '[%' THEN job_required_skills ELSE '[]' END",
)

BATCH_KEY = (
    f"CASE WHEN {filled('apply_link')} THEN lower({strip('apply_link')}) END, "
    + ", ".join(
        f"CASE WHEN NOT {filled('apply_link')} THEN {strip(f'lower({c})')} END"
        for c in rules.POSTING_KEY
    )
)
HISTORY_KEY = f"{filled('apply_link')}, CASE WHEN {filled('apply_link')} THEN apply_link END, " + ", ".join(
    f"CASE WHEN NOT {filled('apply_link')} THEN {c} END" for c in rules.POSTING_KEY
)
BATCH = (
    f"SELECT * FROM ({NORMALISED}) QUALIFY row_number() OVER "
    f"(PARTITION BY {BATCH_KEY} ORDER BY ingest_seq) = 1"
)
RUNS = (
    "SELECT * EXCLUDE (o_orderdate), CASE WHEN o_orderdate < TIMESTAMP "
    f"'{fixtures.HISTORY_END}' THEN 1 ELSE 2 END::BIGINT AS ingest_run FROM ({RAW})"
)


def keep_last(source: str) -> str:
    return (
        f"SELECT * FROM ({source}) QUALIFY row_number() OVER "
        f"(PARTITION BY {HISTORY_KEY} ORDER BY ingest_run DESC, ingest_seq DESC) = 1"
    )


ORACLES["normalize_payload"] = NORMALISED
ORACLES["extract_skills_documents"] = f"SELECT doc_id, {terms('text')} AS skills FROM documents"
ORACLES["extract_skills_automaton"] = ORACLES["extract_skills_documents"]
_TEXT = "job_title || ' ' || description"
ORACLES["extract_skills_postings"] = with_raw(
    f"SELECT ingest_seq, {terms(_TEXT)} AS skills, {terms(_TEXT, strict=False)} "
    "AS skills_loose_edges FROM raw"
)
ORACLES["array_file_split"] = with_raw("SELECT ingest_seq, job_title, skills, description, location FROM raw")
ORACLES["batch_dedup"] = BATCH
ORACLES["history_merge"] = keep_last(RUNS)
ORACLES["history_merge_incremental"] = keep_last(RUNS)
ORACLES["history_buckets"] = keep_last(RUNS)
ORACLES["reconciliation"] = "".join(
    f"{' UNION ALL ' if run > 1 else ''}SELECT {run}::BIGINT AS run, count(*) AS written, count(*) AS read_back, "
    f"true AS same_content FROM ({keep_last(f'SELECT * FROM ({RUNS}) WHERE ingest_run <= {run}')})"
    for run in (1, 2)
)
ORACLES["landing_rejects"] = (
    "SELECT file, CASE WHEN file % 3 = 1 THEN 0 ELSE count(*) END AS postings, file % 3 = 1 AS rejected "
    f"FROM (SELECT ingest_seq // 500 AS file FROM ({fixtures.landing_sql()})) GROUP BY file"
)
ORACLES["history_backfill"] = keep_last(
    f"SELECT * REPLACE (CASE WHEN ingest_run = 1 THEN salary END AS salary) FROM ({RUNS})"
)
ORACLES["bronze_build"] = keep_last(
    f"SELECT * EXCLUDE (o_orderdate), 1::BIGINT AS ingest_run FROM ({RAW}) "
    f"UNION ALL BY NAME SELECT *, 2::BIGINT AS ingest_run FROM ({BATCH})"
)
ORACLES["merge_summary"] = f"""
SELECT 'batch' AS step, (SELECT count(*) FROM ({NORMALISED})) AS collected,
  (SELECT count(*) FROM ({NORMALISED})) - (SELECT count(*) FROM ({BATCH})) AS removed,
  (SELECT count(*) FROM ({BATCH})) AS saved
UNION ALL
SELECT 'history', (SELECT count(*) FROM ({RUNS})),
  (SELECT count(*) FROM ({RUNS})) - (SELECT count(*) FROM ({keep_last(RUNS)})),
  (SELECT count(*) FROM ({keep_last(RUNS)}))
"""
ORACLES["align_columns"] = (
    "SELECT "
    + ", ".join(
        f"{'CASE WHEN ingest_run = 1 THEN ' + c + ' END' if c in ('salary', 'skills') else c} AS {c.upper()}"
        for c in RAW_NAMES
    )
    + f" FROM ({RUNS})"
)

# --- cleaning --------------------------------------------------------------------------

_TOKENS = f"t AS ({tokens_step('raw')})"
_SQUEEZED = f"s AS ({squeeze_step('t')})"

ORACLES["silver_dedup"] = with_raw(dedup_step("raw"))
ORACLES["null_tokens"] = with_raw(tokens_step("raw"))
ORACLES["clean_text"] = with_raw(
    f"SELECT ingest_seq, {', '.join(rules.TEXT_COLUMNS)} FROM s", _TOKENS, _SQUEEZED
)
ORACLES["employment_type"] = with_raw(
    f"SELECT ingest_seq, {employment('employment_type')} AS employment_type FROM s",
    _TOKENS, _SQUEEZED,
)
ORACLES["company_case"] = with_raw(
    f"SELECT ingest_seq, {company('company')} AS company FROM s", _TOKENS, _SQUEEZED
)
ORACLES["skill_list"] = with_raw(
    f"SELECT ingest_seq, {clean_list('skills')} AS skills, "
    f"CAST(coalesce(len({items('skills')}), 0) AS INTEGER) AS listed FROM s",
    _TOKENS, _SQUEEZED,
)
ORACLES["html_text_pages"] = f"SELECT page_id, url, {html_text('html')} AS page_text FROM pages"
ORACLES["html_text_postings"] = with_raw(
    f"SELECT ingest_seq, {html_text('description')} AS description FROM t", _TOKENS
)
_TIMES = (
    f"f AS (SELECT ingest_seq, {fetched('fetched_at')} AS fetched_at, posted_at AS value FROM t), "
    f"p AS (SELECT ingest_seq, fetched_at, {posted('value', 'fetched_at')} AS posted_at FROM f)"
)
_TOLD = {
    "swapped": "CASE WHEN day(t) <= 12 THEN make_timestamp(year(t), day(t), month(t), 0, 0, 0) "
    "ELSE date_trunc('day', t) END",
    "none": "CAST(NULL AS TIMESTAMP)",
}
_SPELLED = " ".join(
    f"WHEN {i} THEN " + _TOLD.get(told, f"date_trunc('{told}', t)") for i, (_, told) in enumerate(fixtures.SPELLINGS)
)
ORACLES["posted_at_spellings"] = (
    f"SELECT o_orderkey, {shown('told')} AS posted_at FROM (SELECT o_orderkey, "
    f"CASE o_orderkey % {len(fixtures.SPELLINGS)} {_SPELLED} END AS told FROM (SELECT o_orderkey, "
    "CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS t FROM orders))"
)
ORACLES["posted_at"] = with_raw(
    f"SELECT ingest_seq, {shown('fetched_at')} AS fetched_at, {shown('posted_at')} AS posted_at FROM p",
    _TOKENS, _TIMES,
)
ORACLES["date_parts"] = with_raw(
    f"SELECT ingest_seq, {shown_date('posted_at')} AS posted_date, year(posted_at) AS posted_year, "
    "month(posted_at) AS posted_month, day(posted_at) AS posted_day, "
    f"{date_key('posted_at')} AS date_key FROM p",
    _TOKENS, _TIMES,
)
ORACLES["date_parts_events"] = (
    f"SELECT event_id, {shown_date('ts')} AS event_date, year(ts) AS event_year, "
    f"month(ts) AS event_month, day(ts) AS event_day, {date_key('ts')} AS date_key FROM events"
)
ORACLES["experience_level"] = with_raw(
    f"SELECT ingest_seq, job_title, {level('experience_level', 'job_title', 'description')} "
    "AS experience_level FROM x_values",
    SILVER,
)
ORACLES["experience_years_documents"] = (
    f"WITH y AS (SELECT doc_id, {years('text')} AS years FROM documents) "
    f"SELECT doc_id, years, {years_level('years')} AS experience_level FROM y"
)
ORACLES["city_recovery"] = with_raw("SELECT ingest_seq, location, city FROM x_silver", SILVER)
ORACLES["flags"] = with_raw("SELECT ingest_seq, is_remote, has_salary FROM x_silver", SILVER)
ORACLES["remote_flag_conversations"] = (
    f"SELECT conv_id, turn, {remote('role', 'text')} AS is_remote FROM conversations"
)
_SHOWN_SILVER = (
    "SELECT * REPLACE ("
    f"{shown('posted_at')} AS posted_at, {shown('fetched_at')} AS fetched_at, "
    f"{shown_date('posted_date')} AS posted_date) FROM x_silver"
)
_MERGED = (
    f"SELECT *, CAST(NOT {filled('apply_link')} AS INTEGER) AS ingest_unlinked "
    f"FROM ({ORACLES['bronze_build']})"
)
ORACLES["silver_full"] = with_raw(_SHOWN_SILVER, SILVER)
ORACLES["silver_from_landing"] = (
    f"WITH merged AS ({_MERGED}), {silver_steps('merged', 'x_', MERGED_NAMES)} {_SHOWN_SILVER}"
)
ORACLES["silver_incremental"] = ORACLES["silver_from_landing"]
_OLD = (
    f"SELECT *, CAST(NOT {filled('apply_link')} AS INTEGER) AS ingest_unlinked FROM ("
    + keep_last(f"SELECT * EXCLUDE (o_orderdate), 1::BIGINT AS ingest_run FROM ({RAW})")
    + ")"
)
ORACLES["silver_changes"] = (
    f"WITH older AS ({_OLD}), merged AS ({_MERGED}), {silver_steps('older', 'o_', MERGED_NAMES)}, "
    f"{silver_steps('merged', 'x_', MERGED_NAMES)}, was AS ({_SHOWN_SILVER.replace('x_silver', 'o_silver')}), "
    f"now AS ({_SHOWN_SILVER}) SELECT 1 AS sign, * FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM was) "
    "UNION ALL SELECT -1, * FROM (SELECT * FROM was EXCEPT ALL SELECT * FROM now)"
)

# --- star ------------------------------------------------------------------------------

ORACLES["job_id"] = with_raw(f"SELECT ingest_seq, {JOB_ID} AS JOB_ID FROM x_silver", SILVER)
ORACLES["dim_company"] = with_raw("SELECT * FROM x_company", SILVER, STAR)
ORACLES["dim_location"] = with_raw("SELECT * FROM x_location", SILVER, STAR)
ORACLES["dim_date"] = with_raw(
    f"SELECT * REPLACE ({shown_date('POSTED_DATE')} AS POSTED_DATE) FROM x_date", SILVER, STAR
)
ORACLES["dim_job"] = with_raw(
    "SELECT JOB_ID, job_title AS JOB_TITLE, source AS SOURCE, employment_type AS EMPLOYMENT_TYPE, "
    "experience_level AS EXPERIENCE_LEVEL, apply_link AS APPLY_LINK, description AS DESCRIPTION, "
    f"{shown('posted_at')} AS POSTED_AT FROM x_first",
    SILVER, STAR,
)
ORACLES["dim_skill"] = with_raw(
    "SELECT * FROM x_skill ORDER BY lower(SKILL_NAME), SKILL_NAME", SILVER, STAR
)


def _hash(*names: str) -> str:
    parts = " || chr(31) || ".join(f"coalesce('v' || {n}, 'n')" for n in names)
    return f"sha256({parts})"


ORACLES["surrogate_keys"] = with_raw(
    "SELECT 'company' AS dimension, COMPANY_NAME AS part1, CAST(NULL AS VARCHAR) AS part2, "
    f"row_number() OVER (ORDER BY {_hash('COMPANY_NAME')}) AS KEY FROM x_company "
    "UNION ALL SELECT 'location', CITY, LOCATION, "
    f"row_number() OVER (ORDER BY {_hash('CITY', 'LOCATION')}) FROM x_location",
    SILVER, STAR,
)
ORACLES["fact_jobs"] = with_raw("SELECT * FROM x_fact", SILVER, STAR)
ORACLES["bridge_job_skill"] = with_raw("SELECT * FROM x_bridge", SILVER, STAR)
ORACLES["table_counts"] = with_raw(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
        for name, cte in [
            ("DIM_COMPANY", "x_company"), ("DIM_LOCATION", "x_location"), ("DIM_DATE", "x_date"),
            ("DIM_JOB", "x_first"), ("DIM_SKILL", "x_skill"), ("FACT_JOBS", "x_fact"),
            ("BRIDGE_JOB_SKILL", "x_bridge"),
        ]
    ),
    SILVER, STAR,
)

_LOADS = (
    f"WITH runs AS ({RUNS}), older AS (SELECT * FROM runs WHERE ingest_run = 1), "
    f"{silver_steps('older', 'a_')}, {star_steps('a_')}, "
    f"{silver_steps('runs', 'b_')}, {star_steps('b_')} "
)
ORACLES["incremental_load"] = _LOADS + (
    "SELECT * FROM a_fact UNION ALL SELECT * FROM b_fact "
    "WHERE NOT EXISTS (SELECT 1 FROM a_fact WHERE a_fact.JOB_ID = b_fact.JOB_ID)"
)


def _summary(table: str, new: str, old: str, on: str, offered: str | None = None) -> str:
    inserted = f"(SELECT count(*) FROM {new} n WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE {on}))"
    offered = offered or f"(SELECT count(*) FROM {new})"
    return (
        f"SELECT '{table}' AS table_name, {inserted} AS inserted, "
        f"{offered} - {inserted} AS existed, CAST(0 AS BIGINT) AS missed"
    )


ORACLES["load_summary"] = _LOADS + " UNION ALL ".join(
    [
        _summary("DIM_COMPANY", "b_company", "a_company", "o.COMPANY_NAME = n.COMPANY_NAME"),
        _summary(
            "DIM_LOCATION", "b_location", "a_location",
            "o.CITY IS NOT DISTINCT FROM n.CITY AND o.LOCATION IS NOT DISTINCT FROM n.LOCATION",
        ),
        _summary("DIM_DATE", "b_date", "a_date", "o.DATE_KEY = n.DATE_KEY"),
        _summary("DIM_JOB", "b_first", "a_first", "o.JOB_ID = n.JOB_ID"),
        _summary("DIM_SKILL", "b_skill", "a_skill", "o.SKILL_NAME = n.SKILL_NAME"),
        _summary(
            "FACT_JOBS", "b_fact", "a_fact", "o.JOB_ID = n.JOB_ID",
            "(SELECT count(*) FROM b_rows)",
        ),
        _summary(
            "BRIDGE_JOB_SKILL", "b_bridge", "a_bridge",
            "o.JOB_ID = n.JOB_ID AND o.SKILL_NAME = n.SKILL_NAME",
            "(SELECT count(*) FROM b_mention)",
        ),
    ]
)

_NO_JOB = "NOT EXISTS (SELECT 1 FROM a_first o WHERE o.JOB_ID = n.JOB_ID)"
_NO_SKILL = "NOT EXISTS (SELECT 1 FROM a_skill o WHERE o.SKILL_NAME = n.SKILL_NAME)"
ORACLES["load_missed"] = _LOADS + (
    "SELECT 'FACT_JOBS' AS table_name, JOB_ID, CAST(NULL AS VARCHAR) AS SKILL_NAME, count(*) AS offered "
    f"FROM b_rows n WHERE {_NO_JOB} GROUP BY JOB_ID "
    "UNION ALL SELECT 'BRIDGE_JOB_SKILL', JOB_ID, SKILL_NAME, count(*) "
    f"FROM b_mention n WHERE {_NO_JOB} OR {_NO_SKILL} GROUP BY JOB_ID, SKILL_NAME"
)
ORACLES["load_summary_missed"] = _LOADS + (
    "SELECT 'FACT_JOBS' AS table_name, inserted, offered - inserted - missed AS existed, missed FROM ("
    f"SELECT count(*) AS offered, count(*) FILTER (WHERE {_NO_JOB}) AS missed, "
    f"count(DISTINCT JOB_ID) FILTER (WHERE NOT {_NO_JOB}) AS inserted FROM b_rows n) "
    "UNION ALL SELECT 'BRIDGE_JOB_SKILL', inserted, offered - inserted - missed, missed FROM ("
    f"SELECT count(*) AS offered, count(*) FILTER (WHERE {_NO_JOB} OR {_NO_SKILL}) AS missed, "
    "count(DISTINCT {'j': JOB_ID, 's': SKILL_NAME}) "
    f"FILTER (WHERE NOT ({_NO_JOB} OR {_NO_SKILL})) AS inserted FROM b_mention n)"
)

ORACLES["rollups_after_loads"] = _LOADS + (
    ", facts AS (SELECT * FROM a_fact UNION ALL SELECT * FROM b_fact "
    "WHERE NOT EXISTS (SELECT 1 FROM a_fact WHERE a_fact.JOB_ID = b_fact.JOB_ID)), "
    "jobs AS (SELECT JOB_ID, experience_level, employment_type FROM a_first UNION ALL "
    "SELECT JOB_ID, experience_level, employment_type FROM b_first "
    "WHERE NOT EXISTS (SELECT 1 FROM a_first WHERE a_first.JOB_ID = b_first.JOB_ID)), "
    "pairs AS (SELECT JOB_ID, SKILL_NAME FROM a_bridge UNION SELECT JOB_ID, SKILL_NAME FROM b_bridge) "
    "SELECT 'month' AS rollup, CAST(DATE_KEY // 10000 AS VARCHAR) AS a, "
    "CAST(DATE_KEY // 100 % 100 AS VARCHAR) AS b, count(*) AS postings, "
    "CAST(NULL AS BIGINT) AS remote_postings FROM facts WHERE DATE_KEY IS NOT NULL GROUP BY ALL "
    "UNION ALL SELECT 'company', COMPANY_NAME, NULL, count(*), NULL FROM facts "
    "WHERE COMPANY_NAME IS NOT NULL GROUP BY COMPANY_NAME "
    "UNION ALL SELECT 'city', CITY, NULL, count(*), count(*) FILTER (WHERE IS_REMOTE) FROM facts "
    "WHERE NOT (CITY IS NULL AND LOCATION IS NULL) GROUP BY CITY "
    "UNION ALL SELECT 'skill', SKILL_NAME, NULL, count(*), NULL FROM pairs GROUP BY SKILL_NAME "
    "UNION ALL SELECT 'level', experience_level, employment_type, count(*), NULL FROM jobs "
    "GROUP BY experience_level, employment_type"
)

# --- reads over the star ---------------------------------------------------------------

ORACLES["q1_postings_per_month"] = with_raw(
    "SELECT year(posted_date) AS POSTED_YEAR, month(posted_date) AS POSTED_MONTH, "
    "count(*) AS postings FROM x_first WHERE posted_date IS NOT NULL GROUP BY ALL",
    SILVER, STAR,
)
ORACLES["q2_top_companies"] = with_raw(
    "SELECT COMPANY_NAME, count(*) AS postings FROM x_fact WHERE COMPANY_NAME IS NOT NULL "
    "GROUP BY ALL ORDER BY postings DESC, COMPANY_NAME LIMIT 20",
    SILVER, STAR,
)
ORACLES["q3_postings_per_city"] = with_raw(
    "SELECT CITY, count(*) AS postings, count(*) FILTER (WHERE IS_REMOTE) AS remote_postings, "
    "round(count(*) FILTER (WHERE IS_REMOTE) / count(*), 6) AS remote_share FROM x_fact "
    "WHERE NOT (CITY IS NULL AND LOCATION IS NULL) GROUP BY ALL",
    SILVER, STAR,
)
ORACLES["q4_top_skills"] = with_raw(
    "SELECT SKILL_NAME, count(*) AS postings FROM x_bridge GROUP BY ALL "
    "ORDER BY postings DESC, SKILL_NAME LIMIT 20",
    SILVER, STAR,
)
ORACLES["q5_levels_by_employment"] = with_raw(
    "SELECT experience_level AS EXPERIENCE_LEVEL, employment_type AS EMPLOYMENT_TYPE, "
    "count(*) AS postings FROM x_first GROUP BY ALL",
    SILVER, STAR,
)
ORACLES["skill_counts"] = with_raw(
    f"SELECT skill, count(*) AS postings FROM (SELECT unnest({distinct_items('skills')}) AS skill "
    "FROM s) GROUP BY ALL",
    f"u AS ({dedup_step('raw')})", f"t AS ({tokens_step('u')})", _SQUEEZED,
)

# --- quality reports -------------------------------------------------------------------

SILVER_NAMES = list(rules.SILVER_TYPES)


def _null_rows(names: list[str], source: str, pct: bool) -> str:
    share = ", count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS null_pct" if pct else ""
    return " UNION ALL ".join(
        (
            "SELECT '{c}' AS column_name, count(*) AS rows, "
            "count(*) FILTER (WHERE {c} IS NULL) AS null_count" + share + " FROM {s}"
        ).format(c=c, s=source)
        for c in names
    )


ORACLES["null_report"] = with_raw(
    f"SELECT column_name, rows, null_count, CAST(null_pct AS DOUBLE) AS null_pct FROM ({_null_rows(SILVER_NAMES, 'x_silver', True)})",
    SILVER,
)
ORACLES["null_report_cleaning"] = with_raw(
    _null_rows(
        [
            "salary", "city", "employment_type", "skills", "experience_level", "posted_at",
            "fetched_at", "description",
        ],
        'x_values',
        False,
    ),
    SILVER,
)
ORACLES["distributions"] = with_raw(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM x_silver "
        "GROUP BY ALL"
        for c in ("experience_level", "is_remote", "has_salary")
    ),
    SILVER,
)
_CHECKS = " UNION ALL ".join(
    [
        *[
            f"SELECT '{c}' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS findings FROM x_silver"
            for c in rules.POSTING_KEY
        ],
        "SELECT 'duplicates', count(*) - (SELECT count(*) FROM "
        "(SELECT DISTINCT job_title, company, location FROM x_silver)) FROM x_silver",
        "SELECT 'experience_level', count(DISTINCT experience_level) FILTER "
        f"(WHERE experience_level NOT IN {in_list(rules.LEVELS)}) FROM x_silver",
        *[
            f"SELECT '{c}', CAST(NOT coalesce(bool_and({c} IN (true, false)), true) AS BIGINT) FROM x_silver"
            for c in ("is_remote", "has_salary")
        ],
    ]
)
ORACLES["dq_checks"] = with_raw(
    "SELECT check_name, findings, CASE WHEN findings = 0 THEN 'PASS' ELSE 'WARNING' END AS status "
    f"FROM ({_CHECKS})",
    SILVER,
)
ORACLES["invalid_values"] = with_raw(
    "SELECT DISTINCT experience_level AS value, 'experience_level' AS column_name FROM s "
    f"WHERE experience_level NOT IN {in_list(rules.LEVELS)} "
    "UNION ALL SELECT DISTINCT employment_type, 'employment_type' FROM s "
    f"WHERE employment_type NOT IN {in_list(sorted(set(rules.EMPLOYMENT_TYPES.values())))}",
    _TOKENS, _SQUEEZED,
)


def _whitespace(source: str, stage: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE regexp_matches({c}, '^{WS}')) AS leading_ws, "
        f"count(*) FILTER (WHERE regexp_matches({c}, '{WS}$')) AS trailing_ws, "
        f"count(*) FILTER (WHERE regexp_matches({c}, '{WS}{{2,}}')) AS repeated_ws, "
        f"'{stage}' AS stage FROM {source}"
        for c in rules.TEXT_COLUMNS
    )


ORACLES["whitespace_check"] = with_raw(
    "SELECT *, CASE WHEN leading_ws = 0 AND repeated_ws = 0 THEN 'PASS' ELSE 'WARNING' END AS status FROM ("
    f"{_whitespace('t', 'raw')} UNION ALL {_whitespace('x_silver', 'cleaned')})",
    f"t AS ({tokens_step('raw')})", SILVER,
)
ORACLES["recovered_counts"] = with_raw(
    "SELECT column_name, missing_before, missing_after, missing_before - missing_after AS recovered "
    "FROM (SELECT 'experience_level' AS column_name, (SELECT count(*) FROM x_values WHERE "
    f"experience_level IS NULL OR experience_level NOT IN {in_list(rules.LEVELS)}) AS missing_before, "
    "(SELECT count(*) FROM x_silver WHERE experience_level IS NULL) AS missing_after UNION ALL "
    "SELECT 'city', (SELECT count(*) FROM x_values WHERE city IS NULL), "
    "(SELECT count(*) FROM x_silver WHERE city IS NULL))",
    SILVER,
)


def _duplicates(source: str, stage: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT job_title, company, location FROM {source}))"
    return (
        f"SELECT count(*) AS rows, {distinct} AS distinct_keys, count(*) - {distinct} AS duplicates, "
        f"'{stage}' AS stage FROM {source}"
    )


ORACLES["duplicates_report"] = with_raw(
    f"{_duplicates('raw', 'raw')} UNION ALL {_duplicates('x_silver', 'cleaned')}", SILVER
)
ORACLES["silver_shape"] = with_raw(
    f"SELECT count(*) AS rows, CAST({len(SILVER_NAMES)} AS BIGINT) AS columns FROM x_silver", SILVER
)
ORACLES["first_rows"] = with_raw(
    f"SELECT {JOB_ID} AS JOB_ID, job_title AS JOB_TITLE, company AS COMPANY FROM x_silver "
    "ORDER BY ingest_seq LIMIT 5",
    SILVER,
)
ORACLES["schema_dump"] = with_raw(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS non_null FROM x_silver"
        for i, (name, kind) in enumerate(rules.SILVER_TYPES.items(), 1)
    ),
    SILVER,
)
ORACLES["record_files"] = with_raw(_SHOWN_SILVER.replace("* REPLACE", "* EXCLUDE (ingest_seq) REPLACE"), SILVER)
ORACLES["published_table"] = f"SELECT * FROM ({RUNS})"
