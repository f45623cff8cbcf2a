"""The registered queries stated in DuckDB SQL, over the rules of ``workload.fixtures``."""

from __future__ import annotations

BASE = """
n AS (SELECT (SELECT count(*) FROM pages) AS page_rows, (SELECT count(*) FROM events) AS event_rows),
p AS (
  SELECT page_id AS p, url AS plain_url, page_id * 7919 % 2592000 AS spread, page_id * 13 % 50 AS cnt,
    regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title,
    CASE page_id % 25 WHEN 3 THEN 'http://nopath-' || page_id || '.example'
      WHEN 7 THEN 'about:page' || page_id
      WHEN 11 THEN 'file:///home/u/' || page_id
      WHEN 15 THEN 'https://www.awww.example:8080/www.x/' || page_id
      ELSE url END AS url
  FROM pages),
e AS (
  SELECT event_id AS e, user_id AS u, event_type AS t, epoch_us(ts) AS m, page_rows,
    CAST(round(value * 100) AS BIGINT) AS c,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN event_id % 97 = 0 THEN page_rows + 1 ELSE (user_id * 7 + event_id % 11) % page_rows + 1 END AS url_id,
    CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 89 = 0 THEN event_rows + 1000 ELSE event_id END AS from_id
  FROM events CROSS JOIN n WHERE {events_filter})"""

CHROMIUM = """
urls AS (
  SELECT p + 1 AS id, url, CASE WHEN p % 17 <> 0 THEN page_title END AS title, cnt AS visit_count,
    cnt % 7 AS typed_count,
    CASE WHEN p % 31 = 0 THEN 0 ELSE 13348540800000000 + spread * 1000000 END AS last_visit_time
  FROM p),
visits AS (
  SELECT e + 1 AS id, url_id AS url, m + 11644473600000000 AS visit_time, from_id AS from_visit,
    CASE WHEN e % 101 <> 0 THEN 805306368 + e * 7 % 13 END AS transition, c * 10000 AS visit_duration
  FROM e),
terms AS (
  SELECT 'term ' || k AS term, e % (page_rows + 3) + 1 AS url_id FROM e WHERE t = 'click' AND e % 4 = 0),
downloads AS (
  SELECT e + 1 AS id, '/home/u/dl/f' || e || '.bin' AS target_path, c * 1024 AS total_bytes,
    ['application/pdf', 'image/png', ''][e % 3 + 1] AS mime_type,
    CASE WHEN e % 41 <> 0 THEN e % 6 END AS state, m + 11644473600000000 AS start_time,
    CASE WHEN e % 2 <> 0 THEN 'https://dl.example/' || u END AS tab_url,
    CASE WHEN e % 3 <> 0 THEN 'https://ref.example/' END AS referrer
  FROM e WHERE t = 'purchase'),
content_notes AS (
  SELECT e + 1 AS visit_id, CASE WHEN e % 2 <> 0 THEN '/m/0' || k END AS categories,
    CASE WHEN e % 7 <> 0 THEN 'en' END AS page_language, CASE WHEN e % 4 = 0 THEN 'q ' || k END AS search_terms
  FROM e WHERE e % 3 = 0),
context_notes AS (
  SELECT e + 1 AS visit_id, CASE WHEN e % 10 = 0 THEN -1000000 ELSE c * 5000 END AS fg,
    [200, 404, 0][e % 3 + 1]::BIGINT AS response_code, u AS tab_id, u % 5 AS window_id
  FROM e WHERE e % 2 = 0)"""

FIREFOX = """
places AS (
  SELECT p + 1 AS id, url, CASE WHEN p % 17 <> 0 THEN page_title END AS title, cnt AS visit_count,
    CASE WHEN p % 31 <> 0 THEN 1704067200000000 + spread * 1000000 END AS last_visit_date
  FROM p),
visits AS (
  SELECT e + 1 AS id, from_id AS from_visit, url_id AS place_id, m AS visit_date,
    CASE WHEN e % 101 <> 0 THEN e % 12 END AS visit_type
  FROM e),
inputs AS (
  SELECT e % (page_rows + 3) + 1 AS place_id, 'in ' || k AS input, c / 100 AS use_count
  FROM e WHERE t = 'view' AND e % 4 = 0),
marks AS (
  SELECT p + 1 AS id, CASE WHEN p < 10 THEN 2 WHEN p % 13 = 0 THEN 3 ELSE 1 END AS type,
    CASE WHEN p >= 10 AND p % 19 <> 0 THEN p + 1 END AS fk,
    CASE WHEN p % 23 = 0 THEN 99999999 ELSE p % 10 + 1 END AS parent,
    CASE WHEN p % 29 <> 0 THEN 'bm ' || p END AS title, 1704067200000000 + spread * 1000000 AS added
  FROM p)"""

# visit_us keeps the exact microseconds the seconds were made from, for the date tests
SAFARI = """
items AS (
  SELECT p + 1 AS id, url, cnt AS visit_count, CAST(725760000 + spread AS DOUBLE) AS visit_count_score FROM p),
visits AS (
  SELECT e + 1 AS id, url_id AS item, (m - 978307200000000) / 1000000 AS visit_time, m AS visit_us,
    CASE WHEN url_id % 13 = 0 OR e % 3 = 0 THEN NULL WHEN e % 3 = 1 AND e % 2 = 0 THEN '' ELSE 't ' || e END AS title,
    from_id AS source, CASE WHEN e % 6 = 0 THEN e + 2 END AS destination
  FROM e)"""


def with_tables(family: str, select: str, events_filter: str = "true") -> str:
    return f"WITH {BASE.format(events_filter=events_filter)},{family}\n{select}"


def chromium(select: str) -> str:
    return with_tables(CHROMIUM, select)


def edge(select: str) -> str:
    return with_tables(CHROMIUM, select, "user_id % 2 = 1")


def chromium_fleet(select: str) -> str:
    """Two profiles with the same ids."""
    return with_tables(
        f"""{CHROMIUM},
fleet_urls AS (
  SELECT 'p0' AS profile_id, * FROM urls UNION ALL SELECT 'p1', * REPLACE (url || '?p1' AS url) FROM urls),
fleet_visits AS (
  SELECT 'p0' AS profile_id, * FROM visits
  UNION ALL SELECT 'p1', * REPLACE (visit_time - 1800000001 AS visit_time) FROM visits)""",
        select,
    )


def firefox(select: str) -> str:
    return with_tables(FIREFOX, select)


def safari(select: str) -> str:
    return with_tables(SAFARI, select)


# ---- expressions ----------------------------------------------------------


def shown(micros: str, zone: str = "UTC") -> str:
    """Wall-clock text of Unix microseconds."""
    utc = f"make_timestamp({micros} // 1000000 * 1000000)"
    local = utc if zone == "UTC" else f"({utc} AT TIME ZONE 'UTC') AT TIME ZONE '{zone}'"
    return f"strftime({local}, '%Y-%m-%d %H:%M:%S')"


def webkit(column: str, zone: str = "UTC") -> str:
    return shown(f"({column} - 11644473600000000)", zone)


def core_data(seconds: str) -> str:
    """Safari times are rounded to whole Julian-day milliseconds in double arithmetic, then cut to seconds."""
    julian = f"floor(({seconds} + 978307200) * 1000::DOUBLE + 210866760000000::DOUBLE + 0.5::DOUBLE)::BIGINT"
    return shown(f"(({julian} - 210866760000000) * 1000)")


def between(column: str, date_from: str | None, date_to: str | None, offset: int, zone: str = "UTC") -> str:
    """Date test on Unix microseconds plus ``offset``; TRUE without bounds."""

    def micros(date: str) -> str:
        return f"epoch_us(TIMESTAMP '{date}' AT TIME ZONE '{zone}') + {offset}"

    tests = [f"{column} >= {micros(date_from)}"] if date_from else []
    tests += [f"{column} < {micros(date_to)} + 86400000000"] if date_to else []
    return " AND ".join(tests) or "TRUE"


WEBKIT_US = 11644473600000000


def labels(code: str, names: dict[int, str], otherwise: str) -> str:
    cases = " ".join(f"WHEN {value} THEN '{name}'" for value, name in names.items())
    return f"CASE {code} {cases} ELSE {otherwise} END"


# fixed values
TRANSITIONS = dict(
    enumerate(
        "LINK TYPED BOOKMARK AUTO_SUBFRAME MANUAL_SUBFRAME GENERATED AUTO_TOPLEVEL FORM_SUBMIT RELOAD "
        "KEYWORD KEYWORD_GENERATED".split()
    )
)
SUMMARY_TRANSITIONS = {code: TRANSITIONS[code] for code in (0, 1, 2, 7, 8, 9)}
STATES = dict(enumerate("IN_PROGRESS COMPLETE CANCELLED INTERRUPTED".split()))
VISIT_TYPES = dict(
    enumerate("LINK TYPED BOOKMARK EMBED REDIRECT_PERM REDIRECT_TEMP DOWNLOAD FRAMED_LINK RELOAD".split(), start=1)
)


def transition(column: str) -> str:
    return labels(f"({column} & 255)", TRANSITIONS, f"'OTHER(' || ({column} & 255) || ')'")


def visit_type(column: str) -> str:
    return labels(column, VISIT_TYPES, f"'OTHER(' || {column} || ')'")


def rounded(micros: str, unit: int, scale: int) -> str:
    return f"(sign({micros}) * ((abs({micros}) + {unit // 2}) // {unit}) / {scale})::DOUBLE"


def domain(url: str) -> str:
    rest = f"replace(substr({url}, instr({url}, '://') + 3), 'www.', '')"
    return f"CASE WHEN instr({rest}, '/') > 0 THEN left({rest}, instr({rest}, '/') - 1) WHEN {url} IS NOT NULL THEN '' END"


def top(limit: int) -> str:
    return "" if limit < 0 else f" LIMIT {limit}"


# ---- reports --------------------------------------------------------------


def chromium_urls(date_from=None, date_to=None, limit=100, zone="UTC") -> str:
    return f"""SELECT url, title, visit_count, typed_count, {webkit("last_visit_time", zone)} AS last_visit_time
FROM urls WHERE {between("last_visit_time", date_from, date_to, WEBKIT_US, zone)}
ORDER BY urls.last_visit_time DESC, id{top(limit)}"""


def chromium_visits(date_from=None, date_to=None, limit=100, zone="UTC") -> str:
    return f"""SELECT u.url, u.title, {webkit("v.visit_time", zone)} AS visit_time,
  {rounded("v.visit_duration", 100000, 10)} AS duration_sec, {transition("v.transition")} AS transition,
  coalesce(fu.url, '') AS from_url
FROM visits v JOIN urls u ON u.id = v.url
LEFT JOIN visits fv ON fv.id = v.from_visit LEFT JOIN urls fu ON fu.id = fv.url
WHERE {between("v.visit_time", date_from, date_to, WEBKIT_US, zone)}
ORDER BY v.visit_time DESC, v.url, v.id{top(limit)}"""


def chromium_searches(date_from=None, date_to=None, limit=100) -> str:
    return f"""SELECT term, url, title, {webkit("last_visit_time")} AS last_visit_time
FROM terms JOIN urls ON urls.id = terms.url_id
WHERE {between("last_visit_time", date_from, date_to, WEBKIT_US)}
ORDER BY urls.last_visit_time DESC, url_id, term{top(limit)}"""


def chromium_downloads(date_from=None, date_to=None, limit=100, zone="UTC") -> str:
    return f"""SELECT target_path, total_bytes, mime_type,
  {labels("state", STATES, "'UNKNOWN(' || state || ')'")} AS state, {webkit("start_time", zone)} AS start_time,
  coalesce(tab_url, '') AS tab_url, coalesce(referrer, '') AS referrer
FROM downloads WHERE {between("start_time", date_from, date_to, WEBKIT_US, zone)}
ORDER BY {webkit("downloads.start_time", zone)} DESC, downloads.start_time DESC, id{top(limit)}"""


def chromium_annotations(date_from=None, date_to=None, limit=100) -> str:
    return f"""SELECT u.url, u.title, {webkit("v.visit_time")} AS visit_time, coalesce(a.categories, '') AS categories,
  coalesce(a.page_language, '') AS page_language, coalesce(a.search_terms, '') AS search_terms
FROM content_notes a JOIN visits v ON v.id = a.visit_id JOIN urls u ON u.id = v.url
WHERE {between("v.visit_time", date_from, date_to, WEBKIT_US)}
ORDER BY v.visit_time DESC, v.url, v.id{top(limit)}"""


def chromium_contexts(date_from=None, date_to=None, limit=100) -> str:
    return f"""SELECT u.url, u.title, {webkit("v.visit_time")} AS visit_time,
  {rounded("a.fg", 100000, 10)} AS foreground_sec, a.response_code, a.tab_id, a.window_id
FROM context_notes a JOIN visits v ON v.id = a.visit_id JOIN urls u ON u.id = v.url
WHERE {between("v.visit_time", date_from, date_to, WEBKIT_US)}
ORDER BY v.visit_time DESC, v.url, v.id{top(limit)}"""


def firefox_urls(date_from=None, date_to=None, limit=100, zone="UTC") -> str:
    return f"""SELECT url, coalesce(title, '') AS title, visit_count, {shown("last_visit_date", zone)} AS last_visit_time
FROM places WHERE visit_count > 0 AND {between("last_visit_date", date_from, date_to, 0, zone)}
ORDER BY last_visit_date DESC NULLS LAST, id{top(limit)}"""


def firefox_visits(date_from=None, date_to=None, limit=100) -> str:
    return f"""SELECT u.url, coalesce(u.title, '') AS title, {shown("v.visit_date")} AS visit_time,
  {visit_type("v.visit_type")} AS transition, coalesce(fu.url, '') AS from_url
FROM visits v JOIN places u ON u.id = v.place_id
LEFT JOIN visits fv ON fv.id = v.from_visit LEFT JOIN places fu ON fu.id = fv.place_id
WHERE {between("v.visit_date", date_from, date_to, 0)}
ORDER BY v.visit_date DESC, v.place_id, v.id{top(limit)}"""


def firefox_searches(limit=100) -> str:
    return f"""SELECT input, url, coalesce(title, '') AS title, use_count
FROM inputs JOIN places ON places.id = inputs.place_id
ORDER BY use_count DESC, place_id, input{top(limit)}"""


def firefox_bookmarks(limit=100) -> str:
    return f"""SELECT b.title, coalesce(u.url, '') AS url, {shown("b.added")} AS "dateAdded",
  coalesce(f.title, '') AS parent_title
FROM marks b LEFT JOIN places u ON u.id = b.fk LEFT JOIN marks f ON f.id = b.parent
WHERE b.type = 1 ORDER BY b.added DESC, b.id{top(limit)}"""


def safari_urls(date_from=None, date_to=None, limit=100, last_visit="score") -> str:
    seen = ""
    if date_from or date_to:
        seen = f"AND i.id IN (SELECT item FROM visits WHERE {between('visit_us', date_from, date_to, 0)})"
    when = "visit_count_score"
    if last_visit != "score":
        when = "(SELECT max(visit_time) FROM visits v WHERE v.item = i.id)"
    return f"""SELECT i.url, coalesce(t.title, '') AS title, i.visit_count, {core_data(when)} AS last_visit_time
FROM items i LEFT JOIN (
  SELECT item, arg_max(title, visit_us) AS title FROM visits WHERE title <> '' GROUP BY item) t ON t.item = i.id
WHERE i.visit_count > 0 {seen}
ORDER BY {when} DESC NULLS LAST, i.id{top(limit)}"""


def safari_visits(date_from=None, date_to=None, limit=100) -> str:
    return f"""SELECT i.url, coalesce(v.title, '') AS title, {core_data("v.visit_time")} AS visit_time,
  coalesce(si.url, '') AS redirect_source, coalesce(di.url, '') AS redirect_destination
FROM visits v JOIN items i ON i.id = v.item
LEFT JOIN visits sv ON sv.id = v.source LEFT JOIN items si ON si.id = sv.item
LEFT JOIN visits dv ON dv.id = v.destination LEFT JOIN items di ON di.id = dv.item
WHERE {between("v.visit_us", date_from, date_to, 0)}
ORDER BY v.visit_us DESC, v.item, v.id{top(limit)}"""


# ---- summaries ------------------------------------------------------------

#: per browser: wrapper, page table, visit column names, duration column, type label
SUMMARIES = {
    "chrome": (chromium, "urls", "url", "visit_time", WEBKIT_US, True, labels("(transition & 255)", SUMMARY_TRANSITIONS, "'OTHER'")),
    "edge": (edge, "urls", "url", "visit_time", WEBKIT_US, True, None),
    "firefox": (firefox, "places", "place_id", "visit_date", 0, False, labels("visit_type", VISIT_TYPES, "'OTHER'")),
    "safari": (safari, "items", "item", "visit_us", 0, False, None),
}

HOURS = "(sum(visit_duration)::BIGINT + 18000000) // 36000000"


def summary_basic(browser: str, date_from=None, date_to=None) -> str:
    wrap, _, page, time, offset, timed, _ = SUMMARIES[browser]
    hours = f", ({HOURS} / 100)::DOUBLE AS total_hours" if timed else ""
    return wrap(
        f"SELECT count(*) AS total_visits, count(DISTINCT {page}) AS unique_urls{hours} "
        f"FROM visits WHERE {between(time, date_from, date_to, offset)}"
    )


def _domain_counts(browser: str, date_from, date_to, zone="UTC") -> str:
    _, pages, page, time, offset, _, _ = SUMMARIES[browser]
    return (
        f"SELECT {domain('g.url')} AS domain, count(*) AS cnt FROM visits v JOIN {pages} g ON g.id = v.{page} "
        f"WHERE {between('v.' + time, date_from, date_to, offset, zone)} GROUP BY 1 ORDER BY cnt DESC, domain NULLS FIRST LIMIT 10"
    )


def _type_counts(browser: str, date_from, date_to, zone="UTC") -> str:
    _, _, _, time, offset, _, label = SUMMARIES[browser]
    return f"SELECT {label} AS type, count(*) AS cnt FROM visits WHERE {between(time, date_from, date_to, offset, zone)} GROUP BY 1"


def summary_domains(browser: str, date_from=None, date_to=None) -> str:
    return SUMMARIES[browser][0](_domain_counts(browser, date_from, date_to))


def summary_types(browser: str, date_from=None, date_to=None) -> str:
    return SUMMARIES[browser][0](_type_counts(browser, date_from, date_to))


def _sections(browser: str, date_from, date_to, zone="UTC") -> str:
    """Long form as a chain of CTEs ending in ``report``."""
    _, _, page, time, offset, timed, label = SUMMARIES[browser]
    basic = ["(1, 'total_visits', visits)", "(2, 'unique_urls', pages)"]
    if timed:
        basic.append("(3, 'total_hours', hours)")
    hours = f", CAST(({HOURS} / 100)::DOUBLE AS VARCHAR) AS hours" if timed else ""
    parts = [
        "SELECT 'basic' AS section, f.r AS rank, f.k AS key, f.v AS value FROM b, "
        f"LATERAL (VALUES {', '.join(basic)}) f(r, k, v)",
        "SELECT 'domains', row_number() OVER (ORDER BY cnt DESC, domain NULLS FIRST), domain, cnt::VARCHAR FROM d",
    ]
    if label:
        parts.append("SELECT 'types', row_number() OVER (ORDER BY cnt DESC, type), type, cnt::VARCHAR FROM t")
    types = f", t AS ({_type_counts(browser, date_from, date_to, zone)})" if label else ""
    return f""", b AS (
  SELECT count(*)::VARCHAR AS visits, count(DISTINCT {page})::VARCHAR AS pages{hours}
  FROM visits WHERE {between(time, date_from, date_to, offset, zone)}),
d AS ({_domain_counts(browser, date_from, date_to, zone)}){types},
report AS ({" UNION ALL ".join(parts)})"""


def summary(browser: str, date_from=None, date_to=None, zone="UTC") -> str:
    sql = SUMMARIES[browser][0]("@@")
    return sql.replace("\n@@", _sections(browser, date_from, date_to, zone) + "\nSELECT section, rank::INTEGER AS rank, key, value FROM report")


def summary_text(browser: str, date_from=None, date_to=None) -> str:
    name = browser.capitalize()
    fixed = [(0, 1, f"=== {name} History Summary ===")]
    fixed += [(0, 2, f"From: {date_from}")] if date_from else []
    fixed += [(0, 3, f"To: {date_to}")] if date_to else []
    titles = ["Basic Stats", "Top 10 Domains"]
    if SUMMARIES[browser][6]:
        titles.append("Transition Types" if browser == "chrome" else "Visit Types")
    for block, title in enumerate(titles, start=1):
        fixed += [(block, -1, ""), (block, 0, f"--- {title} ---")]
    rows = ", ".join(f"({b}, {n}, '{text}')" for b, n, text in fixed)
    line = """CASE key WHEN 'total_visits' THEN 'Total visits:    ' || value WHEN 'unique_urls' THEN 'Unique URLs:     ' || value
    WHEN 'total_hours' THEN 'Total duration:  ' || coalesce(value, '') || ' hours' END"""
    return summary(browser, date_from, date_to).replace(
        "\nSELECT section, rank::INTEGER AS rank, key, value FROM report",
        f"""
SELECT block::INTEGER AS block, line_no::INTEGER AS line_no, line FROM (
  SELECT * FROM (VALUES {rows}) f(block, line_no, line) UNION ALL
  SELECT 1, rank, {line} FROM report WHERE section = 'basic' UNION ALL
  SELECT 2, rank, '  ' || rpad(coalesce(key, ''), greatest(40, length(coalesce(key, '')))::INTEGER, ' ') || ' ' || value || ' visits'
  FROM report WHERE section = 'domains' UNION ALL
  SELECT 3, rank, '  ' || rpad(key, greatest(20, length(key))::INTEGER, ' ') || ' ' || value FROM report WHERE section = 'types')""",
    )


# ---- several profiles -----------------------------------------------------


def fleet_visits(limit: int, per_profile: bool) -> str:
    """The newest visits of two profiles, together or of each."""
    group = "PARTITION BY v.profile_id " if per_profile else ""
    return chromium_fleet(
        f"""SELECT {"profile_id, " if per_profile else ""}url, title, visit_time, duration_sec, transition, from_url FROM (
  SELECT v.profile_id, u.url, u.title, {webkit("v.visit_time")} AS visit_time,
    {rounded("v.visit_duration", 100000, 10)} AS duration_sec, {transition("v.transition")} AS transition,
    coalesce(origin.url, '') AS from_url,
    row_number() OVER ({group}ORDER BY v.visit_time DESC, v.profile_id, v.url, v.id) AS place
  FROM fleet_visits v JOIN fleet_urls u ON (u.profile_id, u.id) = (v.profile_id, v.url)
  LEFT JOIN (
    SELECT o.profile_id, o.id, p.url FROM fleet_visits o JOIN fleet_urls p ON (p.profile_id, p.id) = (o.profile_id, o.url)
  ) origin ON (origin.profile_id, origin.id) = (v.profile_id, v.from_visit))
WHERE place <= {limit}"""
    )


def profile_visits(profile: str) -> str:
    """All visits of one of the two profiles in the second week of the year."""
    return chromium_fleet(
        f"""SELECT u.url, u.title, {webkit("v.visit_time")} AS visit_time, {rounded("v.visit_duration", 100000, 10)} AS duration_sec,
  {transition("v.transition")} AS transition, coalesce(p.url, '') AS from_url
FROM fleet_visits v JOIN fleet_urls u ON (u.profile_id, u.id) = (v.profile_id, v.url)
LEFT JOIN fleet_visits o ON (o.profile_id, o.id) = (v.profile_id, v.from_visit)
LEFT JOIN fleet_urls p ON (p.profile_id, p.id) = (o.profile_id, o.url)
WHERE v.profile_id = '{profile}' AND {between("v.visit_time", "2024-01-08", "2024-01-14", WEBKIT_US)}"""
    )


def fleet_basic() -> str:
    return chromium_fleet(
        f"SELECT profile_id, count(*) AS total_visits, count(DISTINCT url) AS unique_urls, ({HOURS} / 100)::DOUBLE AS total_hours "
        "FROM fleet_visits GROUP BY profile_id"
    )


def fleet_domains() -> str:
    return chromium_fleet(
        f"""SELECT profile_id, domain, cnt FROM (
  SELECT v.profile_id, {domain("u.url")} AS domain, count(*) AS cnt
  FROM fleet_visits v JOIN fleet_urls u ON (u.profile_id, u.id) = (v.profile_id, v.url) GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY profile_id ORDER BY cnt DESC, domain NULLS FIRST) <= 10"""
    )


# ---- three snapshots of one profile -----------------------------------------

#: Every visit is in some snapshot. Those of the last quarter were first seen in the third, which renamed some pages.
SEEN = f"""
later AS (
  SELECT v.*, v.id - 1 AS e, u.id IS NOT NULL AS known, u.title,
    CASE WHEN (u.id - 1) % 19 = 0 AND v.id - 1 >= 3 * (n.event_rows // 4) THEN u.url || '#new' ELSE u.url END AS page_url,
    n.event_rows // 4 AS quarter
  FROM visits v CROSS JOIN n LEFT JOIN urls u ON u.id = v.url)"""


def history_visits() -> str:
    return with_tables(
        f"{CHROMIUM},{SEEN}",
        f"""SELECT v.page_url AS url, v.title, {webkit("v.visit_time")} AS visit_time,
  {rounded("v.visit_duration", 100000, 10)} AS duration_sec, {transition("v.transition")} AS transition,
  coalesce(o.page_url, '') AS from_url
FROM later v LEFT JOIN later o ON o.id = v.from_visit WHERE v.known""",
    )


def history_annotations() -> str:
    return with_tables(
        f"{CHROMIUM},{SEEN}",
        f"""SELECT v.page_url AS url, v.title, {webkit("v.visit_time")} AS visit_time, coalesce(a.categories, '') AS categories,
  coalesce(a.page_language, '') AS page_language, coalesce(a.search_terms, '') AS search_terms
FROM content_notes a JOIN later v ON v.id = a.visit_id WHERE v.known""",
    )


def history_basic() -> str:
    """Without the deleted visits: those still younger than the oldest one of the second snapshot."""
    return with_tables(
        f"{CHROMIUM},{SEEN}",
        f"""SELECT count(*) AS total_visits, count(DISTINCT (url, known AND (url - 1) % 19 = 0 AND e >= 3 * quarter)) AS unique_urls,
  ({HOURS} / 100)::DOUBLE AS total_hours
FROM later WHERE NOT (e % 41 = 0 AND e < 2 * quarter AND e > quarter // 2 + CASE WHEN quarter // 2 % 41 = 0 THEN 1 ELSE 0 END)""",
    )


# ---- saved tabs, sinks, profiles, ingest ----------------------------------


def saved_tabs(grouped: bool, limit: int = 100) -> str:
    date = "strftime(make_timestamp((1704067200 + p // 20 * 60) * 1000000), '%Y-%m-%d %H:%M:%S')" if grouped else "''"
    return with_tables(
        CHROMIUM,
        f"""SELECT url, title, group_date FROM (
  SELECT p, plain_url AS url, regexp_replace(page_title, '[^A-Za-z0-9 ]', '', 'g') AS title, {date} AS group_date,
    row_number() OVER (PARTITION BY plain_url ORDER BY p) AS copy FROM p)
WHERE copy = 1 AND length(title) <= 500 ORDER BY p{"" if limit <= 0 else f" LIMIT {limit}"}""",
    )


def odd_saved_tabs() -> str:
    return """WITH t AS (
  SELECT page_id AS p, page_id // 20 AS g,
    regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[^A-Za-z0-9 ]', '', 'g') AS said
  FROM pages),
k AS (SELECT *, g < 2 AS loose, g >= 2 AND g % 3 <> 0 AS grouped FROM t),
f AS (
  SELECT p, 'https://tab.example/' || CASE WHEN p % 10 IN (5, 6) THEN p - 5 WHEN p % 10 = 8 THEN p % 40 ELSE p END AS url,
    CASE p % 10 WHEN 0 THEN repeat('x', 500) WHEN 2 THEN CASE WHEN loose THEN 'ab ' || said ELSE said END WHEN 4 THEN ''
      ELSE said END AS title,
    CASE WHEN grouped THEN strftime(make_timestamp((1704067200 + g * 60) * 1000000), '%Y-%m-%d %H:%M:%S') ELSE '' END AS group_date,
    p % 10 = 1 OR p % 10 = 3 OR (p % 10 = 7 AND loose) AS unreadable,
    row_number() OVER (PARTITION BY CASE WHEN p % 10 IN (5, 6) THEN p - 5 WHEN p % 10 = 8 THEN p % 40 ELSE p END ORDER BY p) AS copy
  FROM k WHERE grouped OR (loose AND p % 10 <> 4))
SELECT url, title, group_date FROM f WHERE copy = 1 AND NOT unreadable"""


def lines(wrap, report: str, columns: list[str], sep: str) -> str:
    fields = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    return wrap(
        f"SELECT '{sep.join(columns)}' AS line UNION ALL SELECT concat_ws('{sep}', {fields}) AS line FROM (\n{report})"
    )


def profile_select(browser: str) -> str:
    if browser == "firefox":
        folder = """CASE page_id % 5 WHEN 0 THEN name || '.default-release' WHEN 1 THEN name || '.default'
      WHEN 2 THEN name || '.default-esr' ELSE 'work-' || name END"""
        file_name = "CASE WHEN page_id % 4 = 3 THEN 'prefs.js' ELSE 'places.sqlite' END"
        rank = "CASE WHEN dir LIKE '%.default-release' THEN 0 WHEN dir LIKE '%.default%' THEN 1 END"
        db, fallback, first = "places.sqlite", "places.sqlite", "FALSE"
    else:
        folder = "CASE WHEN page_id % 17 = 0 THEN 'Default' ELSE 'Profile ' || name END"
        file_name = "CASE WHEN page_id % 4 = 3 THEN 'Cookies' ELSE 'History' END"
        rank = "CASE WHEN dir LIKE 'Profile %' THEN 0 END"
        db, fallback, first = "History", "Default/History", "has_fallback"
    return f"""WITH l AS (
  SELECT '/fleet/' || page_id // 7 AS root, CASE WHEN page_id // 7 % 9 = 4 THEN NULL
    WHEN page_id % 11 = 0 THEN 'places.sqlite' ELSE {folder} || '/' || {file_name} END AS rel_path
  FROM (SELECT page_id, (page_id * 7919 % 13)::VARCHAR AS name FROM pages)),
d AS (
  SELECT root, rel_path, CASE WHEN rel_path LIKE '%/%' THEN split_part(rel_path, '/', 1) END AS dir FROM l),
c AS (
  SELECT root, dir, row_number() OVER (PARTITION BY root ORDER BY {rank}, dir) AS r FROM d
  WHERE {rank} IS NOT NULL GROUP BY root, dir),
r AS (SELECT root, coalesce(bool_or(rel_path = '{fallback}'), FALSE) AS has_fallback FROM l GROUP BY root)
SELECT root, CASE WHEN {first} THEN '{fallback}' WHEN usable THEN dir || '/{db}' ELSE '{fallback}' END AS db_path,
  has_fallback OR usable AS found
FROM (
  SELECT r.root, has_fallback, c.dir,
    c.dir IS NOT NULL AND EXISTS (
      SELECT 1 FROM l WHERE l.root = r.root AND l.rel_path = c.dir || '/{db}') AS usable
  FROM r LEFT JOIN c ON c.root = r.root AND c.r = 1)"""


def sqlite_ingest() -> str:
    return chromium(
        """SELECT 'f' || (id - 1) // 500 AS profile_id, id, url, visit_time, from_visit, transition, visit_duration
FROM visits WHERE (id - 1) // 500 % 10 <> 9"""
    )


def sqlite_rejected() -> str:
    return chromium("SELECT DISTINCT 'f' || (id - 1) // 500 AS profile_id FROM visits WHERE (id - 1) // 500 % 10 = 9")
