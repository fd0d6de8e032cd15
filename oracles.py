"""DuckDB statements that say what each query has to return, written apart from the Spark code."""

from __future__ import annotations

from logtally.sources.events import LINES_SQL

# The keywords of the sample configuration, the levels in report order, the error rules.
KEYWORDS = ("Exception", "Error", "timeout", "fail", "OOM", "connection refused", "deadlock")
LEVELS = ("FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE", "UNKNOWN")
RULES = (
    ("NullPointerException", "NullPointerException"),
    ("OutOfMemoryError", "OutOfMemoryError"),
    ("Timeout/TimedOut", "timeout|timed.?out"),
    ("Connection Failure", "connection.?(refused|reset|closed)"),
    ("SQL/Deadlock", "SQLException|deadlock"),
)
SEED = 7
GENERATED_FILES = 3
# The line pattern, and one of three groups.
PATTERN = (
    r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?)\s+"
    r"(TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL|SEVERE)\s+\[?([^\]]+?)\]?\s+([\w\.]+)\s+-\s+(.*)$"
)
SHORT_PATTERN = r"(\S+[T ]\S+)\s+([A-Z]+)\s+\[([^\]]*)\].*"
FILE_NAMES = ("007", "7", "20240601", "2024-06-01", "app[1].log", "a+b c%20.log", "1e3", "true")
TIME_FORMATS = ("d MMM yyyy HH:mm[:ss]", "M/d/yyyy h:mm a", "EEE, dd MMMM yyyy HH:mm:ss", "yyyyMMdd'T'HHmmss[.SSS]['Z']")
# Texts in these formats made from each event; read by both engines.
WRITTEN_TIMES = """
  SELECT event_id, CASE event_id % 12
    WHEN 0 THEN concat(d, ' ', mon, ' ', y, ' ', hh, ':', mi) WHEN 1 THEN concat(d, ' ', mon, ' ', y, ' ', hh, ':', mi, ':', se)
    WHEN 2 THEN concat(m, '/', d, '/', y, ' ', h12, ':', mi, ' ', ap) WHEN 3 THEN concat(y, mm, dd, 'T', hh, mi, se)
    WHEN 4 THEN concat(y, mm, dd, 'T', hh, mi, se, '.250Z') WHEN 5 THEN concat(y, mm, dd, 'T', hh, mi, se, 'Z')
    WHEN 6 THEN concat('10 Mar ', y, ' 02:30') WHEN 7 THEN concat('31 Apr ', y, ' ', hh, ':', mi)
    WHEN 8 THEN concat('2/30/', y, ' ', h12, ':', mi, ' ', ap) WHEN 9 THEN concat(d, ' ', upper(mon), ' ', y, ' ', hh, ':', mi)
    WHEN 10 THEN concat(y, mm, dd, 'T', hh, mi, se, '.25') ELSE concat('13/1/', y, ' ', h12, ':', mi, ' ', ap) END AS text
  FROM (
    SELECT event_id, substr(t, 1, 4) AS y, substr(t, 6, 2) AS mm, substr(t, 9, 2) AS dd, substr(t, 12, 2) AS hh,
      substr(t, 15, 2) AS mi, substr(t, 18, 2) AS se, CAST(CAST(substr(t, 6, 2) AS INT) AS VARCHAR(2)) AS m,
      CAST(CAST(substr(t, 9, 2) AS INT) AS VARCHAR(2)) AS d,
      substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(substr(t, 6, 2) AS INT) * 3 - 2, 3) AS mon,
      CAST((CAST(substr(t, 12, 2) AS INT) + 11) % 12 + 1 AS VARCHAR(2)) AS h12,
      CASE WHEN CAST(substr(t, 12, 2) AS INT) < 12 THEN 'AM' ELSE 'PM' END AS ap
    FROM (SELECT event_id, substr(CAST(ts AS VARCHAR(40)), 1, 19) AS t FROM {events}) AS t1) AS t2"""

_LINES = LINES_SQL.format(
    events="events",
    MS="strftime(ts, '%Y-%m-%d %H:%M:%S.%g')",
    SEC="strftime(ts, '%Y-%m-%d %H:%M:%S')",
    TMS="strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')",
)


def _trim(x: str) -> str:
    return f"trim({x}, chr(9) || chr(10) || chr(13) || ' ')"


def _level(x: str) -> str:
    token = f"upper({_trim(x)})"
    return (
        f"CASE {token} WHEN 'WARNING' THEN 'WARN' WHEN 'SEVERE' THEN 'ERROR' "
        + " ".join(f"WHEN '{name}' THEN '{name}'" for name in LEVELS[:-1])
        + " ELSE 'UNKNOWN' END"
    )


def _fallback(x: str) -> str:
    order = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")
    return "CASE " + " ".join(f"WHEN contains(upper({x}), '{n}') THEN '{n}'" for n in order) + " ELSE 'UNKNOWN' END"


def _timestamp(x: str) -> str:
    """Text to timestamp: day clamped to its month, 24:00:00 the next midnight, else null."""
    year, month, day, hour, minute, second = (
        f"TRY_CAST(substr({x}, {position}, {width}) AS INT)"
        for position, width in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))
    )
    millis = f"coalesce(TRY_CAST(nullif(substr({x}, 21, 3), '') AS INT), 0)"
    return (
        rf"CASE WHEN regexp_full_match({x}, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}})?') "
        f"AND {year} >= 1 AND {month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31 AND {minute} <= 59 AND {second} <= 59 "
        f"AND ({hour} <= 23 OR ({hour} = 24 AND {minute} = 0 AND {second} = 0 AND {millis} = 0)) "
        f"THEN CAST(make_date({year}, {month}, least({day}, day(last_day(make_date({year}, {month}, 1))))) AS TIMESTAMP) "
        f"+ to_milliseconds((({hour} * 60 + {minute}) * 60 + {second}) * 1000 + {millis}) END"
    )


ENTRIES = f"""
WITH lines AS ({_LINES}),
matched AS (
  SELECT *, regexp_full_match(t, '{PATTERN}') AS ok,
    regexp_extract(t, '{PATTERN}', ['stamp', 'lvl', 'thread', 'logger', 'message']) AS g
  FROM (SELECT *, {_trim("raw")} AS t FROM lines)),
parsed AS (
  SELECT line_number, source_file, raw,
    CASE WHEN ok THEN {_timestamp("g.stamp")} END AS ts,
    CASE WHEN ok THEN {_level("g.lvl")} ELSE {_fallback("raw")} END AS level,
    CASE WHEN ok THEN {_trim("g.thread")} ELSE 'unknown' END AS thread,
    CASE WHEN ok THEN {_trim("g.logger")} ELSE 'unknown' END AS logger,
    CASE WHEN ok THEN {_trim("g.message")} ELSE raw END AS message
  FROM matched),
entries AS (
  SELECT *, level = 'UNKNOWN' AND ts IS NULL AS malformed, strftime(ts, '%Y-%m-%d %H') AS hour FROM parsed)
"""

_RULE_HITS = " UNION ALL ".join(
    f"SELECT '{name}' AS pattern FROM errors WHERE regexp_matches(message, '(?i){regex}')" for name, regex in RULES
)
_NAMES = (
    r"SELECT regexp_extract(message, '\b(\w*(?:Exception|Error))\b', 1) AS pattern FROM errors "
    r"WHERE regexp_matches(message, '\b(\w*(?:Exception|Error))\b')"
)
PATTERNS = (
    ENTRIES
    + f""", errors AS (SELECT * FROM entries WHERE level IN ('ERROR', 'FATAL')),
patterns AS (SELECT pattern, count(*) AS count FROM ({_RULE_HITS} UNION ALL {_NAMES}) GROUP BY pattern)"""
)
_KEYWORD_LIST = ", ".join(f"'{kw}'" for kw in KEYWORDS)
KEYWORD_ROWS = f""", keyword_rows AS (
  SELECT entries.*, keyword FROM entries, (SELECT unnest([{_KEYWORD_LIST}]) AS keyword)
  WHERE contains(lower(raw), lower(keyword)))"""
_LEVEL_DIMENSION = "(VALUES " + ", ".join(f"({i}, '{name}')" for i, name in enumerate(LEVELS)) + ") AS d(ordinal, level)"
LEVEL_COUNTS = f""", level_counts AS (
  SELECT d.level, d.ordinal, count(e.level) AS count FROM {_LEVEL_DIMENSION} LEFT JOIN entries e ON e.level = d.level
  GROUP BY d.level, d.ordinal)"""
METRICS = (
    PATTERNS
    + KEYWORD_ROWS
    + LEVEL_COUNTS
    + """, metrics AS (
  SELECT 'total' AS metric, '' AS key, count(*) AS count FROM entries
  UNION ALL SELECT 'processed', '', count(*) FROM entries
  UNION ALL SELECT 'malformed', '', count(*) FILTER (malformed) FROM entries
  UNION ALL SELECT 'level', level, count FROM level_counts
  UNION ALL SELECT 'pattern', pattern, count FROM patterns
  UNION ALL SELECT 'keyword', keyword, count(*) FROM keyword_rows GROUP BY keyword
  UNION ALL SELECT 'hour', hour, count(*) FROM entries WHERE ts IS NOT NULL GROUP BY hour
  UNION ALL SELECT 'file', source_file, count(*) FROM entries GROUP BY source_file)"""
)
_ALL_METRICS = METRICS + " SELECT metric, key, count FROM metrics"


def _bar(pct: str, width: int) -> str:
    filled = f"CAST(floor({pct} / 100.0 * {width} + 0.5) AS BIGINT)"
    return f"repeat('█', {filled}) || repeat('░', {width} - {filled})"


def _number(x: str, width: int = 0) -> str:
    text = f"format('{{:,}}', CAST({x} AS BIGINT))"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, ' ') ELSE {text} END" if width else text


def _padded(x: str, width: int) -> str:
    return f"CASE WHEN length({x}) < {width} THEN rpad({x}, {width}, ' ') ELSE {x} END"


_ISO = """CASE WHEN ts IS NULL THEN 'null'
  WHEN date_part('second', ts) = 0 AND date_part('microsecond', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M')
  WHEN date_part('microsecond', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END"""

# Text for level and timestamp parsing made from each event; read by both engines.
TOKENS = """
  SELECT event_id, CASE event_id % 13
    WHEN 0 THEN 'INFO' WHEN 1 THEN 'WARN' WHEN 2 THEN 'WARNING' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'SEVERE'
    WHEN 5 THEN 'DEBUG' WHEN 6 THEN 'TRACE' WHEN 7 THEN 'FATAL' WHEN 8 THEN 'GARBAGE' WHEN 9 THEN ' info '
    WHEN 10 THEN concat(chr(9), 'Severe') WHEN 11 THEN event_type END AS token FROM {events}"""
STAMPS = """
  SELECT event_id, CASE event_id % 16
    WHEN 0 THEN sec WHEN 1 THEN concat(sec, '.120') WHEN 2 THEN replace(sec, ' ', 'T')
    WHEN 3 THEN concat(replace(sec, ' ', 'T'), '.007') WHEN 4 THEN concat(sec, '.5') WHEN 5 THEN concat(sec, '.1234')
    WHEN 6 THEN concat(substr(sec, 1, 8), '31', substr(sec, 11)) WHEN 7 THEN concat(substr(sec, 1, 8), '32', substr(sec, 11))
    WHEN 8 THEN concat(substr(sec, 1, 10), ' 24:00:00') WHEN 9 THEN concat(substr(sec, 1, 10), ' 24:00:01')
    WHEN 10 THEN concat(substr(sec, 1, 17), '60') WHEN 11 THEN concat('0000', substr(sec, 5))
    WHEN 12 THEN concat('2023-02-29T', substr(sec, 12), '.123') WHEN 13 THEN concat(substr(sec, 1, 5), '13', substr(sec, 8))
    WHEN 14 THEN concat(' ', sec, chr(9)) ELSE concat(sec, ' PM') END AS text
  FROM (SELECT event_id, substr(CAST(ts AS VARCHAR(40)), 1, 19) AS sec FROM {events}) AS t"""

_LEVEL_LINE = (
    f"'  ' || {_padded('level', 8)} || ' : ' || {_number('count', 7)} || '  (' || "
    "lpad(CAST(CAST(round(pct, 1) AS DECIMAL(5, 1)) AS VARCHAR), 5, ' ') || '%)  ' || " + _bar("pct", 30)
)
REPORT = (
    METRICS
    + f""", of_level AS (SELECT level, ordinal, count, count * 100.0::DOUBLE / sum(count) OVER () AS pct FROM level_counts),
of_hour AS (SELECT key, count, count * 100.0::DOUBLE / max(count) OVER () AS pct FROM metrics WHERE metric = 'hour'),
of_pattern AS (SELECT *, row_number() OVER (ORDER BY count DESC, pattern) AS rank FROM patterns),
spread AS (SELECT count(*) AS total, count(*) FILTER (malformed) AS malformed, min(ts) AS earliest, max(ts) AS latest,
  count(DISTINCT source_file) AS files FROM entries),
headings AS (
  SELECT * FROM (VALUES (1, '▶ OVERVIEW'), (2, '▶ LOG LEVEL DISTRIBUTION'), (3, '▶ TOP ERROR PATTERNS'),
    (4, '▶ KEYWORD SEARCH RESULTS'), (5, '▶ HOURLY ACTIVITY'), (6, '▶ PER-FILE STATISTICS')) AS h(section, heading)
  WHERE (section <> 4 OR EXISTS (SELECT * FROM metrics WHERE metric = 'keyword'))
    AND (section <> 5 OR EXISTS (SELECT * FROM metrics WHERE metric = 'hour'))
    AND (section <> 6 OR (SELECT files FROM spread) > 1))
SELECT CAST(section AS INT) AS section, CAST(place AS INT) AS place, CAST(rank AS BIGINT) AS rank, key, line FROM (
  SELECT 0 AS section, 0 AS place, 0 AS rank, '' AS key, '' AS line
  UNION ALL SELECT 0, 0, 1, '', repeat('═', 70) UNION ALL SELECT 0, 0, 2, '', '   LOG ANALYSIS REPORT'
  UNION ALL SELECT 0, 0, 3, '', repeat('═', 70) UNION ALL SELECT 0, 3, 0, '', ''
  UNION ALL SELECT 7, 0, 0, '', repeat('═', 70)
  UNION ALL SELECT section, 0, 0, '', heading FROM headings
  UNION ALL SELECT section, 1, 0, '', repeat('─', 70) FROM headings
  UNION ALL SELECT section, 3, 0, '', '' FROM headings
  UNION ALL SELECT 1, 2, 0, '', '  Total Lines Read   : ' || {_number('total')} FROM spread
  UNION ALL SELECT 1, 2, 1, '', '  Parsed Entries     : ' || {_number('total')} FROM spread
  UNION ALL SELECT 1, 2, 2, '', '  Malformed Lines    : ' || {_number('malformed')} FROM spread
  UNION ALL SELECT 1, 2, 3, '', '  Earliest Timestamp : ' || strftime(earliest, '%Y-%m-%d %H:%M:%S') FROM spread
    WHERE earliest IS NOT NULL
  UNION ALL SELECT 1, 2, 4, '', '  Latest Timestamp   : ' || strftime(latest, '%Y-%m-%d %H:%M:%S') FROM spread
    WHERE latest IS NOT NULL
  UNION ALL SELECT 2, 2, ordinal + 1, level, {_LEVEL_LINE} FROM of_level WHERE count > 0
  UNION ALL SELECT 3, 2, rank, pattern, '  ' || lpad(CAST(rank AS VARCHAR), 2, ' ') || '. ' || {_padded('pattern', 40)}
    || '  ' || {_number('count')} || ' occurrences' FROM of_pattern WHERE rank <= 10
  UNION ALL SELECT 3, 2, 0, '', '  (no errors detected)' WHERE NOT EXISTS (SELECT * FROM patterns)
  UNION ALL SELECT 4, 2, -count, key, '  ' || {_padded('key', 25)} || ' : ' || {_number('count')} || ' hits'
    FROM metrics WHERE metric = 'keyword'
  UNION ALL SELECT 5, 2, 0, key, '  ' || key || '  ' || {_number('count', 6)} || '  ' || {_bar('pct', 40)} FROM of_hour
  UNION ALL SELECT 6, 2, -count, key, '  ' || {_padded('key', 40)} || '  ' || {_number('count')} || ' lines'
    FROM metrics WHERE metric = 'file' AND (SELECT files FROM spread) > 1)"""
)


_SHORT = f"""
WITH lines AS ({_LINES}),
matched AS (SELECT *, regexp_full_match(t, '{SHORT_PATTERN}') AS ok,
    regexp_extract(t, '^(?:{SHORT_PATTERN})$', ['stamp', 'lvl', 'thread']) AS g
  FROM (SELECT *, {_trim("raw")} AS t FROM lines))
SELECT source_file, line_number, CASE WHEN ok THEN {_timestamp("g.stamp")} END AS ts,
  CASE WHEN ok THEN {_level("g.lvl")} ELSE {_fallback("raw")} END AS level,
  CASE WHEN ok THEN {_trim("g.thread")} ELSE 'unknown' END AS thread, 'unknown' AS logger, raw AS message
FROM matched
"""


def _generated() -> str:
    from logtally.sources import synthetic as s

    def draw(number: int, below: int) -> str:
        return f"(CAST(('0x' || substr(digest, {1 + 5 * number}, 5)) AS INT) % {below})"

    def pick(values: tuple[str, ...], index: str) -> str:
        return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][{index} + 1]"

    message = "CASE level " + " ".join(
        f"WHEN '{level}' THEN {pick(values, draw(4, len(values)))}" for level, values in s.MESSAGES.items()
    )
    message = f"replace({message} END, '{{}}', CAST({draw(3, 9000)} + 1000 AS VARCHAR))"
    traced = f"(level IN ('ERROR', 'FATAL') AND {draw(7, 100)} < 30)"
    at_service, at_controller, cause = (f"chr(9) || '{text[1:]}'" for text in (s.AT_SERVICE, s.AT_CONTROLLER, s.CAUSE))
    return f"""
WITH ids AS (SELECT event_id % {GENERATED_FILES} + 1 AS file, event_id // {GENERATED_FILES} AS record FROM events),
drawn AS (SELECT *, sha256('{SEED}|' || file || '|' || record) AS digest FROM ids),
leveled AS (SELECT *, {pick(s.LEVELS, draw(0, 9))} AS level,
  sum({draw(1, 500)} + 1) OVER (PARTITION BY file ORDER BY record) AS millis FROM drawn),
timed AS (SELECT *, TIMESTAMP '2024-06-01 08:00:00' + to_hours(CAST((file - 1) * 8 AS INT))
  + to_milliseconds(CAST(millis AS BIGINT)) AS ts FROM leveled),
written AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST({draw(2, 1000)} AS VARCHAR), 3, '0') || ' '
  || rpad(level, 5, ' ') || ' [' || {pick(s.THREADS, draw(5, 8))} || '] ' || {pick(s.LOGGERS, draw(6, 9))} || ' - '
  || {message} AS line FROM timed)
SELECT 'app_' || file || '.log' AS source_file, record, part, raw FROM (
  SELECT file, record, 0 AS part, line AS raw FROM written
  UNION ALL SELECT file, record, 1, {at_service} || CAST({draw(8, 491)} + 10 AS VARCHAR) || ')' FROM written WHERE {traced}
  UNION ALL SELECT file, record, 2, {at_controller} || CAST({draw(9, 291)} + 10 AS VARCHAR) || ')' FROM written WHERE {traced}
  UNION ALL SELECT file, record, 3, {cause} FROM written WHERE {traced} AND {draw(10, 100)} < 50)"""


_ENTRY_COLUMNS = "source_file, line_number, ts, level, thread, logger, message, raw, malformed, hour"
ORACLES = {
    "scan_logs": ENTRIES + " SELECT source_file, raw FROM entries",
    "line_numbers": ENTRIES
    + " SELECT source_file, raw, row_number() OVER (PARTITION BY source_file ORDER BY entries.line_number) AS line_number"
    " FROM entries",
    "parse_logs": ENTRIES + f" SELECT {_ENTRY_COLUMNS} FROM entries",
    "fallback_level": ENTRIES + f" SELECT source_file, line_number, {_fallback('raw')} AS level FROM entries",
    "normalize_level": f"SELECT event_id, token, {_level('token')} AS level FROM ({TOKENS.format(events='events')})",
    "parse_timestamps": f"SELECT event_id, text, {_timestamp(_trim('text'))} AS ts FROM ({STAMPS.format(events='events')})",
    "entry_display": ENTRIES
    + f" SELECT source_file, line_number, '[' || level || '] ' || {_ISO} || ' ' || logger || ' - ' || message AS display"
    " FROM entries",
    "error_entries": ENTRIES + f" SELECT {_ENTRY_COLUMNS} FROM entries WHERE level IN ('ERROR', 'FATAL')",
    "keyword_lines": ENTRIES
    + KEYWORD_ROWS
    + " SELECT DISTINCT source_file, line_number, raw FROM keyword_rows",
    "keyword_search": ENTRIES + KEYWORD_ROWS + " SELECT source_file, line_number, raw, keyword FROM keyword_rows",
    "error_pattern_rows": PATTERNS
    + " SELECT source_file, line_number, pattern FROM ("
    + " UNION ALL ".join(
        f"SELECT source_file, line_number, '{name}' AS pattern FROM errors WHERE regexp_matches(message, '(?i){regex}')"
        for name, regex in RULES
    )
    + " UNION ALL SELECT source_file, line_number, pattern FROM (SELECT *, "
    + r"regexp_extract(message, '\b(\w*(?:Exception|Error))\b', 1) AS pattern FROM errors) WHERE pattern <> '')",
    "overview": ENTRIES
    + " SELECT count(*) AS total, count(*) AS processed, count(*) FILTER (malformed) AS malformed,"
    " min(ts) AS earliest, max(ts) AS latest FROM entries",
    "level_counts": ENTRIES + LEVEL_COUNTS + " SELECT level, count, ordinal FROM level_counts",
    "error_patterns": PATTERNS + " SELECT pattern, count FROM patterns",
    "baseline_patterns": ENTRIES
    + ", errors AS (SELECT * FROM entries WHERE level IN ('ERROR', 'FATAL')) SELECT pattern, count(*) AS count FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS pattern FROM errors WHERE regexp_matches(message, '(?i){regex}')" for name, regex in RULES[:2]
    )
    + f" UNION ALL {_NAMES}) GROUP BY pattern",
    "baseline_metrics": METRICS.replace(_RULE_HITS, _RULE_HITS.split(" UNION ALL SELECT 'Timeout")[0])
    + " SELECT metric, key, count FROM metrics WHERE metric <> 'malformed'",
    "top_error_patterns": PATTERNS
    + " SELECT pattern, count, CAST(row_number() OVER (ORDER BY count DESC, pattern) AS INT) AS rank FROM patterns"
    " ORDER BY count DESC, pattern LIMIT 10",
    "heavy_error_patterns": PATTERNS
    + " SELECT pattern, count, CAST(row_number() OVER (ORDER BY count DESC, pattern) AS INT) AS rank FROM patterns"
    " ORDER BY count DESC, pattern LIMIT 10",
    "keyword_hits": ENTRIES
    + KEYWORD_ROWS
    + " SELECT keyword, count(*) AS count FROM keyword_rows GROUP BY keyword ORDER BY 2 DESC, 1",
    "hourly_activity": ENTRIES
    + " SELECT hour, count(*) AS count FROM entries WHERE ts IS NOT NULL GROUP BY hour ORDER BY hour",
    "file_counts": ENTRIES
    + " SELECT source_file, count(*) AS count FROM entries GROUP BY source_file ORDER BY 2 DESC, 1",
    "level_distribution": ENTRIES
    + LEVEL_COUNTS
    + f" SELECT level, count, ordinal, pct, {_bar('pct', 30)} AS bar FROM"
    " (SELECT *, count * 100.0::DOUBLE / sum(count) OVER () AS pct FROM level_counts) WHERE count > 0 ORDER BY ordinal",
    "hourly_profile": ENTRIES
    + f" SELECT hour, count, pct, {_bar('pct', 40)} AS bar FROM (SELECT hour, count(*) AS count,"
    " count(*) * 100.0::DOUBLE / max(count(*)) OVER () AS pct FROM entries WHERE ts IS NOT NULL GROUP BY hour)",
    "chronological": ENTRIES
    + " SELECT source_file, line_number, ts, level FROM entries ORDER BY ts NULLS LAST, source_file, line_number",
    "chronological_once": ENTRIES
    + " SELECT source_file, line_number, ts, level FROM entries ORDER BY ts NULLS LAST, source_file, line_number",
    "dedupe_entries": ENTRIES + f" SELECT {_ENTRY_COLUMNS} FROM entries",
    "all_metrics": _ALL_METRICS,
    "report_lines": REPORT,
    "stream_metrics": _ALL_METRICS,
    "stream_merged_metrics": _ALL_METRICS,
    "stream_time_range": ENTRIES + " SELECT min(ts) AS earliest, max(ts) AS latest FROM entries",
    "stream_alerts": ENTRIES + " SELECT source_file, level, raw FROM entries WHERE level IN ('ERROR', 'FATAL')",
    "stream_hours": ENTRIES
    + " SELECT hour, count(*) AS count FROM entries WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR"
    " <= (SELECT max(ts) FROM entries) - INTERVAL 6 HOURS GROUP BY hour",
    "stream_expiring_metrics": _ALL_METRICS,
    "stream_distinct_lines": ENTRIES + " SELECT source_file, level, raw FROM entries WHERE ts IS NOT NULL",
    "stream_after_batch": _ALL_METRICS,
    "stream_after_batch_overview": ENTRIES
    + " SELECT count(*) AS total, count(*) AS processed, count(*) FILTER (malformed) AS malformed,"
    " min(ts) AS earliest, max(ts) AS latest FROM entries",
    "tail_metrics": _ALL_METRICS,
    "tail_events": ENTRIES + " SELECT raw, 'app.log' AS source_file FROM entries",
    "monitor_metrics": _ALL_METRICS,
    "monitor_report": REPORT,
    "named_files": ENTRIES
    + f" SELECT {list(FILE_NAMES)}[line_number % {len(FILE_NAMES)} + 1] AS source_file, count(*) AS count FROM entries GROUP BY 1",
    "written_report": f"SELECT line FROM ({REPORT}) WHERE line <> ''",
    "short_pattern": _SHORT,
    "any_format": f"""
      SELECT event_id, text, CASE event_id % 12
        WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN ts WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN ts
        WHEN 4 THEN ts + INTERVAL 250 MILLISECONDS WHEN 5 THEN ts WHEN 6 THEN make_timestamp(year(ts), 3, 10, 2, 30, 0)
        WHEN 7 THEN make_timestamp(year(ts), 4, 30, hour(ts), minute(ts), 0)
        WHEN 8 THEN make_timestamp(year(ts), 2, day(last_day(make_date(year(ts), 2, 1))), hour(ts), minute(ts), 0) END AS ts
      FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events) JOIN ({WRITTEN_TIMES.format(events="events")}) USING (event_id)""",
    "generate_logs": _generated(),
}
