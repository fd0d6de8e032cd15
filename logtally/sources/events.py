"""Log lines written out from an ``events`` table, for runs without log files of their own.

Every event becomes one line. Most are well-formed; every so many events a line is blank, a
stack-trace line, lower-case, cut short, or carries a date that does not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# {MS}, {SEC} and {TMS} are the event time as text: with milliseconds, to the second, and with
# milliseconds and a T separator.
LINES_SQL = """
WITH b AS (SELECT event_id, user_id, event_type, {MS} AS ms, {SEC} AS sec, {TMS} AS tms FROM {events}),
m AS (SELECT *,
  CASE event_type
    WHEN 'error' THEN CASE WHEN event_id % 9 = 0 THEN 'FATAL' WHEN event_id % 9 = 1 THEN 'SEVERE' ELSE 'ERROR' END
    WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'WARN' ELSE 'WARNING' END
    WHEN 'click' THEN 'DEBUG'
    WHEN 'view' THEN 'INFO'
    ELSE CASE WHEN event_id % 5 = 0 THEN 'TRACE' ELSE 'INFO' END END AS lvl,
  CASE WHEN event_type = 'error' THEN CASE user_id % 10
    WHEN 0 THEN 'NullPointerException in Handler.get at line 142'
    WHEN 1 THEN 'Connection refused to database host db-1:5432'
    WHEN 2 THEN 'SQLException: deadlock detected on table orders'
    WHEN 3 THEN 'OutOfMemoryError: heap space'
    WHEN 4 THEN 'TimeoutException: remote call timed out after 5000ms'
    WHEN 5 THEN 'connection reset by peer'
    WHEN 6 THEN 'IllegalArgumentException: bad id'
    WHEN 7 THEN 'Failed: com.x.core.JsonParseException'
    WHEN 8 THEN 'HTTP 500 Internal Server Error'
    ELSE 'Authentication failed' END
  ELSE concat('user ', CAST(user_id AS STRING), ' did - ', event_type) END AS msg
  FROM b)
SELECT event_id + 1 AS line_number, concat('app_', CAST(event_id % 3 + 1 AS STRING), '.log') AS source_file,
  CASE
    WHEN event_id % 97 = 0 THEN '   '
    WHEN event_id % 89 = 0 THEN concat(chr(9), 'at com.example.Service.method(Service.java:', CAST(user_id AS STRING), ')')
    WHEN event_id % 83 = 0 THEN 'Something went wrong ERROR in the system: SQLException'
    WHEN event_id % 79 = 0 THEN concat(sec, ' info [t] com.x - lower case level, stacktrace')
    WHEN event_id % 73 = 0 THEN concat(sec, ' ERROR [t] com.x -  ')
    WHEN event_id % 71 = 0 THEN concat(sec, '.12 ERROR [t] com.x - two digit fraction timeout')
    WHEN event_id % 67 = 0 THEN concat('2024-02-30 08:15:32 ', lvl, ' [t] com.x - ', msg)
    ELSE concat('  ', CASE event_id % 3 WHEN 0 THEN ms WHEN 1 THEN sec ELSE tms END, ' ', lvl,
                '  [worker-', CAST(user_id % 8 AS STRING), '] com.example.', event_type, ' - ', msg) END AS raw
FROM m
"""

_SECONDS = "substr(CAST(ts AS STRING), 1, 19)"
_MILLIS = "rpad(substr(CAST(ts AS STRING), 21, 3), 3, '0')"
# Taken from the text of the zone-less time, so that no session time zone can shift it.
SPARK_TIME = {
    "MS": f"concat({_SECONDS}, '.', {_MILLIS})",
    "SEC": _SECONDS,
    "TMS": f"concat(replace({_SECONDS}, ' ', 'T'), '.', {_MILLIS})",
}


def log_lines_from_events(events: DataFrame) -> DataFrame:
    """``line_number``, ``source_file`` and ``raw`` of the lines written out from ``events``."""
    return events.sparkSession.sql(LINES_SQL.format(events="{events}", **SPARK_TIME), events=events)
