from __future__ import annotations

import calendar
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from logtally import entry_display, error_entries, parse_logs
from logtally.functions.levels import fallback_level, normalize_level
from logtally.functions.matching import DEFAULT_PATTERN
from logtally.functions.timestamps import hour_bucket, hour_label, hour_number, iso_local, parse_timestamp

D = dt.datetime


def one(lines_of, raw, **options):
    return parse_logs(lines_of(raw), **options).first()


def test_well_formed_line(lines_of):
    raw = "2024-06-01 08:15:32.123 INFO  [main] com.example.App - Application started"
    entry = one(lines_of, raw)
    assert entry.ts == D(2024, 6, 1, 8, 15, 32, 123000)
    assert (entry.level, entry.thread, entry.logger) == ("INFO", "main", "com.example.App")
    assert (entry.message, entry.raw) == ("Application started", raw)
    assert (entry.malformed, entry.hour) == (False, "2024-06-01 08")


def test_error_line(lines_of):
    raw = "2024-06-01 09:00:01.000 ERROR [http-nio-8080-exec-1] com.example.Svc - NullPointerException in handler"
    entry = one(lines_of, raw)
    assert entry.level == "ERROR" and "NullPointerException" in entry.message


def test_fallback_finds_the_level(lines_of):
    entry = one(lines_of, "Something went wrong ERROR in the system")
    assert (entry.level, entry.ts, entry.thread, entry.logger) == ("ERROR", None, "unknown", "unknown")
    assert not entry.malformed


@pytest.mark.parametrize("raw", [None, "", "   ", "\t  "])
def test_null_and_blank_lines_are_malformed(lines_of, raw):
    entry = one(lines_of, raw)
    assert (entry.level, entry.ts, entry.malformed) == ("UNKNOWN", None, True)
    assert entry.raw == entry.message == (raw or "")


def test_blank_line_never_matches_a_pattern_for_anything(lines_of):
    assert one(lines_of, "   ", pattern="(.*)(.*)").thread == "unknown"


@pytest.mark.parametrize(
    ("raw", "level", "thread", "logger", "message"),
    [
        ("2024-06-01 08:15:32 INFO [t] l -", "INFO", "unknown", "unknown", None),
        ("2024-06-01 08:15:32 INFO [t] l -  ", "INFO", "unknown", "unknown", None),
        ("2024-06-01 08:15:32 info [t] l - lower", "INFO", "unknown", "unknown", None),
        ("x ERROR stacktrace", "TRACE", "unknown", "unknown", None),
        ("information about an ERROR", "INFO", "unknown", "unknown", None),
        ("SEVERE FAILED", "UNKNOWN", "unknown", "unknown", None),
        ("2024-06-01 08:15:32 INFO com.Foo - a b - c", "INFO", "com.Foo - a", "b", "c"),
        ("2024-06-01 08:15:32 WARNING pool 1 com.x - a - b", "WARN", "pool 1", "com.x", "a - b"),
        ("\t2024-06-01T08:15:32 SEVERE [t] l - m \x1f", "ERROR", "t", "l", "m"),
        ("2024-06-01 08:15:32 INFO [t] l - a\x01b", "INFO", "t", "l", "a\x01b"),
        ("no match \x01 here FATAL", "FATAL", "unknown", "unknown", None),
    ],
)
def test_line_shapes(lines_of, raw, level, thread, logger, message):
    entry = one(lines_of, raw)
    expected = raw if message is None else message
    assert (entry.level, entry.thread, entry.logger, entry.message) == (level, thread, logger, expected)


def test_pattern_must_match_the_whole_line(lines_of):
    pattern = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (\w+)"
    whole, more = "2024-06-01 08:15:32 FATAL", "2024-06-01 08:15:32 FATAL x"
    assert one(lines_of, whole, pattern=pattern).ts is not None
    assert one(lines_of, more, pattern=pattern).ts is None


def test_groups_the_pattern_lacks(lines_of):
    raw = "2024-06-01 08:15:32 FATAL  worker "
    two = one(lines_of, raw, pattern=r"([\d: -]+) (\w+)\s+\w+")
    assert (two.level, two.thread, two.logger, two.message) == ("FATAL", "unknown", "unknown", raw)
    three = one(lines_of, raw, pattern=r"([\d: -]+) (\w+)\s+(\w+)")
    assert (three.thread, three.logger, three.message) == ("worker", "unknown", raw)
    with pytest.raises(ValueError, match="group"):
        one(lines_of, raw, pattern=r"(.*)")


def test_group_that_takes_no_part_is_empty(lines_of):
    entry = one(lines_of, "2024-06-01 08:15:32 INFO x", pattern=r"([\d: -]{19}) (\w+)(?: \[(\w+)\])? (\w)(-)?")
    assert (entry.thread, entry.logger, entry.message) == ("", "x", "")


def test_unknown_level_with_a_time_is_not_malformed(lines_of):
    entry = one(lines_of, "2024-06-01 08:15:32 NOTICE", pattern=r"([\d: -]{19}) (\w+)")
    assert (entry.level, entry.malformed) == ("UNKNOWN", False)


@pytest.mark.parametrize(
    ("token", "level"),
    [
        ("INFO", "INFO"), ("WARN", "WARN"), ("WARNING", "WARN"), ("ERROR", "ERROR"), ("SEVERE", "ERROR"),
        ("DEBUG", "DEBUG"), ("TRACE", "TRACE"), ("FATAL", "FATAL"), ("GARBAGE", "UNKNOWN"), (" warn\t", "WARN"),
        ("UNKNOWN", "UNKNOWN"), (None, "UNKNOWN"), ("", "UNKNOWN"),
    ],
)
def test_normalize_level(spark, token, level):
    frame = spark.createDataFrame([(token,)], "token string")
    assert frame.select(normalize_level(F.col("token"))).first()[0] == level


def test_fallback_order(spark):
    names = ["FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE"]
    rows = [(" ".join(names[:n]),) for n in range(len(names) + 1)]
    got = [r[0] for r in spark.createDataFrame(rows, "raw string").select(fallback_level(F.col("raw"))).collect()]
    assert got == ["UNKNOWN", *names]


STAMPS = [
    ("2024-06-01 08:15:32.5", None),
    ("2024-06-01 08:15:32.1234", None),
    ("2024-06-01 08:15", None),
    ("2024-06-01  08:15:32", None),
    ("2024-02-30 08:15:32", D(2024, 2, 29, 8, 15, 32)),
    ("2023-02-29T08:15:32.123", D(2023, 2, 28, 8, 15, 32, 123000)),
    ("2024-04-31 08:15:32.999", D(2024, 4, 30, 8, 15, 32, 999000)),
    ("2024-06-01 24:00:00", D(2024, 6, 2)),
    ("2024-02-30T24:00:00.000", D(2024, 3, 1)),
    ("2024-06-01 24:00:01", None),
    ("2024-06-01 24:00:00.001", None),
    ("2024-06-01 23:59:60", None),
    ("2024-06-01 23:60:00", None),
    ("2024-13-01 00:00:00", None),
    ("2024-00-01 00:00:00", None),
    ("2024-04-32 00:00:00", None),
    ("2024-04-00 00:00:00", None),
    ("0000-01-01 00:00:00", None),
    ("0001-01-01 00:00:00", D(1, 1, 1)),
    (" \t2024-06-01T08:15:32.001\x0b", D(2024, 6, 1, 8, 15, 32, 1000)),
    # Gap and overlap of the session zone.
    ("2024-03-10 02:30:00", D(2024, 3, 10, 2, 30)),
    ("2024-11-03 01:30:00", D(2024, 11, 3, 1, 30)),
    ("", None),
    (None, None),
]


def test_timestamps(spark):
    frame = spark.createDataFrame([(text,) for text, _ in STAMPS], "text string")
    ts = parse_timestamp(F.col("text"))
    rows = frame.select("text", ts.alias("ts"), hour_bucket(ts).alias("hour"), hour_label(hour_number(ts)).alias("label"))
    for row, (text, expected) in zip(rows.collect(), STAMPS, strict=True):
        assert row.ts == expected, text
        assert row.hour == row.label == (f"{expected:%Y-%m-%d %H}".rjust(13, "0") if expected else None), text


def by_rule(text: str) -> D | None:
    """The same rules, written down for one text."""
    match = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)[ T](\d\d):(\d\d):(\d\d)(?:\.(\d{3}))?", text)
    if not match:
        return None
    year, month, day, hour, minute, second, milli = (int(g or 0) for g in match.groups())
    if not (year and 1 <= month <= 12 and 1 <= day <= 31 and minute < 60 and second < 60):
        return None
    if hour > 24 or (hour == 24 and (minute or second or milli)):
        return None
    day = min(day, calendar.monthrange(year, month)[1])
    return D(year, month, day) + dt.timedelta(hours=hour, minutes=minute, seconds=second, milliseconds=milli)


def test_timestamps_against_the_rules_on_random_text(spark):
    rng = random.Random(1)

    def near(limit: int) -> int:
        return rng.choice([0, 1, limit - 1, limit, limit + 1, rng.randint(0, limit)])

    texts = []
    for _ in range(3000):
        text = f"{rng.choice([0, 1, 1900, 2000, 2023, 2024]):04}-{near(12):02}-{near(31):02}{rng.choice(' T')}"
        text += f"{near(24):02}:{near(60) if rng.random() < 0.5 else 0:02}:{near(60) if rng.random() < 0.5 else 0:02}"
        texts.append(text + rng.choice(["", ".000", ".001", ".5", ".12", f".{rng.randint(0, 999):03}"]))
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = frame.select("text", parse_timestamp(F.col("text")).alias("ts")).collect()
    assert [(r.text, r.ts) for r in got] == [(t, by_rule(t)) for t in texts]


@pytest.mark.parametrize(
    ("formats", "text", "expected"),
    [
        (["dd/MM/yyyy HH:mm:ss"], "31/02/2024 08:15:32", D(2024, 2, 29, 8, 15, 32)),
        (["dd/MM/yyyy HH:mm"], "01/03/2024 24:00", D(2024, 3, 2)),
        (["yyyyMMdd'at'HHmmssSSS"], "20240301at081532007", D(2024, 3, 1, 8, 15, 32, 7000)),
        (["yyyy-MM-dd HH:mm:ss.SSSSSS"], "2024-03-01 08:15:32.000123", D(2024, 3, 1, 8, 15, 32, 123)),
        (["yyyy-MM-dd HH:mm:ss,SSSSSSSSS"], "2024-03-01 08:15:32,123456789", D(2024, 3, 1, 8, 15, 32, 123456)),
        # Same shape: the first format that reads it wins, here the second.
        (["yyyy-MM-dd HH:mm", "yyyy-dd-MM HH:mm"], "2024-30-01 08:15", D(2024, 1, 30, 8, 15)),
        (["yyyy-dd-MM HH:mm:ss", "yyyy-MM-dd HH:mm:ss"], "2024-02-03 08:15:32", D(2024, 3, 2, 8, 15, 32)),
        (["yyyy-MM-dd"], "2024-03-01", None),
        (["d MMM yyyy HH:mm:ss"], "3 Jan 2024 08:15:32", D(2024, 1, 3, 8, 15, 32)),
        (["d MMM yyyy HH:mm:ss"], "nothing of the kind", None),
        ([], "2024-03-01 08:15:32", None),
    ],
)
def test_other_formats(spark, formats, text, expected):
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(parse_timestamp(F.col("text"), formats)).first()[0] == expected


def test_iso_local(spark):
    stamps = [D(2024, 6, 1, 8, 15), D(2024, 6, 1, 8, 15, 1), D(2024, 6, 1, 8, 15, 0, 120000), D(2024, 6, 1, 8, 15, 0, 120)]
    frame = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = [r[0] for r in frame.select(iso_local(F.col("ts"))).collect()]
    assert got == ["2024-06-01T08:15", "2024-06-01T08:15:01", "2024-06-01T08:15:00.120", "2024-06-01T08:15:00.000120"]


def test_entry_display(lines_of):
    lines = lines_of("2024-06-01 08:15:32.120 ERROR [t] com.x - m", "x DEBUG y")
    texts = [r.display for r in entry_display(parse_logs(lines)).orderBy("line_number").collect()]
    assert texts == ["[ERROR] 2024-06-01T08:15:32.120 com.x - m", "[DEBUG] null unknown - x DEBUG y"]


def test_filter_on_a_parsed_column_does_not_match_twice(lines_of):
    plan = error_entries(parse_logs(lines_of("x"))).select("message")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace") == 1
    assert DEFAULT_PATTERN in text
