"""Zone-less timestamps from text, the way a lenient-by-default calendar parser reads them.

A date format such as ``yyyy-MM-dd HH:mm:ss.SSS`` has fixed-width fields, so each one is
turned into a shape (a regex over the whole text) and the position of every field. Fields of variable
width and names (``d``, ``MMM``, ``a``) become groups of a regex. Optional sections in brackets give one
format with and one without them. Either way the fields are put into ISO order and read from there.

Beyond the plain calendar two things are accepted: a day past the end of its month is moved back to the
last day (2024-02-30 is 2024-02-29), and 24:00:00 is midnight of the next day. Digit counts
are exact: ``SSS`` does not read ``.5``. Nothing here depends on the session time zone. A format
with a letter or sign that cannot be read raises ``ValueError``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtally.functions.text import java_trim

# The formats tried, in this order.
DEFAULT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
)

# Stands between the groups of a text; no group can hold it.
_MARK = "\x01"
_TOKEN = re.compile(r"'(?:[^']|'')*'|([A-Za-z])\1*|.", re.DOTALL)
_FIELDS = {"yyyy": "year", "MM": "month", "dd": "day", "HH": "hour", "mm": "minute", "ss": "second"}
_ISO_ORDER = ("year", "month", "day", "hour", "minute", "second", "fraction")
# Formats whose text Spark's own string-to-timestamp cast reads as it is.
_ISO = re.compile(r"yyyy-MM-dd( |'T')HH:mm:ss(\.S{1,6})?")


@dataclass(frozen=True)
class FixedFormat:
    """A format made of fixed-width fields: its shape and ``field -> (position, width)``."""

    shape: str
    fields: dict[str, tuple[int, int]]
    is_iso: bool


# Names in a date, in calendar order.
_MONTHS = ("January February March April May June July August September October November December").split()
_DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
_ZONES = {"X": r"(?:Z|[+-]\d{2}(?:\d{2})?)", "XX": r"(?:Z|[+-]\d{4})", "XXX": r"(?:Z|[+-]\d{2}:\d{2})", "Z": r"[+-]\d{4}"}
_ZONES |= {"x": r"[+-]\d{2}(?:\d{2})?", "xx": r"[+-]\d{4}", "xxx": r"[+-]\d{2}:\d{2}"}


def _any_of(names: Sequence[str]) -> str:
    return "(" + "|".join(names) + ")"


#: What the letters of a format other than fixed-width ones stand for: field and group.
_VARIABLE = {
    **{letter: ("year", r"((?!0+(?!\d))\d{1,4})") for letter in "yu"},
    "uuuu": ("year", r"((?!0000)\d{4})"),
    "yy": ("short_year", r"(\d{2})"),
    **{"M" * n: ("month", r"(\d{1,2})") if n == 1 else ("month_name", _any_of([m[: 3 if n == 3 else None] for m in _MONTHS])) for n in (1, 3, 4)},
    "d": ("day", r"(\d{1,2})"),
    **{"E" * n: ("weekday", _any_of([d[: None if n == 4 else 3] for d in _DAYS])) for n in (1, 2, 3, 4)},
    "H": ("hour", r"(\d{1,2})"),
    "h": ("half_hour", r"(0?[1-9]|1[0-2])"),
    "hh": ("half_hour", r"(0[1-9]|1[0-2])"),
    "a": ("half", "(AM|PM)"),
    "m": ("minute", r"(\d{1,2})"),
    "s": ("second", r"(\d{1,2})"),
    **{letter: ("zone", f"({regex})") for letter, regex in _ZONES.items()},
}


def alternatives(fmt: str) -> list[str]:
    """The formats without optional sections that a format stands for, those with more of them first."""
    depth, start = 0, None
    for token in _TOKEN.finditer(fmt):
        if token.group(0) == "[":
            start = token.start() if depth == 0 else start
            depth += 1
        elif token.group(0) == "]":
            depth -= 1
            if depth < 0:
                break
            if depth == 0:
                before, inside, after = fmt[:start], fmt[start + 1 : token.start()], fmt[token.end() :]
                return [a for part in (inside, "") for a in alternatives(before + part + after)]
    if depth:
        raise ValueError(f"brackets do not match in the format {fmt!r}")
    return [fmt]


def _literal(text: str) -> str:
    quoted = len(text) > 1 and text.startswith("'")
    if not quoted and text in "{}#'":
        raise ValueError(f"the sign {text} cannot stand in a format")
    return (text[1:-1].replace("''", "'") or "'") if quoted else text


def fixed_format(fmt: str) -> FixedFormat | None:
    """Read a format; None if it has a field of variable width or a name (``d``, ``MMM``, ``a``)."""
    shape, fields, position = "", {}, 1
    for token in _TOKEN.finditer(fmt):
        text = token.group(0)
        if token.group(1):
            name = "fraction" if set(text) == {"S"} and len(text) <= 9 else _FIELDS.get(text)
            if name is None or name in fields:
                return None
            fields[name] = (position, len(text))
            shape += r"(?!0000)\d{4}" if name == "year" else rf"\d{{{len(text)}}}"
            position += len(text)
        else:
            literal = _literal(text)
            shape += re.escape(literal)
            position += len(literal)
    return FixedFormat(shape, fields, _ISO.fullmatch(fmt) is not None)


def grouped_format(fmt: str) -> tuple[str, dict[str, int]]:
    """A regex of a format with fields of any width, and the group of each field."""
    shape, groups = "", {}
    for token in _TOKEN.finditer(fmt):
        text = token.group(0)
        if not token.group(1):
            shape += re.escape(_literal(text))
            continue
        if text in _FIELDS:
            name, group = _FIELDS[text], r"((?!0000)\d{4})" if text == "yyyy" else rf"(\d{{{len(text)}}})"
        elif set(text) == {"S"} and len(text) <= 9:
            name, group = "fraction", rf"(\d{{{len(text)}}})"
        elif text in _VARIABLE:
            name, group = _VARIABLE[text]
        else:
            raise ValueError(f"cannot read {text} in the format {fmt!r}")
        if name in groups:
            raise ValueError(f"{text} stands twice in the format {fmt!r}")
        shape += group
        groups[name] = len(groups) + 1
    return shape, groups


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, and written into the plan once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _read_grouped(text: Column, fmt: str) -> Column:
    """Read text of a format with fields of any width; null if it is not of that format."""
    shape, groups = grouped_format(fmt)
    have = set(groups) | ({"month"} & {name.removesuffix("_name") for name in groups})
    have |= {"year"} if "short_year" in groups else set()
    have |= {"hour"} if {"half_hour", "half"} <= groups.keys() else set()
    if not {"year", "month", "day", "hour"} <= have:
        return F.lit(None).cast("timestamp_ntz")
    whole = rf"\A(?:{shape})\z"
    # All groups in one evaluation; a group that took no part is empty.
    fields = F.split(F.regexp_replace(text, whole, _MARK.join(f"${g}" for g in groups.values())), _MARK, -1)

    def place(names: Sequence[str], value: Column) -> Column:
        return F.array_position(F.array(*map(F.lit, names)), F.substring(value, 1, 3))

    def iso(parts: Column) -> Column:
        field = {name: F.get(parts, F.lit(group - 1)) for name, group in groups.items()}
        if "month_name" in field:
            field["month"] = place([m[:3] for m in _MONTHS], field["month_name"]).cast("string")
        if "short_year" in field:
            field["year"] = F.concat(F.lit("20"), field["short_year"])
        if {"half_hour", "half"} <= field.keys():
            later = F.when(field["half"] == "PM", 12).otherwise(0)
            field["hour"] = (field["half_hour"].try_cast("int") % 12 + later).cast("string")
        out: list[Column] = []
        for name, before in zip(_ISO_ORDER[:-1], ("", "-", "-", " ", ":", ":"), strict=True):
            value = F.lpad(field[name], 4 if name == "year" else 2, "0") if name in field else F.lit("00")
            out += [F.lit(before), value]
        fraction = F.substring(field["fraction"], 1, 6) if "fraction" in field else F.lit("0")
        made = _bind(F.concat(*out, F.lit("."), fraction), lambda x: F.coalesce(x.try_cast("timestamp_ntz"), _lenient(x)))
        if "weekday" not in field:
            return made
        said = place([d[:3] for d in _DAYS], field["weekday"]) - 1
        return _bind(made, lambda ts: F.when(F.weekday(ts) == said, ts))

    return _bind(F.when(text.rlike(whole), fields), lambda parts: F.when(parts.isNotNull(), iso(parts)))


def _iso_text(text: Column, fmt: FixedFormat) -> Column:
    """Rearrange text of the shape of ``fmt`` into ``yyyy-MM-dd HH:mm:ss.S``."""
    if fmt.is_iso:
        return text
    if not {"year", "month", "day", "hour"} <= fmt.fields.keys():
        return F.lit(None).cast("string")
    parts: list[Column] = []
    for name, before in zip(_ISO_ORDER, ("", "-", "-", " ", ":", ":", "."), strict=True):
        # Spark keeps microseconds; further digits are cut off.
        position, width = fmt.fields.get(name, (0, 0))
        value = F.substring(text, position, min(width, 6)) if width else F.lit("00")
        parts += [F.lit(before), value]
    return F.concat(*parts)


def _lenient(iso: Column) -> Column:
    """Read what Spark's cast turns down: a day past the month's end, and 24:00:00."""
    first = F.concat(F.substring(iso, 1, 8), F.lit("01")).try_cast("date")
    day = F.substring(iso, 9, 2).try_cast("int")
    date = F.when(day.between(1, 31), F.least(F.date_add(first, day - 1), F.last_day(first)))
    time = F.substring(iso, 12, 15)
    return F.when(time.rlike(r"\A24:00:00(\.0+)?\z"), F.date_add(date, 1).cast("timestamp_ntz")).otherwise(
        F.concat(date.cast("string"), F.lit(" "), time).try_cast("timestamp_ntz")
    )


def _read(text: Column, shape: str, iso: Column) -> Column:
    in_shape = text.rlike(rf"\A(?:{shape})\z")
    return F.when(in_shape, F.coalesce(iso.try_cast("timestamp_ntz"), _lenient(iso)))


def read_timestamp(text: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """First format that reads the whole text wins; null if none does.

    Text of a fixed-width format is rearranged into ISO order and cast; only what the cast turns
    down is looked at again.
    """
    tries: list[Column] = []
    layouts = [(fmt, fixed_format(fmt)) for given in formats for fmt in alternatives(given)]
    # Neighbouring ISO formats share one test of the shape and one reading.
    for is_iso, run in groupby(layouts, key=lambda pair: pair[1] is not None and pair[1].is_iso):
        if is_iso:
            tries.append(_read(text, "|".join(layout.shape for _, layout in run), text))
            continue
        for fmt, layout in run:
            if layout is None:
                tries.append(_read_grouped(text, fmt))
            else:
                tries.append(_read(text, layout.shape, _iso_text(text, layout)))
    return F.coalesce(*tries) if tries else F.lit(None).cast("timestamp_ntz")


def parse_timestamp(col: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """Zone-less timestamp of a text with blanks around it, see :func:`read_timestamp`."""
    return read_timestamp(java_trim(col), formats)


def hour_bucket(ts: Column) -> Column:
    """``yyyy-MM-dd HH`` of a zone-less timestamp."""
    return F.substring_index(ts.cast("string"), ":", 1)


def hour_number(ts: Column) -> Column:
    """Hours since 1970, a fixed-width grouping key for the hour bucket."""
    return F.unix_date(ts.cast("date")) * 24 + F.hour(ts)


def hour_label(number: Column) -> Column:
    """The ``yyyy-MM-dd HH`` bucket of an hour number."""
    day = F.date_from_unix_date(F.floor(number / 24).cast("int"))
    hour = F.lpad(F.pmod(number, F.lit(24)).cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit(" "), hour)


def iso_local(ts: Column) -> Column:
    """ISO text of a zone-less timestamp: seconds only if needed, fractions in threes."""
    text = ts.cast("string")
    whole = F.replace(F.substring_index(text, ".", 1), F.lit(" "), F.lit("T"))
    fraction = F.split_part(text, F.lit("."), F.lit(2))
    return (
        F.when((fraction == "") & F.endswith(whole, F.lit(":00")), F.substring_index(whole, ":", 2))
        .when(fraction == "", whole)
        .when(F.length(fraction) <= 3, F.concat(whole, F.lit("."), F.rpad(fraction, 3, "0")))
        .otherwise(F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0")))
    )
