"""Dates: lenient parsing, dates in addresses, date score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.arrays import let, let_sql, quoted
from pagemill.functions.urls import url_date_text

# Accepted layouts, tried in this order.
DATE_FORMATS = [
    "yyyy-M-d", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m", "yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy/M/d", "yyyy/M/d H:m:s",
    "yyyyMMdd", "yyyyMMddHHmm", "yyyyMMddHHmmss", "M/d/yyyy", "M/d/yyyy h:ma", "M/d/yyyy H:m", "MMMM d yyyy",
    "MMM d yyyy", "MMMM d yyyy h:m a", "MMM d yyyy h:m a", "h:m:s a MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy",
    "d MMM yyyy H:m:s", "yyyy MMM d", "yyyy M d", "d.M.yyyy", "d.M.yyyy H:m", "d-MMM-yyyy", "M/d/yy", "d MMMM yyyy H:m",
    "d MMM yyyy H:m", "d MMMM yyyy H:m:s", "MMMM d yyyy H:m", "MMM d yyyy H:m",
]


# Clean-up rules, in order: outer space, weekday names, fractions, zone offsets
# (the wall clock is relabelled as UTC, not converted), am/pm spelling.
_RULES = [
    (r"^\s+|\s+$", ""),
    (r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?,?", ""),
    (r"(\d:\d{2})[.,]\d+", "$1"),
    (r"(\d:\d{2})\s*(?:Z|UTC|GMT|[ECMP][SD]T|CES?T|BST|[+-]\d{2}:?\d{2})$", "$1"),
    (r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1"),
    (r"(?i)\b(jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)t?\.", "$1"),
    (r"(?i)\bsept\b", "Sep"),
    (r"(?i)([ap])\.?m\.?\b", "$1M"),
    (",", " "),
    (r"\s+", " "),
]


# Month names, words that may stand in a date, names of zones.
MONTHS = [
    "JAN(?:UARY)?", "FEB(?:RUARY)?", "MAR(?:CH)?", "APR(?:IL)?", "MAY", "JUNE?", "JULY?", "AUG(?:UST)?", "SEPT?(?:EMBER)?",
    "OCT(?:OBER)?", "NOV(?:EMBER)?", "DEC(?:EMBER)?",
]
FILLERS = "AT|ON|OF|THE|AND|UTC|GMT|Z|[ECMP][SD]T|CES?T|BST|T"
_MONTH = r"(?<!\p{L})(" + "|".join(MONTHS) + r")(?!\p{L})"
_TIME = r"(?<![0-9:])([0-9]{1,2})(?::([0-9]{2})(?::([0-9]{2}))?\s*([AP]M)?|()()\s*([AP]M))(?![0-9:\p{L}])"


def _grammar() -> str:
    """SQL lambda for a date that no fixed layout fits: numbers, month names, a time
    with or without am/pm, zones and fillers, in any order and with any of the
    separators blank, dot, slash, hyphen, underscore and comma. Anything else, and
    any part too many or too few, makes it null.

    A number of three or four digits or above 31 is a year. With a month name the
    other number is the day; of two small numbers the first is. Without one, a year in
    front means year, month, day; otherwise month, day, year, or day, month, year
    where dots separate them or the first number is no month. A month that is none
    changes places with the day. Years of two digits are those from 1970 to 2069."""
    months = " ".join(f"WHEN rlike(p.month, {quoted('^' + m + '$')}) THEN {i}" for i, m in enumerate(MONTHS, 1))
    num = lambda n: f"try_cast({n} AS INT)"
    year = lambda n: f"(length({n}) > 2 OR {num(n)} > 31)"
    full = lambda n: f"CASE length({n}) WHEN 4 THEN {num(n)} WHEN 2 THEN {num(n)} + IF({num(n)} < 70, 2000, 1900) WHEN 1 THEN {num(n)} + 2000 END"
    ymd = lambda y, m, d: f"named_struct('y', {y}, 'm', {num(m)}, 'd', {num(d)})"
    a, b, c = "get(p.n, 0)", "get(p.n, 1)", "get(p.n, 2)"
    swap = lambda y, m, d: f"IF({num(m)} > 12 AND {num(d)} <= 12, {ymd(y, d, m)}, {ymd(y, m, d)})"
    block = lambda t, at: num(f"nullif(substring({t}, {at}, 2), '')")
    part = lambda pattern: num(f"nullif(regexp_extract(p.time, {quoted(pattern)}, 1), '')")
    return f"""t -> get(transform(array(regexp_replace(regexp_replace(t, {quoted('(?<=[0-9])T(?=[0-9])')}, ' '), {quoted(rf'(?<![\p{{L}}])(?:{FILLERS})(?![\p{{L}}])')}, ' ')), c ->
      get(transform(array(named_struct('times', regexp_extract_all(c, {quoted(_TIME)}, 0), 'rest', regexp_replace(c, {quoted(_TIME)}, ' '))), r ->
      get(transform(array(named_struct('time', get(r.times, 0), 'many', size(r.times), 'names', size(regexp_extract_all(r.rest, {quoted(_MONTH)}, 0)),
          'month', regexp_extract(r.rest, {quoted(_MONTH)}, 1), 'left', regexp_replace(r.rest, {quoted(_MONTH)}, ' '))), q ->
      get(transform(array(named_struct('time', q.time, 'month', q.month, 'left', q.left, 'n', regexp_extract_all(q.left, '[0-9]+', 0),
          'able', q.many < 2 AND q.names < 2 AND NOT rlike(q.left, {quoted('[^0-9 ./,_-]')}) AND NOT rlike(q.left, '[0-9]{{15}}'))), p ->
      IF(NOT p.able, NULL, get(transform(array(named_struct(
        'day', CASE
          WHEN p.month <> '' AND size(p.n) = 2 AND NOT {year(a)} THEN {ymd(full(b), f'CASE {months} END', a)}
          WHEN p.month <> '' AND size(p.n) = 2 AND NOT {year(b)} THEN {ymd(full(a), f'CASE {months} END', b)}
          WHEN p.month = '' AND size(p.n) = 3 AND {year(a)} AND NOT {year(b)} AND NOT {year(c)} THEN {swap(full(a), b, c)}
          WHEN p.month = '' AND size(p.n) = 3 AND NOT {year(a)} AND NOT {year(b)} AND rlike(p.left, {quoted('[0-9][.][0-9]+[.][0-9]')}) THEN {swap(full(c), b, a)}
          WHEN p.month = '' AND size(p.n) = 3 AND NOT {year(a)} AND NOT {year(b)} THEN {swap(full(c), a, b)}
          WHEN p.month = '' AND size(p.n) < 3 AND length({a}) = 8 THEN {ymd(num(f'left({a}, 4)'), f'substring({a}, 5, 2)', f'right({a}, 2)')}
          END,
        'clock', CASE
          WHEN p.time IS NOT NULL THEN named_struct('h', {part('^([0-9]+)')}, 'm', coalesce({part('^[0-9]+:([0-9]+)')}, 0),
            's', coalesce({part('^[0-9]+:[0-9]+:([0-9]+)')}, 0), 'half', regexp_extract(p.time, '[AP]M', 0))
          WHEN p.month = '' AND size(p.n) = 2 AND length({a}) = 8 AND length({b}) IN (4, 6) THEN
            named_struct('h', {block(b, 1)}, 'm', {block(b, 3)}, 's', coalesce({block(b, 5)}, 0), 'half', '')
          WHEN size(p.n) = 1 OR (size(p.n) = 2 AND p.month <> '') OR size(p.n) = 3 THEN named_struct('h', 0, 'm', 0, 's', 0, 'half', '') END)), x ->
        IF(x.clock.half <> '' AND NOT x.clock.h BETWEEN 1 AND 12, NULL, try_make_timestamp(x.day.y, x.day.m, x.day.d,
          CASE x.clock.half WHEN 'PM' THEN x.clock.h % 12 + 12 WHEN 'AM' THEN x.clock.h % 12 ELSE x.clock.h END, x.clock.m, x.clock.s))), 0))), 0)), 0)), 0)), 0)"""


def _parse_program() -> str:
    text = "r"
    for pattern, to in _RULES:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(to)})"
    # Layouts with a month name want "May 3 2015 6:42 AM"; the others are plain.
    named = f"""regexp_replace(initcap(t), {quoted(r"([AaPp])m\b")}, {quoted("$1M")})"""
    tries = ", ".join(
        f"try_to_timestamp({'n' if 'MMM' in layout or 'a' in layout else 't'}, {quoted(layout)})" for layout in DATE_FORMATS
    )
    return f"""r -> get(transform(array(upper(trim({text}))),
      t -> get(transform(array({named}), n -> coalesce({tries}, get(transform(array(t), {_grammar()}), 0))), 0)), 0)"""


_PARSE = _parse_program()


def parse_date(text: Column) -> Column:
    """Timestamp of a date string: the fixed layouts first, then the grammar; null
    when neither fits. Missing parts are never filled from today's date."""
    return let_sql(text, _PARSE)


def url_date(url: Column) -> Column:
    """Date written in an address; null when absent, partial or impossible."""
    return let(
        F.trim(F.regexp_replace(url_date_text(url), r"[./\-_]+", " ")),
        lambda t: F.coalesce(
            F.try_to_timestamp(t, F.lit("yyyy M d")),
            F.try_to_timestamp(F.initcap(t), F.lit("yyyy MMM d")),
            F.try_to_timestamp(t, F.lit("yyyyMMdd")),
        ),
    )


def drop_offset(text: Column) -> Column:
    """Timestamp text without its zone: the wall clock is taken as UTC."""
    return F.regexp_replace(F.trim(text), r"(\d:\d{2}(?:[.,]\d+)?)\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$", "$1")


def date_score(page_date: Column, event_date: Column, event_type: Column | str = "Shooting") -> Column:
    """1 for the 30 days from the event on, 0 otherwise and for an unknown date.
    Hurricanes also score the days before the event."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    limit = fixed.DATE_TOLERANCE_DAYS
    seconds = F.unix_timestamp(page_date) - F.unix_timestamp(event_date)
    return let(
        F.floor(seconds / 86400),
        lambda days: F.when(page_date.isNull() | event_date.isNull(), F.lit(0.0))
        .when(days > limit, F.lit(0.0))
        .when(days >= 0, 1.0 - F.floor(days / limit).cast("double"))
        .when(kind == "Hurricane", 1.0 + days.cast("double") / float(limit))
        .otherwise(F.lit(0.0)),
    )
