"""Dates in text, read by classes of tokens: year, month, month name, day, time, half of the day, zone.

A text is a date, a time behind it if any, and a zone behind the time if any. What is read is a timestamp without
zone: the wall time as written, or the UTC time where a zone is written. Everything else is null, which makes an unknown label.

Dates: year first (2020-02-29, 2020/2/9, 2020.02.29, 20200229, 2020 Feb 29), month first (2/29/2020, 02-29-20,
Feb 29, 2020, February 29th 2020), day first with a month name (29 February 2020, 29-Feb-20), day first with
numbers where the first cannot be a month (29/2/2020), and without a day, which is the 1st (2020-02, Feb 2020, 2020).
A weekday may stand before the date. Years of two digits are 1969 to 2068.
Times: 9:05, 09:05:30, 09:05:30.25, 9:05 pm, 9 PM, and T090530 or 0905 behind a date without separators.
Zones: Z, UTC, GMT, +02:00, -0530, +2.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names of months and weekdays.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _names(words: Sequence[str]) -> str:
    """A pattern for the words and their first three letters."""
    return "|".join(f"{w[:3]}(?:{w[3:]})?" for w in words) if words else ""


MONTH = f"({_names(MONTHS)}|sept)[.]?"
WEEKDAY = f"(?i)^(?:{_names(WEEKDAYS)})[.]?,?\\s+"
DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
SEP = r"[-/.]"
GAP = r"[-/.,\s]+"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2}(?:[.,]\d{1,9})?))?\s*(?:([ap])[.]?m[.]?)?"
HOUR = r"(\d{1,2})\s*([ap])[.]?m[.]?"
ZONE = r"(z|utc|gmt|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?)"
TIME = rf"(?i)(?:t|[,\s]\s*)(?:{CLOCK}|{HOUR})\s*{ZONE}?$"
#: Stands between the parts of a text; a text with it is no date.
MARK = "\u0001"
#: A compact date with its time, and how separators are put into it.
COMPACT = (
    (rf"(?i)^(\d{{8}})[t\s]?(\d{{2}})(\d{{2}})(\d{{2}})\s*{ZONE}?$", "$1T$2:$3:$4$5"),
    (rf"(?i)^(\d{{8}})[t\s]?(\d{{2}})(\d{{2}})\s*{ZONE}?$", "$1T$2:$3$4"),
)

#: Patterns of whole dates and how their groups make year, month and day.
DATES = (
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", "$1 $2 $3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1 $2 $3"),
    (rf"(?i)^(\d{{4}}){GAP}{MONTH}{GAP}{DAY}$", "$1 $2 $3"),
    (r"^(1[3-9]|2\d|3[01])[-/.](\d{1,2})[-/.](\d{4}|\d{2})$", "$3 $2 $1"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$", "$3 $1 $2"),
    (rf"(?i)^{MONTH}{GAP}{DAY}{GAP}(\d{{4}}|\d{{2}})$", "$3 $1 $2"),
    (rf"(?i)^{DAY}{GAP}{MONTH}{GAP}(\d{{4}}|\d{{2}})$", "$3 $2 $1"),
    (r"^(\d{4})[-/.](\d{1,2})$", "$1 $2 1"),
    (rf"(?i)^{MONTH}{GAP}(\d{{4}})$", "$2 $1 1"),
    (r"^(\d{4})$", "$1 1 1"),
)


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _year(text: Column) -> Column:
    year = _number(text)
    return F.when(F.char_length(text) > 2, year).otherwise(year + F.when(year < 69, 2000).otherwise(1900))


def _month(text: Column) -> Column:
    """Of a number or an English name."""
    place = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.left(text, F.lit(3)))).cast("int")
    return F.coalesce(_number(text), F.nullif(place, F.lit(0)))


def _zone_seconds(zone: Column) -> Column:
    """Seconds east of UTC; letters and nothing are 0."""
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours = _number(F.when(F.char_length(digits) > 2, F.left(digits, F.char_length(digits) - 2)).otherwise(digits))
    minutes = _number(F.when(F.char_length(digits) > 2, F.right(digits, F.lit(2))).otherwise(F.lit("0")))
    seconds = (hours * 3600 + minutes * 60) * F.when(zone.contains("-"), -1).otherwise(1)
    return F.coalesce(seconds, F.lit(0))


def parse_date(text: Column, formats: Sequence[str] = ()) -> Column:
    """Date or date-time text as a timestamp without zone; null (an unknown label) when unreadable.

    ``formats`` are further patterns of Spark, tried on texts that the classes of tokens leave unread.
    """
    plain = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), WEEKDAY, "")
    for pattern, spread in COMPACT:
        plain = F.regexp_replace(plain, pattern, spread)
    read = _once(F.when(~text.contains(MARK), plain), lambda whole: _once(_parts(whole), _read))
    return F.coalesce(read, *[F.try_to_date(text, f).cast("timestamp_ntz") for f in formats])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is computed once for a row, however often it is used."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def _parts(plain: Column) -> Column:
    """What stands before the time, the groups of the time, and what is behind it; a text without a time alone."""
    groups = MARK + MARK.join(f"${g}" for g in range(1, 8)) + MARK
    return F.when(plain.rlike(TIME), F.split(F.regexp_replace(plain, TIME, groups), MARK)).otherwise(F.array(plain))


def _read(parts: Column) -> Column:
    written = F.concat(parts[0], F.coalesce(F.get(parts, F.lit(8)), F.lit("")))
    ordered = _once(written, lambda x: F.coalesce(*[F.when(x.rlike(p), F.regexp_replace(x, p, to)) for p, to in DATES]))
    return _once(F.split(ordered, " "), lambda date: _at(parts, date))


def _at(parts: Column, date: Column) -> Column:
    def of_time(*groups: int) -> Column:
        return F.coalesce(*[F.nullif(F.get(parts, F.lit(g)), F.lit("")) for g in groups])

    timed = F.size(parts) > 1
    half, hour = F.lower(of_time(4, 6)), _number(of_time(1, 5))
    day_hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.replace(F.coalesce(of_time(3), F.lit("0")), F.lit(","), F.lit(".")).try_cast("decimal(16,6)")
    year, month, day = (F.get(date, F.lit(i)) for i in range(3))
    whole_hour = F.when(timed, day_hour).otherwise(0)
    minute = F.when(timed, F.coalesce(_number(of_time(2)), F.lit(0))).otherwise(0)
    at = F.try_make_timestamp_ntz(_year(year), _month(month), _number(day), whole_hour, minute, F.when(timed, second).otherwise(F.lit(0).cast("decimal(16,6)")))
    east = F.when(timed, _zone_seconds(F.coalesce(of_time(7), F.lit("")))).otherwise(0)
    return at - F.make_dt_interval(secs=east)
