"""Event times: parsing, precision bounds, zones, freshness and evaluation grids."""

from __future__ import annotations

import logging
import re
import zoneinfo
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.functions.columns import fill_template, strip, template_fields
from dqspark.plans.joins import quoted

log = logging.getLogger(__name__)

EXECUTION_TIME = "execution_time"
UNIX_TIME = "unixtime"

# Strptime directives and the Spark datetime pattern of each.
STRPTIME_TO_SPARK = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "b": "MMM",
    "B": "MMMM",
    "d": "dd",
    "j": "DDD",
    "H": "HH",
    "I": "hh",
    "p": "a",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "z": "XX",
    "Z": "z",
}

# Upper edge in minutes (inclusive) and label of each freshness bucket from 0 on.
FRESHNESS_EDGES = (
    (5, "0-5min"),
    (10, "5-10min"),
    (20, "10-20min"),
    (30, "20-30min"),
    (60, "30-60min"),
    (120, "1-2h"),
    (180, "2-3h"),
    (1440, "3-24h"),
)
FAR_FUTURE, NEAR_FUTURE, STALE = "future: >1 hour", "future: 0-1 hour", ">24h"


# Directives of digits, and those of them that Spark reads with one digit or two by a single letter.
DIGITS = frozenset("YymdjHIMSf")
ONE_OR_TWO = frozenset("mdHIMS")
# Weekday names say nothing that the date does not.
WEEKDAYS = frozenset("aA")
WEEKDAY_TEXT = r"(?i)\b(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b"
WIDTHS = {"Y": 4, "y": 2, "m": 2, "d": 2, "j": 3, "H": 2, "I": 2, "M": 2, "S": 2}


def _pieces(strptime_format: str) -> list[tuple[bool, str]]:
    """Directives, as ``(True, letter)``, and the literal text between them; weekdays are left out."""
    out: list[tuple[bool, str]] = []
    for directive, char in re.findall(r"%(.?)|([^%])", strptime_format, re.DOTALL):
        if directive in WEEKDAYS:
            continue
        if directive and directive != "%":
            if directive not in STRPTIME_TO_SPARK:
                raise ValueError(f"time format directive %{directive} cannot be parsed by Spark")
            out.append((True, directive))
        elif out and not out[-1][0]:
            out[-1] = (False, out[-1][1] + (char or "%"))
        else:
            out.append((False, char or "%"))
    return out


def spark_pattern(strptime_format: str) -> str:
    """The Spark datetime pattern of a strptime format; literal letters are quoted.

    Fields take one digit or two where no digits touch them, and two where they do.
    """
    pieces, out = _pieces(strptime_format), []

    def digit(at: int, side: int) -> bool:
        if not 0 <= at < len(pieces):
            return False
        directive, text = pieces[at]
        return text in DIGITS if directive else text[side].isdigit()

    for i, (directive, text) in enumerate(pieces):
        if not directive:
            literal = text.replace("'", "''")
            out.append(f"'{literal}'" if any(ch.isalpha() or ch in "'[]{}#" for ch in text) else text)
        elif text in ONE_OR_TWO and not digit(i - 1, -1) and not digit(i + 1, 0):
            out.append(STRPTIME_TO_SPARK[text][0])
        else:
            out.append(STRPTIME_TO_SPARK[text])
    return "".join(out)


def _fraction_at(strptime_format: str) -> int | None:
    """Where digits of a fraction start right after other digits, all before them having fixed widths."""
    pieces = _pieces(strptime_format)
    at = pieces.index((True, "f")) if (True, "f") in pieces else 0
    if not at or pieces[at - 1][1] not in DIGITS or not pieces[at - 1][0]:
        return None
    widths = [WIDTHS.get(text) if directive else len(text) for directive, text in pieces[:at]]
    return None if None in widths else sum(widths)


def precision(strptime_format: str) -> str | None:
    """The finest unit a format holds, from second to year."""
    for unit, directives in (
        ("second", ("%S",)),
        ("minute", ("%M",)),
        ("hour", ("%H", "%I")),
        ("day", ("%d", "%j")),
        ("month", ("%m", "%b", "%B")),
        ("year", ("%Y", "%y")),
    ):
        if any(d in strptime_format for d in directives):
            return unit
    return None


def known_zone(zone: str | None) -> str:
    if not zone:
        return "UTC"
    try:
        zoneinfo.ZoneInfo(zone)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        log.warning("time zone %s is not known, keeping UTC", zone)
        return "UTC"
    return zone


def is_instant(strptime_format: str) -> bool:
    """Whether the text itself says its offset or zone."""
    return "%z" in strptime_format or "%Z" in strptime_format


def parse_time(text: Column, strptime_format: str) -> Column:
    """Timestamp of a text, NULL where it does not fit: the instant if the format holds an offset or a zone,
    else the wall clock."""
    source, fmt = strip(text), strptime_format
    if any(f"%{day}" in fmt for day in WEEKDAYS):
        source = F.regexp_replace(source, WEEKDAY_TEXT, "")
    if "%z" in fmt:
        end = "$" if fmt.endswith("%z") else ""
        source = F.regexp_replace(source, rf"([+-][0-9]{{2}}):([0-9]{{2}}){end}", "$1$2")
    at = _fraction_at(fmt)
    if at is not None:
        # Spark reads a fraction of any length only after a character that is no digit.
        source = F.concat(F.substring(source, 1, at), F.lit("."), F.substring(source, at + 1, 2**31 - 1))
        fmt = fmt.replace("%f", ".%f")
    pattern = spark_pattern(fmt)
    if "%I" in fmt and "%p" not in fmt:
        source, pattern = F.concat(source, F.lit(" AM")), pattern + " a"
    parsed = F.try_to_timestamp(source, F.lit(pattern))
    if "%y" in fmt and "%Y" not in fmt:
        # Two-digit years 69-99 belong to the last century.
        parsed = F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200).cast("timestamp")
                        + (parsed - F.date_trunc("day", parsed))).otherwise(parsed)
    return parsed


def time_bounds(
    when: Column, strptime_format: str, zone: str | None = None, instant: bool = False
) -> tuple[Column, Column]:
    """First and last epoch second a time can mean at the precision of its format.

    ``when`` is a wall clock in ``zone``, or an instant. An instant stays itself: its wall clock, which
    two instants share in the hour that a zone repeats, only gives the distance to the bounds.
    """
    unit, tz = precision(strptime_format), known_zone(zone)

    def epoch(wall_clock: Column) -> Column:
        return F.unix_seconds(F.to_utc_timestamp(wall_clock, tz))

    own = F.unix_seconds(when) if instant else epoch(when)
    if unit in (None, "second"):
        return own, own
    local = F.from_utc_timestamp(when, tz) if instant else when
    floor = F.date_trunc(unit, local)
    last = floor + F.expr(f"INTERVAL 1 {unit}") - F.expr("INTERVAL 1 SECOND")
    if instant and unit in ("minute", "hour"):
        seconds = F.unix_seconds(local)
        return own - (seconds - F.unix_seconds(floor)), own + (F.unix_seconds(last) - seconds)
    return epoch(floor), epoch(last)


def freshness_minutes(reference: Column, epoch: Column) -> Column:
    return (reference - epoch) / F.lit(60.0)


def freshness_label(minutes: Column) -> Column:
    """Bucket of an age in minutes; ``<empty>`` when there is none."""
    out = F.when(minutes < -60, FAR_FUTURE).when(minutes < 0, NEAR_FUTURE)
    for edge, name in FRESHNESS_EDGES:
        out = out.when(minutes <= edge, name)
    return out.when(minutes > FRESHNESS_EDGES[-1][0], STALE).otherwise("<empty>")


@dataclass
class TimeColumns:
    """Names of the time columns of a dataset: all, the primary, and the freshness dimensions."""

    names: list[str] = field(default_factory=list)
    primary: str = EXECUTION_TIME
    freshness: list[str] = field(default_factory=list)


def add_times(
    df: DataFrame, mappings: Mapping[str, Mapping], execution_time: int
) -> tuple[DataFrame, TimeColumns]:
    """Add ``max_<key>`` and ``min_<key>`` epoch columns for each mapping, and freshness labels.

    A mapping holds ``column`` (a name or a ``{a}-{b}`` template), ``format`` (strptime or
    ``unixtime``) and optionally ``timezone``, ``primary`` and ``freshness``. Dates and timestamps
    are taken as they are, the format giving only their precision. A mapping whose columns
    are missing is skipped. The first mapping flagged primary gives the primary time, else the
    execution time does.
    """
    times, fresh = TimeColumns(names=[EXECUTION_TIME]), []
    added: dict[str, Column] = {EXECUTION_TIME: F.lit(int(execution_time)).cast("bigint")}
    primary = None
    for key, mapping in mappings.items():
        template = mapping["column"]
        needed = template_fields(template) or [template]
        if any(c not in df.columns for c in needed):
            log.warning("a column of time %s is not in the dataset, leaving it out", key)
            continue
        source = fill_template(template) if template_fields(template) else F.col(quoted(template))
        if mapping["format"] == UNIX_TIME:
            lower = upper = F.floor(source.try_cast("double")).cast("bigint")
        else:
            zone, kind = mapping.get("timezone"), df.select(source).schema[0].dataType
            typed = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
            when = source.cast("timestamp") if typed else parse_time(source, mapping["format"])
            instant = isinstance(kind, T.TimestampType) if typed else is_instant(mapping["format"])
            lower, upper = time_bounds(when, mapping["format"], zone, instant)
        added[f"max_{key}"], added[f"min_{key}"] = upper, lower
        times.names += [f"max_{key}", f"min_{key}"]
        if mapping.get("primary"):
            if primary is None:
                primary = key
            else:
                log.warning("more than one primary time, staying with %s", primary)
        if mapping.get("freshness"):
            fresh.append(key)
    if primary is not None:
        times.primary = f"max_{primary}"
    out = df.withColumns(added)
    labels = {
        f"{key}_freshness": freshness_label(
            freshness_minutes(F.col(quoted(times.primary)), F.col(quoted(f"min_{key}")))
        )
        for key in fresh
        if key != primary
    }
    times.freshness = list(labels)
    return (out.withColumns(labels) if labels else out), times


# -- evaluation grid -----------------------------------------------------------------------------

# Month and weekday names of cron fields.
MONTH_NAMES = "jan feb mar apr may jun jul aug sep oct nov dec".split()
WEEKDAY_NAMES = "sun mon tue wed thu fri sat".split()


def cron_field(text: str, low: int, high: int, names: list[str] | None = None) -> list[int]:
    """The values of one cron field: ``*``, numbers, names, ranges, lists and steps."""

    def number(token: str) -> int:
        token = token.strip().lower()
        if names and token[:3] in names:
            return names.index(token[:3]) + (1 if low == 1 else 0)
        return int(token)

    values: set[int] = set()
    for part in text.split(","):
        span, _, step = part.partition("/")
        if span == "*":
            first, last = low, high
        elif "-" in span:
            first, last = (number(t) for t in span.split("-"))
        else:
            first = number(span)
            last = high if step else first
        values.update(range(first, last + 1, int(step or 1)))
    if not values or min(values) < low or max(values) > high:
        raise ValueError(f"cron field {text!r} is outside {low}-{high}")
    return sorted(values)


def evaluation_times(
    bounds: DataFrame, cron: str, start: str, end: str, delay: int = 0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Times of a cron expression after ``start`` up to ``end - delay`` (epoch-second columns).

    As in a loop that tests before it steps, the first time past the end is included. One row per
    time: the ``keep`` columns and ``evaluation_time``.
    """
    minute, hour, day, month, weekday = cron.split()
    minutes, hours = cron_field(minute, 0, 59), cron_field(hour, 0, 23)
    days, months = cron_field(day, 1, 31), cron_field(month, 1, 12, MONTH_NAMES)
    weekdays = sorted({d % 7 for d in cron_field(weekday, 0, 7, WEEKDAY_NAMES)})

    def day_matches(d: Column) -> Column:
        in_month = F.month(d).isin(months)
        by_day, by_weekday = F.dayofmonth(d).isin(days), (F.dayofweek(d) - 1).isin(weekdays)
        both_set = not day.startswith("*") and not weekday.startswith("*")
        return in_month & ((by_day | by_weekday) if both_set else (by_day & by_weekday))

    offsets = F.array(*[F.lit(h * 3600 + m * 60).cast("bigint") for h in hours for m in minutes])
    # The day after the last one may be years off (29 February), and never more than eight.
    horizon = 366 * 8
    spans = bounds.select(
        *[F.col(quoted(c)) for c in keep],
        F.col(quoted(start)).cast("bigint").alias("_from"),
        (F.col(quoted(end)).cast("bigint") - F.lit(int(delay))).alias("_to"),
    ).filter(F.col("_from") <= F.col("_to"))
    spans = spans.withColumn("_last", F.date_from_unix_date(F.floor(F.col("_to") / 86400).cast("int")))
    inside = F.filter(
        F.sequence(F.date_from_unix_date(F.floor(F.col("_from") / 86400).cast("int")), F.col("_last")),
        day_matches,
    )
    after = F.filter(
        F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon)), day_matches
    )
    spans = spans.withColumn("_days", F.concat(inside, F.slice(after, 1, 1)))
    per_day = spans.withColumn(
        "_next",
        F.array_min(
            F.filter(
                F.flatten(
                    F.transform(
                        F.slice(F.filter("_days", lambda d: d >= F.col("_last")), 1, 2),
                        lambda d: F.transform(offsets, lambda s: F.unix_date(d).cast("bigint") * 86400 + s),
                    )
                ),
                lambda t: t > F.col("_to"),
            )
        ),
    ).withColumn("_day", F.explode("_days"))
    times = per_day.withColumn(
        "evaluation_time",
        F.explode(F.transform(offsets, lambda s: F.unix_date("_day").cast("bigint") * 86400 + s)),
    )
    t = F.col("evaluation_time")
    return times.filter((t > F.col("_from")) & ((t <= F.col("_to")) | (t == F.col("_next")))).select(
        *[F.col(quoted(c)) for c in keep], "evaluation_time"
    )
