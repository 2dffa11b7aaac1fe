"""Strict number parsing and strftime-style date parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws

# Plain decimal or scientific notation. `try_cast` alone is too lenient: it accepts '1d',
# '1.5f', 'nan' and 'inf', which the pandas parser rejects or turns into missing values.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number_text(c: Column, decimal_comma: bool = True, thousands: str | None = None) -> Column:
    """Text as the converter sees it: thousands separator removed, `,` -> `.`, stripped."""
    t = c.cast("string")
    if thousands:
        t = F.replace(t, F.lit(thousands), F.lit(""))
    if decimal_comma:
        t = F.replace(t, F.lit(","), F.lit("."))
    return strip_ws(t)


def strict_double(c: Column, decimal_comma: bool = True, thousands: str | None = None) -> Column:
    """Number or NULL: the text must be a plain number after the decimal-comma rule."""
    t = number_text(c, decimal_comma, thousands)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


# strftime directive -> Java DateTimeFormatter pattern letters.
_STRFTIME = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm",
             "S": "ss", "f": "SSSSSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE",
             "A": "EEEE", "j": "DDD", "z": "Z", "Z": "z", "e": "d"}


def strftime_to_java(fmt: str, offset: str = "Z", zone: str = "z") -> str:
    """Translate a strftime format (`%Y-%m-%d %H:%M`) to a Spark datetime pattern; `offset` and `zone` are the
    letters for %z and %Z."""
    letters = _STRFTIME | {"z": offset, "Z": zone}
    out, lit, i = [], [], 0

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(f"'{text}'" if any(ch.isalpha() for ch in text) else text)
            lit.clear()

    while i < len(fmt):
        ch = fmt[i]
        if ch == "%" and i + 1 < len(fmt):
            d = fmt[i + 1]
            if d == "%":
                lit.append("%")
            elif d in letters:
                flush()
                out.append(letters[d])
            else:
                raise ValueError(f"unsupported strftime directive %{d}")
            i += 2
        else:
            lit.append(ch)
            i += 1
    flush()
    return "".join(out)


# Patterns tried in order when no format is given (first that parses wins).
DEFAULT_PATTERNS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm",
                    "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy"]
# A time of day followed by an offset or a zone name, which makes a value an instant.
_SUFFIX = r"^(.*\d:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)\s*(Z|z|[+-]\d{2}(?::?\d{2})?|UTC|GMT|[A-Z][A-Za-z_]+(?:/[A-Z][A-Za-z_]+)+)$"
_OFFSET = r"[+-]\d{2}:?\d{2}|[Zz]$"
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _utc_wall(instant: Column) -> Column:
    """TIMESTAMP -> its wall clock in UTC (timestamp_ntz), without passing the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def _clock(text: Column, pattern: str) -> Column:
    """Text without zone -> wall clock, or NULL. It is read as if in UTC, so that hours which the session zone skips
    or repeats stay as they are."""
    return _utc_wall(F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{pattern} Z")))


def _shifted(wall: Column, zone: Column) -> Column:
    """Wall clock at an offset (`+02:00`, `+0200`, `+02`, `Z`) or in a named zone -> wall clock in UTC."""
    digits = F.replace(F.substring(zone, 2, 10), F.lit(":"), F.lit(""))
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    signed = F.when(zone.startswith("-"), minutes).otherwise(-minutes)
    return (F.when(F.upper(zone).isin("Z", "UTC", "GMT"), wall)
            .when(zone.rlike("^[+-]"), F.timestamp_add("MINUTE", signed, wall))
            .otherwise(F.convert_timezone(zone, F.lit("UTC"), wall)))


def parse_zoned(c: Column, fmt: str | None = None) -> Column:
    """struct(clock timestamp_ntz, zone string) of a text that names a time; NULL clock for text that does not parse.

    With an offset or zone in the value (`%z`, `%Z`, or found at its end without a format) the value is an
    instant: `clock` is its wall clock in UTC and `zone` the offset or name as written. Else it is a wall clock of no
    zone, returned as it is, with a NULL zone. Neither depends on the session zone."""
    t = c.cast("string")
    if fmt is None:
        found = F.regexp_extract(t, _SUFFIX, 2)
        zone = F.when(found != "", found)
        body = F.when(zone.isNotNull(), F.regexp_extract(t, _SUFFIX, 1)).otherwise(t)
        wall = F.coalesce(*[_clock(body, f"{p}[.SSSSSSSSS]" if "ss" in p else p) for p in DEFAULT_PATTERNS])
        clock = F.when(zone.isNull(), wall).otherwise(_shifted(wall, zone))
    elif "%z" in fmt.replace("%%", "") or "%Z" in fmt.replace("%%", ""):
        if "%z" in fmt.replace("%%", ""):  # %z reads +0200, +02:00 and Z alike
            forms = [strftime_to_java(fmt, offset=x) for x in ("XX", "XXX")]
            zone = F.element_at(F.regexp_extract_all(t, F.lit(f"({_OFFSET})"), F.lit(1)), -1)
        else:
            forms = [strftime_to_java(fmt, zone=x) for x in ("VV", "z")]
            zone = F.regexp_extract(t, r"([A-Za-z_]+(?:/[A-Za-z_]+)*)\s*$", 1)
        clock = F.coalesce(*[_utc_wall(F.try_to_timestamp(t, F.lit(p))) for p in forms])
    else:
        zone, clock = F.lit(None).cast("string"), _clock(t, strftime_to_java(fmt))
    return F.struct(clock.alias("clock"), F.when(clock.isNotNull(), zone).alias("zone"))


def parse_timestamp(c: Column, fmt: str | None = None) -> Column:
    """The clock of `parse_zoned`: a wall clock, in UTC for values with an offset or zone; NULL for text that does not
    parse."""
    return parse_zoned(c, fmt)["clock"]


def parse_in_zone(c: Column, fmt: str | None = None, zone: str = "UTC") -> Column:
    """UTC wall clock (timestamp_ntz) of each value: values with an offset or zone are instants already, others are wall
    clocks of `zone`."""
    z = parse_zoned(c, fmt)
    return F.when(z["zone"].isNotNull(), z["clock"]).otherwise(localize_utc(z["clock"], zone))


def localize_utc(wall: Column, zone: str = "UTC") -> Column:
    """A wall-clock time read in `zone`, expressed as the UTC wall clock (timestamp_ntz).

    Independent of the session time zone. `to_instant` turns the result into a TIMESTAMP.
    """
    w = wall.cast("timestamp_ntz")
    if zone in ("UTC", "Etc/UTC", "Z"):
        return w
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), w)


def to_instant(utc_wall: Column) -> Column:
    """UTC wall clock (timestamp_ntz) -> TIMESTAMP instant, without using the session zone."""
    return F.make_timestamp(F.year(utc_wall), F.month(utc_wall), F.dayofmonth(utc_wall),
                            F.hour(utc_wall), F.minute(utc_wall),
                            F.date_part(F.lit("SECOND"), utc_wall), F.lit("UTC"))
