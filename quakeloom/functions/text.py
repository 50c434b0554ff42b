"""Text and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quakeloom.functions.numeric import as_col, exact_half_even

# Day 1 is Sunday.
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]

# Category ids of the natural-event feed and their short names.
CATEGORY_NAMES = {
    "wildfires": "wildfire",
    "severeStorms": "storm",
    "volcanoes": "volcano",
    "floods": "flood",
    "seaLakeIce": "ice",
    "landslides": "landslide",
    "drought": "drought",
    "dustHaze": "dust_haze",
    "manmade": "manmade",
    "snow": "snow",
}

_BLANKS = " \t\r\n"


def region_of(place: Column | str = "place") -> Column:
    """Text after the last comma, trimmed; the whole place without one."""
    p = as_col(place)
    last = F.element_at(F.split(p, ","), -1)
    return F.when(p.isNull(), "Unknown").otherwise(F.btrim(last, F.lit(_BLANKS)))


def category_name(category_id: Column | str) -> Column:
    """Short event type; an unmapped category keeps its own id."""
    pairs = [F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair]
    c = as_col(category_id)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def title_case(c: Column | str) -> Column:
    """Capitalise every run of letters; anything else ends a word."""
    words = F.regexp_extract_all(as_col(c), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(words, F.initcap), "")


def weekday_name(day_of_week: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), as_col(day_of_week).cast("int"))


def shown(c: Column | str) -> Column:
    """Text of a value; a missing one prints as ``None``."""
    return F.coalesce(as_col(c).cast("string"), F.lit("None"))


def one_decimal(c: Column | str) -> Column:
    """Text with one decimal; a missing value prints as ``nan``."""
    return F.when(as_col(c).isNull(), "nan").otherwise(F.format_string("%.1f", exact_half_even(c, 1)))


def iso_utc(millis: Column) -> Column:
    """Epoch milliseconds as ISO-8601 UTC text, fraction only when there is one."""
    ts = F.timestamp_millis(millis)
    fraction = F.when(F.pmod(millis, F.lit(1000)) == 0, "").otherwise(F.date_format(ts, ".SSS'000'"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def minute_text(ts: Column | str) -> Column:
    """The first 16 characters of the ISO text: date, hour and minute."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm")


def stable_fraction(key: Column | str) -> Column:
    """A value in [0, 1) fixed by the key alone, whatever the partitioning."""
    digits = F.substring(F.md5(as_col(key).cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 4294967296.0
