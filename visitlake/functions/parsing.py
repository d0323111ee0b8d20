"""Lenient text-to-value rules of the loader, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake.functions.ladders import ladder

# Accepted layouts of dates and of times behind them, besides ISO 8601,
# with the shape of their texts. A layout is tried only on texts of its shape, since a
# failed attempt costs far more than a look at the shape. Texts are tidied first, see
# ``tidied``, so that weekdays, commas, long month names and lower case need no layouts.
DATE_LAYOUTS = [
    ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "M/d/yyyy"),
    ("[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", "M-d-yyyy"),
    ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "yyyy/M/d"),
    ("[A-Z][a-z]{2} [0-9]{1,2} [0-9]{4}", "MMM d yyyy"),
    ("[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}", "d MMM yyyy"),
]
TIME_LAYOUTS = [
    ("", ""),
    (" [0-9]{1,2}:[0-9]{2}", " H:mm"),
    (" [0-9]{1,2}:[0-9]{2}:[0-9]{2}", " H:mm:ss"),
    (" [0-9]{1,2}:[0-9]{2} [AP]M", " h:mm a"),
    (" [0-9]{1,2}:[0-9]{2}:[0-9]{2} [AP]M", " h:mm:ss a"),
]
WEEKDAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun"
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
# Written numbers, and whole numbers in base 16, 8 and 2.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BASES = [(16, "^0[xX][0-9a-fA-F]+$"), (8, "^0[oO][0-7]+$"), (2, "^0[bB][01]+$")]


def text(c: Column) -> Column:
    """Missing text becomes the empty text."""
    return F.coalesce(c, F.lit(""))


def flag(c: Column) -> Column:
    """True only for the word "true" in any case."""
    return F.coalesce(F.lower(c) == "true", F.lit(False))


def email(c: Column, owner: Column) -> Column:
    """A blank address becomes a placeholder that is the same in every rerun."""
    made_up = F.concat(F.lit("no-email-"), F.substring(F.sha2(text(owner), 256), 1, 16), F.lit("@placeholder.com"))
    return F.when(c.isNull() | c.rlike(r"\A\s*\z"), made_up).otherwise(c)


def tidied(c: Column) -> Column:
    """A written date in one manner: no weekday, comma or zone name, short month names, AM and PM in capitals."""
    words = F.initcap(F.regexp_replace(F.regexp_replace(F.trim(c), ",", " "), r"\s+", " "))
    words = F.regexp_replace(words, f"^({WEEKDAYS})[a-z]* ", "")
    words = F.regexp_replace(words, " (Gmt|Utc|Z)([+]0+)?( [(].*[)])?$", "")
    words = F.regexp_replace(words, f"(^| )({MONTHS})[a-z]*[.]? ", "$1$2 ")
    for half in ("AM", "PM"):
        words = F.regexp_replace(words, f" ?(?i){half}$", f" {half}")
    return words


def timestamp(c: Column) -> Column:
    """A time in milliseconds, read as UTC unless the text names an offset; NULL if unreadable."""
    trimmed = F.trim(c)
    iso = F.when(trimmed.rlike(r"^[0-9]{4}(-|$)"), F.try_to_timestamp(trimmed))
    tidy = F.when(trimmed.rlike("[0-9]") & ~trimmed.rlike(r"^[0-9]{4}(-|$)"), tidied(c))
    layouts = [(day + time, day_layout + layout) for day, day_layout in DATE_LAYOUTS for time, layout in TIME_LAYOUTS]

    def by_shape(t: Column) -> Column:
        return ladder([(t.rlike(f"^{shape}$"), F.try_to_timestamp(t, F.lit(layout))) for shape, layout in layouts], None)

    # a one-element array binds the tidied text, which would else be written out once per layout
    other = F.get(F.transform(F.array(tidy), by_shape), 0)
    return F.date_trunc("millisecond", F.coalesce(iso, other)).cast("timestamp_ntz")


def unreadable_time(c: Column, value: Column) -> Column:
    """Whether a text means a time but none could be read from it."""
    return F.coalesce(~F.lower(F.trim(c)).isin("", "none", "null"), F.lit(False)) & value.isNull()


def whole_number(c: Column) -> Column:
    """An INT, truncated; 0 when the text is not a number."""
    trimmed = F.trim(c)
    value = F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))
    for base, shape in BASES:
        value = value.when(trimmed.rlike(shape), F.conv(F.substring(trimmed, 3, 64), base, 10).try_cast("double"))
    return F.coalesce(value.try_cast("int"), F.lit(0))
