"""Cleaning of text cells: Column in, Column out, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width characters and their half-width forms.
WIDE_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
WIDE_MARKS, MARKS = "．－", ".-"
WIDE_LETTERS, LETTERS = "ＦＬ", "FL"
WIDE_SPACE = "　"
DASHES = ["-", "—", "ー", "―"]

# The full-width block is the printable ASCII block shifted by a constant.
ALL_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
ALL_NARROW = "".join(chr(0x21 + i) for i in range(94))

# Patterns hold the white space themselves, so a cell is matched once.
NUMBER = r"^[\s　]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[\s　]*$"
WHOLE = r"^[\s　]*([+-]?[0-9]+)(?:\.0*)?[\s　]*$"
PLACE = r"^[\s　]*([1-6])(?:\.0*)?[\s　]*$"
COUNT = r"^[\s　]*([0-9]+)(?:\.0)?[\s　]*$"


def strip(c: Column) -> Column:
    """Trim ASCII and full-width white space on both sides."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c" + WIDE_SPACE))


def half_width(c: Column, marks: bool = True, letters: bool = False) -> Column:
    """Full-width digits (and optionally marks, F/L) to half-width."""
    wide, narrow = WIDE_DIGITS, DIGITS
    if marks:
        wide, narrow = wide + WIDE_MARKS, narrow + MARKS
    if letters:
        wide, narrow = wide + WIDE_LETTERS, narrow + LETTERS
    return F.translate(c, wide, narrow)


def half_width_all(c: Column) -> Column:
    return F.translate(c, ALL_WIDE, ALL_NARROW)


def taken(c: Column, pattern: str, kind: str) -> Column:
    """First group of the pattern cast to ``kind``; no match is null."""
    return F.regexp_extract(c.cast("string"), pattern, 1).try_cast(kind)


def to_number(c: Column) -> Column:
    """Tolerant cast to DOUBLE; anything that is not a plain number is null."""
    return taken(c, NUMBER, "double")


def to_whole(c: Column) -> Column:
    """Tolerant cast to BIGINT that accepts ``1.0``; fractions become null."""
    return taken(c, WHOLE, "long")


def to_flag(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "t", "yes", "y"), F.lit(False))


def is_blank_mark(c: Column) -> Column:
    """Empty or one of the dash marks."""
    return (c == "") | c.isin(DASHES)


def pad_left(c: Column, width: int) -> Column:
    """Zero-pad without cutting longer text (``lpad`` alone would cut)."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def drop_point_zero(c: Column) -> Column:
    return F.regexp_replace(strip(c.cast("string")), r"\.0$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(~c.isin("", "nan", "None"), c)


def venue_code(c: Column) -> Column:
    """``1`` / ``1.0`` -> ``01``; other text is kept."""
    t = drop_point_zero(blank_to_null(strip(c.cast("string"))))
    return F.regexp_replace(t, "^([0-9])$", "0$1")


def motor_key(c: Column) -> Column:
    """``11101`` / ``11101.0`` -> ``011101``."""
    digits = F.regexp_replace(drop_point_zero(c), r"[^0-9]", "")
    return F.when(digits != "", pad_left(digits, 6))


def section_key(c: Column) -> Column:
    """``20240928-3`` / ``20240928_3`` -> ``20240928_03``; other text is kept."""
    t = F.replace(strip(c.cast("string")), F.lit("-"), F.lit("_"))
    return F.nullif(F.regexp_replace(t, r"^([0-9]{8})_([0-9])$", "$1_0$2"), F.lit(""))


def race_key(c: Column) -> Column:
    """Undo ``2.02504E+11``; digits and other text are only trimmed."""
    t = strip(c.cast("string"))
    plain = t.try_cast("decimal(38,10)").cast("decimal(38,0)").cast("string")
    return (
        F.when((t == "") | (F.lower(t) == "nan"), None)
        .when(t.rlike(r"^[0-9]+(\.[0-9]+)?[eE]\+[0-9]+$"), F.coalesce(plain, t))
        .otherwise(t)
    )


def parse_day(c: Column) -> Column:
    """Date from ``YYYYMMDD`` (also with ``.0``), ``YYYY-MM-DD`` or ``YYYY/MM/DD``."""
    t = drop_point_zero(c)
    dashed = F.replace(F.substring(t, 1, 10), F.lit("/"), F.lit("-"))
    compact = F.when(t.rlike("^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd"))
    generic = F.when(dashed.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), dashed.try_cast("date"))
    return F.coalesce(compact, generic)


def compact_day(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def iso_day(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def first_int(c: Column) -> Column:
    return taken(half_width(c.cast("string")), r"([0-9]+)", "long")


def first_decimal(c: Column) -> Column:
    return taken(half_width(c.cast("string")), r"([0-9]+(?:\.[0-9]+)?)", "double")


def percent(c: Column) -> Column:
    return to_number(F.replace(half_width(c.cast("string")), F.lit("%"), F.lit("")))


def parse_count(c: Column) -> Column:
    """Digits only, optional ``.0``."""
    return taken(half_width(c.cast("string")), COUNT, "long")


def parse_lane(c: Column) -> Column:
    return taken(half_width(c.cast("string")), PLACE, "long")


def payout_amount(c: Column) -> Column:
    """Strip currency signs and thousands commas; digits only, else null."""
    return taken(F.regexp_replace(half_width(c.cast("string")), r"[¥￥\\円,]", ""), r"^[\s　]*([0-9]+)[\s　]*$", "long")


def race_number(c: Column) -> Column:
    """``7R`` -> 7."""
    return first_int(c)


def person_name(c: Column) -> Column:
    """Runs of full-width spaces become one space."""
    return F.trim(F.regexp_replace(c, "　+", " "))


def strip_unit(c: Column, unit: str) -> Column:
    """Number in front of a unit such as ``kg``, ``歳``, ``℃``, ``m`` or ``cm``."""
    return to_number(F.replace(half_width(c.cast("string")), F.lit(unit), F.lit("")))


def start_mean(c: Column) -> Column:
    """A dash stands for the neutral mean 0.19; the replacement is by substring."""
    return F.replace(c, F.lit("-"), F.lit("0.19"))


def split_token(c: Column, position: int) -> Column:
    """Token ``position`` (0-based) of white-space separated text."""
    return F.get(F.split(strip(c), r"\s+"), position)


def slash_part(c: Column, position: int) -> Column:
    """Part ``position`` (0-based) of slash separated text, trimmed."""
    return strip(F.get(F.split(c, "/"), position))
