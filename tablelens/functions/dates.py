"""Dates inside text: mixed-format parsing, literal clean-up, bounds of a filter text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts accepted in text columns, by the shape of the text: a shape is tested before its layouts
# are tried in this order, so a text is only parsed by layouts it can have.
DATE_LAYOUTS = {
    r"^\d{4}-": (
        "yyyy-M-d",
        "yyyy-M-d'T'H:mm[:ss][.SSSSSSSSS][XXX][XX]",
        "yyyy-M-d H:mm[:ss][.SSSSSSSSS][XXX][XX]",
    ),
    r"^\d{4}/": ("yyyy/M/d", "yyyy/M/d H:mm[:ss][.SSSSSSSSS]"),
    r"^\d{4}\.": ("yyyy.M.d", "yyyy.M.d H:mm[:ss][.SSSSSSSSS]"),
    r"^\d{1,2}/\d{1,2}/\d{4}": ("M/d/yyyy", "M/d/yyyy h:mm[:ss] a", "M/d/yyyy H:mm[:ss][.SSSSSSSSS]"),
    r"^\d{1,2}/\d{1,2}/\d{2}(?!\d)": ("M/d/yy", "M/d/yy h:mm[:ss] a", "M/d/yy H:mm[:ss]"),
    r"^\d{8}$": ("yyyyMMdd",),
    r"^[A-Za-z]{3}\s": ("MMM d[,] yyyy", "MMM d[,] yyyy h:mm[:ss] a", "MMM d[,] yyyy H:mm[:ss]"),
    r"^[A-Za-z]{4,}\s": ("MMMM d[,] yyyy", "MMMM d[,] yyyy h:mm[:ss] a", "MMMM d[,] yyyy H:mm[:ss]"),
    r"^[Mm][Aa][Yy]\s": ("MMMM d[,] yyyy",),
    r"^\d{1,2}[ -][A-Za-z]{3}[ -]": ("d MMM yyyy", "d-MMM-yyyy", "d MMM yyyy H:mm[:ss]", "d-MMM-yyyy H:mm[:ss]"),
    r"^\d{1,2}[ -][A-Za-z]{4,}[ -]": ("d MMMM yyyy", "d-MMMM-yyyy", "d MMMM yyyy H:mm[:ss]"),
}
#: All layouts, in order.
DATE_FORMATS = tuple(layout for layouts in DATE_LAYOUTS.values() for layout in layouts)
LOWER_OPS = ("ge", "gt", "eq")
UPPER_OPS = ("le", "lt", "eq")


def _literal() -> str:
    """Every spelling of a day in a filter text that is not a bare ISO day already."""
    short, two, four, quote = r"\d{1,2}", r"\d{2}", r"\d{4}", "['\"]"
    iso = "-".join((four, two, two))
    slashes = "/".join((short, short, four)) + rf"(?:\s+{short}:{two}:{two}\s*(?:AM|PM)?)?"
    spellings = (
        f"{quote}{iso}(?:T[^'\"]*)?{quote}",
        rf"{iso}T{two}:{two}:{two}[Z\d:.+\-]*",
        f"{quote}{slashes}{quote}",
        slashes,
    )
    return "|".join(spellings)


def parse_timestamp(col: Column) -> Column:
    """Timestamp from text in any of DATE_LAYOUTS, else null; two-digit years are 1969 to 2068."""
    text = F.trim(col)

    def read(layout: str) -> Column:
        at = F.try_to_timestamp(text, F.lit(layout))
        if "yyyy" in layout:
            return at
        return F.when(F.year(at) > 2068, at - F.expr("interval 100 years")).otherwise(at)

    found = [F.when(text.rlike(shape), F.coalesce(*map(read, layouts))) for shape, layouts in DATE_LAYOUTS.items()]
    return F.coalesce(*found)


def normalize_dates(col: Column) -> Column:
    """Rewrite the date literals of a filter text to bare ISO days."""
    literal = F.lit(_literal())
    found, around = F.regexp_extract_all(col, literal, F.lit(0)), F.split(col, _literal(), -1)

    def iso(text: Column) -> Column:
        number = F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))
        month_first = F.array(number[2], F.lpad(number[0], 2, "0"), F.lpad(number[1], 2, "0"))
        return F.array_join(F.when(text.contains("/"), month_first).otherwise(F.slice(number, 1, 3)), "-")

    days = F.transform(found, iso)
    return F.array_join(F.transform(around, lambda text, i: F.concat(text, F.coalesce(F.get(days, i), F.lit("")))), "")


def date_bounds(col: Column, field: str) -> Column:
    """Closed bounds a filter text sets on `field`, as struct(min DATE, max DATE).

    The last comparison on a side wins; a side never compared stays null.
    """
    # the closing quote keeps names with spaces usable
    found = r'(?<!\w)"?' + _java_quote(field) + r'"?\s+(ge|gt|le|lt|eq)\s+(\d{4}-\d{2}-\d{2})'
    pairs = F.arrays_zip(
        F.regexp_extract_all(col, F.lit(found), F.lit(1)).alias("op"),
        F.regexp_extract_all(col, F.lit(found), F.lit(2)).alias("day"),
    )

    def last_of(ops: tuple[str, ...]) -> Column:
        hits = F.filter(pairs, lambda p: p["op"].isin(*ops))
        return F.try_element_at(hits, F.lit(-1))["day"].try_cast("date")

    return F.struct(last_of(LOWER_OPS).alias("min"), last_of(UPPER_OPS).alias("max"))


def _java_quote(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def epoch_micros(col: Column) -> Column:
    """Microseconds since 1970 of a timestamp's clock reading, free of any time zone."""
    seconds = (
        F.unix_date(F.to_date(col)).cast("long") * 86400
        + F.hour(col) * 3600
        + F.minute(col) * 60
    )
    fraction = (F.extract(F.lit("SECOND"), col) * 1000000).cast("long")
    return seconds * 1000000 + fraction


def from_epoch_micros(micros: Column) -> Column:
    """Zone-free timestamp from microseconds since 1970."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
