"""Column functions; everything here stays in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.schemas import SCORE_DIGITS

# Fixed value: the characters a JVM string trim removes.
CONTROL_AND_SPACE = "".join(chr(code) for code in range(33))
MILLISECONDS_FROM = 100_000_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(CONTROL_AND_SPACE))


def stable(score: Column | str) -> Column:
    """A score that compares and sorts the same whatever order its parts were summed in."""
    return F.round(_col(score), SCORE_DIGITS)


def norm_epoch(ts: Column | str) -> Column:
    """Epoch seconds from a column that mixes seconds and milliseconds."""
    ts = _col(ts).cast("long")
    return F.when(ts >= MILLISECONDS_FROM, F.floor(ts / 1000)).otherwise(ts)


def year_month(ts: Column | str, offset_seconds: int = 0) -> Column:
    """``yyyyMM`` as an int, in UTC shifted by a fixed offset; independent of the session zone."""
    day = F.date_from_unix_date(F.floor((norm_epoch(ts) + F.lit(offset_seconds)) / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def wall_seconds(ts: Column | str) -> Column:
    """Seconds since 1970 of a zone-less timestamp, read as UTC whatever the session zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (_col(ts).cast("timestamp_ntz") - start).cast("interval second").cast("long")


def half_star_bin(score: Column | str) -> Column:
    return F.floor(_col(score) / 0.5 + 0.5) / 2


def contains_ci(text: Column | str, part: Column | str) -> Column:
    return F.contains(F.lower(_col(text)), F.lower(_col(part)))


def first_word(text: Column | str) -> Column:
    return F.get(F.split(_col(text), " "), F.lit(0))


def split_prefs(text: Column | str) -> Column:
    """Comma-separated categories; blanks at the end do not count."""
    return F.split(F.regexp_replace(_col(text), ",+$", ""), ",")


def split_values(text: Column | str) -> Column:
    """Tokens of a ``|``-joined column."""
    return F.split(_col(text), r"\|")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a).cast("array<double>"), _col(b).cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two array columns; null when either has length zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def log10_count(n: Column | str) -> Column:
    """Base-10 logarithm of a count, where a missing count stands for one."""
    return F.log10(F.greatest(F.lit(1), F.coalesce(_col(n), F.lit(1))).cast("double"))


def user_id_of(name: Column | str) -> Column:
    """Signed 32-bit polynomial string hash over UTF-16 units, base 31."""
    mask = F.lit(0xFFFFFFFF).cast("long")

    def step(h: Column, unit: Column) -> Column:
        return (h * 31 + unit).bitwiseAND(mask)

    def add_char(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("long")
        rest = code - 0x10000
        high, low = F.floor(rest / 1024) + 0xD800, F.pmod(rest, F.lit(1024)) + 0xDC00
        return F.when(code < 0x10000, step(h, code)).otherwise(step(step(h, high), low))

    chars = F.filter(F.split(_col(name), ""), lambda c: c != "")
    h = F.aggregate(chars, F.lit(0).cast("long"), add_char)
    return F.when(h >= 0x80000000, h - 0x100000000).otherwise(h)


def words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.filter(F.split(F.lower(_col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
