"""Column expressions used by the cleaning step.

Every helper returns a ``Column`` built from Spark built-ins only, so the
whole cleaning step stays one codegen'd Project + Filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Weekday keyword in a capture file's name -> capture date.
# When several match, the later entry in this list wins.
FILENAME_DATE_HINTS: list[tuple[str, str]] = [
    ("monday", "2017-07-03"),
    ("tuesday", "2017-07-04"),
    ("wednesday", "2017-07-05"),
    ("thursday", "2017-07-06"),
    ("friday", "2017-07-07"),
]

# Timestamp text formats, tried in this order; first parse wins.
TIMESTAMP_FORMATS: list[str] = [
    "d/M/yyyy H:mm",
    "d/M/yyyy H:mm:ss",
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy H:mm",
]

CAPTURE_FOLDER = "capture="

BENIGN = "BENIGN"
ATTACK = "ATTACK"
STRAY_HEADER_LABEL = "Label"


def nonfinite_to_null(c: Column) -> Column:
    """NaN, +Infinity and -Infinity become null (``isnan`` alone misses inf)."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def is_floating(data_type) -> bool:
    return isinstance(data_type, (DoubleType, FloatType))


def capture_name(path: Column) -> Column:
    """Name of the capture a row came from: the file's base name, or the value of its
    ``capture=`` folder where captures are stored as folders.  Plain searches for the last
    slashes; no pattern runs over the path."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    in_folder = folder.startswith(CAPTURE_FOLDER) & path.contains("/" + CAPTURE_FOLDER)
    return (F.when(in_folder, F.substring(folder, len(CAPTURE_FOLDER) + 1, 1 << 30))
            .otherwise(F.substring_index(path, "/", -1)))


def date_from_path(path: Column) -> Column:
    """Capture date hinted by a weekday keyword in the capture's name; else null.

    Folder names don't count.  One CASE with the last hint checked first ("last match
    wins").
    """
    return date_from_name(capture_name(path))


def date_from_name(name: Column) -> Column:
    """The same for a capture's name."""
    lowered = F.lower(name)
    out = None
    for keyword, day in reversed(FILENAME_DATE_HINTS):
        cond = lowered.contains(keyword)
        value = F.lit(day).cast("date")
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.lit(None).cast("date"))


# The formats above as patterns over their numbers.  Days, months and hours may have leading
# zeros; minutes and seconds have two digits, years four.
_DAY, _MONTH = r"0*([1-9]|[12][0-9]|3[01])", r"0*([1-9]|1[0-2])"
_H24, _H12 = r"0*([0-9]|1[0-9]|2[0-3])", r"0*([1-9]|1[0-2])"
_MIN_SEC, _YEAR = r"([0-5][0-9])", r"([0-9]{4})"
_DAY_FIRST = rf"^{_DAY}/{_MONTH}/{_YEAR} {_H24}:{_MIN_SEC}((?::[0-5][0-9])?)$"
_MONTH_FIRST_24 = rf"^{_MONTH}/{_DAY}/{_YEAR} {_H24}:{_MIN_SEC}$"
_MONTH_FIRST_12 = rf"^(?i){_MONTH}/{_DAY}/{_YEAR} {_H12}:{_MIN_SEC}:{_MIN_SEC} [ap]m$"


def _iso(text: Column, pattern: str, order: str) -> Column:
    """The text's numbers in ISO order, cast: null only where a month lacks the day."""
    return F.regexp_replace(text, pattern, order).try_cast("timestamp_ntz")


def parse_timestamp_multi(text: Column) -> Column:
    """The first of TIMESTAMP_FORMATS that parses, as a wall-clock ``timestamp_ntz``.

    The pattern that fits decides the format, so a miss costs no JVM exception: its numbers are put
    in ISO order and cast once.  A text that fits day first but names no date (31/2) fits no
    month-first format either."""
    noon = F.when(text.rlike(r" 0*12:"), F.lit(-12)).otherwise(F.lit(0))
    half = F.when(F.lower(text).endswith("pm"), F.lit(12)).otherwise(F.lit(0))
    in_half_days = _iso(text, _MONTH_FIRST_12, "$3-$1-$2 $4:$5:$6") + F.make_interval(hours=noon + half)
    return (F.when(text.rlike(_DAY_FIRST), _iso(text, _DAY_FIRST, "$3-$2-$1 $4:$5$6"))
            .when(text.rlike(_MONTH_FIRST_24), _iso(text, _MONTH_FIRST_24, "$3-$1-$2 $4:$5"))
            .when(text.rlike(_MONTH_FIRST_12), in_half_days))


def attack_category(label: Column) -> Column:
    return F.when(F.upper(label) == F.lit(BENIGN), F.lit(BENIGN)).otherwise(F.lit(ATTACK))


def flow_bytes(fwd: Column | None, bwd: Column | None) -> Column:
    """fwd + bwd as bigint when both columns exist, else 0.

    ``try_cast`` + ``try_add``: text or an overflowing sum gives null
    (skipped by ``sum``) instead of failing the job under ANSI.
    """
    if fwd is None or bwd is None:
        return F.lit(0).cast("bigint")
    return F.try_add(fwd.try_cast("bigint"), bwd.try_cast("bigint"))
