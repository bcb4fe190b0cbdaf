"""Scalar helpers as native column expressions (no Python UDFs).

Each function takes and returns ``Column`` objects, so it stays inside
whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the click log and report tables.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"  # hours may be written without a leading zero
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time -------------------------------------------------------------------

def parse_time(s) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text to timestamp; NULL when unparsable."""
    return F.try_to_timestamp(_c(s), F.lit(TIME_PARSE_FORMAT))


def time_before(a, b) -> Column:
    """time text ``a`` strictly before ``b``."""
    return parse_time(a) < parse_time(b)


def time_after(a, b) -> Column:
    """time text ``a`` strictly after ``b``."""
    return parse_time(a) > parse_time(b)


def seconds_between(start, end) -> Column:
    """Seconds from ``start`` to ``end`` (timestamps), both cut to whole seconds first."""
    second = F.timestamp_diff("SECOND", F.lit("0001-01-01").cast("timestamp_ntz"), _c(end).cast("timestamp_ntz"))
    return second - F.timestamp_diff("SECOND", F.lit("0001-01-01").cast("timestamp_ntz"), _c(start).cast("timestamp_ntz"))


def time_minus(a, b) -> Column:
    """``a - b`` in whole seconds for two time texts."""
    return seconds_between(parse_time(b), parse_time(a))


def date_hour(ts) -> Column:
    """``yyyy-MM-dd_HH`` of a timestamp."""
    return F.date_format(_c(ts), DATE_HOUR_FORMAT)


def today() -> Column:
    """F5."""
    return F.current_date()


def yesterday() -> Column:
    """F6."""
    return F.date_sub(F.current_date(), 1)


def format_date(ts) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_time(ts) -> Column:
    """F8: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date_key(ts) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(_c(ts), DATE_KEY_FORMAT)


def parse_date_key(s) -> Column:
    """``yyyyMMdd`` text to date; NULL when unparsable."""
    return F.try_to_date(_c(s), DATE_KEY_FORMAT)


def format_minute_key(ts) -> Column:
    """``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), MINUTE_KEY_FORMAT)


def epoch_millis_to_ntz(ms) -> Column:
    """Epoch milliseconds to a UTC wall-clock ``timestamp_ntz`` (zone-free)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))


def epoch_millis_to_date(ms) -> Column:
    """epoch milliseconds to the UTC calendar date."""
    return epoch_millis_to_ntz(ms).cast("date")


def ntz_to_epoch_millis(ts) -> Column:
    """UTC wall-clock ``timestamp_ntz`` to epoch milliseconds (truncated).

    Built from the calendar day and the time-of-day fields, so the
    session time zone never enters.
    """
    t = _c(ts)
    day_ms = F.unix_date(t.cast("date")).cast("bigint") * 86_400_000
    tod_ms = (F.hour(t) * 3_600_000 + F.minute(t) * 60_000).cast("bigint")
    sec_ms = F.floor(F.date_part(F.lit("SECOND"), t) * 1000).cast("bigint")
    return day_ms + tod_ms + sec_ms


# -- numbers ----------------------------------------------------------------

def round_half_up(x, scale: int = 2) -> Column:
    """HALF_UP rounding of a double to ``scale`` places."""
    return F.round(_c(x), scale)


def ratio(numerator, denominator, scale: int = 2) -> Column:
    """Share rounded HALF_UP; NULL when the denominator is 0."""
    return F.round(F.try_divide(_c(numerator).cast("double"), _c(denominator)), scale)


# -- text -------------------------------------------------------------------

def is_empty(s) -> Column:
    """NULL or ''."""
    return _c(s).isNull() | (_c(s) == "")


def is_not_empty(s) -> Column:
    """neither NULL nor ''."""
    return _c(s).isNotNull() & (_c(s) != "")


def trim_comma(s) -> Column:
    """cut one leading and one trailing comma."""
    return F.regexp_replace(_c(s), r"^,|,$", "")


def pad2(s) -> Column:
    """F16: prefix one '0' unless the text has length 2 (longer text is kept)."""
    c = _c(s)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def _field_pattern(key: str) -> str:
    esc = "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in key)
    return r"(?:^|\|)" + esc + r"=([^=|]+)(?:\||$)"


def get_field(s, key: str) -> Column:
    """value of ``key`` in a ``k=v|k=v`` text; first well-formed token wins.

    Tokens without exactly one ``=`` or with an empty value are skipped;
    NULL when no token matches.
    """
    return F.nullif(F.regexp_extract(_c(s), _field_pattern(key), 1), F.lit(""))


def set_field(s, key: str, value) -> Column:
    """replace the value of ``key`` in a ``k=v|k=v`` text, order kept."""
    val = _c(value) if not isinstance(value, (str, int, float)) else F.lit(str(value))
    tokens = F.split(_c(s), r"\|")
    replaced = F.transform(
        tokens,
        lambda t: F.when(F.split_part(t, F.lit("="), F.lit(1)) == F.lit(key),
                         F.concat(F.lit(key + "="), val)).otherwise(t))
    return F.array_join(replaced, "|")


def concat_id_name(id_col, name_col, sep: str = ":") -> Column:
    """``<id><sep><name>``."""
    return F.concat_ws(sep, _c(id_col).cast("string"), _c(name_col))


def json_field(s, field: str) -> Column:
    """Top-level field of a JSON text as a string; NULL when absent."""
    return F.get_json_object(_c(s), f"$.{field}")


def csv_tokens(s) -> Column:
    """Non-empty tokens of a comma-separated text (NULL text gives NULL)."""
    return F.filter(F.split(_c(s), ","), lambda x: x != "")


def csv_to_ids(s) -> Column:
    """comma-separated ids to ``array<bigint>``; bad tokens become NULL."""
    return F.transform(csv_tokens(s), lambda x: x.try_cast("bigint"))


def pair_label(a, b, sep: str = "_") -> Column:
    """``<a>_<b>`` label."""
    return F.concat_ws(sep, _c(a).cast("string"), _c(b).cast("string"))


def sorted_distinct_join(c, sep: str = ",") -> Column:
    """U3 aggregate: distinct values, sorted, joined; NULL when there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(_c(c))), sep), F.lit(""))
