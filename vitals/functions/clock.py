"""Time: lenient instant parsing, hour partitions, stream order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import double_of, is_number_type, text_of

EPOCH_MILLIS_ABOVE = 1e11
_MIN_EPOCH_SECOND = -62135596800  # 0001-01-01
_MAX_EPOCH_SECOND = 253402300799  # 9999-12-31

# The usual form; Spark's own cast reads it.
_USUAL_ISO = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?\z"
)

_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}-\d|\d{4}-W\d{2}|\d{4}W\d{3}|\d{4}W\d{2})"
_HOUR, _SIXTY = r"(?:[01]\d|2[0-3])", r"[0-5]\d"
_TIME = rf"({_HOUR}(?::{_SIXTY}(?::{_SIXTY})?)?|{_HOUR}{_SIXTY}(?:{_SIXTY})?)(?:[.,](\d+))?"
_OFFSET = r"([+-])(\d{2}(?::\d{2}(?::\d{2})?)?|\d{4}(?:\d{2})?)(?:[.,](\d+))?"
# Groups: 1 date, 2 clock, 3 fraction, 4 offset sign, 5 offset clock, 6 offset fraction.
_ANY_ISO = rf"(?s)^(?!0000){_DATE}(?:.{_TIME}(?:{_OFFSET})?)?\z"


def _week_date(digits: Column) -> Column:
    """Date of year, week and weekday written as seven digits; null if there is none."""
    year, week, weekday = (
        F.substring(digits, i, n).cast("int") for i, n in ((1, 4), (5, 2), (7, 1))
    )
    first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    day = F.date_add(first_monday, week * 7 + weekday - 8)
    return F.when(weekday.between(1, 7) & (F.weekofyear(day) == week), day)


def _micros_at(date: Column, clock: Column, fraction: Column) -> Column:
    """Microseconds since 1970 of a date with a clock such as '14', '1430' or '14:30:05'."""
    digits = F.rpad(F.translate(clock, ":", ""), 6, "0")
    in_full = F.regexp_replace(digits, "(..)(..)(..)", "T$1:$2:$3.")
    return F.unix_micros(
        F.concat(date, in_full, F.rpad(fraction, 6, "0"), F.lit("Z")).try_cast("timestamp")
    )


def _instant_of_parts(parts: Column) -> Column:
    date, clock, fraction, sign, offset, offset_fraction = (parts[i] for i in range(6))
    day = F.when(
        date.contains("W"), _week_date(F.rpad(F.translate(date, "-W", ""), 7, "1")).cast("string")
    ).otherwise(F.regexp_replace(date, r"(\d{4})-?(\d\d)-?(\d\d)", "$1-$2-$3"))
    shift = _micros_at(F.lit("1970-01-01"), offset, offset_fraction)
    return F.timestamp_micros(
        _micros_at(day, clock, fraction) + F.when(sign == "-", shift).otherwise(-shift)
    )


def with_iso_instant(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, a TIMESTAMP: any ISO 8601 date and clock form, any separator; no offset means UTC.

    Spark's cast reads the usual form. Any other form is cut into its six parts inside a lambda:
    that is interpreted, on the few rows that need it, and so does not swell the code generated for
    all the others beyond what is compiled to machine code.
    """
    usual = F.col(text).rlike(_USUAL_ISO)
    iso = F.replace(F.col(text), F.lit("Z"), F.lit("+00:00"))
    parts = F.split(F.regexp_replace(iso, _ANY_ISO, "$1|$2|$3|$4|$5|$6"), r"\|")
    other = F.transform(F.array(parts), _instant_of_parts)[0]
    return df.withColumn(
        out,
        F.when(usual, F.col(text).try_cast("timestamp")).when(iso.rlike(_ANY_ISO), other),
    )


def from_seconds(seconds: Column) -> Column:
    """Epoch seconds to TIMESTAMP, rounded half-even to a microsecond; null outside years 1 to 9999."""
    whole = F.floor(seconds)
    micros = whole.cast("bigint") * 1_000_000 + F.rint((seconds - whole) * 1_000_000).cast("bigint")
    return F.when(
        (seconds >= _MIN_EPOCH_SECOND) & (seconds < _MAX_EPOCH_SECOND + 1), F.timestamp_micros(micros)
    )


def parse_epoch(number: Column) -> Column:
    """Epoch seconds, or milliseconds when too large to be seconds."""
    return from_seconds(F.when(number > EPOCH_MILLIS_ABOVE, number / 1000).otherwise(number))


def with_instant(df: DataFrame, value: Column, type_name: Column, out: str) -> DataFrame:
    """Add ``out``: a VARIANT holding ISO text or an epoch number as TIMESTAMP; null for anything else."""
    kept = df.withColumns(
        {
            "_text": F.when(type_name == "STRING", text_of(value)),
            "_number": F.when(is_number_type(type_name), double_of(value)),
        }
    )
    return (
        with_iso_instant(kept, "_text", "_from_text")
        .withColumn(out, F.coalesce("_from_text", parse_epoch(F.col("_number"))))
        .drop("_text", "_number", "_from_text")
    )


def utc_text(ts: Column) -> Column:
    """ISO 8601 text with an explicit offset; the fraction appears only when there is one."""
    whole = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) == 0
    return F.concat(
        F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        ),
        F.lit("+00:00"),
    )


def to_stored(ts: Column) -> Column:
    """Zone-less UTC at millisecond precision, the form tables keep."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def hour_partition(ts: Column) -> dict[str, Column]:
    return {"dt": F.to_date(ts).cast("string"), "hour": F.lpad(F.hour(ts).cast("string"), 2, "0")}


def stream_order(sequence_number: Column) -> list[Column]:
    """Sort keys giving decimal strings of any length their numeric order."""
    digits = F.ltrim(sequence_number, F.lit("0"))
    return [F.length(digits), digits]


def bucket_start(epoch_seconds: Column, width: int) -> Column:
    """Start of the ``width``-second bucket, as epoch seconds; integer arithmetic, no text."""
    return epoch_seconds - F.pmod(epoch_seconds, F.lit(width))
