"""15-minute slots: columns, window arithmetic and prunable predicates.

All slot arithmetic is integer arithmetic on epoch milliseconds in UTC, so it does
not depend on the session time zone and stays inside generated code.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.errors import SpecError

SLOT_FORMAT = "%Y%m%d%H%M"
SLOT_COLUMNS = ("year", "month", "day", "hour", "min")
SLOT_MS = 15 * 60 * 1000
HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS


class Granularity(Enum):
    FIFTEEN_MIN = timedelta(minutes=15)
    HOUR = timedelta(hours=1)
    DAY = timedelta(days=1)


def parse_slot(slot_id: str | datetime) -> datetime:
    """``yyyyMMddHHmm`` (UTC) as a naive datetime on a quarter of an hour."""
    if isinstance(slot_id, datetime):
        moment = slot_id
    else:
        if not re.fullmatch(r"\d{12}", slot_id or ""):
            raise SpecError(f"slot id {slot_id!r} is not yyyyMMddHHmm")
        try:
            moment = datetime.strptime(slot_id, SLOT_FORMAT)
        except ValueError as error:
            raise SpecError(f"slot id {slot_id!r} is not a time") from error
    if moment.minute % 15 or moment.second or moment.microsecond:
        raise SpecError(f"slot {slot_id!r} is not on a quarter of an hour")
    return moment


def slot_id(moment: datetime) -> str:
    return moment.strftime(SLOT_FORMAT)


def check_window(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
    first, last = parse_slot(start), parse_slot(end)
    if first > last:
        raise SpecError(f"window starts at {first} after its end {last}")
    return first, last


def epoch_ms(moment: datetime) -> int:
    return (moment - datetime(1970, 1, 1)) // timedelta(milliseconds=1)


def window_steps(start, end, granularity: Granularity = Granularity.FIFTEEN_MIN) -> list[datetime]:
    """Steps of ``[start, end)``; the start step is always part of the window."""
    first, last = check_window(start, end)
    steps = [first]
    while steps[-1] + granularity.value < last:
        steps.append(steps[-1] + granularity.value)
    return steps


def slot_folder(moment: datetime, granularity: Granularity = Granularity.FIFTEEN_MIN) -> str:
    """Relative folder of a slot; hourly granularity globs over the quarters."""
    minute = f"{moment:%M}" if granularity is Granularity.FIFTEEN_MIN else "*"
    return f"year={moment:%Y}/month={moment:%m}/day={moment:%d}/hour={moment:%H}/min={minute}"


def window_folders(start, end, granularity: Granularity = Granularity.FIFTEEN_MIN) -> list[str]:
    return [slot_folder(step, granularity) for step in window_steps(start, end, granularity)]


def day_bucket_folders(pattern: str, start, end) -> list[str]:
    """Folders of a ``<yyyy-mm-dd>...`` pattern for every day the window touches.

    The text in angle brackets is a date pattern; what follows (for example
    ``/*/*``) is kept as it is.
    """
    found = re.fullmatch(r"([^<]*)<([^>]*)>(.*)", pattern)
    if found is None:
        raise SpecError(f"day bucket {pattern!r} has no <date pattern>")
    head, date_pattern, tail = found.groups()
    first, last = check_window(start, end)
    day = first.replace(hour=0, minute=0)
    folders = []
    while True:
        name = date_pattern
        for token, value in (("yyyy", f"{day:%Y}"), ("mm", f"{day:%m}"), ("dd", f"{day:%d}")):
            name = name.replace(token, value)
        folders.append(f"{head}{name}{tail}")
        day += timedelta(days=1)
        if day >= last:
            return folders


def slot_frame(spark: SparkSession, start, end, granularity: Granularity = Granularity.FIFTEEN_MIN) -> DataFrame:
    """The window's slots as rows (``slot_ms`` and the slot columns)."""
    first, last = check_window(start, end)
    step = int(granularity.value.total_seconds() * 1000)
    rows = spark.range(epoch_ms(first), max(epoch_ms(last), epoch_ms(first) + 1), step)
    return with_slot_columns(rows.withColumnRenamed("id", "slot_ms"), "slot_ms")


def as_epoch_ms(column: Column | str) -> Column:
    """A long or numeric text column as epoch milliseconds; other text gives null."""
    text = F.col(column) if isinstance(column, str) else column
    return text.cast("string").try_cast("bigint")


def timestamp_to_ms(name: str) -> Column:
    """A timestamp column without zone as epoch milliseconds, truncated."""
    return F.expr(f"({name} - timestamp_ntz'1970-01-01 00:00:00') div interval '0.001' second")


def slot_start(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(SLOT_MS))


def _slot_fields(ms: Column) -> dict[str, Column]:
    day = F.date_from_unix_date(((ms - F.pmod(ms, F.lit(DAY_MS))) / F.lit(DAY_MS)).cast("int"))
    in_day = F.pmod(ms, F.lit(DAY_MS))
    in_hour = F.pmod(ms, F.lit(HOUR_MS))

    def two_digits(number: Column) -> Column:
        return F.lpad(number.cast("int").cast("string"), 2, "0")

    return {
        "year": F.year(day),
        "month": two_digits(F.month(day)),
        "day": two_digits(F.dayofmonth(day)),
        "hour": two_digits(F.floor(in_day / HOUR_MS)),
        "min": two_digits(F.floor(in_hour / SLOT_MS) * 15),
    }


def with_slot_columns(df: DataFrame, epoch_column: str) -> DataFrame:
    """Adds year (int) and two-digit text month, day, hour and min of the slot."""
    quoted = "`" + epoch_column.replace("`", "``") + "`"
    return df.withColumns(_slot_fields(as_epoch_ms(quoted)))


def in_window(start, end, columns: tuple[str, ...] = SLOT_COLUMNS) -> Column:
    """``start <= slot < end`` as a lexicographic test on the partition columns.

    Only the raw partition columns are compared, never a value computed from
    several of them, so Spark can prune partitions by it. The leading test on the
    year alone also lets metastore-backed tables prune. The start slot is always part of
    the window, as in ``window_steps``.
    """
    first, last = check_window(start, end)
    last = max(last, first + Granularity.FIFTEEN_MIN.value)

    def bound(moment: datetime, strict) -> Column:
        values = [moment.year, f"{moment:%m}", f"{moment:%d}", f"{moment:%H}", f"{moment:%M}"]
        test = strict(F.col(columns[-1]), F.lit(values[-1]), True)
        for name, value in list(zip(columns, values))[-2::-1]:
            test = strict(F.col(name), F.lit(value), False) | ((F.col(name) == F.lit(value)) & test)
        return test

    lower = bound(first, lambda c, v, closed: c >= v if closed else c > v)
    upper = bound(last, lambda c, v, closed: c < v)
    return (F.col(columns[0]).between(first.year, last.year)) & lower & upper
