"""Hour series, daylight-saving calendar and local-to-UTC bucketing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from functools import cached_property
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.errors import ParameterError

HOUR = timedelta(hours=1)


@dataclass(frozen=True)
class LocalAnomaly:
    """One local clock hour that a zone skips ('nonexistent') or repeats ('ambiguous').

    offsets are the UTC offsets before and after the change.
    """

    kind: str
    start: datetime
    end: datetime
    offsets: tuple[timedelta, timedelta]


def ntz(value: datetime) -> Column:
    """Literal of type TIMESTAMP_NTZ from a naive datetime."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def instant(value: datetime) -> Column:
    """Literal of type TIMESTAMP from an aware datetime, free of the session zone."""
    return F.timestamp_micros(F.lit(round(value.timestamp() * 1_000_000)))


def offset_changes(
    start: datetime, end: datetime, tz: str
) -> Iterator[tuple[datetime, timedelta, timedelta]]:
    """UTC instants near the window where the zone's offset changes: (at, before, after)."""
    zone = ZoneInfo(tz)

    def offset(at: datetime) -> timedelta:
        return at.astimezone(zone).utcoffset()

    at = start.replace(tzinfo=UTC) - timedelta(days=2)
    stop = end.replace(tzinfo=UTC) + timedelta(days=2)
    while at < stop:
        low, high = at, at + timedelta(hours=6)
        at = high
        before, after = offset(low), offset(high)
        if before == after:
            continue
        while high - low > timedelta(seconds=1):
            middle = low + timedelta(seconds=int((high - low).total_seconds()) // 2)
            if offset(middle) == before:
                low = middle
            else:
                high = middle
        yield high, before, after


def local_anomalies(start: datetime, end: datetime, tz: str) -> tuple[LocalAnomaly, ...]:
    """Local hours in [start, end) whose half-hour mark falls in a clock change."""
    found = []
    for at, before, after in offset_changes(start, end, tz):
        wall = at.replace(tzinfo=None)
        kind = "nonexistent" if after > before else "ambiguous"
        low, high = wall + min(before, after), wall + max(before, after)
        slot = low.replace(minute=0, second=0, microsecond=0)
        while slot < high:
            if low <= slot + HOUR / 2 < high and start <= slot < end:
                found.append(LocalAnomaly(kind, slot, slot + HOUR, (before, after)))
            slot += HOUR
    return tuple(found)


@dataclass(frozen=True)
class LocalWindow:
    """A half-open local-time window [start, end) of one source in zone tz."""

    start: datetime
    end: datetime
    tz: str

    def __post_init__(self) -> None:
        if self.start.tzinfo is not None or self.end.tzinfo is not None:
            raise ParameterError("window bounds are local wall times without a zone")
        for bound in (self.start, self.end):
            if bound.minute or bound.second or bound.microsecond:
                raise ParameterError("window bounds must align to whole hours")
        if self.start >= self.end:
            raise ParameterError("window start must be before its end")

    @classmethod
    def month(cls, month: str, tz: str) -> LocalWindow:
        start = datetime.strptime(month, "%Y-%m")
        return cls(start, (start + timedelta(days=32)).replace(day=1), tz)

    @classmethod
    def months(cls, months: list[str], tz: str) -> LocalWindow:
        """One window over consecutive months."""
        windows = [cls.month(month, tz) for month in months]
        for earlier, later in zip(windows, windows[1:]):
            if earlier.end != later.start:
                raise ParameterError("months must be consecutive")
        return cls(windows[0].start, windows[-1].end, tz)

    @property
    def label(self) -> str:
        return self.start.strftime("%Y-%m")

    @cached_property
    def anomalies(self) -> tuple[LocalAnomaly, ...]:
        return local_anomalies(self.start, self.end, self.tz)

    @property
    def utc_start(self) -> datetime:
        return self.start.replace(tzinfo=ZoneInfo(self.tz)).astimezone(UTC)

    @property
    def utc_end(self) -> datetime:
        return self.end.replace(tzinfo=ZoneInfo(self.tz)).astimezone(UTC)

    @property
    def hours(self) -> int:
        return int((self.utc_end - self.utc_start) / HOUR)

    @property
    def ambiguous_hours(self) -> tuple[datetime, ...]:
        """UTC hours that a repeated local hour may stand for: one per offset."""
        hours = set()
        for item in self.anomalies:
            if item.kind == "ambiguous":
                for offset in item.offsets:
                    passed = (item.start - offset).replace(minute=0, tzinfo=UTC)
                    hours.add(passed)
        return tuple(sorted(hours))


def hour_series(spark: SparkSession, start: datetime, end: datetime, name: str) -> DataFrame:
    """All hours of [start, end): TIMESTAMP for aware bounds, TIMESTAMP_NTZ for naive."""
    aware = start.tzinfo is not None
    origin = int((start if aware else start.replace(tzinfo=UTC)).timestamp())
    hour = F.timestamp_seconds(F.lit(origin) + F.col("id") * 3600)
    if not aware:
        hour = hour.cast("timestamp_ntz")
    return spark.range(int((end - start) / HOUR)).select(hour.alias(name))


def utc_hours_array(start: datetime, end: datetime) -> Column:
    """Array of the UTC hours of [start, end), to explode beside an entity."""
    return F.sequence(instant(start), instant(end - HOUR), F.expr("INTERVAL 1 HOUR"))


def utc_hour(local_ts: Column, tz: str) -> Column:
    """UTC hour bucket of a local wall time."""
    return F.date_trunc("hour", F.to_utc_timestamp(local_ts, tz))


def utc_offset_seconds(local_ts: Column, window: LocalWindow) -> Column:
    """UTC offset in force at a wall time of the window, from literal change points.

    Skipped and repeated wall times have no single offset; they are to be
    rejected beforehand.
    """
    changes = list(offset_changes(window.start, window.end, window.tz))
    if not changes:
        offset = window.start.replace(tzinfo=ZoneInfo(window.tz)).utcoffset()
        return F.lit(int(offset.total_seconds()))
    at, before, after = changes[-1]
    cases = F.when(local_ts >= ntz(at.replace(tzinfo=None) + before), int(after.total_seconds()))
    for at, before, after in reversed(changes[:-1]):
        wall = ntz(at.replace(tzinfo=None) + before)
        cases = cases.when(local_ts >= wall, int(after.total_seconds()))
    return cases.otherwise(int(changes[0][1].total_seconds()))


def utc_hour_number(local_ts: Column, window: LocalWindow) -> Column:
    """UTC hours since the epoch of a usable wall time of the window.

    Same bucket as utc_hour, from integer arithmetic: no time-zone lookup per
    row, and an integer to group by.
    """
    seconds = F.unix_seconds(local_ts.cast("timestamp")) - utc_offset_seconds(local_ts, window)
    return F.floor(seconds / 3600)


def hour_of_number(number: Column) -> Column:
    return F.timestamp_seconds(number * 3600)


def in_anomaly(local_ts: Column, anomalies: tuple[LocalAnomaly, ...], kind: str) -> Column:
    """True when the wall time falls in a listed clock change; literal ranges only."""
    hit = F.lit(False)
    for item in anomalies:
        if item.kind == kind:
            hit = hit | ((local_ts >= ntz(item.start)) & (local_ts < ntz(item.end)))
    return hit


def local_hour_kind(local_ts: Column, tz: str) -> Column:
    """'nonexistent', 'ambiguous' or NULL for the local hour of a wall time.

    A skipped time does not survive the trip to UTC and back; a repeated one is
    also reached from the UTC instant one hour away. Valid for one-hour shifts.
    """
    middle = F.date_trunc("hour", local_ts).cast("timestamp") + F.expr("INTERVAL 30 MINUTES")
    as_utc = F.to_utc_timestamp(middle, tz)

    def back(shift: str) -> Column:
        return F.from_utc_timestamp(as_utc + F.expr(f"INTERVAL {shift} HOURS"), tz)

    return F.when(back("0") != middle, "nonexistent").when(
        (back("1") == middle) | (back("-1") == middle), "ambiguous"
    )


def dst_calendar(hours: DataFrame, hour_col: str, tz: str) -> DataFrame:
    """Rows of an hourly local-time frame that fall in a clock change, with their kind."""
    return (
        hours.withColumn("kind", local_hour_kind(F.col(hour_col), tz))
        .where(F.col("kind").isNotNull())
        .withColumn("start_local", F.date_trunc("hour", F.col(hour_col)).cast("timestamp_ntz"))
        .withColumn("end_local", F.col("start_local") + F.expr("INTERVAL 1 HOUR"))
    )
