"""Run schedules as DataFrames, and rows assigned to the run that handles them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cron import Cron, parse_cron
from ..functions.durations import duration_seconds

_DAY = 86_400
# The calendar is read this far past the end, enough for the rarest day (29 Feb).
_LOOK_AHEAD_DAYS = 8 * 366 + 1
_BROADCAST_DAYS = 500 * 366


def check_schedule(interval: str | int | None, cron: str | None) -> None:
    """Exactly one of interval and cron."""
    if interval is None and cron is None:
        raise ValueError("a schedule needs an interval or a cron expression")
    if interval is not None and cron is not None:
        raise ValueError("a schedule takes an interval or a cron expression, not both")


def interval_schedule(
    spark: SparkSession, start: int, every: str | int, *, count: int | None = None, end: int | None = None
) -> DataFrame:
    """Ticks at ``start``, ``start + every``, … as (run, scheduled_at) in seconds.

    Bounded by ``count`` rows, by ``end`` (inclusive), or both.  All columns are
    arithmetic on the run number, including the previous and following run.
    """
    step = duration_seconds(every)
    if count is None and end is None:
        raise ValueError("a finite schedule needs count or end")
    runs = count if end is None else max(0, (end - start) // step + 1)
    if count is not None:
        runs = min(runs, count)
    at = F.lit(start) + F.col("id") * step
    return spark.range(runs).select(
        F.col("id").alias("run"),
        at.alias("scheduled_at"),
        F.when(F.col("id") > 0, at - step).alias("last_run_time"),
        _uncounted(F.col("id"), count, at + step).alias("next_run_time"),
    )


def _uncounted(run: Column, count: int | None, following: Column) -> Column:
    return following if count is None else F.when(run < count - 1, following)


def _calendar(spark: SparkSession, cron: Cron, first_day: int, last_day: int) -> DataFrame:
    """Days of the span with neighbouring firing days; one row per calendar day.

    The single window runs over days, not data: a century is 36,500 rows.
    """
    days = spark.range(first_day, last_day + _LOOK_AHEAD_DAYS).select(
        F.col("id").alias("day"), F.date_from_unix_date(F.col("id").cast("int")).alias("date")
    )
    marked = days.select("day", cron.fires_on(F.col("date")).alias("fires"))
    own = F.when(F.col("fires"), F.col("day"))
    following = Window.orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    preceding = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return marked.select(
        "day",
        "fires",
        F.min(own).over(following).alias("next_day"),
        F.max(own).over(preceding).alias("last_day"),
    ).where(F.col("day") <= last_day)


def cron_schedule(
    spark: SparkSession, expression: str, start: int, *, end: int | None = None, count: int | None = None
) -> DataFrame:
    """Fires strictly after ``start`` up to ``end`` (UTC seconds), at most ``count``."""
    cron = parse_cron(expression)
    if end is None:
        if count is None:
            raise ValueError("a finite schedule needs count or end")
        # Grow the span until it holds `count` fires.  A date that does not exist, such as
        # 30 February, never fires: the schedule is empty.
        span = max(1, count // len(cron.times_of_day)) * _DAY
        end = start + span
        if cron.ever_fires():
            while _fires(spark, cron, start, end).limit(count).count() < count:
                span *= 4
                end = start + span
    fires = _fires(spark, cron, start, end)
    if count is not None:
        fires = fires.orderBy("scheduled_at").limit(count)
        last = fires.agg(F.max("scheduled_at")).scalar()
        done = fires.agg(F.count(F.lit(1))).scalar() >= count
        fires = fires.withColumn(
            "next_run_time", F.when(~((F.col("scheduled_at") == last) & done), F.col("next_run_time"))
        )
    return fires


def _fires(spark: SparkSession, cron: Cron, start: int, end: int) -> DataFrame:
    times = cron.times_of_day
    literal = F.from_json(F.lit(str(times)), "array<bigint>")
    days = _calendar(spark, cron, start // _DAY, end // _DAY).where("fires")
    spread = days.select("day", "next_day", "last_day", F.posexplode(literal).alias("_i", "_minute"))
    at = F.col("day") * _DAY + F.col("_minute") * 60
    earlier = F.coalesce(
        F.col("day") * _DAY + F.get(literal, F.col("_i") - 1) * 60,
        F.col("last_day") * _DAY + times[-1] * 60,
    )
    later = F.coalesce(
        F.col("day") * _DAY + F.get(literal, F.col("_i") + 1) * 60,
        F.col("next_day") * _DAY + times[0] * 60,
    )
    return (
        spread.select(
            at.alias("scheduled_at"),
            F.when(earlier > start, earlier).alias("last_run_time"),
            later.alias("next_run_time"),
        )
        .where((F.col("scheduled_at") > start) & (F.col("scheduled_at") <= end))
    )


def run_windows(schedule: DataFrame, message: str | None = None) -> DataFrame:
    """Schedule rows as run messages: last and next run time, optional message."""
    out = schedule.select("scheduled_at", "last_run_time", "next_run_time")
    return out if message is None else out.withColumn("message", F.lit(message))


def interval_run_of(seconds: Column, start: int, every: str | int) -> Column:
    """Scheduled time of the first tick at or after ``seconds``; closed form."""
    step = duration_seconds(every)
    run = F.greatest(F.ceil((seconds - start) / step), F.lit(0))
    return F.lit(start) + run * step


def with_cron_run(df: DataFrame, seconds: str, expression: str, start: int, end: int) -> DataFrame:
    """Add ``scheduled_at``: the first fire strictly after each row's time.

    Within the day the fire is a literal lookup; across days it needs the next
    firing day, from a calendar with one row per day of the span.  That table's
    size depends on the span alone; it is broadcast for spans up to 500 years.
    """
    cron = parse_cron(expression)
    spark = df.sparkSession
    calendar = _calendar(spark, cron, start // _DAY, end // _DAY).select("day", "fires", "next_day")
    if (end - start) // _DAY <= _BROADCAST_DAYS:
        calendar = F.broadcast(calendar)
    day = F.floor(F.col(seconds) / _DAY)
    minute = F.floor((F.col(seconds) % _DAY) / 60)
    joined = df.withColumn("day", day).join(calendar, "day", "left")
    today = F.when(F.col("fires"), F.col("day") * _DAY + cron.next_time_of_day(minute) * 60)
    later = F.col("next_day") * _DAY + cron.times_of_day[0] * 60
    return joined.withColumn("scheduled_at", F.coalesce(today, later)).drop("day", "fires", "next_day")
