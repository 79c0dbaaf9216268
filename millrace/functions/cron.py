"""Five-field cron expressions as Spark predicates.

The expression is read once on the driver into small literal sets; matching and
"next fire" run as built-in expressions over literal lookup arrays.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names accepted in the month and weekday fields.
MONTH_NAMES = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
WEEKDAY_NAMES = ["SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT"]


@dataclass(frozen=True)
class Cron:
    minutes: tuple[int, ...]
    hours: tuple[int, ...]
    days: tuple[int, ...]
    months: tuple[int, ...]
    weekdays: tuple[int, ...]
    any_day: bool
    any_weekday: bool

    @property
    def times_of_day(self) -> list[int]:
        """Minutes since midnight at which a matching day fires, ascending."""
        return [h * 60 + m for h in self.hours for m in self.minutes]

    def ever_fires(self) -> bool:
        """Whether any date matches.  Calendar dates repeat after 400 years, weekdays too."""
        first = datetime.date(2000, 1, 1).toordinal()
        return any(self._matches(datetime.date.fromordinal(first + n)) for n in range(146_097))

    def _matches(self, day: datetime.date) -> bool:
        by_day, by_weekday = day.day in self.days, day.isoweekday() % 7 in self.weekdays
        if self.any_day or self.any_weekday:
            chosen = (self.any_day or by_day) and (self.any_weekday or by_weekday)
        else:
            chosen = by_day or by_weekday
        return day.month in self.months and chosen

    def fires_on(self, day: Column) -> Column:
        """Whether a DATE column is a firing day.

        When day-of-month and weekday are both restricted, either may match.
        """
        in_month = F.month(day).isin(*self.months)
        by_day = F.dayofmonth(day).isin(*self.days)
        by_weekday = (F.dayofweek(day) - 1).isin(*self.weekdays)
        if self.any_day and self.any_weekday:
            return in_month
        if self.any_day:
            return in_month & by_weekday
        if self.any_weekday:
            return in_month & by_day
        return in_month & (by_day | by_weekday)

    def next_time_of_day(self, minute_of_day: Column) -> Column:
        """First firing minute strictly after ``minute_of_day``; NULL if none is left.

        A 1,440-entry literal lookup array, so the cost per row is one index.
        """
        times, table, upcoming = set(self.times_of_day), [None] * 1440, None
        for minute in range(1439, -1, -1):
            table[minute] = upcoming
            if minute in times:
                upcoming = minute
        lookup = F.from_json(
            F.lit("[" + ",".join("null" if t is None else str(t) for t in table) + "]"),
            "array<int>",
        )
        return F.element_at(lookup, minute_of_day.cast("int") + 1)


def _values(field: str, low: int, high: int, names: list[str], first_name: int) -> tuple[int, ...]:
    def number(token: str) -> int:
        token = token.upper()
        if token in names:
            return names.index(token) + first_name
        if not token.isdigit():
            raise ValueError(f"bad cron value {token!r}")
        return int(token)

    found: set[int] = set()
    for item in field.split(","):
        span, _, step_text = item.partition("/")
        step = int(step_text) if step_text else 1
        if step < 1:
            raise ValueError(f"bad cron step in {item!r}")
        if span in ("*", "?"):
            start, stop = low, high
        elif "-" in span:
            left, right = span.split("-", 1)
            start, stop = number(left), number(right)
        else:
            start = number(span)
            stop = high if step_text else start
        if start < low or stop > high or start > stop:
            raise ValueError(f"cron value out of range in {item!r}")
        found.update(range(start, stop + 1, step))
    return tuple(sorted(found))


def parse_cron(expression: str) -> Cron:
    """Read ``MIN HOUR DOM MONTH DOW`` (lists, ranges, steps and names)."""
    fields = expression.split()
    if len(fields) != 5:
        raise ValueError(f"a cron expression has 5 fields: {expression!r}")
    minute, hour, day, month, weekday = fields
    weekdays = _values(weekday, 0, 7, WEEKDAY_NAMES, 0)
    return Cron(
        minutes=_values(minute, 0, 59, [], 0),
        hours=_values(hour, 0, 23, [], 0),
        days=_values(day, 1, 31, [], 0),
        months=_values(month, 1, 12, MONTH_NAMES, 1),
        weekdays=tuple(sorted({d % 7 for d in weekdays})),
        any_day=day in ("*", "?"),
        any_weekday=weekday in ("*", "?"),
    )
