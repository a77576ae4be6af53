"""US federal holidays as date arithmetic on a year or a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# US federal holiday rules.
# (name, month, day of month, first year)
FIXED_DATE = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1938),
    ("Christmas Day", 12, 25, 1871),
]
# (name, month, weekday, which one in the month, first year)
NTH_WEEKDAY = [
    ("Martin Luther King Jr. Day", 1, "MON", 3, 1986),
    ("Washington's Birthday", 2, "MON", 3, 1971),
    ("Labor Day", 9, "MON", 1, 1894),
    ("Columbus Day", 10, "MON", 2, 1971),
    ("Thanksgiving", 11, "THU", 4, 1942),
]
# (name, month, weekday, first year): the last such weekday of the month
LAST_WEEKDAY = [("Memorial Day", 5, "MON", 1971)]

WEEKDAY_NUMBER = {"SUN": 1, "MON": 2, "TUE": 3, "WED": 4, "THU": 5, "FRI": 6, "SAT": 7}

HOLIDAY_NAMES = [r[0] for r in FIXED_DATE + NTH_WEEKDAY + LAST_WEEKDAY] + [
    f"{r[0]} (observed)" for r in FIXED_DATE
]


def _from(first_year: int, year: Column, ds: Column) -> Column:
    return F.when(year >= first_year, ds)


def _observed(ds: Column) -> Column:
    """Day off for a fixed date: Friday for a Saturday, Monday for a Sunday, else NULL."""
    weekday = F.dayofweek(ds)
    return F.when(weekday == 7, F.date_sub(ds, 1)).when(weekday == 1, F.date_add(ds, 1))


def holiday_dates(year: Column) -> dict[str, Column]:
    """Date of every holiday and observed day of ``year``, NULL where there is none.

    The observed New Year's Day may fall on the last day of the year before.
    """
    dates: dict[str, Column] = {}
    for name, month, day, since in FIXED_DATE:
        dates[name] = _from(since, year, F.make_date(year, F.lit(month), F.lit(day)))
        dates[f"{name} (observed)"] = _observed(dates[name])
    for name, month, weekday, nth, since in NTH_WEEKDAY:
        eve = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
        dates[name] = _from(since, year, F.date_add(F.next_day(eve, weekday), 7 * (nth - 1)))
    for name, month, weekday, since in LAST_WEEKDAY:
        month_end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
        dates[name] = _from(since, year, F.date_sub(F.next_day(month_end, weekday), 7))
    return dates


def holiday_flags(ds: Column) -> list[Column]:
    """0/1 columns, one per name in HOLIDAY_NAMES, that mark the day ``ds``.

    Tests month, day and weekday instead of building the dates of the year.
    """
    flags: dict[str, Column] = {}
    weekday = F.dayofweek(ds)

    def falls_on(day: Column, month: int, day_of_month: int, since: int) -> Column:
        return (F.month(day) == month) & (F.dayofmonth(day) == day_of_month) & (F.year(day) >= since)

    for name, month, day, since in FIXED_DATE:
        friday = (weekday == 6) & falls_on(F.date_add(ds, 1), month, day, since)
        monday = (weekday == 2) & falls_on(F.date_sub(ds, 1), month, day, since)
        flags[name] = falls_on(ds, month, day, since)
        flags[f"{name} (observed)"] = friday | monday
    for name, month, day_name, nth, since in NTH_WEEKDAY:
        week = F.floor((F.dayofmonth(ds) - 1) / 7) + 1
        on_day = (weekday == WEEKDAY_NUMBER[day_name]) & (week == nth)
        flags[name] = (F.month(ds) == month) & on_day & (F.year(ds) >= since)
    for name, month, day_name, since in LAST_WEEKDAY:
        last_week = F.month(F.date_add(ds, 7)) != month
        flags[name] = (F.month(ds) == month) & (weekday == WEEKDAY_NUMBER[day_name]) & last_week & (F.year(ds) >= since)
    return [F.when(flags[name], 1.0).otherwise(0.0) for name in HOLIDAY_NAMES]
