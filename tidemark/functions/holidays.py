"""US federal holidays as columns, by their rules; observed days count as well as the dates themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name, month, day of month, first year. Fixed values.
FIXED = [
    ("New Year's Day", 1, 1, 1900),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1900),
    ("Veterans Day", 11, 11, 1900),
    ("Christmas Day", 12, 25, 1900),
]
#: Name, month, weekday (1 Monday), first and last day of month on which it can fall. Fixed values.
FLOATING = [
    ("Martin Luther King Jr. Day", 1, 1, 15, 21),
    ("Washington's Birthday", 2, 1, 15, 21),
    ("Memorial Day", 5, 1, 25, 31),
    ("Labor Day", 9, 1, 1, 7),
    ("Columbus Day", 10, 1, 8, 14),
    ("Thanksgiving", 11, 4, 22, 28),
]


def holiday_name(day: Column) -> Column:
    """The holiday of a date or null; a Saturday's is observed on the Friday before, a Sunday's on the Monday after."""
    weekday = F.weekday(day) + 1

    def on(d: Column, month: int, dom: int, since: int) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == dom) & (F.year(d) >= since)

    rules = [(name, (F.month(day) == m) & (weekday == w) & F.dayofmonth(day).between(a, b)) for name, m, w, a, b in FLOATING]
    rules += [(name, on(day, m, d, y)) for name, m, d, y in FIXED]
    rules += [(f"{name} (observed)", (on(F.date_sub(day, 1), m, d, y) & (weekday == 1)) | (on(F.date_add(day, 1), m, d, y) & (weekday == 5))) for name, m, d, y in FIXED]
    return reduce(lambda out, rule: F.when(rule[1], F.lit(rule[0])).otherwise(out), reversed(rules), F.lit(None).cast("string"))


def day_type(day: Column) -> Column:
    return F.when(holiday_name(day).isNotNull(), "holiday").when(F.weekday(day) >= 5, "weekend").otherwise("weekday")


def sql(day: str) -> str:
    """The same rule as an SQL expression, for checks."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    on = lambda d, m, k, y: f"(month({d}) = {m} AND day({d}) = {k} AND year({d}) >= {y})"
    out = [f"WHEN month({day}) = {m} AND isodow({day}) = {w} AND day({day}) BETWEEN {a} AND {b} THEN {text(n)}" for n, m, w, a, b in FLOATING]
    out += [f"WHEN {on(day, m, d, y)} THEN {text(n)}" for n, m, d, y in FIXED]
    out += [f"WHEN {on(f'({day} - 1)', m, d, y)} AND isodow({day}) = 1 OR {on(f'({day} + 1)', m, d, y)} AND isodow({day}) = 5 THEN {text(n + ' (observed)')}" for n, m, d, y in FIXED]
    return "CASE " + " ".join(out) + " END"
