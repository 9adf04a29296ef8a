"""Dates in mixed notations, periods and serial days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.money import let

# Fixed values.
MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
#: A time of day behind a date, with its zone; it isn't read, but has to be one.
TIME = r"(?:[T ]\s*(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?(?: ?[AaPp][Mm])?(?: ?(?:Z|UTC|[+-][0-9]{2}:?[0-9]{2}))?)$"


def _text(c: Column) -> Column:
    text = F.trim(c)
    return F.when(~text.isin("", "nan", "None"), text)


def _year(text: Column) -> Column:
    """Of four digits, or of two from 1969 to 2068."""
    short = F.when(F.length(text) == 2, F.concat(F.when(text > "68", "19").otherwise("20"), text))
    return F.when(F.length(text) == 4, text).otherwise(short)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", F.when(year.isNotNull(), year), month, day).try_cast("date")


def _by_numbers(p: Column) -> Column:
    """Three numbers: year, month, day where the year is first, else day first, and month first only where
    the second can't be a month."""
    first, second, third = (F.get(p, F.lit(i)) for i in range(3))
    year_last = F.when(second.try_cast("int").between(1, 12), _date(_year(third), second, first)).otherwise(_date(_year(third), first, second))
    return F.when(F.length(first) == 4, F.when(F.length(third) < 3, _date(first, second, third))).when((F.length(first) < 3) & F.length(third).isin(2, 4), year_last)


def _by_name(text: Column) -> Column:
    """A month's name, or its first three letters, with a day and a year in any order; a weekday and a comma may stand by."""
    def read(tokens: Column) -> Column:
        names = F.filter(tokens, lambda t: t.rlike("[a-z]"))
        numbers = F.filter(tokens, lambda t: ~t.rlike("[a-z]"))
        known = F.array(*[F.lit(n) for n in NAMES], *[F.lit(n[:3]) for n in NAMES])
        month = F.lpad((F.pmod(F.array_position(known, F.get(names, F.lit(0))) - 1, F.lit(12)) + 1).cast("string"), 2, "0")
        one, two = F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))
        full = F.when(F.length(one) == 4, _date(one, month, two)).otherwise(_date(_year(two), month, one))
        valid = (F.size(names) == 1) & F.array_contains(known, F.get(names, F.lit(0)))
        return F.when(valid & (F.size(numbers) == 2), full).when(valid & (F.size(numbers) == 1) & (F.length(one) == 4), _date(one, month, F.lit("01")))

    # A number and a name that touch are two tokens.
    parted = F.regexp_replace(F.lower(text), "(?<=[0-9])(?=[a-z])|(?<=[a-z])(?=[0-9])", " ")
    days = ["", *[x for d in WEEKDAYS for x in (d, d[:3])]]
    return let(F.filter(F.split(parted, "[-/., ]+"), lambda t: ~t.isin(days)), read)


def parse_date(c: Column) -> Column:
    """The day of a text in any of the usual notations: with or without padding, with names of months, with a
    time of day, year first or last, day before month. Null where it is none."""
    def shaped(head: Column) -> Column:
        return (
            F.when(head.rlike(r"^[0-9]{1,4}([-/. ])[0-9]{1,2}\1[0-9]{1,4}$"), let(F.split(head, "[-/. ]"), _by_numbers))
            .when(head.rlike("[A-Za-z]{3}"), _by_name(head))
            .when(head.rlike("^[0-9]{8}$"), _date(F.substring(head, 1, 4), F.substring(head, 5, 2), F.substring(head, 7, 2)))
            .when(head.rlike("^[0-9]{4}-[0-9]{2}$"), F.concat(head, F.lit("-01")).try_cast("date"))
        )

    return let(let(_text(c), lambda text: F.when(text.contains(":"), F.regexp_replace(text, TIME, "")).otherwise(text)), shaped)


def as_date(c: Column, kind: str) -> Column:
    """The day of a column of any type: dates and timestamps as they are, numbers as serial days where they
    can be ones (1954 to 2064), everything else by its text."""
    if kind == "date" or kind.startswith("timestamp"):
        return c.cast("date")
    if kind in ("int", "bigint", "smallint", "double", "float"):
        number = c.cast("double")
        return F.when(number.between(20000, 60000), serial_to_date(number))
    return parse_date(c.cast("string"))


def is_invalid_date(c: Column) -> Column:
    return _text(c).isNotNull() & parse_date(c).isNull()


def period_parts(c: Column) -> dict[str, Column]:
    """Year, month, first day, month name, quarter and half of a YYYYMM period; nulls where it is none."""
    p = c.try_cast("long")
    year, month = F.floor(p / 100).cast("long"), F.pmod(p, F.lit(100)).cast("long")
    ok = F.coalesce(p.isNotNull() & year.between(1990, 2100) & month.between(1, 12), F.lit(False))
    y, m = F.when(ok, year), F.when(ok, month)
    return {
        "ok": ok, "periodo": p, "anio": y, "mes": m, "fecha": F.when(ok, F.make_date(y.cast("int"), m.cast("int"), F.lit(1))),
        "mes_nombre": F.get(F.array(*[F.lit(x) for x in MONTHS]), (m - 1).cast("int")),
        "trimestre": F.concat(F.lit("T"), (F.floor((m - 1) / 3) + 1).cast("string")),
        "semestre": F.when(m <= 6, "S1").when(m > 6, "S2"),
    }


def serial_to_date(c: Column) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), c.cast("int"))


def in_bounds(c: Column, first: int = 1900, last: int = 2100) -> Column:
    return F.when(F.year(c).between(first, last), c)
