"""Rules on dates and times."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions.tickets import flag


def day_of_week(at: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(at) - 1


def year_month(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def shift(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "Manha")
        .when(hour.between(12, 17), "Tarde")
        .when(hour.between(18, 23), "Noite")
        .otherwise("Madrugada")
    )


def off_hours(hour: Column) -> Column:
    """Outside 08:00 to 18:59."""
    return flag(~hour.between(8, 18))


def is_weekend(dow: Column) -> Column:
    return flag(dow.isin(0, 6))


def weekend(at: Column) -> Column:
    return is_weekend(day_of_week(at))


def weekday_name(at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in S.WEEKDAY_NAMES]), F.dayofweek(at))


def month_name_padded(at: Column) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(at, "MMMM"), 9, " ")


def weekdays_before(day: Column) -> Column:
    """Monday-to-Friday days from Monday 1970-01-05 up to, not including, a day."""
    n = F.date_diff(day, F.lit("1970-01-05").cast("date"))
    return 5 * F.floor(n / 7) + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Weekdays in [start, end); an end before the start counts as the start."""
    return weekdays_before(F.greatest(start, end)) - weekdays_before(start)


def crosses_weekend(opened: Column, closed: Column) -> Column:
    """Opened Friday or later, closed on a weekend, or open two days or more."""
    days = F.floor(F.timestamp_diff("MICROSECOND", opened, closed) / F.lit(86400e6))
    return flag((F.weekday(opened) >= 4) | (F.weekday(closed) >= 5) | (days >= 2))


def easter_sunday(year: Column) -> Column:
    """Gregorian computus as integer arithmetic on the year."""
    def whole(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    golden = year % 19
    century = whole(year, 100)
    epact = (
        19 * golden + century - whole(century, 4)
        - whole(century - whole(century + 8, 25) + 1, 3) + 15
    ) % 30
    within = year % 100
    to_sunday = (
        32 + 2 * (century % 4) + 2 * whole(within, 4) - epact - within % 4
    ) % 7
    fix = whole(golden + 11 * epact + 22 * to_sunday, 451)
    from_march = epact + to_sunday - 7 * fix + 114
    return F.make_date(year, whole(from_march, 31), from_march % 31 + 1)


def day_kind(is_holiday: Column, day: Column) -> Column:
    return (
        F.when(is_holiday, "Feriado")
        .when(F.weekday(day) >= 5, "Final de Semana")
        .otherwise("Dia Útil")
    )
