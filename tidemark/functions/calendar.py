"""Calendar expressions: date parts, weeks, cyclic encodings and Brazilian holidays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# National holidays by month and day, with the first year they hold.
FIXED_HOLIDAYS = [
    (1, 1, 1900),
    (4, 21, 1900),
    (5, 1, 1900),
    (9, 7, 1900),
    (10, 12, 1980),
    (11, 2, 1900),
    (11, 15, 1900),
    (11, 20, 2024),
    (12, 25, 1900),
]
GOOD_FRIDAY_OFFSET = -2


def weekday_number(day: Column) -> Column:
    """Monday 0 ... Sunday 6."""
    return F.weekday(day)


def week_of_wednesday(day: Column) -> Column:
    """First day of the Wednesday-to-Tuesday week."""
    return F.date_sub(F.next_day(F.to_date(day), "WED"), 7)


def sunday_week(day: Column) -> Column:
    """Week of the year with Sunday first; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 6 - (F.dayofweek(day) - 1)) / 7).cast("int")


def sunday_week_label(day: Column) -> Column:
    return F.format_string("%04d-W%02d", F.year(day), sunday_week(day))


def shift_name(hour: Column) -> Column:
    return (
        F.when(hour.isNull(), F.lit(None))
        .when(hour < 6, F.lit("madrugada"))
        .when(hour < 18, F.lit("comercial"))
        .otherwise(F.lit("noite"))
    )


def cyclic(value: Column, period: int, prefix: str) -> list[Column]:
    angle = value * F.lit(2 * math.pi / period)
    return [F.sin(angle).alias(f"{prefix}_sin"), F.cos(angle).alias(f"{prefix}_cos")]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Gauss's rule: days after 21 March from the moon, then to the Sunday."""

    def div(value: Column, by: int) -> Column:
        return F.floor(value / by)

    century = div(year, 100)
    golden = year % 19
    moon = (
        19 * golden + 15 + century - div(century, 4) - div(8 * century + 13, 25)
    ) % 30
    # The two exceptions keep the moon inside 29 days.
    late = (moon == 29) | ((moon == 28) & (golden > 10))
    moon = moon - F.when(late, 1).otherwise(0)
    equinox = F.make_date(year, F.lit(3), F.lit(21))
    full_moon = F.date_add(equinox, moon.cast("int"))
    return F.next_day(full_moon, "SUN")


def is_holiday(day: Column) -> Column:
    year, month, dom = F.year(day), F.month(day), F.dayofmonth(day)
    fixed = F.lit(False)
    for m, d, since in FIXED_HOLIDAYS:
        fixed = fixed | ((month == m) & (dom == d) & (year >= since))
    # Good Friday falls between 20 March and 23 April: other months skip the computation.
    moving = F.when(
        month.isin(3, 4), F.date_add(easter_sunday(year), GOOD_FRIDAY_OFFSET) == day
    ).otherwise(False)
    return fixed | moving


def holiday_flags(day: Column) -> list[Column]:
    """Holiday, eve and day after, for every year (31 December is an eve)."""
    return [
        is_holiday(day).cast("int").alias("feriado"),
        is_holiday(F.date_add(day, 1)).cast("int").alias("vespera_feriado"),
        is_holiday(F.date_sub(day, 1)).cast("int").alias("dia_seguinte_feriado"),
    ]


def day_calendar(day: str = "data") -> list[Column]:
    """Day-grain calendar columns of a date column, all known ahead of time."""
    at = F.col(day)
    dow = weekday_number(at)
    return [
        dow.alias("dia_semana"),
        (dow >= 5).cast("int").alias("fim_de_semana"),
        *holiday_flags(at),
        F.dayofmonth(at).alias("dia_do_mes"),
        F.month(at).alias("mes"),
        *cyclic(dow, 7, "dow"),
    ]


def hour_calendar(time: str = "aberto") -> list[Column]:
    """Columns of the opening hour."""
    hour = F.hour(time)
    return [
        hour.alias("hora_abertura"),
        *cyclic(hour, 24, "hora"),
        shift_name(hour).alias("turno_abertura"),
        (shift_name(hour) != "comercial").cast("int").alias("fora_horario_comercial"),
    ]


def ticket_calendar(time: str = "aberto") -> list[Column]:
    """Ticket-grain calendar columns of an opening time, hour and day."""
    day = F.to_date(time)
    dow = weekday_number(day)
    return [
        *hour_calendar(time),
        dow.alias("dia_semana"),
        (dow >= 5).cast("int").alias("fim_de_semana"),
        *cyclic(dow, 7, "dow"),
        *holiday_flags(day),
    ]


def day_spine(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Every day from the first to the last observed one, per key (days only: small by nature)."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    return ends.select(*keys, F.explode(F.sequence("_a", "_b")).alias(day))


def future_days(spark: SparkSession, start: str, periods: int) -> DataFrame:
    """``periods`` days from ``start`` on, with their calendar block."""
    days = spark.range(periods).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("data")
    )
    return days.select("data", *day_calendar("data"))
