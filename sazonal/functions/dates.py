"""Date and hour parsing. Bad input gives null, never an error (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date formats of the notification files by year of the file.
FORMAT_TO_2014 = "yyyy/MM/dd HH:mm:ss"
FORMAT_ISO = "yyyy-MM-dd"
FORMAT_DAY_FIRST = "dd/MM/yyyy"
# Date formats of the station files.
STATION_DASHED = "yyyy-MM-dd"
STATION_SLASHED = "yyyy/MM/dd"
STATION_SLASHED_FROM = 2019


def _exact(text: Column, fmt: str) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def notification_time(text: Column, year: Column) -> Column:
    """Timestamp of a notification, with the format its file year uses."""
    iso_years = year.between(2015, 2020) | year.isin(2022, 2023)
    return (
        F.when(year < 2015, _exact(text, FORMAT_TO_2014))
        .when(iso_years, _exact(text, FORMAT_ISO))
        .otherwise(_exact(text, FORMAT_DAY_FIRST))
    )


def station_date(text: Column, year: Column | None = None) -> Column:
    """Date of a station reading; without a file year both formats are tried."""
    dashed, slashed = _exact(text, STATION_DASHED), _exact(text, STATION_SLASHED)
    if year is None:
        return F.coalesce(slashed, dashed).cast("date")
    return F.when(year < STATION_SLASHED_FROM, dashed).otherwise(slashed).cast("date")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of three number columns; an impossible date gives null."""
    zero = F.lit(0)
    parts = [c.cast("int") for c in (year, month, day)]
    return F.to_date(F.try_make_timestamp(*parts, zero, zero, zero))


def day_of(text: Column) -> Column:
    """Parsed text cut to its day."""
    return text.try_cast("timestamp").cast("date")


def hour_from_clock(text: Column) -> Column:
    """Hour of ``HH:MM`` text."""
    return F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int")


def hour_from_utc(text: Column) -> Column:
    """Hour of ``HHMM UTC`` text; other text gives null."""
    return F.regexp_extract(text, r"(\d{2})\d{2}\s*UTC", 1).try_cast("int")


def station_hour(text: Column) -> Column:
    """Hour in either layout."""
    return F.when(text.contains(":"), hour_from_clock(text)).otherwise(hour_from_utc(text))


def calendar_parts(df: DataFrame, date_col: str = "data") -> DataFrame:
    """Add ``ano, mes, dia, dia_da_semana`` (Monday is 0)."""
    d = F.col(date_col)
    return df.withColumns(
        {
            "ano": F.year(d),
            "mes": F.month(d),
            "dia": F.dayofmonth(d),
            "dia_da_semana": F.weekday(d),
        }
    )


def with_date(df: DataFrame, date_col: str = "data") -> DataFrame:
    """Make sure there is a date column: parse it, or build it from its parts."""
    if date_col in df.columns:
        return df.withColumn(date_col, F.col(date_col).try_cast("date"))
    if {"ano", "mes", "dia"} <= set(df.columns):
        return df.withColumn(date_col, date_from_parts(F.col("ano"), F.col("mes"), F.col("dia")))
    return df
