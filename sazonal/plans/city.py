"""The single-city daily dataset, from files to model-ready rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_parts, with_date
from ..functions.missing import drop_missing, numeric_columns
from ..operators.aggregate import count_per_key, mean_per_key
from ..operators.clean import clean_cases, clean_weather
from ..operators.schema import FEATURE_NAMES, rename_present
from ..operators.series import add_lags, prior_window_mean
from ..sources.files import require_files
from ..sources.notifications import YEARS, read_notifications
from ..sources.stations import read_stations, sensors_as_numbers

# Columns that get lags, and the lags in days.
LAGGED = ("temperatura_min_media_c", "precipitacao_total_media_mm", "casos_dengue")
LAGS = (7, 14, 21)
# The named lag set and its lags.
NAMED_LAGS = {
    "casos": "casos",
    "numeric__temperatura_min_media_c": "temp_min",
    "numeric__precipitacao_total_media_mm": "chuva",
    "numeric__umidade_rel_min_media": "umidade",
}
NAMED_LAG_DAYS = (7, 14, 21, 28)
# Fixed value: name of a station-year file.
STATION_FILE = "INMET_NE_PE_A301_RECIFE_01-01-{year}_A_31-12-{year}.csv"


def weather_cases(
    cases: DataFrame, weather: DataFrame, window: int = 30, sensors: Sequence[str] | None = None
) -> DataFrame:
    """Daily case counts beside the means of the ``window`` days measured before.

    Both sides shrink to one row per day first, so the window and the join are as long
    as the calendar. Days without a case row vanish; incomplete days are dropped.
    """
    sensors = numeric_columns(weather, exclude=("data", "ano_arquivo")) if sensors is None else sensors
    per_day = count_per_key(cases, ["data"])
    daily = mean_per_key(weather, ["data"], sensors)
    before = prior_window_mean(daily, sensors, ("data",), (), window, bounded=True)
    return drop_missing(before.join(per_day, "data"))


def city_dataset(
    cases: DataFrame, weather: DataFrame, window: int = 30, sensors: Sequence[str] | None = None
) -> DataFrame:
    """Model-ready rows of one city, sorted by date, with calendar parts for the date."""
    joined = weather_cases(cases, weather, window, sensors).drop("hora")
    dated = calendar_parts(rename_present(joined, FEATURE_NAMES).orderBy("data"))
    return dated.drop("data")


def build_city(
    spark: SparkSession,
    cases_folder: str,
    weather_folder: str,
    years: Iterable[int] = YEARS,
    station_file: str = STATION_FILE,
    window: int = 30,
) -> DataFrame:
    """``city_dataset`` from the yearly notification and station files."""
    years = list(years)
    stations = [f"{weather_folder}/{station_file.format(year=y)}" for y in years]
    require_files(spark, stations, "weather stations")
    cases = clean_cases(read_notifications(spark, cases_folder, years))
    hourly = sensors_as_numbers(read_stations(spark, stations)).drop(
        "caminho", "colunas", "_bloco", "_linha"
    )
    return city_dataset(cases, clean_weather(hourly), window)


def city_supervised(
    df: DataFrame,
    target: str = "casos_dengue",
    lagged: Sequence[str] = LAGGED,
    lags: Sequence[int] = LAGS,
) -> tuple[DataFrame, list[str]]:
    """Add lags in date order (one row per date); the frame and its feature columns."""
    kept = df.columns
    out = add_lags(with_date(df), lagged, lags, ("data",), bounded=True)
    out = out if "data" in kept else out.drop("data")
    return out, [c for c in out.columns if c != target]


def named_lags(
    df: DataFrame, target: str = "casos", order_by: Sequence[str] = ("data",), **how
) -> DataFrame:
    """Lags of the target and three climate columns under short names."""
    names = {target if c == "casos" else c: n for c, n in NAMED_LAGS.items()}
    return add_lags(df, names, NAMED_LAG_DAYS, order_by, **how)
