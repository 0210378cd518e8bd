"""Rule-based demand estimate of a station at an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.numbers import half_up
from velogrid.operators.stations import busiest

# --- fixed values -----------------------------------------------------------
# (first hour, last hour, change of arrivals, change of confidence, reason)
HOUR_BANDS = [
    (7, 9, 8, 10, "Hora pico matutina (7-9 AM)"),
    (17, 19, 12, 15, "Hora pico vespertina (5-7 PM)"),
    (12, 14, 4, 5, "Hora de almuerzo (12-2 PM)"),
    (22, 6, -2, -10, "Hora de bajo tráfico (10 PM - 6 AM)"),
]
BASE_ARRIVALS, BASE_CONFIDENCE = 5, 70
ARRIVAL_BOUNDS, CONFIDENCE_BOUNDS = (1, 50), (50, 95)
DEFAULT_DOCKS = 20
PEAK_HOUR, LOW_HOUR = 18, 3
WEEKEND_REASON = "Fin de semana (menor actividad)"
WORKDAY_REASON = "Día laborable (mayor actividad)"
FULL_REASON = "Alta disponibilidad de bicis"
SPARSE_REASON = "Baja disponibilidad de bicis"
# ----------------------------------------------------------------------------


def _in_band(hour: Column, first: int, last: int) -> Column:
    return hour.between(first, last) if first <= last else (hour >= first) | (hour <= last)


def _by_band(hour: Column, pick: int, default: Column) -> Column:
    out = None
    for band in HOUR_BANDS:
        test, value = _in_band(hour, band[0], band[1]), F.lit(band[pick])
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def _availability() -> Column:
    docks = F.when(F.coalesce("total_docks", F.lit(0)) == 0, F.lit(DEFAULT_DOCKS)).otherwise(F.col("total_docks"))
    return F.coalesce("available_bikes", F.lit(0)) / docks


def _popularity() -> Column:
    return F.coalesce("popularity_score", F.lit(0.0))


def expected_arrivals(hour: Column, weekend: Column) -> Column:
    base = half_up(_popularity() / 100 * 15) + BASE_ARRIVALS + _by_band(hour, 2, F.lit(0))
    base = F.when(weekend, half_up(base * 0.6)).otherwise(base)
    base = base + F.when(_availability() > 0.8, 2).when(_availability() < 0.2, -3).otherwise(0)
    return F.greatest(F.lit(ARRIVAL_BOUNDS[0]), F.least(F.lit(ARRIVAL_BOUNDS[1]), base)).cast("bigint")


def confidence(hour: Column, weekend: Column) -> Column:
    points = F.lit(BASE_CONFIDENCE) + _by_band(hour, 3, F.lit(0)) + F.when(weekend, -5).otherwise(5)
    points = points + F.when(_availability() < 0.2, -10).otherwise(0)
    return F.greatest(F.lit(CONFIDENCE_BOUNDS[0]), F.least(F.lit(CONFIDENCE_BOUNDS[1]), points)).cast("bigint")


def reasons(hour: Column, weekend: Column) -> Column:
    score = _popularity()
    shown = F.when(score == F.floor(score), F.floor(score).cast("string")).otherwise(score.cast("string"))
    trips = F.coalesce("total_trips", F.lit(0).cast("bigint"))
    counted = F.format_number(trips, 0)
    return F.array_compact(
        F.array(
            F.concat(F.lit("Popularidad de estación: "), shown, F.lit("%")),
            _by_band(hour, 4, F.lit(None).cast("string")),
            F.when(weekend, WEEKEND_REASON).otherwise(WORKDAY_REASON),
            F.when(_availability() > 0.8, FULL_REASON).when(_availability() < 0.2, SPARSE_REASON),
            F.when(trips > 10000, F.concat(F.lit("Estación muy activa ("), counted, F.lit(" viajes históricos)")))
            .when(trips > 5000, F.concat(F.lit("Estación moderadamente activa ("), counted, F.lit(" viajes históricos)")))
            .otherwise(F.concat(F.lit("Estación de baja actividad ("), trips.cast("string"), F.lit(" viajes históricos)"))),
        )
    )


def demand_score(stations: DataFrame, instant: str = "timestamp") -> DataFrame:
    """Arrivals, confidence and reasons for every row with a catalogue record and an instant."""
    hour, weekend = F.hour(instant), F.weekday(instant) >= 5
    return stations.withColumns(
        {
            "predicted": expected_arrivals(hour, weekend),
            "confidence": confidence(hour, weekend),
            "factors": reasons(hour, weekend),
        }
    )


def score_overview(stations: DataFrame, instant: str, n: int = 10) -> DataFrame:
    """Now, at the peak and at the low hour of the same day, for the busiest stations."""
    now = F.lit(instant).cast("timestamp_ntz")
    hour, weekend = F.hour(now), F.weekday(now) >= 5
    return busiest(stations, n).select(
        "id",
        "name",
        expected_arrivals(hour, weekend).alias("currentPrediction"),
        confidence(hour, weekend).alias("confidence"),
        expected_arrivals(F.lit(PEAK_HOUR), weekend).alias("peakHourPrediction"),
        expected_arrivals(F.lit(LOW_HOUR), weekend).alias("lowHourPrediction"),
    )


def score_of(stations: DataFrame, station_id, instant: str) -> DataFrame:
    """The estimate of one station; an unknown id gives no row."""
    return demand_score(
        stations.filter(F.col("id").cast("string") == str(station_id)).withColumn(
            "timestamp", F.lit(instant).cast("timestamp_ntz")
        )
    )
