"""Predicted against real demand, per station and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.numbers import between_bounds, half_even
from velogrid.operators.metrics import PREDICTED
from velogrid.schemas import NAME_DEFAULT, TARGET

SUM_DIGITS = 6


def with_errors(df: DataFrame, y: str = TARGET, p: str = PREDICTED) -> DataFrame:
    """Absolute error and accuracy, the latter always clipped to 0..1."""
    error = F.abs(F.col(y) - F.col(p))
    accuracy = F.lit(1.0) - error / F.greatest(F.lit(1), F.col(y))
    return df.withColumns({"error_prediccion": error, "accuracy": between_bounds(accuracy, 0.0, 1.0)})


def with_station_names(df: DataFrame, stations: DataFrame) -> DataFrame:
    """Names and addresses from the catalogue; Spark broadcasts it when it is small."""
    return df.join(stations.select("id_estacion", "nombre_estacion", "direccion_estacion"), "id_estacion", "left")


def _earliest(df: DataFrame, column: str) -> Column:
    """The value of the earliest row that has one, the smallest of several or where rows have no ``timestamp``; the order of rows plays no part."""
    order = [c for c in ("timestamp",) if c in df.columns]
    return F.min(F.when(F.col(column).isNotNull(), F.struct(*order, column)))[column]


def compare_stations(predicted: DataFrame, stations: DataFrame | None = None, hour: int | None = None) -> DataFrame:
    """One row per station. Rows are summed first; names join the few sums.

    The predicted sum drops its fraction. It is rounded to six digits before, as the order in which
    partial sums arrive must not decide whether a sum reaches the next whole number.
    """
    if hour is not None:
        predicted = predicted.filter(F.col("hora") == hour)
    if "duracion_recorrido_mean" not in predicted.columns:
        predicted = predicted.withColumn("duracion_recorrido_mean", F.lit(0.0))
    rows = (
        with_errors(predicted)
        .groupBy("id_estacion")
        .agg(
            _earliest(predicted, "lat_estacion").alias("lat"),
            _earliest(predicted, "long_estacion").alias("lng"),
            F.sum(TARGET).alias("arribos_reales"),
            F.sum("despachos_count").alias("salidas_reales"),
            F.sum(PREDICTED).alias("predichos"),
            F.avg("error_prediccion").alias("error_prediccion"),
            F.avg("accuracy").alias("accuracy"),
            F.avg("duracion_recorrido_mean").alias("duracion"),
        )
    )
    if stations is None:
        rows = rows.withColumn("nombre_estacion", F.lit(None).cast("string"))
    else:
        rows = with_station_names(rows, stations)
    whole = F.round("predichos", SUM_DIGITS)
    return rows.select(
        "id_estacion",
        F.coalesce("nombre_estacion", F.concat(F.lit(NAME_DEFAULT), F.col("id_estacion").cast("string"))).alias("nombre_estacion"),
        F.coalesce("lat", F.lit(0.0)).alias("lat_estacion"),
        F.coalesce("lng", F.lit(0.0)).alias("lng_estacion"),
        "arribos_reales",
        "salidas_reales",
        whole.cast("bigint").alias("arribos_predichos"),
        "error_prediccion",
        "accuracy",
        (F.col("arribos_reales") + F.col("salidas_reales")).alias("total_viajes"),
        F.coalesce("duracion", F.lit(0.0)).alias("duracion_promedio"),
        F.lit(hour).cast("int").alias("hour"),
    )


def model_performance(comparison: DataFrame) -> DataFrame:
    """One row, from the station totals; figures are rounded with halves to even."""
    gap = (F.col("arribos_reales") - F.col("arribos_predichos")).cast("double")
    exact = F.count_if(F.col("error_prediccion") == 0)
    return comparison.agg(
        half_even(F.avg(F.abs(gap)), 2).alias("mae"),
        half_even(F.sqrt(F.avg(gap * gap)), 2).alias("rmse"),
        half_even(F.avg("accuracy"), 3).alias("avg_accuracy"),
        exact.alias("exact_predictions"),
        F.count("*").alias("total_stations"),
        half_even(F.try_divide(exact.cast("double"), F.count("*").cast("double")), 3).alias("exact_prediction_rate"),
    )


def peak_hours(grid: DataFrame, n: int = 3) -> DataFrame:
    """Hours with most rows; the lower hour first on a tie."""
    return grid.groupBy("hora").agg(F.count("*").alias("filas")).orderBy(F.desc("filas"), "hora").limit(n)


def result_summary(grid: DataFrame, comparison: DataFrame) -> DataFrame:
    """One row of key figures; the lists hold the 3 peak hours and the 5 busiest stations."""
    hours = peak_hours(grid).agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("filas")).alias("n"), "hora"))), lambda r: r["hora"])
    )
    top = top_stations(comparison, "total_viajes").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("total_viajes")).alias("n"), "id_estacion", "nombre_estacion"))),
            lambda r: F.struct(r["nombre_estacion"].alias("name"), (-r["n"]).alias("trips")),
        )
    )
    figures = grid.agg(
        F.count("*").alias("totalTrips"),
        F.countDistinct("id_estacion").alias("totalStations"),
        F.concat(F.to_date(F.min("timestamp")), F.lit(" to "), F.to_date(F.max("timestamp"))).alias("dateRange"),
        F.coalesce(half_even(F.avg("duracion_recorrido_mean"), 0), F.lit(0.0)).alias("avgTripDuration"),
    )
    performance = model_performance(comparison)
    return figures.withColumns(
        {
            "peakHours": hours.scalar(),
            "topStations": top.scalar(),
            "modelPerformance": performance.select(F.struct(*performance.columns)).scalar(),
            "dataPoints": comparison.agg(F.count("*")).scalar(),
        }
    )


def top_stations(comparison: DataFrame, by: str, n: int = 5) -> DataFrame:
    """Best accuracy, largest error or most trips, the smaller id first on a tie."""
    return comparison.orderBy(F.desc(by), "id_estacion").limit(n)


# Colours of good, middling and bad accuracy, the bounds between them, and a marker's size and opacity.
GOOD, MIDDLING, BAD = "#059669", "#d97706", "#dc2626"
GOOD_ABOVE, MIDDLING_ABOVE = 0.6, 0.4
RADIUS, OPACITY = (8.0, 20), (0.6, 0.4)


def marker_style(comparison: DataFrame, view: str = "comparison") -> DataFrame:
    """Map marker per station: colour band of the accuracy, size and opacity relative to the largest value."""
    real, predicted = F.col("arribos_reales"), F.col("arribos_predichos")
    value = {"real": real, "predicted": predicted}.get(view, F.greatest(real, predicted))
    band = F.when(F.col("accuracy") > GOOD_ABOVE, GOOD).when(F.col("accuracy") > MIDDLING_ABOVE, MIDDLING).otherwise(BAD)
    fill = {"real": F.lit(GOOD), "predicted": F.lit(BAD)}.get(view, band)
    largest = comparison.agg(F.max(value))
    ratio = F.when(F.col("_max") > 0, value / F.col("_max")).otherwise(F.lit(0.0))
    return (
        comparison.withColumn("_max", largest.scalar())
        .withColumns(
            {
                "fill_color": fill,
                "radius": F.lit(RADIUS[0]) + ratio * RADIUS[1],
                "fill_opacity": F.lit(OPACITY[0]) + ratio * OPACITY[1],
            }
        )
        .drop("_max")
    )
