"""Trip and user cleaning, date cuts and row filters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velogrid.functions.numbers import decimal_comma, id_number, strip_tag, thousands_int
from velogrid.operators.columns import drop_and_rename, fold_headers
from velogrid.schemas import (
    ANALYSIS_BOX,
    CATALOG_BOX,
    MAX_AGE,
    MIN_AGE,
    MIN_TRIP_SECONDS,
    TAGGED_IDS,
    TRIP_SCHEMA,
)

COORDINATES = [
    ("lat_estacion_origen", "long_estacion_origen"),
    ("lat_estacion_destino", "long_estacion_destino"),
]


#: Which file a row comes from, if the reader says so.
FILE = "_file"


def unpack_coordinates(df: DataFrame) -> DataFrame:
    """Split ``"lat,long"`` texts, for all rows of a file's column in which any row has a comma.

    A row without a comma in such a column loses its longitude. The flags come from one narrow
    scan of the latitude columns: a row per file, or one for all rows where no ``FILE`` is given.
    """
    pairs = [(lat, lng) for lat, lng in COORDINATES if lat in df.columns]
    if not pairs:
        return df
    flag = F.struct(*[F.coalesce(F.max(F.col(lat).contains(",")), F.lit(False)).alias(lat) for lat, _ in pairs]).alias("_packed")
    if FILE in df.columns:
        out = df.join(df.groupBy(FILE).agg(flag), FILE, "left")
    else:
        out = df.withColumn("_packed", df.agg(flag).scalar())
    new: dict[str, Column] = {}
    for lat, lng in pairs:
        packed = F.col(f"_packed.{lat}")
        parts = F.split(F.col(lat), ",")
        long_now = F.col(lng) if lng in df.columns else F.lit(None).cast("string")
        second = F.get(parts, F.lit(1)) if lng in df.columns else F.lit(None).cast("string")
        new[lat] = F.when(packed, F.get(parts, F.lit(0))).otherwise(F.col(lat))
        new[lng] = F.when(packed, second).otherwise(long_now)
    return out.withColumns(new).drop("_packed")


def type_trips(df: DataFrame) -> DataFrame:
    """Text columns to the trip schema, in its order; columns that are absent are skipped."""
    chosen = []
    for field in TRIP_SCHEMA.fields:
        name = field.name
        if name not in df.columns:
            continue
        c = F.col(name)
        if name in TAGGED_IDS:
            c = id_number(strip_tag(c.cast("string")))
        elif name == "duracion_recorrido":
            c = thousands_int(c.cast("string"))
        elif name.startswith(("lat_", "long_")):
            c = decimal_comma(c.cast("string"))
        elif name.startswith("fecha_"):
            c = c.try_cast("timestamp_ntz")
        chosen.append(c.alias(name))
    return df.select(*chosen)


def valid_trips(df: DataFrame, min_seconds: int = MIN_TRIP_SECONDS) -> DataFrame:
    """Long enough (unknown durations go) and with an origin; the destination may be missing."""
    if "duracion_recorrido" in df.columns:
        df = df.filter(F.col("duracion_recorrido") >= min_seconds)
    return df.filter(F.col("id_estacion_origen").isNotNull())


def clean_trips(df: DataFrame, drop=(), rename: dict[str, str] | None = None) -> DataFrame:
    """Raw text trips of one file set to typed, valid trips."""
    folded = fold_headers(drop_and_rename(df, drop, rename))
    return valid_trips(type_trips(unpack_coordinates(folded)))


def clean_users(df: DataFrame, low: int = MIN_AGE, high: int = MAX_AGE) -> DataFrame:
    """Users with an all-digit age in the range, ids as numbers."""
    text = F.trim(F.replace(F.col("edad_usuario").cast("string"), F.lit(","), F.lit("")))
    return (
        df.withColumns({"edad_usuario": text, "id_usuario": id_number(F.col("id_usuario").cast("string"))})
        .filter(F.col("edad_usuario").rlike("^[0-9]+$"))
        .withColumn("edad_usuario", F.col("edad_usuario").try_cast("int"))
        .filter(F.col("edad_usuario").between(low, high))
    )


def before_cut(column: str, year: int, month: int) -> Column:
    """Up to and including ``month`` of ``year``, as a range on the column so that scans can skip."""
    return F.col(column) < F.lit(_month_start(year, month + 1)).cast("timestamp_ntz")


def train_part(df: DataFrame, year: int = 2024, month: int = 8, column: str = "fecha_destino_recorrido") -> DataFrame:
    return df.filter(before_cut(column, year, month))


def test_part(df: DataFrame, year: int = 2024, month: int = 8, column: str = "fecha_destino_recorrido") -> DataFrame:
    """The rest of the cut year; later years belong to neither part."""
    end = F.lit(_month_start(year + 1, 1)).cast("timestamp_ntz")
    return df.filter(~before_cut(column, year, month) & (F.col(column) < end))


def _month_start(year: int, month: int) -> str:
    extra, index = divmod(month - 1, 12)
    return f"{year + extra:04d}-{index + 1:02d}-01 00:00:00"


def on_day(df: DataFrame, day: date | str, column: str = "timestamp") -> DataFrame:
    """One calendar day, as a half-open range."""
    first = date.fromisoformat(day) if isinstance(day, str) else day
    return df.filter(
        (F.col(column) >= _ntz(first.isoformat())) & (F.col(column) < _ntz((first + timedelta(days=1)).isoformat()))
    )


def time_filter(df: DataFrame, start=None, end=None, hour: int | None = None, weekday: int | None = None) -> DataFrame:
    """Optional filters on the grid; both ends of the range belong to it, Monday is 0."""
    if start:
        df = df.filter(F.col("timestamp") >= _ntz(start))
    if end:
        df = df.filter(F.col("timestamp") <= _ntz(end))
    if hour is not None:
        df = df.filter(F.col("hora") == hour)
    if weekday is not None:
        df = df.filter(F.col("dia_semana") == weekday)
    return df


def at_instants(df: DataFrame, instants: list[str], column: str = "timestamp") -> DataFrame:
    return df.filter(F.col(column).isin([_ntz(i) for i in instants]))


def _ntz(value) -> Column:
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def in_box(lat: str, lng: str, box=CATALOG_BOX) -> Column:
    return F.col(lat).between(box[0], box[1]) & F.col(lng).between(box[2], box[3])


def in_analysis_box(lat: str, lng: str) -> Column:
    return in_box(lat, lng, ANALYSIS_BOX)


def usable_coordinates(df: DataFrame, lat: str = "lat_estacion", lng: str = "lng_estacion") -> DataFrame:
    """Neither null, NaN nor zero."""
    fine = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.col(c) != 0) for c in (lat, lng)]
    return df.filter(fine[0] & fine[1])


def with_status(df: DataFrame, status: str = "all") -> DataFrame:
    return df if status == "all" else df.filter(F.col("status") == status)
