"""Readers for trip, user, catalogue and feature files."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velogrid.operators.cleaning import FILE, clean_trips
from velogrid.operators.columns import fold_headers, user_header
from velogrid.schemas import BASE_FEATURES, CATALOG_SCHEMA, DNI_COLUMN, TARGET


# Texts that stand for a missing value in CSV files.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
#: What Spark itself reads as missing.
NOT_GIVEN = [""]


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("quote", '"').option("escape", '"')


def data_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files below files and folders; names only, as many as there are files."""
    found = spark.read.format("binaryFile").load([path] if isinstance(path, str) else list(path)).select("path")
    return sorted(r[0] for r in found.collect())


def read_text_csv(spark: SparkSession, path: str | list[str], with_file: bool = False, missing: list[str] = NOT_GIVEN) -> DataFrame:
    """CSVs with headers, every column as text: headers drift, so types are set by the cleaner.

    Files are read in groups of the same header, so that columns in another order or only in some files are
    met by name. Texts in ``missing`` become null.
    ``with_file`` adds the column ``FILE`` with each row's file. Without any file this raises.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in data_files(spark, path):
        groups.setdefault(tuple(_csv(spark).csv(file).columns), []).append(file)
    if not groups:
        raise FileNotFoundError(f"no CSV files in {path}")
    parts = []
    for names, some in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = _csv(spark).schema(schema).csv(some)
        numbered = rows.select("*", F.col("_metadata.file_path").alias("_path")).toDF(*[f"_{i}" for i in range(len(names) + 1)])
        present = [F.when(~F.col(f"_{i}").isin(missing), F.col(f"_{i}")).alias(n) for i, n in enumerate(names)]
        parts.append(numbered.select(*present, *[F.col(f"_{len(names)}").alias(FILE)] * with_file))
    return union_all(parts)


def read_trips(spark: SparkSession, path: str | list[str], drop=(), rename: dict[str, str] | None = None) -> DataFrame:
    return clean_trips(read_text_csv(spark, path, with_file=True, missing=MISSING), drop, rename)


@dataclass(frozen=True)
class YearFile:
    """One year's trips with its header fixes. A year can be read and still be kept out of the union."""

    path: str
    drop: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    use: bool = True


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_years(spark: SparkSession, files: list[YearFile]) -> DataFrame:
    return union_all([read_trips(spark, f.path, f.drop, f.rename) for f in files if f.use])


def normalise_users(df: DataFrame, has_dni: bool) -> DataFrame:
    keep = [i for i, c in enumerate(df.columns) if not (has_dni and c == DNI_COLUMN)]
    names = [df.columns[i] for i in keep]
    numbered = df.toDF(*[str(i) for i in range(len(df.columns))]).select(*[F.col(str(i)) for i in keep])
    return fold_headers(numbered.toDF(*names), user_header)


def read_users(spark: SparkSession, files: dict[str, bool]) -> DataFrame:
    """User files by path; the flag says whether the file has the identity-document column."""
    users = union_all([normalise_users(read_text_csv(spark, p), dni) for p, dni in files.items()])
    if "fecha_alta" in users.columns:
        users = users.withColumn("fecha_alta", F.col("fecha_alta").try_cast("timestamp_ntz"))
    return users


def read_station_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Stations of the catalogue JSON, one row per id."""
    schema = T.StructType([T.StructField("stations", T.ArrayType(CATALOG_SCHEMA))])
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("stations"))
    return rows.withColumn("id", F.col("id").try_cast("bigint")).dropDuplicates(["id"])


def catalog_as_stations(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        F.col("id").cast("bigint").alias("id_estacion"),
        F.col("name").alias("nombre_estacion"),
        F.col("address").alias("direccion_estacion"),
        F.col("lat").alias("lat_estacion"),
        F.col("lng").alias("long_estacion"),
    )


def read_scoring_input(spark: SparkSession, path: str) -> DataFrame:
    """Raw trips or ready-made features from CSV. Which of the two it is shows in the header, so
    neither kind needs the columns of the other."""
    df = read_text_csv(spark, path)
    if "timestamp" not in df.columns:
        return df
    kinds = {"timestamp": "timestamp_ntz", "id_estacion": "bigint", TARGET: "bigint"}
    numbers = {c: "double" for c in BASE_FEATURES if c != "id_estacion"}
    cast = {c: F.col(c).try_cast(k) for c, k in {**numbers, **kinds}.items() if c in df.columns}
    return df.withColumns(cast)


def read_stage(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, column: str = "timestamp") -> DataFrame:
    """A stage table, optionally for a half-open range of dates; the range also prunes partitions."""
    df = spark.read.parquet(path)
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        at = F.lit(f"{bound} 00:00:00").cast("timestamp_ntz")
        year, month = int(bound[:4]), int(bound[5:7])
        number = F.col("anio_p") * 12 + F.col("mes_p")
        if is_start:
            df = df.filter((F.col(column) >= at) & (number >= year * 12 + month))
        else:
            df = df.filter((F.col(column) < at) & (number <= year * 12 + month))
    return df
